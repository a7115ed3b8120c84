import pytest

from bandsieve.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(2, 2, "3g", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
