import numpy as np
import pytest

from bandsieve import cli
from bandsieve.operators import detectors as D
from bandsieve.operators.stages import run_stages
from bandsieve.schema import VIDEOS
from bandsieve.sources.store import Store


def test_container():
    assert D.container(0, 0)["reasons"] == ["empty"] and D.container(5, 10)["reasons"] == ["corrupt"] and D.container(5, 5000)["decision"] == "good"
    assert D.container_stage(lambda p: 1 / 0).fn("x")["reasons"] == ["probe_fail"]


def test_camera():
    rng = np.random.default_rng(0)
    sharp = rng.integers(0, 255, (4, 12, 16, 3)).astype(np.uint8)
    assert D.camera(sharp, [0, 1, 2, 3])["decision"] == "good"
    dark = D.camera(np.zeros((40, 12, 16, 3), np.uint8), list(range(40)))
    assert dark["decision"] == "bad" and dark["reasons"] == ["black", "blur", "static"] and len(dark["hits"]) == 30
    assert D.camera(sharp[:1], [0])["med_motion"] == 1.0
    assert D.camera(sharp[:0], [])["reasons"] == ["empty"]


def test_models():
    assert D.hands([True, False, False, False, False, False], list(range(6)))["decision"] == "bad"
    assert D.phone([0.0, 0.5], [0, 1.26])["hits"] == [{"reason": "phone", "t": 1.3, "conf": 0.5}]
    got = D.scene(np.array([[1, 0, 0], [0, 1, 1], [0, 1, 0]]), [0, 1, 2], ["on_task", "looking_away", "no_workspace"])
    assert got["frac"] == {"on_task": 0.33, "looking_away": 0.67, "no_workspace": 0.0} and got["decision"] == "unsure" and len(got["hits"]) == 2


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    s = Store(spark, f"file://{tmp_path_factory.mktemp('cli')}")
    s.add_videos(spark.createDataFrame([(f"processed_v3/e/c{i}.mp4", "e", f"c{i}", None, 0.0) for i in range(6)], VIDEOS))

    def frames(path):
        i = int(path[-5])
        rng = np.random.default_rng(i)
        return (np.zeros((3, 8, 8, 3), np.uint8) if i == 0 else rng.integers(0, 255, (3, 8, 8, 3)).astype(np.uint8)), [0.0, 1.0, 2.0]

    run_stages(
        s,
        [
            D.container_stage(lambda p: (5.0, 9000.0)),
            D.camera_stage(frames),
            D.hands_stage(frames, lambda: lambda f: True),
            D.phone_stage(frames, lambda: lambda fs: [0.0] * len(fs)),
            D.scene_stage(frames, lambda: lambda fs: np.tile([[1.0, 0.0, 0.0]], (len(fs), 1)), ["on_task", "looking_away", "no_workspace"]),
        ],
    )
    vectors = D.embed(s.videos(), frames, lambda: lambda fs: fs.reshape(len(fs), -1)[:, :8].astype(float) + 1, "tiny")
    vectors.write.partitionBy("encoder").parquet(f"{s.path}/vectors")
    return s


def test_command_line(spark, store, tmp_path):
    run = lambda *a: cli.run(["--store", store.path, *a], spark)
    assert "cheap_cv" in run("funnel", "--md") and "semantic" in run("status")
    assert "FAIL" in run("verdict") and '"n_pending": 0' in run("bad", "--out", str(tmp_path / "bad"))
    assert '"persisted_verdicts"' in run("snapshot", "--out", str(tmp_path / "s.json"))
    run("eval", "bootstrap", "--gold", str(tmp_path / "gold"), "--n", "3")
    gold = tmp_path / "gold.jsonl"
    gold.write_text('{"video": "processed_v3/e/c0.mp4", "reasons": ["black"]}\n')
    assert "black" in run("eval", "score", "--gold", str(gold), "--version", "c1")
    assert "black" in run("eval", "compare")
    run("eval", "confirm")
    assert '"near_dup"' in run("explore", f"{store.path}/vectors", "--encoder", "tiny")
    (tmp_path / "r/processed_v3/x").mkdir(parents=True)
    (tmp_path / "r/processed_v3/x/new.mp4").write_bytes(b"1")
    assert run("catalog", str(tmp_path / "r")) == "1 files found" and store.videos().count() == 7
