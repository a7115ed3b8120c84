"""Search without all pairs, quantiles by ranges, small scalars, clip details, gates and the command line."""

import json
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bandsieve import cli
from bandsieve.functions import text
from bandsieve.functions.stats import nearest_rank
from bandsieve.operators import cascade, evaluate, explore, reports
from bandsieve.operators.stages import Stage, run_stages
from bandsieve.queries import _SIM
from bandsieve.schema import EVAL, RESULTS, RUBRIC, VERDICT, VIDEOS
from bandsieve.sources import files
from bandsieve.sources.store import Store

CLIPS = [(f"processed_v3/ego/clip{i:03d}.mp4", "ego", f"clip{i:03d}", None, 0.0) for i in range(12)]


def fake_fetch(key):
    if "lost" in key:
        raise OSError(key)
    return key.encode()


def verdict(**fields):
    return tuple(fields.get(f.name) for f in VERDICT.fields)


STAGES = [
    Stage("meta", "c1", lambda p: {"decision": "good", "bad": False, "reasons": []}),
    Stage("cheap_cv", "c1", lambda p: {"decision": "unsure" if "00" in p else "good", "bad": False, "reasons": []}),
    Stage("vlm", "cap", lambda p: {"bad": True, "verdict": "FAIL", "reasons": ["phone"]}),
]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((60, 24))
    v = np.concatenate([centres[i % 60] + 0.3 * rng.standard_normal(24) for i in range(3000)]).reshape(3000, 24)
    v[100:140] = v[100]  # equal vectors
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(None, v[0].tolist()), (9999, None)], "vec_id long, embedding array<double>").repartition(4), v


def test_search_against_all_pairs(vectors):
    df, v = vectors
    w = v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-8)
    sim = w @ w.T
    np.fill_diagonal(sim, -np.inf)
    want = np.argsort(-sim, axis=1, kind="stable")[:, :5]
    for exact, least in ((True, 1.0), (False, 0.9)):
        got = {}
        for r in explore.neighbours(df, k=5, exact=exact, run=128).collect():
            assert math.isclose(r["sim"], sim[r["id"], r["neighbour"]], abs_tol=1e-9)
            got.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
        assert set(got) == set(range(3000)) and all(sorted(x) == [1, 2, 3, 4, 5] for x in got.values())
        # Equal similarities may be named by any of the equal vectors.
        hit = sum(sim[i, got[i][k + 1]] >= sim[i, want[i, k]] - 1e-9 for i in range(3000) for k in range(5))
        assert hit >= least * 15000


def test_exact_search_sends_on_only_the_nearest(vectors):
    """One block after the other is met inside a task: k rows a vector leave it, not k for each pair of blocks, and no block is shuffled once a partner."""
    df, _ = vectors
    found = explore._exact(df, "vec_id", "embedding", 5)
    assert found.count() == 3000 * 5
    pairs = explore.neighbours(df, k=5)._jdf.queryExecution().executedPlan().toString()
    assert pairs.count("Exchange") == 3  # the table's own, one of the vectors, one of what was found
    assert "CartesianProduct" in pairs


def test_exact_search_breaks_ties_like_sql(spark, monkeypatch):
    """Equal, scaled, nearly equal and zero vectors in many blocks, and ids that repeat: the same rows as the SQL's, to the last bit."""
    monkeypatch.setattr(explore, "BLOCK", 100)
    rng = np.random.default_rng(1)
    v = rng.standard_normal((600, 64)).astype(np.float32)
    v[200:400], v[400:420], v[420:425] = v[3], 2 * v[5], 0
    v[430:480] = v[7] * (1 + 1e-7 * rng.standard_normal((50, 64))).astype(np.float32)
    ids = rng.permutation(600)
    ids[::60] //= 2
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<float>").repartition(3)
    con = duckdb.connect()
    con.register("given", pa.table({"vec_id": ids, "embedding": pa.array(list(v), pa.list_(pa.float32()))}))
    con.sql("create view embeddings as select * from given")
    want = con.sql(_SIM + " SELECT id, rank, neighbour, sim FROM k").fetchall()
    assert sorted(map(tuple, explore.neighbours(df).collect())) == sorted(want)
    with pytest.raises(Exception, match="several lengths"):
        explore.neighbours(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>").coalesce(1)).count()


def test_clusters_have_their_first_members(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 300)] + [(500, 501)], "a long, b long")
    got = {r["component"]: (r["size"], r["examples"]) for r in explore.clusters(edges, examples=6).collect()}
    assert got == {0: (300, [0, 1, 2, 3, 4, 5]), 500: (2, [500, 501])}


def test_quantiles_by_ranges(spark):
    rng = random.Random(2)
    data = {"a": [rng.gauss(0, 1) for _ in range(501)], "b": [1.0] * 7, "c": [rng.randint(0, 5) * 1.0 for _ in range(40)], "d": [float("inf"), -1.0, float("-inf"), 2.0, 1e300]}
    df = spark.createDataFrame([(k, v) for k, x in data.items() for v in x] + [("a", None)], "k string, value double")
    fractions = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    for cells in (1, 16, 4096):
        got = {r["k"]: r for r in nearest_rank(df, ["k"], fractions, cells).collect()}
        for k, x in data.items():
            for name, f in fractions.items():
                at = (len(x) - 1) * f
                place = int(at) + (at - int(at) > 0.5 or at - int(at) == 0.5 and int(at) % 2 == 1)
                value = sorted(x)[place]
                assert math.isinf(value) or math.isclose(got[k][name], value, abs_tol=1e-6, rel_tol=1e-9), (k, name, cells)


def test_scalars(spark):
    row = spark.range(1).select(
        text.pts_times(F.lit("n:0 pts:0 pts_time:0.04 x\nn:1 pts_time:12 y")).alias("pts"), text.pts_times(F.lit(None).cast("string")).alias("none"),
        text.even_times(F.lit(10.0), 4).alias("even"), text.even_times(F.lit(0.0), 4).alias("no_even"),
        text.clamped(F.lit(-1.0), F.lit(30.0), F.lit(20.0)).alias("all"), text.clamped(F.lit(25.0), F.lit(5.0), F.lit(20.0)).alias("turned"), text.clamped(F.lit(0.0), F.lit(1.0), F.lit(0.0)).alias("nothing"),
        text.step(F.lit(0), -1, F.lit(5)).alias("back"), text.step(F.lit(0), 1, F.lit(0)).alias("nowhere"),
        text.percent(F.lit(1), F.lit(8)).alias("pct"), text.percent(F.lit(0), F.lit(0)).alias("pct0"),
        *[text.human_bytes(F.lit(n)).alias(f"b{i}") for i, n in enumerate((999, 1500, 2_500_000_000))],
        *[text.human_seconds(F.lit(s)).alias(f"s{i}") for i, s in enumerate((12.9, 450.0, 7500.0, None))],
    ).first()
    assert row["pts"] == [0.04, 12.0] and row["none"] == [] and row["even"] == [1.25, 3.75, 6.25, 8.75] and row["no_even"] == []
    assert tuple(row["all"]) == (0.0, 20.0, 0.0, 100.0) and tuple(row["turned"]) == (20.0, 20.0, 100.0, 100.0) and row["nothing"] is None
    assert row["back"] == 4 and row["nowhere"] is None and row["pct"] == "12.5%" and row["pct0"] == "0.0%"
    assert [row["b0"], row["b1"], row["b2"]] == ["999 B", "1.5 kB", "2.5 GB"] and [row[f"s{i}"] for i in range(4)] == ["12s", "7m30s", "2h05m", None]


def test_one_clip_in_full(spark):
    hits = [("phone", 9.0, 0.5), ("phone", 3.0, 0.9)]
    rows = [
        ("a", "cheap_cv", "c1", verdict(decision="good", hits=[]), 0.0, 1.0),
        ("a", "objects", "c1", verdict(decision="bad", hits=hits), 0.0, 2.0),
        ("a", "vlm", "cap", verdict(bad=True, verdict="FAIL", rubric=[("phone", False), ("hands", True)], judge_note="n"), 0.0, 3.0),
        ("a", "verdict", "v1", verdict(verdict="FAIL"), 0.0, 4.0),
        ("b", "cheap_cv", "old", verdict(decision="good", hits=[("blur", 1.0, None)]), 0.0, 1.0),
    ]
    results = spark.createDataFrame(rows, RESULTS)
    items = spark.createDataFrame([(0, "hands", "Hands"), (1, "phone", "Phone"), (2, "light", "Light")], "ord int, id string, label string")
    got = reports.episode(results, "a", items=items)
    assert got["verdict"] == "FAIL" and [h["t"] for h in got["hits"]] == [3.0, 9.0] and got["judge"]["judge_note"] == "n"
    assert [(x["id"], x["passed"], x["first_t"]) for x in got["rubric"]] == [("hands", True, None), ("phone", False, 3.0), ("light", None, None)]
    assert got["integrity"] == {"tiers_run": ["cheap_cv", "objects", "vlm"], "versions": {"cheap_cv": "c1", "objects": "c1", "vlm": "cap"}}
    wide = {r["id"]: (r["path"], r["passed"], r["first_t"]) for r in reports.rubric_rows(results, items).collect()}
    assert wide == {"hands": ("a", True, None), "phone": ("a", False, 3.0), "light": ("a", None, None)}
    assert not reports.snapshot_state(results).first()[0]
    old = results.filter("path = 'b'")
    assert reports.snapshot_state(old).first()[0] and not reports.snapshot_state(results.limit(0)).first()[0]
    assert [x["stage"] for x in reports.episode(old, "b")["rungs"]] == ["cheap_cv"] and reports.episode(old, "z")["rungs"] == []


def test_wide_comparison(spark):
    history = spark.createDataFrame([("s", "v1", "blur", 1.0, 1.0, 0.5, 3, 1.0), ("s", "v2", "blur", 1.0, 1.0, 0.7, 3, 1.0), ("s", "v2", "phone", 1.0, 1.0, 0.9, 3, 1.0)], EVAL)
    got = {r["version"]: (r["blur"], r["phone"]) for r in evaluate.compare_wide(history, "s", ["blur", "phone"]).collect()}
    assert got == {"v1": (0.5, None), "v2": (0.7, 0.9)}


def test_a_stage_of_ones_own_has_a_gate(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.add_videos(spark.createDataFrame(CLIPS, VIDEOS))
    own = Stage("own", "v1", lambda p: {"bad": False}, gate=lambda results: results.filter("stage = 'cheap_cv' and verdict.decision = 'good'").select("path"))
    done = run_stages(store, [*STAGES[:2], own])
    assert done["own"] == sum("00" not in c[0] for c in CLIPS) > 0


def test_command_line_runs_stages_and_the_judge(spark, tmp_path):
    store = f"file://{tmp_path}/store"
    Store(spark, store).add_videos(spark.createDataFrame(CLIPS, VIDEOS))
    go = lambda *args: cli.run(["--store", store, *args], spark)
    assert json.loads(go("run", "--stages", "tests.test_more:STAGES", "--stage", "meta", "--limit", "5")) == {"meta": 5}
    assert json.loads(go("run", "--stages", "tests.test_more:STAGES")) == {"meta": 7, "cheap_cv": 12, "vlm": 10}
    assert json.loads(go("judge", "--stages", "tests.test_more:STAGES")) == {"vlm": 0}
    assert json.loads(go("judge", "--stages", "tests.test_more:STAGES", "--sample", "1")) == {"vlm": 1}
    assert json.loads(go("bad", "--min", "2"))["n_confirmed_bad"] == 0


def test_download_takes_what_is_missing(spark, tmp_path):
    listing, folder = f"file://{tmp_path}/listing", f"file://{tmp_path}/data"
    spark.createDataFrame([("a/one.mp4", 9), ("a/two.mp4", 9), ("b/lost.mp4", 4)], "key string, size long").write.parquet(listing)
    (tmp_path / "data/a").mkdir(parents=True)
    (tmp_path / "data/a/two.mp4").write_bytes(b"")
    assert cli.run(["--store", f"file://{tmp_path}/s", "download", listing, folder, "--fetch", "tests.test_more:fake_fetch"], spark) == "2 fetched, 1 still missing"
    assert cli.run(["--store", f"file://{tmp_path}/s", "download", listing, folder, "--fetch", "tests.test_more:fake_fetch"], spark) == "0 fetched, 1 still missing"
    got = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in files.file_digests(spark, folder).collect()}
    assert set(got) == {"one.mp4", "two.mp4"} and all(len(x) == 64 for x in got.values())
