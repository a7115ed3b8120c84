import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandsieve.operators import evaluate, explore, frames, reports
from bandsieve.sources import files, signing
from bandsieve.streaming.incremental import new_files, throughput

PAGE = """<?xml version="1.0"?><ListBucketResult xmlns="http://s3.amazonaws.com/doc/2006-03-01/"><IsTruncated>{more}</IsTruncated>{body}</ListBucketResult>"""


def test_catalog_and_stream(spark, tmp_path):
    for name in ("processed_v3/ego/a/clip1.mp4", "processed_v3/robot/clip2.mp4", "processed_v3/robot/notes.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    rows = {r["path"]: (r["embodiment"], r["hash"]) for r in files.catalog(spark, str(tmp_path)).collect()}
    assert rows == {"processed_v3/ego/a/clip1.mp4": ("ego", "clip1"), "processed_v3/robot/clip2.mp4": ("robot", "clip2")}
    q = new_files(spark, str(tmp_path)).writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("seen").count() == 2


def test_small_files(spark, tmp_path):
    gold = tmp_path / "gold.jsonl"
    gold.write_text('{"video": "a", "reasons": ["blur"]}\n\n{"video": "b", "reasons": []}\n{"video": "a", "reasons": ["phone"]}\n')
    assert {r["video"]: r["reasons"] for r in files.gold(spark, str(gold)).collect()} == {"a": ["phone"], "b": []}
    bands = tmp_path / "bands.json"
    assert files.load_bands(spark, str(bands))["phone"] == (0.35, 0.6)
    files.save_bands(str(bands), {"phone": (0.1, 0.9), "nope": (0, 1)})
    assert files.load_bands(spark, str(bands))["phone"] == (0.1, 0.9)
    bands.write_text("{broken")
    assert files.load_bands(spark, str(bands))["phone"] == (0.35, 0.6)
    rubric = tmp_path / "rubric.json"
    rubric.write_text(json.dumps({"task": "t", "scene": "s", "items": [{"id": "x", "label": "X", "desc": "d", "fail_if": "f", "borderline": True}]}, indent=1))
    assert files.rubric(spark, str(rubric)).first()["id"] == "x"


def test_listing(spark):
    def fetch(prefix, delimiter, token):
        if delimiter:
            return PAGE.format(more="false", body="".join(f"<CommonPrefixes><Prefix>{p}</Prefix></CommonPrefixes>" for p in ("v3/a/", "v3/b.zarr/")))
        key = lambda k, n: f"<Contents><Key>{k}</Key><Size>{n}</Size></Contents>"
        if token is None:
            return PAGE.format(more="true", body=key("v3/a/1.mp4", 5) + key("v3/a/x.txt", 9) + "<NextContinuationToken>t</NextContinuationToken>")
        return PAGE.format(more="false", body=key("v3/a/2.mp4", 7))

    listed = files.listing(spark, fetch, ["v3/"])
    assert sorted((r["key"], r["size"]) for r in listed.collect()) == [("v3/a/1.mp4", 5), ("v3/a/2.mp4", 7)]
    assert files.prefix_sizes(listed).first().asDict() == {"prefix": "v3", "objects": 2, "bytes": 12}


def test_signing():
    # The documentation's own example of a signing key.
    key = signing.signing_key("wJalrXUtnFEMI/K7MDENG+bPxRfiCYEXAMPLEKEY", "20120215", "us-east-1", "iam")
    assert key.hex() == "f4780e2d9f65fa895f9c67b32ce1baf0b0d8a43505a000a1a9e090d414db404d"
    assert "X-Amz-Signature=" in signing.presign("GET", "h.example.com", "/b/k", "A", "S", "20240101T000000Z")


def test_explore(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=16)
    v = np.concatenate((rng.normal(size=(60, 16)), base + rng.normal(scale=0.001, size=(8, 16))))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    out = explore.findings(df, 0.95)
    assert out["near_dup"]["n_clips_with_a_near_dup"] >= 7
    assert out["near_dup"]["largest_clusters"][0]["size"] >= 2
    u = v.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True) + 1e-8
    s = u @ u.T
    np.fill_diagonal(s, -9)
    small = explore.neighbours(df.repartition(3), k=3)
    got = {(r["id"], r["rank"]): r["neighbour"] for r in small.collect()}
    assert got == {(i, k + 1): int(j) for i in range(68) for k, j in enumerate(np.argsort(-s[i], kind="stable")[:3])}
    one = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert explore.neighbours(one).count() == 0


def test_prf_rules(spark):
    rows = spark.createDataFrame([(0, 0, 0), (0, 0, 2), (0, 3, 0), (2, 4, 4)], "tp int, p int, a int")
    got = [tuple(r) for r in rows.select(*evaluate.prf(F.col("tp"), F.col("p"), F.col("a")).values()).collect()]
    assert got == [(1.0, 1.0, 1.0), (0.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.5, 0.5, 0.5)]


def test_subsample():
    assert frames.subsample(0) == [] and frames.subsample(3) == [0, 1, 2] and frames.subsample(20) == [0, 3, 6, 9, 12, 15]


def test_status_and_rates(spark):
    polls = spark.createDataFrame([("a", 0.0, 0, 100), ("a", 10.0, 20, 100)], "stage string, at double, done long, total long")
    last = reports.rates(polls).orderBy("at").collect()[1]
    assert last["rate"] == pytest.approx(2.0) and last["eta"] == 40


def test_windows_on_a_stream(spark, tmp_path):
    events = spark.createDataFrame([(1, "view", 2.0)], "event_id long, event_type string, value double").withColumn("ts", F.lit("2024-01-01 00:30:00").cast("timestamp"))
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = throughput(stream).writeStream.outputMode("complete").format("memory").queryName("tp").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("tp").first()["n"] == 1
