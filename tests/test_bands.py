import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bandsieve.functions import bands as B
from bandsieve.functions.stats import histogram, nearest_rank

EDGES = [("black", 0.5, "unsure"), ("black", 0.1, "unsure"), ("black", 0.51, "bad"), ("black", 0.09, "good"), ("static", 0.0019, "bad"), ("static", 0.002, "unsure"), ("static", 0.011, "good"), ("phone", 0.35, "unsure"), ("black", math.nan, "unsure"), ("static", math.nan, "unsure"), ("blur", None, None)]


def test_band_edges(spark):
    rows = spark.createDataFrame(EDGES, "signal string, v double, want string")
    for k in B.SIGNALS:
        assert all(r["got"] == r["want"] for r in rows.filter(F.col("signal") == k).withColumn("got", B.band(F.col("v"), k)).collect())


def test_worst(spark):
    cases = [("bad", "good", "bad"), ("good", "unsure", "unsure"), ("good", "good", "good"), (None, "unsure", "unsure"), (None, None, "good")]
    got = spark.createDataFrame(cases, "a string, b string, want string").withColumn("got", B.worst(F.col("a"), F.col("b"))).collect()
    assert all(r["got"] == r["want"] for r in got)


def test_overlay_refuses_crossed_bands():
    assert B.overlay({"nope": (0, 1)}) == B.DEFAULT_BANDS
    assert B.overlay({"phone": (0.1, 0.2)})["phone"] == (0.1, 0.2)
    with pytest.raises(ValueError):
        B.overlay({"phone": (0.9, 0.2)})


def test_verdict_words(spark):
    rows = spark.createDataFrame([("borderline", "BDLN"), ("fail", "FAIL"), ("ok", "PASS"), ("BDLN", "BDLN"), (None, "PASS")], "w string, want string")
    assert all(r["got"] == r["want"] for r in rows.withColumn("got", B.normalise_verdict(F.col("w"))).collect())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1, 2) | st.just(math.nan) | st.just(math.inf), min_size=1, max_size=30))
def test_histogram_and_quantile(spark, values):
    df = spark.createDataFrame([("s", v) for v in values], "k string, value double")
    bins = {r["bin"]: r["n"] for r in histogram(df, ["k"], F.lit(1.0), 10, {"n": F.lit(True)}).collect()}
    want = [0] * 10
    for v in values:
        if math.isfinite(v):
            want[min(9, max(0, math.floor(v * 10)))] += 1
    assert [bins[i] for i in range(10)] == want
    finite = sorted(v for v in values if math.isfinite(v))
    if finite:
        got = nearest_rank(spark.createDataFrame([("s", v) for v in finite], "k string, value double"), ["k"], {"p": 0.5}).first()["p"]
        assert got == pytest.approx(finite[round((len(finite) - 1) * 0.5)], abs=1e-6)
