"""The registered queries on the smallest tables: against SQL where there is some, and the pipeline against its stages' promises."""

import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bandsieve.llm import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    out = con.sql(queries.oracle_sql()[name])
    assert sorted(out.columns) == columns
    places = [out.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in places) for r in out.fetchall()), key=str)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.materialize(stage(spark, docs, SF))
        assert docs.columns == columns, name
        if name != "mixing":
            assert 0 < docs.count() <= before and docs.count() == docs.select("doc_id").distinct().count()
    sizes = docs.groupBy("source").count().count()
    assert sizes > 1
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.filter("not round_trip").isEmpty() and last.filter("rank = 1").count() == docs.count()


def test_pipeline_handles_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_results_hold_the_segmentations(spark):
    from bandsieve.llm import pieces

    model = queries.tokenizer_path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    for rows in (pieces.decode_segmentations(last, model), pieces.decode_segmentations(queries.op5_sentencepiece(spark, SF).filter(F.col("doc_id").isin(list(texts))), model)):
        got = rows.collect()
        assert {r["doc_id"] for r in got} == set(texts) and all(r["text"] == texts[r["doc_id"]] for r in got)


def test_pipeline_stages_keep_odd_rows_in_order(spark):
    """Nulls in every column, empty and repeated rows, ties, and names that stages use inside."""
    long = " ".join(f"Word{i} is here" for i in range(60)) + "."
    other = " ".join(f"thing{i} was there" for i in range(60)) + "."
    rows = [(1, long, "a"), (2, long.upper(), "a"), (2, long.upper(), "a"), (3, long + " end", "b"), (4, None, "b"), (5, "", None), (None, other, None), (6, other, "c"), (6, long, "c"), (7, other + " tail", None)]
    docs = spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(1) for c in ("_times", "_copy", "_kept_doc_id", "kept", "digest", "id", "repeats")})
    ids = lambda df: sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=str)
    kept = {name: stage(spark, docs, SF) for name, stage in corpus_pipeline.STAGES[:-1]}
    assert all(df.columns == docs.columns for df in kept.values())
    assert ids(kept["quality_rules"]) == sorted([1, 3, None, 6, 6, 7], key=str)  # capitals and texts without words go
    # Equal texts: {1, 2, 2, 6 with long}, {None, 6 with other}, {4, 5}; the largest id stays, with its own text only.
    assert ids(kept["exact_dedup"]) == sorted([6, 6, 3, 5, 7], key=str)
    assert ids(kept["near_dedup"]) == sorted([1, 4, 5, None], key=str)
    times = [r[0] for r in kept["mixing"].groupBy("doc_id", "text").count().select("count").collect()]
    assert times and max(times) <= 6
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.filter("not round_trip").isEmpty() and last.filter("rank = 1").count() == len(rows)


def test_pipeline_rows_by_plain_python(spark):
    """Stages one to three on the smallest tables against sets and loops over all documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    first = corpus_pipeline.materialize(corpus_pipeline.STAGES[0][1](spark, docs, SF))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = {r[0] for r in con.sql(f"select doc_id from ({queries.OP1_SQL}) where kept").fetchall()}
    assert {r["doc_id"] for r in first.collect()} == want
    lower = lambda x: x.translate({c: c + 32 for c in range(65, 91)})
    best: dict = {}
    for i in want:
        best[lower(texts[i])] = max(i, best.get(lower(texts[i]), i))
    second = corpus_pipeline.materialize(corpus_pipeline.STAGES[1][1](spark, first, SF))
    assert {r["doc_id"] for r in second.collect()} == set(best.values())
    sets = {}
    for i in best.values():
        w = [x for x in re.split("[\x20\x09-\x0d]+", lower(texts[i])) if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    third = corpus_pipeline.STAGES[2][1](spark, second, SF)
    assert {r["doc_id"] for r in third.collect()} == {i for i in sets if top(i) == i}
