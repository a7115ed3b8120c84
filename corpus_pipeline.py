"""A training-data pipeline over documents: quality rules, exact dedup, near dedup, mixing, sampled segmentation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents, whatever other columns
there are and however they are named. run() writes each stage's rows to the shared folder and reads them back for the next. An empty table
gives empty tables. Ties are broken by doc_id. Decisions are by doc_id: rows that share one share the most favourable decision, and so do rows without one;
where a text decides (exact dedup) it is by doc_id and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsieve.llm import exact_dedup, mixing, near_dedup, pieces, quality
from bandsieve.llm._shared import materialize, read
from bandsieve.session import ship

#: Segmentations of a text are in the last stage's result; no SQL has them.
ORACLE_SQL = None


def _new(docs: DataFrame, name: str) -> str:
    """A column name like `name` that docs doesn't have, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _keep(docs: DataFrame, decisions: DataFrame, keys: dict[str, Column], repeats: str | None = None) -> DataFrame:
    """The documents that decisions name, each as many times as `repeats` says. keys: what decisions' columns are in docs."""
    times = F.max(repeats) if repeats else F.lit(1).cast("long")
    names = {k: _new(docs, f"_kept_{k}") for k in keys}
    n, copy = _new(docs, "_times"), _new(docs, "_copy")
    picked = materialize(decisions.groupBy(*[F.col(k).alias(v) for k, v in names.items()]).agg(times.alias(n)))
    on = [column.eqNullSafe(picked[names[k]]) for k, column in keys.items()]
    # Always by a shuffle: decisions are as many as documents, and the plan should be the same at every size.
    out = docs.join(picked.hint("merge"), on)
    if repeats:
        out = out.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), n)))
    return out.select(*[docs[c] for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null and empty texts have no words and go; equal rows share a fate."""
    return quality.kept_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z the row with the largest doc_id, null last. A null text counts as empty. Rows that
    repeat wholly, id and text, stay together."""
    text = F.unhex(F.sha2(F.translate(F.coalesce(docs["text"], F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256))
    groups = exact_dedup.exact_groups(docs, keep="largest").filter("kept")
    return _keep(docs, groups, {"doc_id": docs["doc_id"], "digest": text})


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.8 or more join, over any number of steps, the one with the smallest doc_id. Texts without words
    are linked with nothing and stay; so do rows without a doc_id."""
    return _keep(docs, near_dedup.near_groups(docs).filter("kept"), {"doc_id": docs["doc_id"]})


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as their source's target asks for, none more than three times; a null source is a source, and a text without words
    follows its hash."""
    return _keep(docs, mixing.mix_sources(docs).filter("repeats > 0"), {"doc_id": docs["doc_id"]}, "repeats")


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each row, with their ids; null and empty texts have one, without ids."""
    import public_tokenizers

    return pieces.sample_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), samples=2)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("sentencepiece", segment)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
