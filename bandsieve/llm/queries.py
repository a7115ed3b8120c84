"""The queries that apply each operator to its table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsieve.llm import exact_dedup, licenses, mixing, near_dedup, pieces, quality, records, secrets, substrings, warc
from bandsieve.llm._shared import read
from bandsieve.session import ship


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is on this machine; executors have the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(ship(spark), sf_dir, "documents")
    judged = quality.apply_rules(docs)
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_rows(read(ship(spark), sf_dir, "pages"), min_revisit_bytes=0, split_bytes=8 << 20)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(read(ship(spark), sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(ship(spark), sf_dir, "documents")
    pair = secrets.train(secrets.labelled_samples(secrets.corpus_words(docs)))
    return secrets.secret_digest(secrets.scan_secrets(docs, pair))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(ship(spark), sf_dir, "documents")
    return pieces.sample_segmentations(docs, tokenizer_path("piece_bpe_32k.model"), samples=2)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read(ship(spark), sf_dir, "documents"), keep="largest")
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_record_rows(read(ship(spark), sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read(ship(spark), sf_dir, "documents"), percent=85)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (op1_quality_rules, op2_warc, op3_substring_dedup, op4_secret_scan, op5_sentencepiece, op6_exact_dedup, op7_token_records, op8_license_scan, op9_near_dedup, op10_mixing)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
 p AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 1, 1))) AS i, w FROM d),
 t AS (SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS t FROM p),
 r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM t) WHERE n > 1),
 c AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS x FROM r) GROUP BY doc_id),
 l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
 u AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
 b AS (SELECT doc_id, text, w, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(u.n_lines, 0) AS n_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
   length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS upper,
   coalesce(list_max(list_transform(w, lambda x: octet_length(encode(x)))), 0) AS longest
   FROM d LEFT JOIN u USING (doc_id) LEFT JOIN c USING (doc_id)),
 f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT (base_failed OR 100 * n_symbols > 25 * n_words OR (n_lines >= 4 AND 100 * n_dup_lines > 70 * n_lines) OR word_chars < 2 * n_words OR word_chars > 25 * n_words
  OR upper > 0.5 * letters OR 2 * letters < word_chars OR longest > 2000) AS kept
FROM f
"""

OP2_SQL = """
WITH b AS (SELECT page_id, encode(coalesce(html, '')) AS h FROM pages),
 s AS (SELECT page_id, octet_length(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS low FROM b),
 v AS (SELECT *, list_transform(range(1, 41), lambda i: strpos('0123456789abcdef', x[i]) - 1) AS nib FROM s)
SELECT page_id, payload_bytes,
 array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
  ((((nib[1 + (5 * k) // 4] << 8) + (coalesce(nib[2 + (5 * k) // 4], 0) << 4) + coalesce(nib[3 + (5 * k) // 4], 0)) >> (7 - (5 * k) % 4)) & 31)::BIGINT, 1)), '') AS payload_digest,
 CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> low THEN low END AS refers_to
FROM v
"""

OP6_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
 doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n
"""

OP9_SQL = """
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
 g AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
 p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
 e AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
 r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(root) AS c FROM r GROUP BY node) m ON m.node = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1_SQL, "op2_warc": OP2_SQL, "op6_exact_dedup": OP6_SQL, "op8_license_scan": licenses.oracle_sql(), "op9_near_dedup": OP9_SQL, "op10_mixing": mixing.ORACLE_SQL}
