"""Quality rules as a short-circuit cascade.

Each rule looks at lazily computed features of one text and rejects it or not. A text is kept if no rule
rejects it, so the verdict does not depend on the order of the rules; the order only sets the cost. It is
fitted on a sample of bounded size: each rule's seconds and the share of texts that it rejects are measured,
and rules are put in order of rejections per second, counting only texts that the rules before did not reject.

Null and empty texts have no words: all counts are 0 and they are rejected. Repeated rows each get their own
row. Extra columns don't matter: only the id and the text are read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsieve.llm._shared import column_bytes, releasing, small_batches

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"


class Features:
    """Counts of one text, each made when first asked for."""

    def __init__(self, data: bytes | None):
        self.data = data or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points: all bytes but white space and continuation bytes."""
        return len(self.data.decode("utf-8", "replace")) - len(self.data) + len(self.data.translate(None, _SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.data.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside three-word windows that occur at least twice."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        first: dict[tuple, int] = {}
        if len(set(windows)) == len(windows):
            return 0
        covered = bytearray(len(w))
        for i, x in enumerate(windows):
            j = first.setdefault(x, i)
            if j != i:
                covered[i : i + 3] = covered[j : j + 3] = b"\1\1\1"
        return sum(covered)

    @cached_property
    def upper_share(self) -> float:
        text = self.data.decode("utf-8", "replace")
        letters = sum(map(str.isalpha, text))
        return sum(map(str.isupper, text)) / letters if letters else 0.0

    @cached_property
    def longest_word(self) -> int:
        return max(map(len, self.words), default=0)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Features], bool]


#: The base rules hold for every caller; the rest are conservative, so that clean texts stay.
BASE_RULES = (
    Rule("too_few_words", lambda x: x.n_words < 50),
    Rule("repeated_windows", lambda x: 100 * x.n_repeat_words > 50 * x.n_words),
)
MORE_RULES = (
    Rule("symbols", lambda x: 100 * x.n_symbols > 25 * x.n_words),
    Rule("repeated_lines", lambda x: len(x.lines) >= 4 and 100 * x.n_dup_lines > 70 * len(x.lines)),
    Rule("word_length", lambda x: x.word_chars < 2 * x.n_words or x.word_chars > 25 * x.n_words),
    Rule("shouting", lambda x: x.upper_share > 0.5),
    Rule("letters", lambda x: 2 * sum(map(str.isalpha, x.data.decode("utf-8", "replace"))) < x.word_chars),
    Rule("unbroken_run", lambda x: x.longest_word > 2000),
)


def order_rules(rules: tuple[Rule, ...], texts: list[bytes | None]) -> list[Rule]:
    """Greedy order by rejections per second among the texts that no earlier rule rejects."""
    seconds, hits = {}, {}
    for rule in rules:
        began = time.thread_time()
        hits[rule.name] = {i for i, x in enumerate(texts) if rule.rejects(Features(x))}
        seconds[rule.name] = max(time.thread_time() - began, 1e-9)
    left, out, gone = list(rules), [], set()
    while left:
        best = max(left, key=lambda r: (len(hits[r.name] - gone) / seconds[r.name], -seconds[r.name]))
        left.remove(best)
        out.append(best)
        gone |= hits[best.name]
    return out


def sample_texts(docs: DataFrame, text_col: str, rows: int) -> list[bytes | None]:
    """At most `rows` texts for the fit, those with the smallest hashes: the same whatever the order of files and rows."""
    got = docs.select(F.xxhash64(F.col(text_col)).alias("_h"), F.col(text_col).alias("_t")).orderBy("_h", "_t").limit(rows).collect()
    return [None if r["_t"] is None else r["_t"].encode() for r in got]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, counts: tuple[str, ...] = COUNTS, sample_rows: int = 400) -> DataFrame:
    """Columns: the id, the counts asked for, kept (boolean), rejected_by (the first rule that rejected) and rules_run.

    `sample_rows` bounds the sample that sets the order; every text is judged. The work is one narrow pass
    without a shuffle. rejected_by and rules_run depend on the measured order, kept does not."""
    small_batches(docs.sparkSession)
    todo = order_rules(rules, sample_texts(docs, text_col, sample_rows))
    id_type = docs.schema[id_col].dataType.simpleString()
    out = f"id {id_type}, {''.join(f'{c} long, ' for c in counts)}kept boolean, rejected_by string, rules_run int"

    @releasing
    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns: list[list] = [[] for _ in range(len(counts) + 3)]
            for data in column_bytes(part, "text"):
                x = Features(data)
                by, run = None, 0
                for run, rule in enumerate(todo, 1):
                    if rule.rejects(x):
                        by = rule.name
                        break
                for values, value in zip(columns, [*(getattr(x, c) for c in counts), by is None, by, run]):
                    values.append(value)
            types = [pa.int64()] * len(counts) + [pa.bool_(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(v, t) for v, t in zip(columns, types))], names=["id", *counts, "kept", "rejected_by", "rules_run"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(judge, out).withColumnRenamed("id", id_col)


def kept_documents(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, sample_rows: int = 400) -> DataFrame:
    """The rows of docs, with all their columns, that no rule rejects: the same verdict in one narrow pass, without a join."""
    small_batches(docs.sparkSession)
    todo = order_rules(rules, sample_texts(docs, text_col, sample_rows))

    @releasing
    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            features = map(Features, column_bytes(part, text_col))
            yield part.filter(pa.array([not any(r.rejects(x) for r in todo) for x in features], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
