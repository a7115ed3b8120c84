"""Secret scans: fixed patterns, and character Markov models that tell random strings from ordinary identifiers.

Two Markov chains over characters, each conditioned on the two characters before, are trained from labelled strings:
one from random strings, one from ordinary identifiers. A candidate is a run of at least `min_length` token characters;
it is a secret if the log-likelihood ratio, per character, is over the threshold for its length, fitted on held-out labelled strings. Every
candidate is scored, whatever its characters. Ordinary strings are plain words, names made of words, paths, numbers, dates and rules of
one character, so numbers alone are ordinary. The base patterns' spans always stay; the models add spans of kind "random" where no base span lies.

Null and empty texts have no spans. Repeated rows each get their own row. Extra columns don't matter.
Spans count code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsieve.llm._shared import small_batches

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ASSIGN_WORD = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")

#: Characters of candidates; every other character has one class of its own.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CLASS = np.full(128, len(ALPHABET), np.int64)
_CLASS[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
_N = len(ALPHABET) + 2  # and one for the string's start, which \x7f stands for
_CLASS[127] = _N - 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the base patterns."""
    out = []
    if _ASSIGN_WORD.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


#: Lengths at which a new threshold begins: means over longer strings spread less.
LENGTHS = (0, 20, 28, 44)


@dataclass(frozen=True)
class MarkovPair:
    """ratio[i, j, k]: log-likelihood of class k after i, j among random strings, less that among ordinary ones; a threshold for each of LENGTHS."""

    ratio: np.ndarray
    thresholds: tuple[float, ...]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Mean log-likelihood ratio per character of each text, all in one pass."""
        if not texts:
            return np.empty(0)
        starts = "\x7f\x7f"
        c = _CLASS[np.frombuffer((starts + starts.join(texts)).encode("ascii", "replace"), np.uint8)]
        size = np.array([len(x) for x in texts])
        first = np.cumsum(size + 2) - size  # each text's first character
        total = np.concatenate(([0.0], np.cumsum(self.ratio[c[:-2], c[1:-1], c[2:]], dtype=np.float64)))
        return (total[first - 2 + size] - total[first - 2]) / np.maximum(size, 1)

    def score(self, text: str) -> float:
        return float(self.scores([text])[0])

    def secret(self, texts: list[str]) -> np.ndarray:
        limits = np.array(self.thresholds)[np.searchsorted(LENGTHS, [len(x) for x in texts], "right") - 1]
        return self.scores(texts) > limits


def _chain(strings: list[str]) -> np.ndarray:
    """Log-probabilities of a chain of order two, backed off to orders one and zero."""
    n = np.zeros((_N, _N, _N))
    for x in strings:
        c = np.concatenate(([_N - 1, _N - 1], _CLASS[np.frombuffer(x.encode("ascii", "replace"), np.uint8)]))
        np.add.at(n, (c[:-2], c[1:-1], c[2:]), 1)
    zero = (n.sum((0, 1)) + 0.5) / (n.sum() + 0.5 * _N)
    one = (n.sum(0) + 4 * zero) / (n.sum(0).sum(-1, keepdims=True) + 4)
    two = (n + 8 * one) / (n.sum(-1, keepdims=True) + 8)
    return np.log(two)


def train(samples: list[tuple[str, int]]) -> MarkovPair:
    """Trains on labelled strings (1 random, 0 ordinary); every fifth is held out to set the thresholds.

    Each is the score that at most one in a thousand held-out ordinary strings of its lengths (at least one) passes, but at least 0.2 nats a character."""
    fit, held = [x for i, x in enumerate(samples) if i % 5], samples[::5]
    ratio = _chain([x for x, y in fit if y]) - _chain([x for x, y in fit if not y])
    pair, thresholds = MarkovPair(ratio, (0.0,) * len(LENGTHS)), []
    for lo, hi in zip(LENGTHS, (*LENGTHS[1:], 1 << 62)):
        ordinary = np.sort(pair.scores([x for x, y in held if not y and lo <= len(x) < hi]))[::-1]
        thresholds.append(max(0.2, float(ordinary[min(len(ordinary) // 1000, len(ordinary) - 1)]) + 0.05) if len(ordinary) else 0.2)
    return MarkovPair(ratio, tuple(thresholds))


def random_strings(rng: random.Random, n: int) -> list[str]:
    """Random keys over common alphabets, those of one case included."""
    letters, digits = ALPHABET[:52], ALPHABET[52:62]
    lower, upper = ALPHABET[26:52], ALPHABET[:26]
    alphabets = (letters + digits, letters + digits + "+/", letters + digits + "_-", lower + digits, upper + digits, upper + "234567", "0123456789abcdef", "0123456789ABCDEF", letters, lower, upper)
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 64))) for _ in range(n)]


def ordinary_strings(rng: random.Random, n: int, words: list[str]) -> list[str]:
    """Words, names made of words, paths, numbers, dates and rules of one character, as they are met in ordinary texts."""
    words = sorted({w for w in words if w.isascii() and w.isalpha()}) or ["value", "name", "index", "count", "table", "reader", "writer", "config"]
    out = []
    while len(out) < n:
        parts = [rng.choice(words) for _ in range(rng.randint(1, 4))]
        while sum(map(len, parts)) < 16:
            parts.append(rng.choice(words))
        number = str(rng.randint(0, 10 ** rng.randint(1, 6)))
        style = rng.randrange(12)
        if style < 8:
            x = ("_".join(parts).lower(), "_".join(parts).upper(), "".join(p.capitalize() for p in parts), "-".join(parts).lower(), "/".join(parts), "".join(parts).lower(), "".join(parts).upper(), "".join(parts).capitalize())[style]
        elif style == 8:
            x = rng.choice(("", "_", "-")).join([*parts, number])
        elif style == 9:
            x = "".join(rng.choices("0123456789", k=rng.randint(16, 40)))
        elif style == 10:
            x = f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}" + rng.choice(("", "-", "/")) + rng.choice(parts) + "-" + number.zfill(6)
        else:
            x = rng.choice("-=_+/" + ALPHABET[:62]) * rng.randint(16, 60)
        out.append(x[:80])
    return out


def labelled_samples(words: list[str], n: int = 4000, seed: int = 11) -> list[tuple[str, int]]:
    """Labelled strings: random keys, and ordinary strings with a corpus's words. n bounds the strings of either label."""
    rng = random.Random(seed)
    out = [(x, 1) for x in random_strings(rng, n)] + [(x, 0) for x in ordinary_strings(rng, n, words)]
    rng.shuffle(out)
    return out


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 200) -> list[str]:
    """Words of at most `rows` texts, those with the smallest hashes of id and text, for the ordinary strings; long words and words with digits are left out."""
    got = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("_h"), F.col(text_col).alias("_t")).orderBy("_h", "_t").limit(rows).collect()
    return [w.strip(".,;:!?") for r in got for w in (r["_t"] or "").split() if 2 <= len(w) <= 24]


def _free(base: list[tuple[int, int, int]], candidates: list[re.Match]) -> list[re.Match]:
    """Candidates that no base span touches; both are in order of their starts."""
    ends, out, i, reach = sorted((s, e) for s, _, e in base), [], 0, -1
    for m in candidates:
        while i < len(ends) and ends[i][0] < m.end():
            reach = max(reach, ends[i][1])
            i += 1
        if reach <= m.start():
            out.append(m)
    return out


def find_secrets(texts: list[str], pair: MarkovPair) -> list[list[tuple[int, int, int]]]:
    """(start, kind's place, end) of each text's spans, in order; the candidates of all texts are scored together."""
    found = [base_spans(x) for x in texts]
    free = [_free(base, list(_CANDIDATE.finditer(x))) for base, x in zip(found, texts)]
    matches = [(i, m) for i, ms in enumerate(free) for m in ms]
    for (i, m), is_secret in zip(matches, pair.secret([m[0] for _, m in matches]).tolist() if matches else []):
        if is_secret:
            found[i].append((m.start(), 3, m.end()))
    return [sorted(x) for x in found]


def scan_secrets(docs: DataFrame, pair: MarkovPair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id and spans, an array of (kind, start, end). One narrow pass; the models are a few MB."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((pair.ratio.astype(np.float32), pair.thresholds))

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = MarkovPair(*shared.value)
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for part in parts:
            found = [[(KINDS[k], s, e) for s, k, e in x] for x in find_secrets([x or "" for x in part.column("text").to_pylist()], own)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([[dict(zip(("kind", "start", "end"), y)) for y in x] for x in found], pa.list_(span))], names=["id", "spans"])

    out = f"id {id_type}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, out).withColumnRenamed("id", id_col)


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts and digests of spans, from scan_secrets' rows."""
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select(
        id_col,
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(F.array_join(F.transform(base, one), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", one), ",").alias("spans"),
    )
