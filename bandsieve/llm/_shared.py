"""What the operators of this subpackage share: words, scratch tables, hashing, broadcasting."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsieve.session import remove_folder, shared_base

#: A word, as every operator here reads it.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in one Arrow batch; texts may be long, so batches are small.
BATCH_ROWS = 1000
#: A side of a join is broadcast only if a count of its rows shows at most this many.
BROADCAST_ROWS = 200_000

_MASK = (1 << 64) - 1


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of Arrow batches, and with them the memory of Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


@functools.cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release_memory() -> None:
    """Gives memory that is free, but that the allocators keep, back to the system. Idle Python workers live on beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def releasing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that releases memory before it begins, for what an earlier task has left in the worker, and when its input is worked off."""

    @functools.wraps(work)
    def worked(parts: Iterator) -> Iterator:
        release_memory()
        try:
            yield from work(parts)
        finally:
            release_memory()

    return worked


#: Folders that operators now at work have made; the innermost operator last.
_made: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path under the folder that the driver and all executors share."""
    base = shared_base(spark)
    path = f"{base if '://' in base or base.startswith('file:') else f'file://{base}'}/bandsieve-{uuid.uuid4().hex}"
    if _made:
        _made[-1].append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Writes an operator's result to the shared folder and removes all other folders that it made there."""

    @functools.wraps(make)
    def made(*args, **options) -> DataFrame:  # noqa: ANN002, ANN003
        _made.append([])
        out = None
        try:
            out = materialize(make(*args, **options))
            return out
        finally:
            paths = _made.pop()
            kept = paths.pop() if out is not None else None
            spark = SparkSession.getActiveSession()
            for path in paths:
                remove_folder(spark, path)
            if kept and _made:
                _made[-1].append(kept)

    return made


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcasts a materialized table if a count proves it small; else leaves the join to shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def hash64(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


#: Odd multipliers, one for each place in a shingle: powers of the golden ratio's 64-bit multiplier.
_PLACES = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(64)], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xorshift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


#: A byte as part of a word: lower-case A-Z only, one odd-looking 64-bit number each.
_BYTE = mix64(np.arange(256, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed at once; a longer word makes it more.
_SLICE = 1 << 20
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, _SLICE + (1 << 16))
        _powers[:] = [np.cumprod(np.array([1] + [x] * (n - 1), np.uint64), dtype=np.uint64) for x in (_BASE, _INVERSE)]
    return _powers


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a column of texts, A-Z lower-cased, and where each row's words begin and end (one more than rows).

    A word's hash is a polynomial in its bytes, so that running sums over the column's buffer give all of them without a loop."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if texts.null_count:
        return hashed_words(texts.fill_null(b""))
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    space = _SPACE[data]
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]  # rows' ends part words too
    begins[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        last = max(int(np.searchsorted(ends, begins[at] + _SLICE, "right")), at + 1)
        lo, hi = begins[at], ends[last - 1]
        power, inverse = _power_tables(int(hi - lo))
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        b, e = begins[at:last] - lo, ends[at:last] - lo
        hashes[at:last] = (sums[e] - sums[b]) * inverse[b] + (e - b).astype(np.uint64)
        at = last
    return mix64(hashes), np.searchsorted(begins, offsets, "left")


def shingles(texts: pa.Array, width: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of `width` words of each text, in order, and the rows' bounds in them. A text with fewer words has one, of the whole
    sequence; one without words, or with fewer than `least`, has none."""
    h, bounds = hashed_words(texts)
    n = np.diff(bounds)
    counts = np.where(n >= max(width, least), n - width + 1, 0)
    short = np.flatnonzero((n > 0) & (n < width) & (n >= least))
    counts[short] = 1
    out_bounds = np.concatenate(([0], np.cumsum(counts)))
    total = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for i in range(width):
        total += h[i : len(h) - width + 1 + i] * _PLACES[i]
    total = mix64(total + np.uint64(width))
    where = np.arange(out_bounds[-1]) + np.repeat(bounds[:-1] - out_bounds[:-1], counts)
    if not len(short):
        return total[where], out_bounds
    out = total[np.minimum(where, max(len(total) - 1, 0))] if len(total) else np.zeros(len(where), np.uint64)
    for k in short.tolist():
        words = h[bounds[k] : bounds[k + 1]]
        out[out_bounds[k]] = mix64(np.array([(words * _PLACES[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))], np.uint64))[0]
    return out, out_bounds


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows from row tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
