"""Nearest neighbours, near-duplicates, outliers and clusters of embedding vectors.

Two searches. The exact one packs vectors into blocks of a fixed number of rows. A task holds one block and reads all others one by one, from the shared
folder; it makes a matrix product with each and keeps the best `k` of each row. So what is shuffled and written grows with the vectors and a task's memory
doesn't grow, but the work grows with the square. The other one
orders vectors by the signs of random projections, once for each of several tables, and compares only vectors that are near in one of these orders, in
runs of a fixed number of rows: its work grows with the vectors. Ranges of an order have equal sizes whatever the vectors, so many equal ones don't meet in
one task. What it returns are exact similarities; the tests measure how many true neighbours it finds."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandsieve.functions.stats import round_to
from bandsieve.sources.store import checkpointed

#: Vectors that are compared with each other at once.
BLOCK = 4096
#: Blocks of a file.
_FILE = 16
#: Rows of a matrix product that are looked through at once.
_ROWS = 128
#: Pairs whose similarity is computed term by term at once.
_PAIRS = 1 << 16
_EPS = 1e-8


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    sizes = set(pc.list_value_length(vectors).unique().to_pylist())
    if len(sizes) > 1:
        raise ValueError(f"vectors have several lengths: {sorted(sizes)[:5]}")
    return np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in vectors.chunks]).reshape(len(vectors), -1)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, term after term in doubles: equal vectors get equal results wherever they stand, and other engines' plain loops the same ones."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j].astype(np.float64) * b[:, j]
    return out


def _few_equal(ids: np.ndarray, rows: np.ndarray, keep: int) -> np.ndarray:
    """Which rows, in the order of ids, have fewer than `keep` equal ones under smaller ids. The others can't be among any row's keep - 1 nearest."""
    _, same = np.unique(np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, same))
    new = np.diff(same[order], prepend=-1) != 0
    step = np.cumsum(new | (np.diff(ids[order], prepend=ids[order[0]]) != 0))
    on = np.empty(len(ids), bool)
    on[order] = step - np.repeat(step[new], np.diff(np.append(np.flatnonzero(new), len(ids)))) < keep
    return on


def blocks(dealt: DataFrame, block: int, kind: str, keep: int | None = None) -> DataFrame:
    """block, ids, norms (doubles, a little above 0) and rows (a matrix of numbers of that kind) of each block of a partition of (id, v), ascending in ids.

    keep: leaves out vectors that so many smaller ids of the block have too."""

    def pack(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def one() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            held.clear()
            ids, m = table.column("id").to_numpy(), _matrix(table.column("v")).astype(kind, copy=False)
            order = np.argsort(ids, kind="stable")
            ids, m = ids[order], m[order]
            if keep and m.shape[1]:
                on = _few_equal(ids, m, keep)
                ids, m = ids[on], m[on]
            columns = {"ids": ids.astype("<i8"), "norms": np.sqrt(_dot(m, m)) + _EPS, "rows": m}
            return pa.RecordBatch.from_pydict({"block": pa.array([uuid.uuid4().int >> 65], pa.int64())} | {k: pa.array([x.tobytes()], pa.binary()) for k, x in columns.items()})

        for part in given:
            for lo in range(0, part.num_rows, block):
                held.append(part.slice(lo, block))
                if sum(x.num_rows for x in held) >= 2 * block:
                    yield one()
        if held:
            yield one()

    return dealt.mapInArrow(pack, "block long, ids binary, norms binary, rows binary")


class _Nearest:
    """The k nearest of what a block of vectors has met so far; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, rows: np.ndarray, k: int):
        self.ids, self.norms, self.rows, self.k = ids, norms, rows, k
        self.unit = rows / norms[:, None]
        self.short = self.unit.astype(np.float32)
        self.sim, self.neighbour = np.full((len(ids), k), -np.inf), np.zeros((len(ids), k), np.int64)

    def meet(self, ids: np.ndarray, norms: np.ndarray, rows: np.ndarray) -> None:
        """Products tell which pairs may be among the nearest, up to their own error; the similarities of these are then computed exactly."""
        unit = rows / norms[:, None]
        same = bool(np.isin(ids, self.ids).any())
        units = ((self.short, unit.astype(np.float32)), (self.unit, unit))
        for lo in range(0, len(self.ids), _ROWS):
            hi = min(lo + _ROWS, len(self.ids))
            for mine, theirs in units:
                kind = mine.dtype.type
                sim = mine[lo:hi] @ theirs.T
                if same:
                    sim[self.ids[lo:hi, None] == ids[None, :]] = -np.inf
                error = 4 * (unit.shape[1] + 8) * float(np.finfo(kind).eps)
                floor = np.maximum(self.sim[lo:hi, -1] - error, np.finfo(kind).min).astype(kind)
                hit = np.flatnonzero(np.fmax.reduce(sim, axis=1) >= floor)
                sim, floor = sim[hit], floor[hit]
                on = sim >= floor[:, None]
                few = 4 * self.k * (hi - lo)
                if np.count_nonzero(on) > few and len(ids) > self.k:
                    sim[np.isnan(sim)] = -np.inf
                    floor = np.maximum(floor, np.partition(sim, -self.k, axis=1)[:, -self.k] - kind(error))
                    on = sim >= floor[:, None]
                if np.count_nonzero(on) <= few:
                    break  # else very many are as near as single precision can tell
            at = np.flatnonzero(on)
            for i in range(0, len(at), _PAIRS):
                a, b = np.divmod(at[i : i + _PAIRS], len(ids))
                a = hit[a] + lo
                self._add(a, ids[b], _dot(self.rows[a], rows[b]) / self.norms[a] / norms[b])

    def _add(self, row: np.ndarray, neighbour: np.ndarray, sim: np.ndarray) -> None:
        old = np.unique(row)
        row = np.concatenate((np.repeat(old, self.k), row))
        sim, neighbour = np.concatenate((self.sim[old].ravel(), sim)), np.concatenate((self.neighbour[old].ravel(), neighbour))
        ok = np.isfinite(sim)
        row, sim, neighbour = row[ok], sim[ok], neighbour[ok]
        order = np.lexsort((neighbour, -sim, row))
        row, sim, neighbour = row[order], sim[order], neighbour[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank < self.k
        self.sim[row[best], rank[best]], self.neighbour[row[best], rank[best]] = sim[best], neighbour[best]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ok = np.isfinite(self.sim)
        return np.repeat(self.ids, self.k)[ok.ravel()], self.neighbour[ok], self.sim[ok]


def _best(a_ids: np.ndarray, a: np.ndarray, b_ids: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """id, neighbour and similarity of the k best rows of b for each of a, other than itself."""
    sim = a @ b.T
    sim[a_ids[:, None] == b_ids[None, :]] = -np.inf
    top = np.argsort(-sim, axis=1, kind="stable")[:, :k]
    s = np.take_along_axis(sim, top, 1).ravel()
    ok = np.isfinite(s)
    return np.repeat(a_ids, top.shape[1])[ok], b_ids[top].ravel()[ok], s[ok]


def _found(*parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["id", "neighbour", "sim"])


_FOUND = "id long, neighbour long, sim double"


def _exact(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    kind, spark_kind = ("<f4", "array<float>") if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else ("<f8", "array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(spark_kind).alias("v")).filter("id is not null and v is not null")
    n = rows.count()
    block = min(BLOCK, max(512, -(-n // 32)))  # a block is a task, so few vectors are parted too
    parts = max(1, -(-n // block))
    dealt = rows.repartition(parts, "id")
    every = checkpointed(blocks(dealt, block, kind, k + 1).coalesce(-(-parts // _FILE)))
    mine = blocks(dealt, block, kind).select("block", *(F.col(c).alias(f"my_{c}") for c in ("ids", "norms", "rows")))
    # The right side, a block or so, is what a task holds; the left one, a single partition, is read from the shared folder by each task as it goes, not shuffled.
    pairs = every.drop("block").coalesce(1).crossJoin(mine.hint("shuffle_replicate_nl"))

    def search(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matrices(part: pa.RecordBatch, i: int, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            ids, norms, m = (np.frombuffer(part.column(prefix + c)[i].as_buffer(), x) for c, x in (("ids", "<i8"), ("norms", "<f8"), ("rows", kind)))
            return ids, norms, m.reshape(len(ids), -1)

        held: dict[int, _Nearest] = {}
        for part in given:
            for i, number in enumerate(part.column("block").to_pylist()):
                if number not in held:
                    held[number] = _Nearest(*(x.copy() for x in matrices(part, i, "my_")), k)
                held[number].meet(*matrices(part, i, ""))
        for x in held.values():
            yield _found(x.found())

    return pairs.mapInArrow(search, _FOUND)


def _near_in_orders(vectors: DataFrame, id_col: str, vec_col: str, k: int, tables: int, run: int, seed: int) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter("id is not null and v is not null")

    def signs(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(61, -1, -1, dtype=np.int64))
        planes: np.ndarray | None = None
        for part in given:
            if not part.num_rows:
                continue
            m = np.array(part.column("v").to_pylist(), np.float64)
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((tables, m.shape[1], 62))
            m /= np.linalg.norm(m, axis=1, keepdims=True) + _EPS
            for t in range(tables):
                code = ((m @ planes[t]) > 0) @ weights
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), t, np.int32)), pa.array(code), part.column("id"), pa.array([x.tobytes() for x in m], pa.binary())], names=["t", "code", "id", "v"])

    def compare(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each run with itself and the one before; runs don't cross tables."""
        before: tuple | None = None
        held: list[pa.RecordBatch] = []

        def runs(last: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            table = pa.Table.from_batches(held).combine_chunks()
            t = table.column("t").to_numpy()
            at = 0
            while at < len(t):
                end = min(at + run, int(np.searchsorted(t, t[at], "right")))
                if end == len(t) and not last:
                    break
                yield int(t[at]), table.column("id").to_numpy()[at:end], np.frombuffer(b"".join(table.column("v")[at:end].to_pylist())).reshape(end - at, -1)
                at = end
            held[:] = table.slice(at).to_batches()

        def work(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal before
            for t, ids, m in runs(last):
                both = [_best(ids, m, ids, m, k)]
                if before and before[0] == t:
                    both += [_best(ids, m, *before[1:], k), _best(*before[1:], ids, m, k)]
                before = (t, ids, m)
                yield _found(*both)

        for part in given:
            if part.num_rows:
                held.append(part)
                if sum(x.num_rows for x in held) > 2 * run:
                    yield from work(False)
        if held:
            yield from work(True)

    coded = checkpointed(rows.mapInArrow(signs, "t int, code long, id long, v binary"))
    parts = max(1, coded.count() // (16 * run))
    dealt = coded.repartitionByRange(parts, "t", "code", "id").sortWithinPartitions("t", "code", "id")
    return dealt.mapInArrow(compare, _FOUND).distinct()


def neighbours(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, exact: bool = True, tables: int = 8, run: int = 1024, seed: int = 3) -> DataFrame:
    """id, rank (1 is nearest), neighbour, sim: the k nearest other vectors by cosine; ties go to the smaller id.

    exact=False compares in `tables` orders, each vector with at least those in its own run of `run` rows. Rows without an id or a vector are left out."""
    found = _exact(vectors, id_col, vec_col, k) if exact else _near_in_orders(vectors, id_col, vec_col, k, tables, run, seed)
    order = Window.partitionBy("id").orderBy(F.desc("sim"), "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("id", "rank", "neighbour", "sim")


def nearest(found: DataFrame) -> DataFrame:
    return found.filter("rank = 1").select("id", "neighbour", "sim")


def topk_mean(found: DataFrame) -> DataFrame:
    """id and the mean similarity of its nearest neighbours."""
    return found.groupBy("id").agg(F.avg("sim").alias("mean_sim"))


def dup_pairs(found: DataFrame, threshold: float) -> DataFrame:
    """The edges to the nearest neighbour that reach the threshold."""
    return nearest(found).filter(F.col("sim") >= threshold)


def outliers(found: DataFrame, n: int) -> DataFrame:
    """The n most isolated vectors: a bounded top-k."""
    return topk_mean(found).select("id", round_to(1 - F.col("mean_sim"), 4).alias("isolation"), "mean_sim").orderBy("mean_sim", "id").limit(n).select("id", "isolation")


def components(edges: DataFrame) -> DataFrame:
    """id and component (its smallest member) of undirected edges (a, b), by min-label rounds with pointer jumping."""
    both = checkpointed(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.select(F.col("a").alias("id"), F.col("a").alias("c")).distinct())
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("c").alias("m"))
        moved = labels.join(near, labels.id == near.a, "left").select("id", F.least("c", F.coalesce("m", "c")).alias("c"))
        jump = moved.select(F.col("id").alias("j"), F.col("c").alias("jc"))
        new = checkpointed(moved.join(jump, moved.c == jump.j, "left").select("id", F.least("c", F.coalesce("jc", "c")).alias("c")))
        changed = not new.join(labels.withColumnRenamed("c", "old"), "id").filter("c <> old").isEmpty()
        labels = new
        if not changed:
            return labels.select("id", F.col("c").alias("component"))


def clusters(edges: DataFrame, examples: int = 6, salts: int = 64) -> DataFrame:
    """component, size and its first members, of clusters with more than one. Members are ranked in salted parts first, so that a large cluster spreads."""
    members = components(edges).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    first = members.withColumn("r", F.row_number().over(Window.partitionBy("component", "salt").orderBy("id"))).filter(F.col("r") <= examples)
    few = first.groupBy("component").agg(F.slice(F.array_sort(F.collect_list("id")), 1, examples).alias("examples"))
    return few.join(sizes, "component").select("component", "size", "examples")


def findings(vectors: DataFrame, threshold: float = 0.95, top: int = 20, **cols: str) -> dict[str, Any]:
    """The summary: near-duplicates, clusters, outliers. What is collected is bounded by `top`."""
    found = checkpointed(neighbours(vectors, **cols))
    n = vectors.count()
    dups = checkpointed(dup_pairs(found, threshold))
    n_dups = dups.count()
    groups = checkpointed(clusters(dups.select(F.col("id").alias("a"), F.col("neighbour").alias("b"))))
    return {
        "n": n,
        "dup_threshold": threshold,
        "near_dup": {
            "n_clips_with_a_near_dup": n_dups,
            "rate": round(n_dups / n, 4) if n else 0.0,
            "n_clusters": groups.count(),
            "largest_clusters": [{"size": r["size"], "examples": r["examples"]} for r in groups.orderBy(F.desc("size"), "component").limit(10).collect()],
            "example_pairs": [{"a": r["id"], "b": r["neighbour"], "sim": round(r["sim"], 4)} for r in dups.orderBy("id").limit(top).collect()],
        },
        "outliers": [r.asDict() for r in outliers(found, top).collect()],
    }
