"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct word shingles (the whole sequence if it has fewer words). Of each of `registers` hash
functions a sketch keeps the truncated minimum: with x the smallest hash as an exponential variable, the register is
floor(OFFSET - log_base(x)), held within bounds. Registers of a union are the maxima, and two sets' registers agree
with a probability that rises with their similarity.

1. Documents with equal sets form a class (by a 128-bit digest of the sorted set, which names it); a class is compared through one
   member, so copies are never expanded into pairs. Rows that share an id join their classes.
2. Registers are cut into bands; classes that agree in all registers of a band share a bucket. In each bucket every class is
   compared with the bucket's smallest. A candidate's similarity is first estimated jointly: the likelihood of the numbers of
   registers that are equal, larger and smaller is maximised over the Jaccard similarity. Where even a
   generous upper end of the estimate is below the threshold, the pair is dropped; the others are verified on full sets.
3. Buckets that still hold several components compare their members once more with the member most similar to the
   smallest, which in a family of edited copies is the least edited one.
4. Members that are still outside of their bucket's main component are compared with all members of the bucket, exactly: both are cut into
   tiles of bounded size, a tile's intersections are one matrix product inside a task, and only links that join components leave it.
   So a link between two classes that are both unlike the stars' centres is not lost, and pairs are never expanded into rows.

Joins on classes and buckets are of large tables, so adaptive execution splits a hot key's rows; what a class has found goes back to its rows
by partition and digest, so a third of all rows with one text still spread over all tasks.

Null, empty and blank texts have empty sets, n_shingles 0, and are linked with nothing. Repeated rows with equal ids, whatever their texts,
fall together. A null id is left as a document of its own. Extra columns don't matter: only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsieve.llm._shared import broadcast_if_small, materialize, mix64, releasing, shingles, small_batches, tidy
from bandsieve.llm.components import components

#: Base of the registers' scale; the smaller, the finer.
BASE = 1.05
#: Registers hold 0..LAST in two bytes: minima down to BASE**-LAST.
LAST = 2000
#: Added to all registers, so that no minimum, however large, is cut off at 0.
OFFSET = 101
_STEP = 1 << 16
#: Members of a bucket that meet in one task, on either side.
TILE = 256


def _functions(registers: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, registers, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, registers, np.uint64)


def registers_of(sets: list[np.ndarray], mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The sketches of non-empty sets of 64-bit hashes: a row of uint16 registers each, merged with np.maximum."""
    sizes = np.array([len(x) for x in sets])
    low = np.full((len(sets), len(mult)), 0xFFFFFFFF, np.uint64)
    at = 0
    while at < len(sets):
        # As many whole sets as fit in a step, one at least; of a large one, part by part.
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), _STEP, "right")))
        folded = mix64(np.concatenate(sets[at : at + n])) >> np.uint64(16)
        starts = np.cumsum(sizes[at : at + n]) - sizes[at : at + n]
        for i in range(0, len(folded), _STEP) if n == 1 else (0,):
            part = folded[i : i + _STEP] if n == 1 else folded
            for k in range(len(mult)):
                np.minimum(low[at : at + n, k], np.minimum.reduceat((part * mult[k] + add[k]) >> np.uint64(32), starts), out=low[at : at + n, k])
        at += n
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32)
    return np.clip(np.floor(OFFSET - np.log(x) / math.log(BASE)), 0, LAST).astype(np.uint16)


def joint_estimate(equal: np.ndarray, above: np.ndarray, below: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, z: float) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood Jaccard similarity from register comparisons, and its upper end z deviations up.

    With u and v the shares of the union that only the first and only the second set have, a register of
    the first is larger with probability p(u, v) = 1 - log_b-interpolation; sets' sizes are known, so the similarity is the only unknown."""
    j = np.linspace(0, 1, 201)[None, :]
    a, b = size_a[:, None].astype(float), size_b[:, None].astype(float)
    top = np.minimum(a, b) / np.maximum(a, b)
    j = j * top
    union = (a + b) / (1 + j)
    u, v = np.clip((union - b) / union, 0, 1), np.clip((union - a) / union, 0, 1)
    interpolate = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)
    p, q = interpolate(u), interpolate(v)
    e = np.clip(1 - p - q, 1e-12, 1)
    ll = equal[:, None] * np.log(e) + above[:, None] * np.log(np.maximum(p, 1e-12)) + below[:, None] * np.log(np.maximum(q, 1e-12))
    best = ll.argmax(1)
    rows = np.arange(len(best))
    est = j[rows, best]
    m = np.maximum(equal + above + below, 1)
    return est, est + z * np.sqrt(np.maximum(est * (1 - est), 0.25 / m) / m)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, registers: int, seed: int) -> DataFrame:
    """id, part (the partition that read the row), n_shingles, set_digest (binary, null for empty sets) and sketch (binary, two bytes a register)."""
    mult, add = _functions(registers, seed)
    id_type = docs.schema[id_col].dataType.simpleString()

    @releasing
    def sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = _sets(part.column("text"), width)
            n, digest = list(map(len, found)), list(map(_digest, found))
            made = iter(registers_of([s for s in found if len(s)], mult, add).astype("<u2"))
            rows = [next(made).tobytes() if len(s) else None for s in found]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("part"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(rows, pa.binary())], names=["id", "part", "n_shingles", "set_digest", "sketch"])

    rows = docs.select(F.col(id_col).alias("id"), F.spark_partition_id().alias("part"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sketch, f"id {id_type}, part int, n_shingles long, set_digest binary, sketch binary")


def _sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted."""
    hashes, bounds = shingles(texts, width)
    return [np.unique(x) for x in np.split(hashes, bounds[1:-1])]


def _digest(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """d and shingles (binary, sorted 64-bit hashes) of the wanted classes (id of a member, d the set's digest).

    An id may have several texts: only those with the class's set are taken."""

    @releasing
    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = _sets(part.column("text"), width)
            on = [i for i, (x, d) in enumerate(zip(found, part.column("d").to_pylist())) if _digest(x) == d]
            yield pa.RecordBatch.from_arrays([part.column("d").take(pa.array(on, pa.int64())), pa.array([found[i].tobytes() for i in on], pa.binary())], names=["d", "shingles"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(broadcast_if_small(wanted), "id")
    return rows.mapInArrow(sets, "d binary, shingles binary").dropDuplicates(["d"])


def _likely(pairs: DataFrame, percent: int, z: float) -> DataFrame:
    """Pairs (a, b with sketches) whose joint estimate may reach the threshold."""

    @releasing
    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            grid = [np.frombuffer(b"".join(part.column(c).to_pylist()), "<u2").reshape(part.num_rows, -1).astype(np.int32) for c in ("sketch_a", "sketch_b")]
            n = [part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n_a", "n_b")]
            equal, above = (grid[0] == grid[1]).sum(1), (grid[0] > grid[1]).sum(1)
            _, high = joint_estimate(equal, above, grid[0].shape[1] - equal - above, *n, z)
            ok = (high * 100 >= percent) & (100 * np.minimum(*n) >= percent * np.maximum(*n))
            yield part.select(["a", "b"]).filter(pa.array(ok))

    return pairs.mapInArrow(keep, "a binary, b binary")


def _verified(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """a, b, sim, linked: exact similarity of pairs; linked if 100 * intersection >= percent * union."""
    pairs = materialize(pairs.distinct())
    sets = sets_of(pairs.select(F.col("a").alias("d")).union(pairs.select(F.col("b").alias("d"))).distinct())
    left = pairs.join(sets.select(F.col("d").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = left.join(sets.select(F.col("d").alias("b"), F.col("shingles").alias("set_b")), "b").select("a", "b", "set_a", "set_b")

    @releasing
    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sim, ok = [], []
            for x, y in zip(part.column("set_a").to_pylist(), part.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                union = len(np.union1d(x, y))
                common = len(x) + len(y) - union
                sim.append(common / union)
                ok.append(100 * common >= percent * union)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(sim, pa.float64()), pa.array(ok, pa.bool_())], names=["a", "b", "sim", "linked"])

    return materialize(both.mapInArrow(check, "a binary, b binary, sim double, linked boolean"))


def intersections(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by products of membership matrices."""
    values, where, counts = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    number = np.cumsum(counts > 1) - 1  # values of one set only are left out
    on = counts[where] > 1
    rows, cols = rows[on], number[where[on]]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int((counts > 1).sum()), columns):
        inside = (cols >= lo) & (cols < lo + columns)
        m = np.zeros((len(left) + len(right), columns), np.float32)
        m[rows[inside], cols[inside] - lo] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return np.rint(out).astype(np.int64)


def join_tile(u: list[tuple], m: list[tuple], percent: int) -> list[tuple]:
    """Links between (id, component, set) of u and of m that join different components: a spanning forest of the tile's links."""
    common = intersections([x[2] for x in u], [x[2] for x in m])
    n_u, n_m = np.array([len(x[2]) for x in u])[:, None], np.array([len(x[2]) for x in m])[None, :]
    root: dict = {}

    def find(x):  # noqa: ANN001, ANN202
        while x in root:
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(100 * common >= percent * (n_u + n_m - common))):
        a, b = find(u[i][1]), find(m[j][1])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((u[i][0], m[j][0]))
    return out


def _tiled(inside: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links (a, b) of members outside of their bucket's main component (bucket, rep, component, main) with any member."""
    n = materialize(inside.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("component") != F.col("main")).alias("u")))
    rows = inside.join(broadcast_if_small(n), "bucket")
    blocks = lambda c: F.ceil(F.col(c) / TILE).cast("int")
    own = lambda c: F.pmod(F.xxhash64("rep", F.lit(c)), blocks(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    left = rows.filter("component <> main").select("bucket", own("u").alias("i"), every("m").alias("j"), "rep", "component", F.lit(True).alias("is_u"))
    right = rows.select("bucket", every("u").alias("i"), own("m").alias("j"), "rep", "component", F.lit(False).alias("is_u"))
    sets = sets_of(inside.select(F.col("rep").alias("d")).distinct())
    tiles = left.union(right).join(sets.withColumnRenamed("d", "rep"), "rep")

    def work(pdf):  # noqa: ANN001, ANN202
        import pandas as pd

        rows = [(r, c, np.frombuffer(s, np.uint64)) for r, c, s in zip(pdf["rep"].tolist(), pdf["component"].tolist(), pdf["shingles"])]
        is_u = pdf["is_u"].tolist()
        u, m = [x for x, y in zip(rows, is_u) if y], [x for x, y in zip(rows, is_u) if not y]
        return pd.DataFrame(join_tile(u, m, percent) if u and m else [], columns=["a", "b"])

    return materialize(tiles.groupBy("bucket", "i", "j").applyInPandas(work, "a binary, b binary").distinct())


def _mixed(held: DataFrame, comp: DataFrame) -> DataFrame:
    """rep, bucket, low, component, main of the members of buckets with several components; main is the largest one there."""
    rows = materialize(held.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")).select("rep", "bucket", "low", "component"))
    sizes = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("several"), F.max_by("component", F.struct("n", "component")).alias("main")).filter("several > 1")
    return materialize(rows.join(broadcast_if_small(materialize(main.select("bucket", "main"))), "bucket").select("rep", "bucket", "low", "component", "main"))


@tidy
def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, bands: int = 16, rows: int = 4, seed: int = 9) -> DataFrame:
    """Columns: the id, n_shingles, component_id, kept (the id is its component's smallest).

    bands x rows registers: with 16 x 4 a pair of similarity 0.8 misses all buckets with probability 2e-4, one of 0.85 with 1e-5."""
    small_batches(docs.sparkSession)
    all_rows = materialize(sketches(docs, id_col, text_col, width, bands * rows, seed))
    # 1. Classes of equal sets.
    some = all_rows.filter("set_digest is not null and id is not null")
    classes = materialize(some.groupBy(F.col("set_digest").alias("rep")).agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))
    first_of = some.groupBy("id").agg(F.min("set_digest").alias("b"), F.max("set_digest").alias("z")).filter("b <> z").select("id", "b")
    shared_ids = materialize(some.select("id", F.col("set_digest").alias("a")).join(first_of, "id").filter("a <> b").select("a", "b").distinct())

    def sets_of(wanted: DataFrame) -> DataFrame:
        members = materialize(wanted.join(classes.select(F.col("rep").alias("d"), "id"), "d"))
        return materialize(full_sets(docs, members, id_col, text_col, width))

    # 2. Buckets.
    band = lambda k: F.xxhash64(F.lit(k), F.substring("sketch", 2 * rows * k + 1, 2 * rows))
    keyed = classes.select("rep", "id", F.posexplode(F.array(*map(band, range(bands)))).alias("band", "bucket")).select("rep", "id", "bucket")
    # The class of the smallest id is the centre: what came first is more often the original of the others' edits.
    buckets = keyed.groupBy("bucket").agg(F.min(F.struct("id", "rep"))["rep"].alias("low"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    held = materialize(keyed.join(broadcast_if_small(materialize(buckets)), "bucket").select("rep", "bucket", "low"))
    facts = classes.select("rep", "n", "sketch")
    side = lambda s: facts.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    full = lambda p: p.join(side("a"), "a").join(side("b"), "b")
    check = lambda pairs: _verified(_likely(full(pairs), percent, 4.5), sets_of, percent)
    first = check(held.filter("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct())
    links = first.filter("linked").select("a", "b").union(shared_ids)
    comp = materialize(components(links))
    # 3. In buckets that still hold several components, stars around the member that is most like the smallest.
    inside = _mixed(held, comp)
    if not inside.isEmpty():
        near = inside.join(first.select(F.col("a").alias("rep"), F.col("b").alias("low"), "sim"), ["rep", "low"]).groupBy("bucket").agg(F.max_by(F.struct(F.col("rep").alias("centre"), F.col("component").alias("centre_component")), F.struct("sim", "rep")).alias("c"))
        again = inside.join(broadcast_if_small(materialize(near.select("bucket", "c.*"))), "bucket").filter("component <> centre_component and centre <> rep")
        links = links.union(check(again.select(F.greatest("rep", "centre").alias("a"), F.least("rep", "centre").alias("b")).distinct()).filter("linked").select("a", "b"))
        comp = materialize(components(links))
        inside = _mixed(inside.select("rep", "bucket", "low"), comp)
    # 4. What is left is compared exactly, tile by tile.
    if not inside.isEmpty():
        links = links.union(_tiled(inside, sets_of, percent))
        comp = materialize(components(links))
    named = materialize(classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "id", F.coalesce("component", "rep").alias("component")))
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    down = named.join(smallest, "component").select(F.col("rep").alias("set_digest"), "component_id")
    # Back to the rows by partition and digest, so that a hot class's rows spread.
    leaves = materialize(all_rows.filter("set_digest is not null").select("part", "set_digest").distinct().join(down, "set_digest"))
    found = all_rows.filter("set_digest is not null").join(leaves, ["part", "set_digest"], "left").select("id", "n_shingles", "component_id")
    out = found.union(all_rows.filter("set_digest is null").select("id", "n_shingles", F.col("id").alias("component_id")))
    component = F.coalesce("component_id", F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), component).alias("component_id"), F.when(F.col("id").isNotNull(), F.col("id") == component).otherwise(True).alias("kept"))
