"""Sampled SentencePiece segmentations without replacement, and decoding.

All segmentations of a text into the model's pieces form a lattice. The `samples` segmentations with the largest Gumbel-perturbed
log-probabilities are a sample without replacement; they are found exactly by a perturbed A-star search: a region
of the lattice (a path's prefix, with some edges forbidden at its end) has the log of its mass as a bound, its perturbed maximum
is a Gumbel variable truncated at the parent's, and the best region is opened first: its best path is drawn, and the rest of it is split at
every edge of that path. The next best region's value, kappa, gives inclusion scores 1 - exp(-exp(log_prob - kappa)).

Pieces never join a character with a space after it, nor hold a line feed, nor (in files where that is so) join Latin letters with other
characters, so a text is cut there into units; each unit's lattice is
built once a worker and all units of a batch of texts are walked together. Model files of BPE kind have merge ranks but no
probabilities; Zipf's law turns ranks into them. Characters without a piece are spelled in the model's byte pieces.
All randomness is a hash of the row's key, so reruns agree.

A null text counts as empty: one segmentation without pieces, inclusion 1. Texts with fewer segmentations than asked for give
all they have. Repeated rows give the same samples. Extra columns don't matter: only id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsieve.llm._shared import hash64, mix64, release_memory, releasing, small_batches

#: Units whose lattices a worker keeps; then it starts anew.
REMEMBERED = 250_000
#: Units that are walked at once.
AT_ONCE = 40_000
_LATIN = re.compile(r"[A-Za-z\u00C0-\u024F]")
#: Characters from space on that a state's moves are held for in a table.
_TABLE = 96
_MODELS: dict[str, PieceModel] = {}


def _order(keys: np.ndarray) -> np.ndarray:
    """A stable order of small numbers, by one sort of numbers that hold the key and its place."""
    bits = np.int64(max(1, len(keys)).bit_length())
    code = keys << bits | np.arange(len(keys))
    code.sort()
    return code & ((np.int64(1) << bits) - 1)


class PieceModel:
    """Pieces of a model file with log-probabilities, and lattices of units as flat tables of edges.

    Node tables: first edge and number of edges (none at a unit's end). Edge tables, best first within a node: the
    cumulative probability, the node the edge leads to, the piece, its log-probability given the node, and the log of the others'."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = [model.unk_id()] * 256
        self.lp: dict[str, tuple[int, float]] = {}
        order = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        normal = [i for i in order if not model.is_byte(i)]
        total = np.log(np.sum(1 / (np.arange(len(normal)) + 2.0)))
        for i in order:
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.byte_id[value], self.bytes_of[i] = i, bytes([value])
        for rank, i in enumerate(normal):
            piece = model.id_to_piece(i).replace("▁", " ")
            self.bytes_of[i] = piece.encode()
            self.lp[piece] = (i, float(-np.log(rank + 2.0) - total))
        self.byte_lp = float(-np.log(len(normal) + 2.0) - total)
        self.lp_of = np.full(n, self.byte_lp)
        for i, value in self.lp.values():
            self.lp_of[i] = value
        if odd := next((p for p in self.lp if " " in p.lstrip(" ") or "\n" in p and p != "\n"), None):
            raise ValueError(f"texts are cut into units at spaces and line feeds, but the model has the piece {odd!r}")
        self.prefixes = {p[:k] for p in self.lp for k in range(1, len(p) + 1)}
        self._trie()
        # Where no piece joins a Latin letter with anything but another one, units are cut there too.
        mixed = any(b != " " and bool(_LATIN.match(a)) != bool(_LATIN.match(b)) for p in self.lp for a, b in zip(p, p[1:]) if a != " ")
        self.cut = re.compile(r" *[^ \n]+|\n| +" if mixed else rf" *{_LATIN.pattern}+| *[^A-Za-z\u00C0-\u024F \n]+|\n| +").findall
        self.clear()

    def _trie(self) -> None:
        """Prefixes of pieces as states: sorted keys (state, character), the next state, and the piece that a state completes."""
        states, moves = {"": 0}, {}
        for piece in self.lp:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in states:
                    states[piece[:k]] = len(states)
                    moves[(states[piece[: k - 1]] << 21) | ord(piece[k - 1])] = states[piece[:k]]
        self.trie_keys = np.array(sorted(moves), np.int64)
        self.trie_next = np.array([moves[k] for k in sorted(moves)], np.int64)
        self.trie_piece = np.full(len(states), -1, np.int64)
        for piece, (i, _) in self.lp.items():
            self.trie_piece[states[piece]] = i
        # The same moves for characters from space on as a table; the last column is for all others, which are sought among the keys.
        self.trie_table = np.full((len(states), _TABLE + 1), -1, np.int32)
        state, char = self.trie_keys >> 21, (self.trie_keys & 0x1FFFFF) - 32
        on = (char >= 0) & (char < _TABLE)
        self.trie_table[state[on], char[on]] = self.trie_next[on]

    def clear(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)  # of units; a new one gets the next
        self.n_known = 0
        self.spelled: list[list[int]] = []  # pieces below 0 are ~place here: characters spelled in several bytes
        self.spelled_at: dict[int, int] = {}
        self.n_nodes = self.n_edges = 0
        if hasattr(self, "first"):  # the tables' room is used again
            return
        self.start = np.zeros(1 << 15, np.int64)
        self.first, self.count = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.cum, self.to, self.piece = np.zeros(1 << 17, np.float32), np.zeros(1 << 17, np.int32), np.zeros(1 << 17, np.int32)
        self.log_p, self.log_q = np.zeros(1 << 17, np.float32), np.zeros(1 << 17, np.float32)

    def units(self, text: str) -> list[str]:
        return self.cut(" " + text) if text else []

    def add(self, units: list[str]) -> None:
        """Builds the lattices of units that are not known yet, level by level for all of them."""
        n_chars = np.fromiter(map(len, units), np.int64, len(units))
        base, node = self.n_nodes, int(n_chars.sum()) + len(units)
        while len(self.start) < self.n_known + len(units):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
        ends = np.cumsum(n_chars + 1) - 1
        self.start[self.n_known : self.n_known + len(units)] = base + ends - n_chars
        self.n_known += len(units)
        # A unit has a node before each character and one at its end; there the text holds a value that is no character.
        place = np.arange(node - len(units)) + np.repeat(np.arange(len(units)), n_chars)
        text = np.full(node, 0x110000, np.int64)
        text[place] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        src, dst, piece, level = self._match(text, place, np.repeat(ends, n_chars))
        lps = self.lp_of[np.maximum(piece, 0)]
        if len(piece) and piece.min() < 0:
            odd = piece < 0
            lps[odd] = self.byte_lp * np.array([len(self.spelled[~x]) for x in piece[odd].tolist()])
        # beta of a node: log of the mass of all ways from there to the unit's end; level: characters to the end.
        beta = np.zeros(node)
        order = _order(level * np.int64(node + 1) + src)
        src, dst, piece, lps, level = src[order], dst[order], piece[order], lps[order], level[order]
        bounds = np.flatnonzero(np.diff(level, prepend=0, append=level[-1:] + 1)) if len(level) else np.zeros(1, int)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            x = src[lo:hi]
            heads = np.flatnonzero(np.diff(x, prepend=-1))
            beta[x[heads]] = np.logaddexp.reduceat(beta[dst[lo:hi]] + lps[lo:hi], heads)
        log_p = np.minimum(beta[dst] + lps - beta[src], 0.0)
        p = np.exp(log_p)
        order = np.argsort(src - 0.5 * p)  # by node, likeliest edge first
        src, dst, piece, log_p, p = src[order], dst[order], piece[order], log_p[order], p[order]
        heads = np.flatnonzero(np.diff(src, prepend=-1))
        sizes = np.diff(heads, append=len(src))
        total = np.cumsum(p)
        cum = total - np.repeat(total[heads] - p[heads], sizes)
        cum[heads + sizes - 1] = 2.0  # the last edge takes what rounding leaves
        with np.errstate(divide="ignore"):
            log_q = np.where(np.repeat(sizes, sizes) == 1, -np.inf, np.log(-np.expm1(np.minimum(log_p, -1e-300))))
        self._grow(node, len(src))
        a, b = self.n_nodes, self.n_edges
        self.first[a : a + node] = 0
        self.count[a : a + node] = 0
        self.first[a + src[heads]] = b + heads
        self.count[a + src[heads]] = sizes
        for table, values in ((self.cum, cum), (self.to, a + dst), (self.piece, piece), (self.log_p, log_p), (self.log_q, log_q)):
            table[b : b + len(src)] = values
        self.n_nodes, self.n_edges = a + node, b + len(src)

    def _match(self, text: np.ndarray, place: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """All edges: the pieces that start at each place, found for all places together, one character further at a time."""
        found, at, state, unit = [], place, np.zeros(len(place), np.int64), last
        length = 0
        while len(at):
            char = text[at + length]
            column = char - 32
            column[(column < 0) | (column >= _TABLE)] = _TABLE
            moved = self.trie_table[state, column].astype(np.int64)
            other = np.flatnonzero(column == _TABLE)
            if len(other):
                key = (state[other] << 21) | char[other]
                where = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
                moved[other] = np.where(self.trie_keys[where] == key, self.trie_next[where], -1)
            on = moved >= 0
            at, state, unit = at[on], moved[on], unit[on]
            length += 1
            end = self.trie_piece[state]
            whole = end >= 0
            if length == 1:  # every character that is not a piece is spelled
                alone = np.ones(len(text), bool)
                alone[at[whole]] = False
                odd = np.flatnonzero(alone[place])
                for c in np.unique(text[place[odd]]).tolist():
                    if c not in self.spelled_at:
                        raw = [self.byte_id[x] for x in chr(c).encode("utf-8", "surrogatepass")]
                        self.spelled_at[c] = raw[0] if len(raw) == 1 else ~len(self.spelled)
                        self.spelled += [raw] * (len(raw) > 1)
                spelled = np.array([self.spelled_at[c] for c in text[place[odd]].tolist()], np.int64)
                found.append((place[odd], place[odd] + 1, spelled, last[odd] - place[odd]))
            src = at[whole]
            found.append((src, src + length, end[whole], unit[whole] - src))
        return tuple(map(np.concatenate, zip(*found))) if found else (np.empty(0, np.int64),) * 4

    def _grow(self, nodes: int, edges: int) -> None:
        while len(self.first) < self.n_nodes + nodes:
            self.first, self.count = np.concatenate((self.first, np.zeros_like(self.first))), np.concatenate((self.count, np.zeros_like(self.count)))
        while len(self.cum) < self.n_edges + edges:
            for name in ("cum", "to", "piece", "log_p", "log_q"):
                table = getattr(self, name)
                setattr(self, name, np.concatenate((table, np.zeros_like(table))))

    def start_nodes(self, units: list[list[str]]) -> list[np.ndarray]:
        """The first node of each unit of each text; lattices that are missing are built. Node numbers hold until the next call."""
        if len(self.numbers) > REMEMBERED:
            self.clear()
        sizes = list(map(len, units))
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(units)), np.int64, sum(sizes))
        if len(self.numbers) > self.n_known:
            self.add(list(islice(reversed(self.numbers), len(self.numbers) - self.n_known))[::-1])
        return np.split(self.start[number], np.cumsum(sizes)[:-1]) if sizes else []

    def walk(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draws a path from each node to its unit's end: edges (all paths one after another) and their numbers.

        keys: a 64-bit hash for each node, from which its draws come."""
        steps, at, node, who = [], np.zeros(len(nodes), np.int64), nodes.copy(), np.arange(len(nodes))
        on = self.count[node] > 0
        node, who = node[on], who[on]
        k = 0
        while len(node):
            u = (mix64(keys[who] + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(11)).astype(np.float64) / 2.0**53
            edge = self.first[node].astype(np.int64)
            more = np.flatnonzero(u >= self.cum[edge])
            while len(more):
                edge[more] += 1
                more = more[u[more] >= self.cum[edge[more]]]
            steps.append((who, edge))
            at[who] += 1
            node = self.to[edge].astype(np.int64)
            on = self.count[node] > 0
            node, who = node[on], who[on]
            k += 1
        starts = np.cumsum(at) - at
        out = np.zeros(int(at.sum()), np.int64)
        for i, (w, e) in enumerate(steps):
            out[starts[w] + i] = e
        return out, at

    def ids(self, edges: np.ndarray) -> np.ndarray:
        """Piece ids of a path."""
        piece = self.piece[edges]
        if len(piece) and piece.min() < 0:
            return np.array([y for x in piece.tolist() for y in ((x,) if x >= 0 else self.spelled[~x])], np.int32)
        return piece

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The UTF-8 text of piece ids: their bytes joined, without the space that encoding puts in front."""
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:]

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def model_of(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
        release_memory()  # the library's own tables are not needed any more
    return _MODELS[path]


def _uniform(key: int, index: np.ndarray) -> np.ndarray:
    x = mix64(np.uint64(key) + index.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _truncated(log_mass: np.ndarray, u: np.ndarray, bound: float) -> np.ndarray:
    """Gumbel variables at log_mass, given that they are below bound."""
    with np.errstate(divide="ignore", over="ignore"):
        return -np.logaddexp(-bound, np.log(-np.log(u)) - log_mass)


class _Search:
    """The perturbed A-star search over one text's lattice. Its draws of paths are made by the caller, for many texts at once."""

    def __init__(self, model: PieceModel, starts: np.ndarray, key: int, samples: int):
        self.model, self.starts, self.key, self.left = model, starts, key, samples
        self.out: list[tuple[np.ndarray, np.ndarray, float, float]] = []  # edges, sizes, log_prob, perturbed
        # A region: perturbed maximum, path it leaves, where, edges forbidden there, log-mass of the prefix.
        self.agenda: list[tuple[float, int, int, tuple[int, ...], float]] = []
        self.value = float(-np.log(-np.log(_uniform(key, np.array([0]))[0])))
        self.kappa = -np.inf
        self.head: np.ndarray = np.empty(0, np.int64)  # edges before the draw
        self.head_sizes: np.ndarray = np.empty(0, np.int64)
        self.forbidden: tuple[int, ...] = ()
        self.floor, self.todo = 0, starts

    def took(self, edges: np.ndarray, sizes: np.ndarray) -> None:
        """A region's best path is drawn: emit it, split the region, choose the next."""
        m, floor = self.model, self.floor
        if len(self.head):
            if len(self.todo) == len(self.starts) - len(self.head_sizes) + 1:  # the first draw ends the unit that the head has begun
                sizes = np.concatenate((self.head_sizes[:-1], [self.head_sizes[-1] + sizes[0]], sizes[1:]))
            else:
                sizes = np.concatenate((self.head_sizes, sizes))
            edges = np.concatenate((self.head, edges))
        place = len(self.out)
        self.out.append((edges, sizes, float(m.log_p[edges].sum(dtype=np.float64)), self.value))
        self.left -= 1
        # Regions far along a path weigh next to nothing. With 53 random bits a Gumbel variable lies in [-3.7, 36.8], so regions whose
        # log-mass is 41 below that of the best ones can't be among the best: the path is looked at until then.
        size = 256
        while len(edges) > floor:
            part = edges[: floor + size]
            log_p = m.log_p[part]
            reached = np.cumsum(log_p, dtype=np.float64)
            before = reached - log_p
            mass = before[floor:] + m.log_q[part[floor:]]
            forbidden = (*self.forbidden, int(part[floor])) if self.forbidden else ()
            if forbidden:
                rest = self._others(forbidden)
                mass[0] = before[floor] + (np.log(rest) if rest > 0 else -np.inf)
            if len(part) < len(edges) and np.count_nonzero(mass > reached[-1] + 41) <= self.left:
                size *= 4
                continue
            values = _truncated(mass, _uniform(self.key + 1 + place, np.arange(floor, len(part))), self.value)
            for _ in range(self.left + 1):
                i = int(values.argmax())
                if values[i] == -np.inf:
                    break
                own = forbidden if forbidden and not i else (int(part[floor + i]),)
                self.agenda.append((float(values[i]), place, floor + i, own, float(before[floor + i])))
                values[i] = -np.inf
            break
        self.agenda.sort(key=lambda x: -x[0])
        self.kappa = self.agenda[0][0] if self.agenda else -np.inf
        if self.left and self.agenda:
            self._open(*self.agenda.pop(0))
        else:
            self.left = 0

    def _node(self, edge: int) -> range:
        """The edges of the node that an edge starts from."""
        lo = edge
        m = self.model
        while lo and m.cum[lo - 1] < m.cum[lo] and m.cum[lo - 1] < 2.0:
            lo -= 1
        hi = edge
        while m.cum[hi] < 2.0:
            hi += 1
        return range(lo, hi + 1)

    def _others(self, forbidden: tuple[int, ...]) -> float:
        return float(sum(np.exp(float(self.model.log_p[e])) for e in self._node(forbidden[0]) if e not in forbidden))

    def _open(self, value: float, place: int, at: int, forbidden: tuple[int, ...], before: float) -> None:
        """Keeps the path's head, draws another edge at `at`, and leaves the rest to be drawn."""
        m = self.model
        edges, sizes, _, _ = self.out[place]
        free = [e for e in self._node(forbidden[0]) if e not in forbidden]
        p = np.exp(m.log_p[free].astype(np.float64))
        u = _uniform(self.key + 77 + len(self.out), np.array([at]))[0] * p.sum()
        edge = free[min(int(np.searchsorted(np.cumsum(p), u)), len(free) - 1)]
        ends = np.cumsum(sizes)
        unit = int(np.searchsorted(ends, at, "right"))
        self.head = np.concatenate((edges[:at], [edge]))
        self.head_sizes = np.concatenate((sizes[:unit], [at + 1 - (ends[unit] - sizes[unit])]))
        self.todo = np.concatenate(([int(m.to[edge])], self.starts[unit + 1 :]))
        self.value, self.floor, self.forbidden = value, at, forbidden

    def keys(self) -> np.ndarray:
        return mix64(np.uint64(self.key) + (np.arange(len(self.todo), dtype=np.uint64) + np.uint64(1 + len(self.starts) - len(self.todo))) * np.uint64(0x8CB92BA72F3D8DD7) + np.uint64(1009 * len(self.out)))


def sample_texts(model: PieceModel, texts: list[str], keys: list[int], samples: int) -> list[_Search]:
    """Searches of the texts, run to their ends; in each, out has the samples, best first."""
    starts = model.start_nodes([model.units(x) for x in texts])
    all_ = [_Search(model, x, k, samples) for x, k in zip(starts, keys)]
    live = [x for x in all_ if x.left]
    while live:
        nodes = np.concatenate([x.todo for x in live]) if live else np.empty(0, np.int64)
        edges, sizes = model.walk(nodes.astype(np.int64), np.concatenate([x.keys() for x in live]))
        at_edge = at_unit = 0
        for x in live:
            own = sizes[at_unit : at_unit + len(x.todo)]
            n = int(own.sum())
            at_unit += len(x.todo)
            x.took(edges[at_edge : at_edge + n], own)
            at_edge += n
        live = [x for x in live if x.left]
    return all_


def inclusion(log_prob: float, kappa: float) -> float:
    return float(-np.expm1(-np.exp(min(log_prob - kappa, 700.0)))) if np.isfinite(kappa) else 1.0


def sample_segmentations(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", samples: int = 2, seed: int = 5, with_ids: bool = True) -> DataFrame:
    """Columns: the id, rank (1 is best), n_pieces, log_prob, perturbed, inclusion, round_trip (decoding gives the text back), ids_crc32 (of the ids as
    little-endian 32-bit integers) and, if asked for, ids (those bytes). One narrow pass; one row a sample."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "rank", "n_pieces", "log_prob", "perturbed", "inclusion", "round_trip", "ids_crc32"] + ["ids"] * with_ids
    types = [None, pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.binary()]

    @releasing
    def sample(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model_of(model)
        for part in parts:
            texts = [x or "" for x in part.column("text").to_pylist()]
            keys = [hash64(f"{seed}:{x}".encode()) >> 1 for x in part.column("id").to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) // 5 < AT_ONCE):
                    size += len(texts[hi]) // 5
                    hi += 1
                rows = []
                for i, x in enumerate(sample_texts(own, texts[lo:hi], keys[lo:hi], samples), lo):
                    plain = texts[i].encode("utf-8", "surrogatepass")
                    for rank, (edges, _, log_prob, value) in enumerate(x.out, 1):
                        ids = own.ids(edges)
                        raw = ids.astype("<u4").tobytes()
                        row = (i, rank, len(ids), log_prob, value, inclusion(log_prob, x.kappa), own.decode_bytes(ids.tolist()) == plain, zlib.crc32(raw))
                        rows.append((*row, raw) if with_ids else row)
                columns = list(zip(*rows))
                given = part.column("id").take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([given, *(pa.array(c, t) for c, t in zip(columns[1:], types[1:]))], names=names)
                lo = hi

    out = f"id {id_type}, rank int, n_pieces long, log_prob double, perturbed double, inclusion double, round_trip boolean, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(sample, out).withColumnRenamed("id", id_col)


def decode_segmentations(samples: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """Adds text, decoded from the ids of sample_segmentations."""

    @F.pandas_udf("string")
    def decode(ids):  # noqa: ANN001, ANN202
        own = model_of(model)
        return ids.map(lambda x: None if x is None else own.decode(np.frombuffer(x, "<u4").tolist()))

    return samples.withColumn("text", decode(F.col(ids_col)))
