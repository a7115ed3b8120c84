"""Token ids in length-delimited binary records with masked checksums and an offset index.

A record is: length of the payload (8 bytes, little-endian), masked CRC-32C of those 8 bytes (4), the payload, and its
masked CRC-32C (4). A payload is one document: a flag for a null id (1), the document's id (8), the bytes of a token id (1: two where
the vocabulary has at most 65,536 ids, else four), then the token ids.
Beside each data file lies an index: the offset of each record (8 bytes each), so that records can be read in any order.
Files hold documents in ascending (id, text) order, and file k's documents all come before file k + 1's.

Null texts count as empty: their only token is the end id. Null ids come first and are stored with a flag. Repeated rows
each get a record; ties in the id are ordered by the text's hash. Extra columns don't matter: only the id and the
text are read. Tasks write under a name of their own attempt; the manifest names the files of the attempts that counted.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandsieve.llm._shared import broadcast_if_small, column_bytes, materialize, shared_dir, small_batches, tidy

#: Fixed values of the record format.
MASK_DELTA = 0xA282EAD8
CRC32C_POLY = 0x82F63B78
_HEAD = struct.Struct("<QI")


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(CRC32C_POLY), t >> 1).astype(np.uint32)
    return t


_TABLE = _crc_table()


def _zeros_operator(n: int) -> np.ndarray:
    """What n zero bytes do to a CRC register, as the images of its 32 bits (a linear map)."""
    one = np.uint32(1) << np.arange(32, dtype=np.uint32)
    step = (one >> np.uint32(8)) ^ _TABLE[one & np.uint32(255)]
    out = one.copy()
    while n:
        if n & 1:
            out = _apply(step, out)
        step = _apply(step, step)
        n >>= 1
    return out


def _tables(op: np.ndarray) -> np.ndarray:
    """A linear map, given by the images of the 32 bits, as a table for each byte of a register."""
    v = np.arange(256, dtype=np.uint32)
    out = np.zeros((4, 256), np.uint32)
    for i in range(32):
        out[i // 8] ^= np.where((v >> np.uint32(i % 8)) & np.uint32(1), op[i], np.uint32(0))
    return out


def _mapped(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map, given by its tables, for many registers."""
    out = tables[0][x & np.uint32(255)]
    for byte in range(1, 4):
        out ^= tables[byte][(x >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def _apply(op: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map, given by the images of the 32 bits, for many registers."""
    return _mapped(_tables(op), x)


_BLOCK = 64
_OPERATORS: dict[int, np.ndarray] = {}  # as tables, which are made once a worker


def crc32c(data: bytes) -> int:
    """CRC-32C. Long data is cut into strips that are all advanced together, then folded pairwise."""
    return int(_crc_rows([data])[0])


def _crc_rows(datas: list[bytes]) -> np.ndarray:
    """CRC-32C of each item, all items' 64-byte blocks at once."""
    lengths = np.fromiter(map(len, datas), np.int64, len(datas))
    blocks = -(-lengths // _BLOCK)
    total = int(blocks.sum())
    if not total:
        return np.zeros(len(datas), np.uint32)
    # Zeros before the data leave a zero register as it is, so each item is padded in front.
    buf = np.zeros(total * _BLOCK, np.uint8)
    ends = np.cumsum(blocks) * _BLOCK
    whole = np.frombuffer(b"".join(datas), np.uint8)
    starts = np.cumsum(lengths) - lengths
    buf[np.repeat(ends - lengths - starts, lengths) + np.arange(len(whole))] = whole
    grid = buf.reshape(total, _BLOCK).T.copy()
    reg = np.zeros(total, np.uint32)
    for column in grid:
        reg = (reg >> np.uint32(8)) ^ _TABLE[(reg ^ column) & np.uint32(255)]
    # Fold an item's blocks from the right: a block is moved on by the bytes after it.
    owner = np.repeat(np.arange(len(datas)), blocks)
    after = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(total)
    level = 0
    while after.any():
        if level not in _OPERATORS:
            _OPERATORS[level] = _tables(_zeros_operator(_BLOCK << level))
        on = (after >> level) & 1 == 1
        reg[on] = _mapped(_OPERATORS[level], reg[on])
        after = after & ~(1 << level)
        level += 1
    out = np.zeros(len(datas), np.uint32)
    np.bitwise_xor.at(out, owner, reg)
    # The register starts at all ones, which n bytes turn into something that depends on n alone.
    start = np.full(len(datas), 0xFFFFFFFF, np.uint32)
    bit = 0
    while (lengths >> bit).any():
        key = -1 - bit
        if key not in _OPERATORS:
            _OPERATORS[key] = _tables(_zeros_operator(1 << bit))
        on = (lengths >> bit) & 1 == 1
        start[on] = _mapped(_OPERATORS[key], start[on])
        bit += 1
    return out ^ start ^ np.uint32(0xFFFFFFFF)


def mask(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def frame(payloads: list[bytes]) -> list[bytes]:
    """Records of the payloads."""
    sizes = [struct.pack("<Q", len(x)) for x in payloads]
    heads = mask(_crc_rows(sizes)).astype("<u4")
    tails = mask(_crc_rows(payloads)).astype("<u4")
    return [b"".join((s, h.tobytes(), p, t.tobytes())) for s, h, p, t in zip(sizes, heads, payloads, tails)]


def unframe(data: bytes) -> list[bytes]:
    """Payloads of whole records one after another; raises ValueError where a checksum or a length is wrong."""
    at, sizes, payloads, heads, tails = 0, [], [], [], []
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("a record's head is cut")
        size, head = _HEAD.unpack_from(data, at)
        if at + 16 + size > len(data):
            raise ValueError("a record is cut or its length is wrong")
        sizes.append(data[at : at + 8])
        heads.append(head)
        payloads.append(data[at + 12 : at + 12 + size])
        tails.append(int.from_bytes(data[at + 12 + size : at + 16 + size], "little"))
        at += 16 + size
    if (mask(_crc_rows(sizes)) != np.array(heads, np.uint32)).any() or (mask(_crc_rows(payloads)) != np.array(tails, np.uint32)).any():
        raise ValueError("a record's checksum is wrong")
    return payloads


# Tokenizing

#: Units that a worker remembers the ids of, in each of two generations.
REMEMBERED = 400_000
#: Texts that are encoded at once.
AT_ONCE = 500
_MARKS = ".,;:!?"
# Plain texts are those of these characters, without apostrophes (contractions), odd or double white space, or a full stop or comma behind
# anything but a letter or digit. They may be cut before full stops and commas and around line feeds too.
def _byte_classes() -> bytes:
    """A class for each byte of UTF-8: L letters and digits (ASCII, or U+00C0 to U+027F), S space, N line feed, P full stop and comma, O what plain
    texts don't hold, and - for other marks."""
    out = bytearray(b"O" * 32 + b"-" * 95 + b"O" + b"L" * 64 + b"OOO" + b"L" * 7 + b"O" * 54)
    for x in range(128):
        if chr(x).isalnum():
            out[x] = ord("L")
    for marks, kind in ((b" ", b"S"), (b"\n", b"N"), (b".,", b"P"), (b"'", b"O")):
        for x in marks:
            out[x] = kind[0]
    return bytes(out)


_CLASSES = _byte_classes()
_NOT_PLAIN = (b"O", b"SS", b"NN", b"NS", b"SN", b"-P", b"PP", b"SP", b"NP")
_TOKENIZERS: dict[str, tuple] = {}


class UnitEncoder:
    """Encodes texts with the tokenizers library, unit by unit, remembering each unit's ids.

    Byte-level BPE first splits a text into pieces that never join a character that is not white space with a single
    space that follows it, so a text may be cut before any space between two such characters. Plain texts are cut at some marks too, which makes
    units fewer, all of a batch at once. Texts that hold a special token go to the library whole."""

    def __init__(self, path: str):
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.special = [x["content"] for x in spec.get("added_tokens") or []]
        pre = spec.get("pre_tokenizer") or {}
        self.special_begin = os.path.commonprefix(self.special)  # texts without it hold no special token
        self.by_unit = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.cut = re.compile(r"(?<=\S)(?= \S)").split
        self.double = re.compile(r"\s\s").search
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for piece, i in self.tokenizer.get_vocab().items():
            self.n_bytes[i] = len(piece)  # byte-level pieces have one character for each byte
        self.ids: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, f"<u{self.width}").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def units(self, text: str) -> list[str]:
        if self.double(text) or text[:1].isspace() or text[-1:].isspace():
            return self.cut(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def _learn(self, missing: set[str]) -> None:
        """Remembers the ids of units. Most are strung together, so that the library makes one encoding for many; its ids are dealt
        back by the bytes that each stands for."""
        # A word and the marks behind it are pieces of their own, and the word alone is often known.
        marked = [(u, x, u[len(x) :]) for u in missing if u[-1] in _MARKS and (x := u.rstrip(_MARKS))[1:].isalpha() and x[0] == " "]
        missing.difference_update([u for u, _, _ in marked])
        missing.update(p for _, x, y in marked for p in (x, y) if p not in self.ids)
        plain = [u for u in missing if u[0] == " " and len(u) > 1 and not u[1].isspace() and not u[-1].isspace()]
        odd = list(missing.difference(plain))
        for lo in range(0, len(odd), 10_000):
            self.ids.update(zip(odd[lo : lo + 10_000], self.whole(odd[lo : lo + 10_000])))
        strings = [plain[lo : lo + 300] for lo in range(0, len(plain), 300)]
        n_bytes = pc.binary_length(pa.array(plain, pa.large_string())).to_numpy(zero_copy_only=False)
        for lo, units, raw in zip(range(0, len(plain), 300), strings, self.whole(["".join(x) for x in strings])):
            ends = np.cumsum(n_bytes[lo : lo + 300])
            reach = np.cumsum(self.n_bytes[np.frombuffer(raw, f"<u{self.width}")])
            cuts = (np.searchsorted(reach, ends) + 1) * self.width
            self.ids.update(zip(units, map(raw.__getitem__, map(slice, [0, *cuts[:-1].tolist()], cuts.tolist()))))
        self.ids.update((u, self.ids[x] + self.ids[y]) for u, x, y in marked)

    def is_plain(self, text: str) -> bool:
        if not text or "\u00d7" in text or "\u00f7" in text:
            return False
        kinds = text.encode("utf-8", "surrogatepass").translate(_CLASSES)
        return not any(x in kinds for x in _NOT_PLAIN) and kinds[0] not in b"SNP" and kinds[-1] not in b"SN"

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned integers of `width` bytes."""
        if not self.by_unit:
            return self.whole(texts)
        if len(self.ids) > REMEMBERED:  # what is still in use moves on from the old generation
            self.old, self.ids = self.ids, {}
        out: list[bytes] = [b""] * len(texts)
        special = [bool(self.special) and self.special_begin in x and any(s in x for s in self.special) for x in texts]
        plain = [not odd and self.is_plain(x) for x, odd in zip(texts, special)]
        for i, ids in self._encode_plain([i for i, x in enumerate(plain) if x], texts):
            out[i] = ids
        rest = [i for i, x in enumerate(texts) if x and not plain[i] and not special[i]]
        cut = [self.units(texts[i]) for i in rest]
        self._know(chain.from_iterable(cut))
        for i, x in zip(rest, cut):
            out[i] = b"".join(map(self.ids.__getitem__, x))
        whole = [i for i, x in enumerate(special) if x]
        for i, ids in zip(whole, self.whole([texts[i] for i in whole]) if whole else ()):
            out[i] = ids
        return out

    def _know(self, units: Iterable[str]) -> None:
        missing = set(filterfalse(self.ids.__contains__, units))
        again = [u for u in missing if u in self.old]
        self.ids.update(zip(again, map(self.old.__getitem__, again)))
        self._learn(missing.difference(again))

    def _encode_plain(self, places: list[int], texts: list[str]) -> Iterator[tuple[int, bytes]]:
        """Cuts plain texts with Arrow, looks each different unit up once, and strings the ids together with NumPy."""
        if not places:
            return
        cut = pa.array([texts[i] for i in places], pa.large_string())
        for mark, parted in ((" ", "\0 "), (".", "\0."), (",", "\0,"), ("\n", "\0\n\0")):
            cut = pc.replace_substring(cut, mark, parted)
        cut = pc.split_pattern(cut, "\0")
        coded = cut.values.dictionary_encode()
        together = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.string()))
        units = pc.binary_join(together, "\0")[0].as_py().split("\0")  # far faster than one by one
        self.ids[""] = b""
        self._know(units)
        ids = list(map(self.ids.__getitem__, units))
        kind = f"<u{self.width}"
        flat = np.frombuffer(b"".join(ids), kind)
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
        start, index = np.cumsum(n) - n, coded.indices.to_numpy()
        size = n[index]
        ends = np.cumsum(size)
        raw = flat[np.repeat(start[index] - ends + size, size) + np.arange(ends[-1])].tobytes()
        bounds = np.concatenate(([0], ends))[cut.offsets.to_numpy()] * self.width
        for i, lo, hi in zip(places, bounds[:-1].tolist(), bounds[1:].tolist()):
            yield i, raw[lo:hi]


def encoder(path: str) -> UnitEncoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = UnitEncoder(path)
    return _TOKENIZERS[path]


# Files

_META = 10  # bytes before the ids


def _payload(row_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack("<?qB", row_id is None, row_id or 0, width) + ids


def _row_id(payload: bytes) -> int | None:
    null, row_id = struct.unpack_from("<?q", payload)
    return None if null else row_id


def _ids(payload: bytes) -> bytes:
    """A payload's token ids as little-endian unsigned 32-bit integers."""
    return payload[_META:] if payload[_META - 1] == 4 else np.frombuffer(payload, "<u2", offset=_META).astype("<u4").tobytes()


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    return fs, path


def write_token_records(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, partitions: int | None = None) -> DataFrame:
    """Writes the files and returns the manifest: file (ascending), path, index_path, n_docs, n_tokens, base (tokens in earlier files).

    The ids of a document end with `end_id`. Rows are dealt by ranges of (id, hash of the text), so ids that
    repeat don't meet in one task; the one shuffle carries the texts."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(parts, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")

    def write(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, name = encoder(tokenizer), f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        file = TaskContext.get().partitionId()
        fs = data = None
        offsets, at, n_tokens = [], 0, 0
        try:
            for part in given:
                if not part.num_rows:
                    continue
                if data is None:
                    fs, path = _open(folder)
                    data = fs.open_output_stream(f"{path}/{name}.rec")
                texts = part.column("text").to_pylist()
                end = end_id.to_bytes(own.width, "little")
                for lo in range(0, len(texts), AT_ONCE):
                    ids = part.column("id").slice(lo, AT_ONCE).to_pylist()
                    payloads = [_payload(i, x + end, own.width) for i, x in zip(ids, own.encode(texts[lo : lo + AT_ONCE]))]
                    n_tokens += sum((len(x) - _META) // own.width for x in payloads)
                    framed = frame(payloads)
                    for x in framed:
                        offsets.append(at)
                        at += len(x)
                    data.write(b"".join(framed))
        finally:
            if data is not None:
                data.close()
        if data is not None:
            with fs.open_output_stream(f"{path}/{name}.idx") as index:
                index.write(np.array([*offsets, at], "<u8").tobytes())
            yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int32()), "name": [name], "n_docs": pa.array([len(offsets)], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64()), "n_bytes": pa.array([at], pa.int64())})

    manifest = materialize(dealt.mapInArrow(write, "file int, name string, n_docs long, n_tokens long, n_bytes long"))
    # One row a file: a window over all of them is small.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Reads the files back and checks them: file, doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids (binary)."""

    def load(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for part in given:
            for file in part.to_pylist():
                with fs.open_input_file(f"{path}/{file['name']}.idx") as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
                start = file["base"]
                with fs.open_input_file(f"{path}/{file['name']}.rec") as f:
                    lo = 0
                    while lo < len(offsets) - 1:  # some records at a time, by the index
                        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (8 << 20), "right")) - 1)
                        f.seek(int(offsets[lo]))
                        payloads = unframe(f.read(int(offsets[hi] - offsets[lo])))
                        ids = list(map(_ids, payloads))
                        n = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                        yield pa.RecordBatch.from_pydict(
                            {
                                "file": pa.array([file["file"]] * len(ids), pa.int32()),
                                "doc_id": pa.array(list(map(_row_id, payloads)), pa.int64()),
                                "start": pa.array(start + np.cumsum(n) - n),
                                "n_tokens": pa.array(n),
                                "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                                "ids": pa.array(ids, pa.binary()),
                            }
                        )
                        start += int(n.sum())
                        lo = hi

    files = manifest.select("file", "name", "base")
    return files.repartitionByRange(max(1, manifest.count()), "file").mapInArrow(load, "file int, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


@tidy
def token_record_rows(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Writes docs to the shared folder and returns what the files hold, without the ids themselves."""
    folder = shared_dir(docs.sparkSession)
    manifest = write_token_records(docs, tokenizer, folder, id_col, text_col, end_id)
    return read_token_records(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def shuffled_reads(manifest: DataFrame, folder: str, seed: int, n: int) -> list[bytes]:
    """n records' ids, drawn from all without replacement, each fetched by its index entry: for random access by a loader.

    The driver holds a row for each file and the n draws, nothing for each document."""
    fs, path = pafs.FileSystem.from_uri(folder)
    out, files = [], manifest.orderBy("file").select("name", "n_docs").collect()
    bounds = np.cumsum([f["n_docs"] for f in files])
    total = int(bounds[-1]) if len(bounds) else 0
    for k in np.random.default_rng(seed).choice(total, min(n, total), replace=False) if total else []:
        i = int(np.searchsorted(bounds, k, "right"))
        own = int(k - (bounds[i] - files[i]["n_docs"]))
        with fs.open_input_file(f"{path}/{files[i]['name']}.idx") as f:
            f.seek(8 * own)
            lo, hi = np.frombuffer(f.read(16), "<u8").tolist()
        with fs.open_input_file(f"{path}/{files[i]['name']}.rec") as f:
            f.seek(lo)
            out.append(_ids(unframe(f.read(hi - lo))[0]))
    return out
