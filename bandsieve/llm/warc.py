"""Web archives: a writer that stores equal payloads once, and a splittable reader.

The writer makes one gzip member for each record. Of rows with equal payloads of at least `min_revisit_bytes` bytes, the one
with the smallest id is a response with the whole payload; the others are revisit records, which carry the HTTP head
and a reference. Smaller payloads are always responses. A record's id is a version-8 UUID around the row's id, so a
revisit names its response without a further look-up.

The reader gives each task byte ranges. It looks for gzip magic in its range, takes a place for a member only if
the header decodes, the content starts as a WARC record with the mandatory fields and, in archives written here, the
archive's own mark is in the member's extra field (so an archive stored inside a payload is not taken for records). A
range owns the records that start inside it and reads beyond its end to finish the last one.

Null payloads count as empty. Rows with the smallest id of their group are responses even if the id repeats. A null
id comes last. Extra columns don't matter: only the id and the payload (and the url, if named) are read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandsieve.llm._shared import column_bytes, materialize, shared_dir, small_batches, tidy

#: Groups of equal payloads are dealt over so many keys.
SALTS = 64
MAGIC = b"\x1f\x8b\x08"
_MARK = b"BM"  # names our subfield of gzip's extra field
_PIECE = 1 << 20


def record_id(row_id: int | None) -> str:
    """A version-8 UUID: 1 bit for null, then the id's 64 bits in the custom fields."""
    bits = (1 << 64) if row_id is None else row_id & ((1 << 64) - 1)
    a, b, c = bits >> 60, (bits >> 48) & 0xFFF, bits & ((1 << 48) - 1)
    return str(uuid.UUID(int=(a << 80) | (8 << 76) | (b << 64) | (2 << 62) | c))


def row_id_of(record: str) -> int | None:
    x = uuid.UUID(record).int
    bits = ((x >> 80) << 60) | (((x >> 64) & 0xFFF) << 48) | (x & ((1 << 48) - 1))
    return None if bits >> 64 else bits - (1 << 64) if bits >> 63 else bits


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(row_id: int | None, url: str | None, payload: bytes, original: int | None, is_revisit: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if is_revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id(row_id)}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if is_revisit:
        fields += [("WARC-Refers-To", f"<urn:uuid:{record_id(original)}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Truncated", "length")]
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def make_member(record: bytes, mark: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field holds the archive's mark."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    extra = _MARK + struct.pack("<H", len(mark)) + mark
    return MAGIC + b"\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def mark_of(data: bytes, at: int) -> bytes | None:
    """The mark in the gzip header at `at`, None if it has none."""
    if len(data) < at + 12 or not data[at + 3] & 4:
        return None
    (n,) = struct.unpack_from("<H", data, at + 10)
    extra, i = data[at + 12 : at + 12 + n], 0
    while i + 4 <= len(extra):
        (size,) = struct.unpack_from("<H", extra, i + 2)
        if extra[i : i + 2] == _MARK:
            return extra[i + 4 : i + 4 + size]
        i += 4 + size
    return None


def assign_originals(pages: DataFrame, id_col: str, payload: Column, min_revisit_bytes: int) -> DataFrame:
    """Adds _payload (binary) and _original: the smallest id among rows with an equal payload, null for small payloads.

    First minima by (digest, salt), then by digest; the winners go back to the (digest, salt) pairs that exist, so
    a group of any size is spread over many keys and only ids and digests are aggregated."""
    salt = F.pmod(F.xxhash64(id_col), F.lit(SALTS))
    rows = pages.withColumn("_payload", payload).withColumn("_digest", F.unhex(F.sha2("_payload", 256))).withColumn("_salt", salt)
    keyed = pages.withColumn("_digest", F.unhex(F.sha2(payload, 256))).withColumn("_salt", salt).filter(F.octet_length(payload) >= min_revisit_bytes)
    part = keyed.groupBy("_digest", "_salt").agg(F.min(id_col).alias("_low"))
    best = part.groupBy("_digest").agg(F.min("_low").alias("_original"), F.collect_list("_salt").alias("_salts"))
    won = best.select("_digest", F.explode("_salts").alias("_salt"), "_original")
    return rows.join(won, ["_digest", "_salt"], "left")


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", min_revisit_bytes: int = 0, partitions: int | None = None) -> DataFrame:
    """Writes archives to a folder; returns their manifest: name, n_bytes, n_records (one row a file)."""
    spark = pages.sparkSession
    small_batches(spark)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    url = F.col(url_col) if url_col else F.lit(None).cast("string")
    slim = pages.select(F.col(id_col).cast("long").alias("id"), url.alias("url"), payload.alias("body"))
    rows = assign_originals(slim, "id", F.col("body"), min_revisit_bytes).select("id", "url", F.col("_payload").alias("body"), "_original", (F.octet_length("_payload") >= min_revisit_bytes).alias("grouped"))

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, n_bytes, n_records, mark = None, 0, 0, os.urandom(8)
        try:
            for part in parts:
                if out is None and part.num_rows:
                    fs, path = pafs.FileSystem.from_uri(folder)
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                columns = [part.column(c).to_pylist() for c in ("id", "url", "body", "_original", "grouped")]
                for row_id, address, body, original, grouped in zip(*columns):
                    member = make_member(make_record(row_id, address, body, original, bool(grouped) and original != row_id), mark)
                    out.write(member)
                    n_bytes += len(member)
                    n_records += 1
        finally:
            if out is not None:
                out.close()
        if n_records:
            yield pa.RecordBatch.from_pydict({"name": [name], "n_bytes": pa.array([n_bytes], pa.int64()), "n_records": pa.array([n_records], pa.int64())})

    return materialize(rows.mapInArrow(write, "name string, n_bytes long, n_records long"))


def records_in(f, size: int, lo: int, hi: int, mark: bytes | None) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the members that start in [lo, hi) and hold a WARC record."""
    base, held = lo, b""  # held: bytes from offset base on

    def need(upto: int) -> None:
        nonlocal held
        while base + len(held) < min(upto, size):
            f.seek(base + len(held))
            more = f.read(min(_PIECE, size - base - len(held)))
            if not more:
                return
            held += more

    at = lo
    while at < hi:
        need(at + _PIECE)
        i = held.find(MAGIC, at - base)
        if i < 0:
            end = base + len(held)
            if end >= min(size, hi + len(MAGIC) - 1):
                return
            at = max(at, end - len(MAGIC) + 1)
            base, held = at, held[at - base :]
            continue
        at = base + i
        if at >= hi:
            return
        base, held = at, held[i:]
        need(at + 4096)
        content = None if mark is not None and mark_of(held, 0) != mark else _member(held, at, size, f)
        if content is None:
            at += 1
        else:
            yield at, content[0]
            at += content[1]


def _member(head: bytes, at: int, size: int, f) -> tuple[bytes, int] | None:
    """Content and length of the member at `at`, if it is whole and holds a record."""
    z, out, taken, seen = zlib.decompressobj(31), [], 0, b""
    data = head
    while True:
        try:
            out.append(z.decompress(data))
        except zlib.error:
            return None
        taken += len(data)
        if len(seen) < 2048:  # the first bytes tell whether it is a record
            seen += out[-1]
            if not (seen.startswith(b"WARC/1.") or b"WARC/1.".startswith(seen)):
                return None
        if z.eof:
            break
        f.seek(at + taken)
        data = f.read(min(_PIECE, size - at - taken))
        if not data:
            return None
    content = b"".join(out)
    fields = content.partition(b"\r\n\r\n")[0].lower()
    if not all(k in fields for k in (b"\r\nwarc-type:", b"\r\nwarc-record-id:", b"\r\ncontent-length:")):
        return None
    return content, taken - len(z.unused_data)


def parse_record(content: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and block of a record; ValueError if the block is cut."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    n = int(fields["content-length"])
    if len(rest) < n:
        raise ValueError("a record's block is cut")
    return fields, rest[:n]


def read_warc(files: DataFrame, folder: str, split_bytes: int = 32 << 20) -> DataFrame:
    """Records of archives: name, offset, record_type, record_id, refers_to, url, payload_digest, payload_bytes, payload.

    files: name and n_bytes of each. payload_bytes is the full payload's, from the HTTP head; payload is null for
    revisits. The digest of every response is checked against its payload."""
    spark = files.sparkSession
    small_batches(spark)
    ranges = files.select("name", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("lo"))
    n = files.agg(F.sum(F.floor((F.col("n_bytes") + split_bytes - 1) / split_bytes))).first()[0] or 1
    names = ["name", "offset", "record_type", "record_id", "refers_to", "url", "payload_digest", "payload_bytes", "payload"]

    def load(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        fs, path = pafs.FileSystem.from_uri(folder)

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for part in parts:
            for split in part.to_pylist():
                rows, held = [], 0
                with fs.open_input_file(f"{path}/{split['name']}") as f:
                    mark = mark_of(f.read(4096), 0)
                    for at, content in records_in(f, split["n_bytes"], split["lo"], split["lo"] + split_bytes, mark):
                        fields, block = parse_record(content)
                        head, _, payload = block.partition(b"\r\n\r\n")
                        said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
                        revisit = fields["warc-type"] == "revisit"
                        if fields["warc-type"] == "response" and said and payload_digest(payload) != said:
                            raise ValueError(f"{split['name']}:{at}: the payload doesn't have its digest")
                        bare = lambda x: x[10:-1] if x and x.startswith("<urn:uuid:") else x
                        rows.append((split["name"], at, fields["warc-type"], bare(fields["warc-record-id"]), bare(fields.get("warc-refers-to")), fields.get("warc-target-uri"), said, int(length[1]) if length and revisit else len(payload), None if revisit else payload))
                        held += len(payload)
                        if held > 16 << 20 or len(rows) >= 1000:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)

    out = "name string, offset long, record_type string, record_id string, refers_to string, url string, payload_digest string, payload_bytes long, payload binary"
    # By ranges, so that each task gets one split; by hashes some would get several and others none.
    return ranges.repartitionByRange(int(n), "name", "lo").mapInArrow(load, out)


def id_column(column: str) -> Column:
    """The row's id out of a record id made by `record_id`."""
    x = F.regexp_replace(column, "-", "")
    bits = F.concat(F.substring(x, 12, 1), F.substring(x, 14, 3), F.substring(x, 21, 12))
    null = F.substring(x, 11, 1) == "1"
    return F.when(~null, F.conv(bits, 16, -10).cast("long"))


@tidy
def archive_rows(pages: DataFrame, min_revisit_bytes: int = 0, split_bytes: int = 32 << 20) -> DataFrame:
    """Archives pages in the shared folder and returns what reading them back gives, by page."""
    folder = shared_dir(pages.sparkSession)
    files = write_warc(pages, folder, min_revisit_bytes=min_revisit_bytes)
    rows = read_warc(files, folder, split_bytes)
    return rows.select(id_column("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", id_column("refers_to").alias("refers_to"))
