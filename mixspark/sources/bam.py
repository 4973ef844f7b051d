"""BAM files, split at the borders of their compressed blocks.

A BAM file is a chain of small gzip blocks that all begin with the same bytes. To
Spark's text source those bytes are a line separator, so it cuts large files, in any
store it can read, into ranges of whole blocks. Each task inflates its blocks one by
one. The first range of a file begins with the header; any other one looks for a place
from which records follow one another, and what lies before it, like the incomplete
record at the end, is joined with the neighbours' ends. As those must make whole
records, a wrong place can't go unnoticed.
"""

from __future__ import annotations

import gzip
import io
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixspark.operators.graph import written
from mixspark.sources.ranges import HEAD, TAIL, THROUGH, bare, by_range, decoded, file_places, joined_ends

#: Fixed values of the format: how each block begins, up to its size; the empty block at the end; codes of CIGAR operations.
MARK = bytes.fromhex("1f8b08040000000000ff0600") + b"BC\x02\x00"
END = MARK + bytes.fromhex("1b0003000000000000000000")
OPS = "MIDNSHP=X"
#: Value sizes and forms of tags by type letter.
TAG_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
TAG_INTEGERS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I"}

#: Inflated bytes of a written block; records of a batch; inflated bytes that are parsed at once; inflated bytes in which a range looks for its first border, and records that must follow from there.
BLOCK, BATCH, PIECE, SEEK, CHAIN = 65_280, 10_000, 1 << 20, 4 << 20, 16
#: Records of a range are numbered from 32 times its start: a block inflates 1032-fold at most and a record has 36 bytes at least.
PER_BYTE, PER_FILE = 32, 1 << 45

_FIELDS = struct.Struct("<iiBBHHHi")
#: A record's size and fixed fields.
_FIXED = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("quality", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("length", "<i4")])
_SIZE = struct.Struct("<i")
RECORD, REFERENCE, PLAIN = 10, 11, 12  # kinds of rows beside the ends of ranges
_TYPES = {"path": pa.string(), "start": pa.int64(), "kind": pa.int32(), "idx": pa.int64(), "read": pa.string(), "flag": pa.int32(), "ref_id": pa.int32(), "cigar": pa.string(), "nm": pa.int64(), "bytes": pa.binary()}
_SCHEMA = "path string, start long, kind int, idx long, read string, flag int, ref_id int, cigar string, nm long, bytes binary"


def record_fields(raw: bytes) -> tuple[str, int, int, str | None, int | None]:
    """(read, flag, number of the reference or -1, cigar, nm) of a record without its size."""
    ref, _, name_size, _, _, n_ops, flag, seq_size = _FIELDS.unpack_from(raw)
    p = 32 + name_size
    name = raw[32 : p - 1].decode()
    cigar = "".join(f"{x >> 4}{OPS[x & 15]}" for x in struct.unpack_from(f"<{n_ops}I", raw, p)) or None
    return name, flag, ref, cigar, nm_of(raw, p + 4 * n_ops + (seq_size + 1) // 2 + seq_size, len(raw))


def nm_of(raw: bytes, p: int, end: int) -> int | None:
    """The NM tag among the tags from ``p`` to ``end``."""
    nm = None
    while p < end:
        tag, kind = raw[p : p + 2], chr(raw[p + 2])
        p += 3
        if kind in "ZH":
            p = raw.index(b"\0", p) + 1
        elif kind == "B":
            p += 5 + TAG_SIZES[chr(raw[p])] * struct.unpack_from("<i", raw, p + 1)[0]
        else:
            if tag == b"NM":
                nm = struct.unpack_from(TAG_INTEGERS[kind], raw, p)[0]
            p += TAG_SIZES[kind]
    return nm


def places(lo: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... as many as sizes[0], then those from lo[1], and so on."""
    return np.repeat(lo - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def offsets_of(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)))


def records_at(data: bytes, at: list[int]) -> dict[str, pa.Array]:
    """The columns of ``record_fields`` for the whole records that begin (with their sizes) at the places ``at``."""
    raw, lo = np.frombuffer(data, np.uint8), np.array(at, np.int64)
    f = raw[lo[:, None] + np.arange(36)].view(_FIXED)[:, 0]
    size, name, n_ops, seq = (f[c].astype(np.int64) for c in ("size", "name", "ops", "seq"))
    tags, end = lo + 36 + name + 4 * n_ops + (seq + 1) // 2 + seq, lo + 4 + size
    if (tags > end).any() or (name < 1).any() or (seq < 0).any():
        raise ValueError("a record is longer than its size")
    read = pa.StringArray.from_buffers(len(lo), pa.py_buffer(offsets_of(name - 1).astype(np.int32)), pa.py_buffer(raw[places(lo + 36, name - 1)]))
    read.validate(full=True)
    ops = raw[places(lo + 36 + name, 4 * n_ops)].view("<u4")
    each = pc.binary_join_element_wise(pa.array(ops >> 4).cast(pa.string()), pa.array(list(OPS)).take(pa.array(ops & 15)), "")
    cigar = pc.if_else(pa.array(n_ops > 0), pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets_of(n_ops), pa.int32()), each), ""), None)
    # most records have that tag alone or none; the tags of the others are walked through
    nm, known = np.zeros(len(lo), np.int64), tags == end
    null = known.copy()
    for kind, form in TAG_INTEGERS.items():
        mine = np.nonzero(end - tags == 3 + TAG_SIZES[kind])[0]
        mine = mine[(raw[tags[mine][:, None] + np.arange(3)] == np.frombuffer(b"NM" + kind.encode(), np.uint8)).all(axis=1)]
        nm[mine] = raw[tags[mine][:, None] + 3 + np.arange(TAG_SIZES[kind])].view(form)[:, 0]
        known[mine] = True
    for i in np.nonzero(~known)[0].tolist():
        got = nm_of(data, int(tags[i]), int(end[i]))
        null[i] = got is None
        nm[i] = got or 0
    return {"read": read, "flag": pa.array(f["flag"].astype(np.int32)), "ref_id": pa.array(np.ascontiguousarray(f["ref"])), "cigar": cigar, "nm": pa.array(nm, mask=null)}


def header(data: bytes | bytearray) -> tuple[int, list[str]] | None:
    """Size of the header at the start of ``data`` and the names of its references; None if it isn't all there."""
    if len(data) >= 4 and data[:4] != b"BAM\1":
        raise ValueError("not a BAM stream")
    try:
        p = 8 + struct.unpack_from("<i", data, 4)[0]
        (count,) = struct.unpack_from("<i", data, p)
        p, names = p + 4, []
        for _ in range(count):
            (size,) = struct.unpack_from("<i", data, p)
            names.append(bytes(data[p + 4 : p + 3 + size]).decode())
            p += 8 + size
    except struct.error:
        return None
    return (p, names) if p <= len(data) else None


def _likely(data: bytes, at: int) -> int:
    """Size of a record at ``at`` with its own size, by fields that hold together; 0 if none can be there."""
    (size,) = struct.unpack_from("<i", data, at)
    if not 34 <= size < 1 << 28:
        return 0
    ref, pos, name_size, _, _, n_ops, _, seq_size = _FIELDS.unpack_from(data, at + 4)
    if ref < -1 or pos < -1 or name_size < 1 or seq_size < 0 or 32 + name_size + 4 * n_ops + (seq_size + 1) // 2 + seq_size > size:
        return 0
    name = data[at + 36 : at + 36 + name_size]
    if len(name) == name_size and (name[-1] != 0 or not all(32 < c < 127 for c in name[:-1])):
        return 0
    return size + 4


def first_border(data: bytes) -> int | None:
    """The first place from which likely records follow one another, at least one of them whole; None without one."""
    for at in range(len(data) - 36):
        p, n = at, 0
        while n < CHAIN and p + 36 <= len(data) and (size := _likely(data, p)):
            p, n = p + size, n + (p + size <= len(data))
        if n == CHAIN or n and p + 36 > len(data):
            return at
    return None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES.values(), strict=True)], names=list(_TYPES))


def _columns(path: str, start: int, kind: int, first: int, n: int, **known: pa.Array) -> pa.RecordBatch:
    """``n`` rows of a kind, numbered from ``first``."""
    known |= {"path": pa.repeat(path, n), "start": pa.array(np.full(n, start, np.int64)), "kind": pa.array(np.full(n, kind, np.int32)), "idx": pa.array(np.arange(first, first + n, dtype=np.int64))}
    return pa.RecordBatch.from_arrays([known[c] if c in known else pa.nulls(n, t) for c, t in _TYPES.items()], names=list(_TYPES))


class BlockRange:
    """The blocks of one range, inflated and parsed as they come."""

    def __init__(self, path: str, start: int):
        self.path, self.start, self.held, self.waiting = path, start, bytearray(), b""
        self.border, self.plain, self.n, self.next_try, self.fed = False, False, 0, 0, False
        self.rows: list[pa.RecordBatch] = []

    def row(self, kind: int, idx: int, data: bytes | None = None) -> None:
        self.rows.append(_columns(self.path, self.start, kind, idx, 1, bytes=pa.array([data], pa.binary())))

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        for value in values:
            block = value.as_py()
            if self.start == 0 and not self.fed:  # what comes before the first block: nothing
                self.fed, self.plain = True, bool(block)
                continue
            if self.plain:
                continue
            # A separator that turned up inside a block belongs to it: the block's size tells.
            whole = self.waiting + MARK + block if self.waiting else block
            size = struct.unpack_from("<H", whole)[0] + 1 - len(MARK) if len(whole) > 1 else 1 << 16
            if len(whole) < size:
                self.waiting = whole
                continue
            self.waiting = b""
            self.held += zlib.decompress(whole[2 : size - 8], -15)
            self.parse(False)
            yield from self.rows
            self.rows = []

    def find(self, last: bool) -> None:
        """The header's end or, further on in the file, the first border."""
        if not last and len(self.held) < self.next_try:
            return
        self.next_try = 2 * len(self.held)
        if self.start == 0:
            if got := header(self.held):
                for i in range(0, len(got[1]), BATCH):
                    names = pa.array(got[1][i : i + BATCH], pa.string())
                    self.rows.append(_columns(self.path, self.start, REFERENCE, i, len(names), read=names))
                del self.held[: got[0]]
                self.border, self.next_try = True, 0
        elif last or len(self.held) >= SEEK:
            at = first_border(bytes(self.held))
            if at is not None:
                self.row(HEAD, 0, bytes(self.held[:at]))
                del self.held[:at]
                self.border, self.next_try = True, 0

    def parse(self, last: bool) -> None:
        if not self.border:
            self.find(last)
        if not self.border or not last and len(self.held) < max(PIECE, self.next_try):
            return
        data, p, at = bytes(self.held), 0, []
        while p + 4 <= len(data) and p + 4 + (size := _SIZE.unpack_from(data, p)[0]) <= len(data):
            if size < 32:
                raise ValueError(f"{self.path}: no record where one should begin in the range at {self.start}")
            at.append(p)
            p += 4 + size
        if at:
            self.rows.append(_columns(self.path, self.start, RECORD, self.n, len(at), **records_at(data, at)))
            self.n += len(at)
        del self.held[:p]
        self.next_try = 2 * len(self.held)  # a record of many pieces is waited for

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.plain:
            self.row(PLAIN, 0)
        elif self.waiting:
            raise ValueError(f"{self.path}: a block that begins in the range at {self.start} is cut off")
        else:
            self.parse(True)
            if self.border:
                self.row(TAIL, self.n, bytes(self.held))
            elif self.held:
                self.row(THROUGH, 0, bytes(self.held))
        yield from self.rows


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records (and a header) made of the ends of neighbouring ranges."""
    path, held, origin = None, bytearray(), (0, 0)

    def whole() -> list[tuple]:
        rows, data, p, (start, n) = [], bytes(held), 0, origin
        if data[:4] == b"BAM\1":
            got = header(data)
            if not got:
                raise ValueError(f"{path}: the header is cut off")
            p, rows = got[0], [(path, 0, REFERENCE, i, name, None, None, None, None, None) for i, name in enumerate(got[1])]
        while p < len(data):
            size = struct.unpack_from("<i", data, p)[0] if p + 4 <= len(data) else len(data)
            if size < 32 or p + 4 + size > len(data):
                raise ValueError(f"{path}: no whole records where the range at {start} ends")
            rows.append((path, start, RECORD, n, *record_fields(data[p + 4 : p + 4 + size]), None))
            n, p = n + 1, p + 4 + size
        return rows

    for got in batches:
        rows = []
        for r in got.to_pylist():
            if r["path"] != path:
                rows += whole()
                path, held, origin = r["path"], bytearray(), (0, 0)
            held += r["bytes"]
            if r["kind"] == HEAD:
                rows += whole()
                held = bytearray()
            elif r["kind"] == TAIL:
                origin = (r["start"], r["idx"])
        if rows:
            yield _batch(rows)
    if rows := whole():
        yield _batch(rows)


def _plain_records(stream: BinaryIO, path: str) -> Iterator[tuple]:
    """Rows of an inflated stream, read from its start."""
    data = stream.read(4)
    while (got := header(data)) is None:
        if not (more := stream.read(1 << 16)):
            raise ValueError(f"{path}: the header is cut off")
        data += more
    for i, name in enumerate(got[1]):
        yield (path, 0, REFERENCE, i, name, None, None, None, None, None)
    rest, n = io.BytesIO(data[got[0] :]), 0
    read = lambda k: (a := rest.read(k)) + (stream.read(k - len(a)) if len(a) < k else b"")
    while size := read(4):
        yield (path, 0, RECORD, n, *record_fields(read(struct.unpack("<i", size)[0])), None)
        n += 1


def _plain_files(spark: SparkSession, path: str, paths: DataFrame) -> DataFrame:
    """Files of other gzip blocks, which can't be split: read whole, 2 GB each at most, parsed a piece at a time."""
    found = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.bam").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for name, content in zip(got.column("path"), got.column("content"), strict=True):
                rows = []
                for row in _plain_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))), name.as_py()):
                    rows.append(row)
                    if len(rows) == BATCH:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    at = bare(F.col("_metadata.file_path")).alias("path")
    return found.select(at, "content").join(paths, "path", "left_semi").mapInArrow(run, _SCHEMA)


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    """The same columns as ``read_sam``: sample (file name), ord, read, flag, ref, cigar, nm.

    Files are parsed when this is called, once, into a table in the shared folder.
    ``ord`` is in the order of the sorted paths and of the records in each file, with
    gaps. A file may have 1 TB; one cut off within a record or block is an error.
    """
    found = spark.read.options(recursiveFileLookup="true", pathGlobFilter="*.bam", encoding="ISO-8859-1", lineSep=MARK.decode("latin-1")).text(path)
    blocks = found.select(bare(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    parsed = written(blocks.mapInArrow(lambda batches: by_range(batches, BlockRange), _SCHEMA), "alignments")
    ends = parsed.where(F.col("kind") <= TAIL).select("path", "start", "kind", "idx", "bytes")
    every = parsed.where(F.col("kind").isin(RECORD, REFERENCE)).unionByName(joined_ends(ends, _joined, _SCHEMA))
    plain = parsed.where(F.col("kind") == PLAIN).select("path")
    if plain.take(1):
        every = every.unionByName(_plain_files(spark, path, plain))
    refs = every.where(F.col("kind") == REFERENCE).select("path", F.col("idx").cast("int").alias("ref_id"), F.col("read").alias("ref"))
    records = every.where(F.col("kind") == RECORD).select("path", (F.col("start") * PER_BYTE + F.col("idx")).alias("at"), "read", "flag", "ref_id", "cigar", "nm")
    # names are taken from paths once a file, and written, or they would be worked out for each record
    sample = F.regexp_replace(decoded(F.regexp_extract("path", r"([^/]+)$", 1)), r"\.bam$", "")
    files = written(file_places(spark, found.inputFiles()).withColumn("sample", sample), "files")
    named = records.join(refs, ["path", "ref_id"], "left").join(files, "path")
    return named.select("sample", (F.col("place") * PER_FILE + F.col("at")).alias("ord"), "read", "flag", "ref", "cigar", "nm")


def encoded_record(read: str, flag: int, ref_id: int, cigar: str | None, nm: int | None) -> bytes:
    """A record without bases, with its size."""
    ops, number = [], ""
    for c in cigar or "":
        if c.isdigit():
            number += c
        else:
            ops.append(int(number) << 4 | OPS.index(c))
            number = ""
    name = read.encode() + b"\0"
    body = struct.pack("<iiBBHHHiiii", ref_id, 0 if ref_id >= 0 else -1, len(name), 0, 0, len(ops), flag, 0, -1, -1, 0) + name + struct.pack(f"<{len(ops)}I", *ops)
    if nm is not None:
        body += b"NMi" + struct.pack("<i", nm)
    return struct.pack("<i", len(body)) + body


def encoded_records(got: pa.RecordBatch) -> bytes:
    """``encoded_record`` of all rows (read, flag, ref_id, cigar, nm), one after the other."""
    n, flat = got.num_rows, {}
    for c in ("read", "cigar"):
        text = got.column(c).cast(pa.string())
        text = pc.fill_null(text, "") if c == "cigar" else text
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
        chars = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        flat[c] = (chars[offsets[0] : offsets[-1]], offsets - offsets[0])
    if got.column("read").null_count or got.column("flag").null_count or got.column("ref_id").null_count:
        raise ValueError("a record has no read, flag or reference")
    names, name_at = flat["read"]
    chars, at = flat["cigar"]
    digit = (chars >= 48) & (chars <= 57)
    letter = np.nonzero(~digit)[0]
    code = np.full(256, -1)
    code[np.frombuffer(OPS.encode(), np.uint8)] = np.arange(len(OPS))
    record = np.searchsorted(at, letter, "right") - 1
    width = letter - np.maximum(np.concatenate(([-1], letter[:-1]))[: len(letter)] + 1, at[record])
    number, op = np.zeros(len(letter), np.int64), code[chars[letter]]
    for k in range(min(int(width.max(initial=0)), 18)):
        far = width > k
        number[far] += (chars[letter[far] - 1 - k].astype(np.int64) - 48) * 10**k
    n_ops, has = np.bincount(record, minlength=n), got.column("nm").is_valid().to_numpy(zero_copy_only=False)
    name, nm = np.diff(name_at) + 1, pc.fill_null(got.column("nm"), 0).to_numpy()
    if (op < 0).any() or (width < 1).any() or (width > 18).any() or (number >= 1 << 28).any() or (n_ops >= 1 << 16).any() or (name > 255).any() or (np.abs(nm) >= 1 << 31).any():
        raise ValueError("a record can't be written as BAM: its CIGAR, name or NM has no place there")
    f = np.zeros(n, _FIXED)
    f["ref"], f["flag"], f["name"], f["ops"], f["next_ref"], f["next_pos"] = got.column("ref_id").to_numpy(), got.column("flag").to_numpy(), name, n_ops, -1, -1
    f["pos"] = np.where(f["ref"] >= 0, 0, -1)
    size = 36 + name + 4 * n_ops + 7 * has
    f["size"] = size - 4
    end = np.cumsum(size)
    lo, out = end - size, np.zeros(int(size.sum()), np.uint8)
    out[lo[:, None] + np.arange(36)] = f.view(np.uint8).reshape(n, 36)
    out[places(lo + 36, name - 1)] = names
    out[places(lo + 36 + name, 4 * n_ops)] = (number << 4 | op).astype("<u4").view(np.uint8)
    tag = np.zeros(int(has.sum()), np.dtype([("tag", "S3"), ("nm", "<i4")]))
    tag["tag"], tag["nm"] = b"NMi", nm[has]
    out[(end[has] - 7)[:, None] + np.arange(7)] = tag.view(np.uint8).reshape(len(tag), 7)
    return out.tobytes()


def packed(data: bytes) -> bytes:
    """A block of at most ``BLOCK`` bytes, without the bytes that all blocks begin with."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return struct.pack("<H", len(MARK) + 2 + len(body) + 8 - 1) + body + struct.pack("<II", zlib.crc32(data), len(data))
