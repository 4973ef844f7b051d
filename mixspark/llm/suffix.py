"""Exact substring deduplication by longest-previous-factor arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts elsewhere,
in the same document or another. Within one collection of texts all suffixes are
sorted by their first ``length`` bytes (ranks of doubled lengths); the nearest
smaller positions before and after each position in that order give its longest
previous factor, here up to ``length``. A string whose factor is ``length`` long has
an earlier copy and goes; the first one of each such run of equal ranks is the copy
that stays, or goes as well where all copies go.

No suffix array of the whole corpus is needed. Every string of ``length`` bytes is
filed under the smallest hash of its ``GRAM``-byte substrings, so equal strings
share a file. A stretch of consecutive strings with one smallest hash (``STRETCH``
at most) is kept as one segment of text. Equal segments (copies) are one class from
the start; a class with more than one member has all its strings twice. The other
segments, where another segment shares the file, are fetched and sorted together,
many files to a part of some ``PART`` bytes. A file of more than ``PART`` bytes is
never gathered: its strings are hashed one by one (128 bits) and counted by the
shuffle, with sums combined on the map side.

Two modes: ``all`` removes every copy; ``later`` keeps the first one in order of
document id and position.

Defined cases: a null text counts as empty; texts shorter than the length never
match; texts of any length count whole; rows with equal ids are told apart, and
equal rows count as copies of each other; a null id counts like any other and comes
first; an empty table gives an empty table; other columns, whatever their names, are
ignored by ``remove_repeats`` and come back unchanged from ``dedup_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixspark.llm.common import arrow_map, batch, bounded_batches, materialise, named, release, restored, slices
from mixspark.llm.neardup import mix

LENGTH, GRAM = 200, 40
#: Bytes of segments that are sorted together; strings of a segment.
PART, STRETCH = 1 << 19, 1 << 14
#: Strings of a large file in one batch.
STRINGS = 1 << 16


@lru_cache(2)
def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) + np.uint64(seed << 32))


_BASE = 0x9E3779B97F4A7C15 | 1


def window_hashes(raw: np.ndarray, size: int, seed: int = 5) -> np.ndarray:
    """A 64-bit hash of each window, by doubling: blocks of powers of two are joined."""
    n = len(raw) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    block, width, out, done = _byte_values(seed)[raw], 1, None, 0
    while True:
        if size & width:
            part = block[done : done + n]
            out = part if out is None else out * np.uint64(_BASE) + part
            done += width
        if done == size:
            return mix(out)
        block = block[:-width] * np.uint64(_BASE + 4 * width) + block[width:]
        width *= 2


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    n, width = len(x) - size + 1, 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:n], x[size - width : size - width + n])


def segments(raw: bytes, length: int = LENGTH, gram: int = GRAM, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(file, first string, number of strings, own repeat) of each segment of a text.

    Only where the smallest hash comes up twice can a segment repeat a string itself.
    """
    if len(raw) < length:
        return (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
    hashes = window_hashes(np.frombuffer(raw, np.uint8), gram)
    least = sliding_min(hashes, length - gram + 1)
    first = np.concatenate(([0], np.nonzero(least[1:] != least[:-1])[0] + 1))
    n = np.diff(np.concatenate((first, [len(least)])))
    if n.max() > stretch:
        pieces = -(-n // stretch)
        place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, n = np.repeat(first, pieces) + place * stretch, np.minimum(np.repeat(n, pieces) - place * stretch, stretch)
    files, own = least[first], np.zeros(len(first), bool)
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        for k in np.nonzero(np.isin(files, twice))[0].tolist():
            own[k] = np.count_nonzero(hashes[first[k] : first[k] + n[k] + length - gram] == files[k]) > 1
    return files, first, n, own


class SuffixOrder:
    """The suffixes of one text by their first ``length`` bytes; past its end a text goes on with zeros.

    ``levels``: for widths of 8 bytes, then doubled, then ``length``, the rank of each
    position by its next bytes: the number of suffixes before the first equal one. Only
    positions that still share a rank are sorted again.
    """

    def __init__(self, raw: np.ndarray, length: int):
        n, self.length = len(raw), length
        width = min(8, length)
        padded = np.concatenate((raw, np.zeros(length + 8, np.uint8)))
        words = np.lib.stride_tricks.sliding_window_view(padded, 8)[: n + length]
        self.words = np.ascontiguousarray(words).view(">u8").ravel().astype(np.uint64)
        rank, self.levels = np.full(n + length, -1, np.int32), []
        key = self.words[:n] >> np.uint64(8 * (8 - width))
        act = np.argsort(key)
        old = np.zeros(n, np.int64)
        key = key[act]
        while True:
            new = np.ones(len(act), bool)
            new[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
            place = np.arange(len(act))
            in_old = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1]))[: len(act)], place, 0))
            in_new = np.maximum.accumulate(np.where(new, place, 0))
            rank[act] = old + in_new - in_old
            self.levels.append((width, rank.copy()))
            if width == length:
                break
            shares = ~new
            shares[:-1] |= ~new[1:]
            act = act[shares]
            step = min(width, length - width)
            old = rank[act].astype(np.int64)
            key = rank[act + step].astype(np.int64)
            order = np.argsort(old * (n + length + 1) + key)
            act, old, key = act[order], old[order], key[order]
            width += step
        self.rank = rank

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at i and j, ``length`` at most."""
        got = np.zeros(len(i), np.int64)
        for width, rank in reversed(self.levels):
            fits = (got + width <= self.length) & (rank[np.minimum(i + got, len(rank) - 1)] == rank[np.minimum(j + got, len(rank) - 1)])
            got += width * fits
        last = len(self.words) - 1
        differ = self.words[np.minimum(i + got, last)] ^ self.words[np.minimum(j + got, last)]
        for k in range(1, 8):
            got += (differ >> np.uint64(64 - 8 * k)) == 0
        return np.minimum(got, self.length)


def nearest_smaller(x: np.ndarray) -> np.ndarray:
    """For each place the nearest earlier place with a smaller number, or -1."""
    near = np.arange(-1, len(x) - 1)
    todo = np.nonzero(near >= 0)[0]
    while len(todo := todo[(near[todo] >= 0) & (x[near[todo]] > x[todo])]):
        near[todo] = near[near[todo]]  # what lies between is larger still
    return near


def previous_factors(order: SuffixOrder, starts: np.ndarray) -> np.ndarray:
    """Longest previous factors of ``starts`` (ascending): the longest match with an earlier start, ``length`` at most.

    Starts that share no prefix of a quarter of the length and more (the widest level up
    to half) with another are left out of the order, so lesser factors may come out less.
    """
    _, rank = max((x for x in order.levels if 2 * x[0] <= order.length), key=lambda x: x[0], default=(0, np.zeros(len(order.rank), np.int32)))
    shared = np.bincount(rank[starts], minlength=1)[rank[starts]] > 1
    placed = starts[shared]
    placed = placed[np.argsort(order.rank[placed], kind="stable")]
    before, after = nearest_smaller(placed), len(placed) - 1 - nearest_smaller(placed[::-1])[::-1]
    longest = np.zeros(len(placed), np.int64)
    for near, has in ((before, before >= 0), (after, after < len(placed))):
        longest[has] = np.maximum(longest[has], order.common(placed[has], placed[near[has]]))
    out = np.zeros(len(starts), np.int64)
    out[np.searchsorted(starts, placed)] = longest
    return out


def repeated_strings(raw: np.ndarray, starts: np.ndarray, mode: str, length: int) -> np.ndarray:
    """Whether the string at each start goes: it has an earlier copy or, where all go, any."""
    order = SuffixOrder(raw, length)
    repeats = previous_factors(order, starts) >= length
    if mode == "all":
        copied = np.zeros(len(raw), bool)
        copied[order.rank[starts[repeats]]] = True
        repeats = copied[order.rank[starts]]
    return repeats


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return list(zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist(), strict=True))


def _digest(x: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)


def _segment_rows(source: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per segment: file, content, document, place and number of strings."""
    types = {"file": pa.int64(), "content": pa.int64(), "row": pa.int64(), "doc_id": pa.int64(), "first": pa.int32(), "n": pa.int32(), "own": pa.bool_()}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in types}
        for row, doc, raw in zip(got.column("row").to_pylist(), got.column("doc_id").to_pylist(), got.column("raw").to_pylist(), strict=True):
            files, first, n, own = segments(raw, length, gram)
            out["file"].append(files.view(np.int64))
            out["first"].append(first)
            out["n"].append(n)
            out["own"].append(own)
            out["content"].append(np.array([_digest(raw[a : a + b + length - 1]) for a, b in zip(first.tolist(), n.tolist(), strict=True)], np.int64))
            out["row"].append(np.full(len(n), row, np.int64))
            out["doc_id"].append(np.full(len(n), -1 if doc is None else doc, np.int64))
        return batch(types, {k: np.concatenate(v) for k, v in out.items()})

    return arrow_map(source, rows, "file long, content long, row long, doc_id long, first int, n int, own boolean")


def repeated_spans(source: DataFrame, mode: str = "all", length: int = LENGTH, gram: int = GRAM, part_bytes: int = PART) -> DataFrame:
    """(row, spans): byte ranges that go. ``source``: row, doc_id, raw; rows are distinct."""
    found = materialise(_segment_rows(source, length, gram), "segments")
    # Files that hold more than one segment or a repeat; then classes of equal segments in them.
    files = found.groupBy("file").agg(F.count("*").alias("n_segments"), F.max("own").alias("own")).where("n_segments > 1 OR own").select("file")
    files = materialise(files, "files")  # written first, so that the join can split a hot file
    shared = materialise(found.join(files, "file"), "shared-segments")
    release(found, files)
    place = F.struct("doc_id", "row", "first")
    classes = shared.groupBy("file", "content").agg(F.min(place).alias("at"), F.count("*").alias("members"), F.min("n").alias("n"), F.max("own").alias("own"))
    sizes = classes.groupBy("file").agg(F.count("*").alias("n_classes"), F.sum(F.col("n") + F.lit(length - 1)).alias("bytes"), F.max("own").alias("any_own")).where("n_classes > 1 OR any_own")
    sizes = materialise(sizes.select("file", (F.col("bytes") > part_bytes).alias("large")), "file-sizes")
    # large: null where a class is alone in its file and repeats nothing itself
    classes = materialise(classes.join(sizes, "file", "left").select("file", "content", "members", F.col("at.doc_id").alias("doc_id"), F.col("at.row").alias("row"), F.col("at.first").alias("first"), "n", "large"), "segment-classes")

    # The text of one member of each class that has company in its file.
    spots = classes.where("large IS NOT NULL").groupBy("row").agg(F.collect_list(F.struct("file", "content", "doc_id", "first", "n", "large")).alias("spots"))
    piece_types = {"file": pa.int64(), "content": pa.int64(), "doc_id": pa.int64(), "row": pa.int64(), "first": pa.int32(), "n": pa.int32(), "large": pa.bool_(), "body": pa.binary()}

    def bodies(got: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in piece_types}
        for row, raw, spots in zip(got.column("row").to_pylist(), got.column("raw").to_pylist(), got.column("spots").to_pylist(), strict=True):
            for s in spots:
                out["row"].append(row)
                out["body"].append(raw[s["first"] : s["first"] + s["n"] + length - 1])
                for k in ("file", "content", "doc_id", "first", "n", "large"):
                    out[k].append(s[k])
        return batch(piece_types, out)

    fetched = materialise(arrow_map(source.select("row", "raw").join(spots, "row"), bodies, "file long, content long, doc_id long, row long, first int, n int, large boolean, body binary"), "segment-texts")

    # Files of ordinary size: suffix order within a part, many files each.
    flagged = {"file": pa.int64(), "content": pa.int64(), "runs": pa.list_(pa.list_(pa.int32()))}

    def ordered_runs(part: list[tuple]) -> pa.RecordBatch:
        """Of whole files, in order of place: the strings that go."""
        files, contents, n, bodies_ = (list(x) for x in zip(*part, strict=True))
        lengths, m = np.array([len(b) for b in bodies_], np.int64), np.array(n, np.int64)
        starts = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(m) - m), m) + np.arange(m.sum())
        flags, at, out = repeated_strings(np.frombuffer(b"".join(bodies_), np.uint8), starts, mode, length), 0, {k: [] for k in flagged}
        for file, content, size in zip(files, contents, n, strict=True):
            if got := runs_of(flags[at : at + size]):
                out["file"].append(file)
                out["content"].append(content)
                out["runs"].append([list(r) for r in got])
            at += size
        return batch(flagged, out)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = [], 0
        for whole in batches:
            for got in slices(whole):
                for x in zip(*(got.column(k).to_pylist() for k in ("file", "content", "n", "body")), strict=True):
                    if size >= part_bytes // 2 and x[0] != part[-1][0]:
                        yield ordered_runs(part)
                        part, size = [], 0
                    part.append(x)
                    size += len(x[3])
        if part:
            yield ordered_runs(part)

    bounded_batches(source.sparkSession)
    dealt = fetched.where("NOT large").repartition("file").sortWithinPartitions("file", "doc_id", "row", "first").mapInArrow(in_order, "file long, content long, runs array<array<int>>")

    # Large files: every string by its hashes, counted by the shuffle.
    stringed = {"file": pa.int64(), "content": pa.int64(), "at": pa.int32(), "string": pa.int64(), "string2": pa.int64()} | ({} if mode == "all" else {"doc_id": pa.int64(), "row": pa.int64(), "first": pa.int32()})

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for file, content, doc, row, first, body in zip(*(got.column(k) for k in ("file", "content", "doc_id", "row", "first", "body")), strict=True):
                raw = np.frombuffer(body.as_py(), np.uint8)
                one, two = window_hashes(raw, length).view(np.int64), window_hashes(raw, length, 6).view(np.int64)
                for lo in range(0, len(one), STRINGS):
                    at = np.arange(lo, min(lo + STRINGS, len(one)), dtype=np.int32)
                    same = {k: np.full(len(at), v.as_py(), np.int64) for k, v in (("file", file), ("content", content), ("doc_id", doc), ("row", row))}
                    yield batch(stringed, same | {"at": at, "string": one[at], "string2": two[at], "first": first.as_py() + at})

    single = fetched.where("large").mapInArrow(strings, "file long, content long, at int, string long, string2 long" + ("" if mode == "all" else ", doc_id long, row long, first int"))
    string = ["file", "string", "string2"]
    earliest = [] if mode == "all" else [F.min(place).alias("earliest")]
    counted = materialise(single.groupBy(*string).agg(F.count("*").alias("copies"), *earliest).where("copies > 1"), "string-counts")
    again = single.join(counted, string)
    if mode != "all":
        again = again.where(place != F.col("earliest"))
    sets = again.groupBy("file", "content").agg(F.array_sort(F.collect_set("at")).alias("ats"))  # a segment's strings at most
    first = F.expr("filter(ats, (x, i) -> i = 0 OR get(ats, i - 1) <> x - 1)")
    last = F.expr("filter(ats, (x, i) -> i = size(ats) - 1 OR get(ats, i + 1) <> x + 1)")
    piled = sets.select("file", "content", F.zip_with(first, last, lambda a, b: F.array(a, b + 1)).alias("runs"))

    # Back to all members of the classes.
    mine = dealt.unionByName(piled)
    ruled = classes.join(mine, ["file", "content"], "left").where("members > 1 OR runs IS NOT NULL")
    ruled = ruled.select("file", "content", "members", F.col("row").alias("head_row"), F.col("first").alias("head_first"), "runs")
    ruled = materialise(ruled, "ruled-classes")
    release(fetched, counted, classes)
    whole = F.array(F.array(F.lit(0), F.col("n")))
    others = F.when(F.col("members") > 1, whole)
    if mode == "all":
        taken = F.coalesce(others, F.col("runs"))
    else:
        taken = F.when((F.col("row") == F.col("head_row")) & (F.col("first") == F.col("head_first")), F.col("runs")).otherwise(others)
    spans = shared.join(ruled, ["file", "content"]).select("row", F.explode(F.transform(taken, lambda r: F.struct((F.col("first") + r[0]).alias("lo"), (F.col("first") + r[1] + F.lit(length - 1)).alias("hi")))).alias("span"))
    out = materialise(spans.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans")), "spans")
    release(ruled, shared)
    return out


def merge_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def snap(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans narrowed to whole UTF-8 characters."""
    out = []
    for lo, hi in spans:
        while lo < hi and raw[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(raw) and raw[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append((lo, hi))
    return out


def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(x for s in spans for x in s), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))


def _with_bytes(rows: DataFrame, text_col: str) -> DataFrame:
    return rows.withColumn("raw", F.encode(F.coalesce(F.col("payload").getField(text_col).cast("string"), F.lit("")), "UTF-8"))


def remove_repeats(df: DataFrame, mode: str = "all", length: int = LENGTH, columns: tuple[str, ...] = ("spans",), id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and of ``columns``: spans, kept_bytes, kept_sha256."""
    source = _with_bytes(named(df.select(id_col, text_col), id_col), text_col).select("row", "doc_id", "raw")
    gone = repeated_spans(source, mode, length, part_bytes=part_bytes)
    fields = {"kept_bytes": (pa.binary(), "binary"), "kept_sha256": (pa.string(), "string"), "spans": (pa.list_(pa.list_(pa.int32())), "array<array<int>>")}
    types = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64()} | {c: fields[c][0] for c in columns}
    # Texts without spans need not leave the JVM, unless they are asked for.
    raw = F.col("raw") if "kept_bytes" in columns else F.when(F.col("spans").isNotNull(), F.col("raw"))
    whole = F.when(F.col("spans").isNull(), F.sha2("raw", 256)) if "kept_sha256" in columns else F.lit(None).cast("string")

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in (*types, *fields)}
        for size, raw, known, found in zip(*(got.column(c).to_pylist() for c in ("n_bytes", "raw", "whole", "spans")), strict=True):
            spans = merge_spans(found)
            kept = cut(raw, spans) if raw is not None else b""
            out["n_bytes"].append(size)
            out["n_removed"].append(size - len(kept) if spans else 0)
            out["n_spans"].append(len(spans))
            out["kept_bytes"].append(kept)
            out["kept_sha256"].append(known or hashlib.sha256(kept).hexdigest())
            out["spans"].append([list(s) for s in spans])
        return batch(types, out | {"doc_id": got.column("doc_id")})

    joined = source.join(gone, "row", "left").select("doc_id", F.octet_length("raw").alias("n_bytes"), raw.alias("raw"), whole.alias("whole"), "spans")
    return arrow_map(joined, rows, "doc_id long, n_bytes long, n_removed long, n_spans long" + "".join(f", {c} {fields[c][1]}" for c in columns))


def dedup_repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART) -> DataFrame:
    """The rows of ``df``, all columns, without later copies in the texts (whole characters go)."""
    source = _with_bytes(named(df, id_col), text_col)
    gone = repeated_spans(source.select("row", "doc_id", "raw"), "later", length, part_bytes=part_bytes)

    @F.arrow_udf("string")
    def left(raws: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([None if raw is None else cut(raw, snap(raw, merge_spans(s))).decode() for raw, s in zip(raws.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    bounded_batches(df.sparkSession)
    some = F.col("spans").isNotNull()  # other texts stay in the JVM
    joined = source.join(gone, "row", "left").select("payload", "spans", F.when(some, F.col("raw")).alias("raw"))
    text = F.when(some, left("raw", "spans")).otherwise(F.col("payload").getField(text_col))
    return restored(joined, df.columns, **{text_col: text})
