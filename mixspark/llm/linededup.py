"""Line deduplication by pairwise alignment.

Documents overlap where they share a line, by the hash of the whole line, that says
enough to be rare: at least ``RARE_WORDS`` words. What a line says decides, never how
many documents hold it, nor which document held the line first. Every stretch that
begins or ends with a rare line and holds no other (the line, and the shorter lines
after or before it one by one) is filed under its hash; the longest stretches of a
document that an earlier one has too lead, in stars, to their first holders (smallest
id). So each rare line gives two pairs at most, however many documents hold it, and
any run of lines that two documents share, with a rare line in it, lies in stretches
that lead to a document with the same lines. Each distinct pair is aligned with
patience diff on the hashes of all its lines. A shared rare line of the later document
that this leaves over (repeated on a side, or in another order) is laid beside a line
of the earlier one with the same neighbour, and grows to a run with the equal lines
around it. Runs of aligned lines that hold a shared rare line are common blocks; they
are deleted from the later document. The first holder of a rare line always keeps it.

Only hashes of lines move to the alignment, at most once for each pair; the texts
move once, for the deletion.

Defined cases: a null text stays null; an empty text has one empty line and stays;
texts of any length are aligned whole; rows with equal ids are documents of their
own, and of equal rows one stays; null ids come first; lines are what stands between
line feeds; an empty table gives an empty table; other columns, whatever their names,
are left alone.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixspark.llm.common import arrow_map, batch, materialise, named, restored
from mixspark.llm.neardup import mix

#: Least words of a rare line.
RARE_WORDS = 5

#: Of the hashes of stretches: any odd number.
ODD = np.uint64(0x9E3779B97F4A7C15)


def patience_blocks(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Aligned runs (start in a, start in b, length), in order and disjoint.

    Equal heads and tails of a range are aligned; then lines that occur once on
    both sides, in the longest increasing order, cut the range into smaller ones.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1 and in_a[b[j]] == 1}
        pairs = [(i, place[a[i]]) for i in range(a0, a1) if a[i] in place]
        tails: list[int] = []
        ends: list[int] = []
        back: list[int] = []
        for n, (_, j) in enumerate(pairs):
            k = bisect_left(tails, j)
            back.append(ends[k - 1] if k else -1)
            tails[k : k + 1], ends[k : k + 1] = [j], [n]
        n, chain = (ends[-1] if ends else -1), []
        while n >= 0:
            chain.append(pairs[n])
            n = back[n]
        last_a, last_b = a0, b0
        for i, j in reversed(chain):
            found.append((i, j))
            todo.append((last_a, i, last_b, j))
            last_a, last_b = i + 1, j + 1
        if chain:
            todo.append((last_a, a1, last_b, b1))
    blocks: list[tuple[int, int, int]] = []
    for i, j in sorted(found):
        if blocks and (blocks[-1][0] + blocks[-1][2], blocks[-1][1] + blocks[-1][2]) == (i, j):
            blocks[-1] = (*blocks[-1][:2], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def blocks_left_over(a: list[int], b: list[int], blocks: list[tuple[int, int, int]], shared: set[int]) -> list[tuple[int, int, int]]:
    """Runs as above, disjoint in b, for the lines of ``shared`` that ``blocks`` leave over in b; lines of a count again.

    Each is laid beside one line of a: one with the same next line, else with the
    same line before, else the first. Time grows with both lengths only.
    """
    done = bytearray(len(b))
    for _, j, n in blocks:
        done[j : j + n] = bytes([1]) * n
    left = [j for j, h in enumerate(b) if not done[j] and h in shared]
    if not left:
        return []
    at: dict[int, int] = {}
    with_next: dict[tuple[int, int], int] = {}
    with_last: dict[tuple[int, int], int] = {}
    for i, h in enumerate(a):
        if h in shared:
            at.setdefault(h, i)
            if i + 1 < len(a):
                with_next.setdefault((h, a[i + 1]), i)
            if i:
                with_last.setdefault((h, a[i - 1]), i)
    found = []
    for j in left:
        if done[j] or b[j] not in at:
            continue
        i = with_next.get((b[j], b[j + 1])) if j + 1 < len(b) else None
        if i is None and j:
            i = with_last.get((b[j], b[j - 1]))
        if i is None:
            i = at[b[j]]
        back, on = 0, 1
        while back < min(i, j) and not done[j - back - 1] and a[i - back - 1] == b[j - back - 1]:
            back += 1
        while i + on < len(a) and j + on < len(b) and not done[j + on] and a[i + on] == b[j + on]:
            on += 1
        done[j - back : j + on] = bytes([1]) * (back + on)
        found.append((i - back, j - back, back + on))
    return found


def line_table(source: DataFrame) -> DataFrame:
    """row, doc_id, hashes of all lines, and whether each has the words to be rare."""
    lines = F.split(F.col("text"), "\n", -1)
    rare = lambda x: F.regexp_like(x, F.lit(rf"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){{{RARE_WORDS - 1}}}[^\x20\x09-\x0D]"))
    table = source.where("text IS NOT NULL").select("row", "doc_id", F.transform(lines, lambda x: F.xxhash64(x)).alias("lines"), F.transform(lines, rare).alias("rare"))
    return table.where(F.exists("rare", lambda x: x))


def stretches(lines: np.ndarray, rare: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash, spot and length of each stretch: a rare line and the lines after it up to the next rare one (spot: its place + 1), or before it down to the last (minus that). ``doc``: of each line, rising."""
    n, at, place = len(lines), np.nonzero(rare)[0], np.arange(len(lines))
    power = np.cumprod(np.full(n + 1, ODD), dtype=np.uint64)
    inverse = np.cumprod(np.full(n + 1, pow(int(ODD), -1, 1 << 64), np.uint64), dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(lines.view(np.uint64)) * power[:n], dtype=np.uint64)])
    edge = np.concatenate([[-1], at, [n]])  # the rare line that a line follows or is; the next one, or itself
    ahead, behind = edge[np.searchsorted(at, place, "right")], edge[np.searchsorted(at, place, "left") + 1]
    on = (ahead >= 0) & (doc[ahead] == doc)
    back = (behind < n) & (behind != place) & (doc[np.minimum(behind, n - 1)] == doc)
    start, stop = np.concatenate([ahead[on], place[back]]), np.concatenate([place[on], behind[back]]) + 1
    first = np.searchsorted(doc, doc)
    spot = np.concatenate([(ahead - first + 1)[on], (first - behind - 1)[back]])
    h = mix((total[stop] - total[start]) * inverse[start] + (stop - start).astype(np.uint64)).view(np.int64)
    return np.concatenate([doc[on], doc[back]]), h, spot.astype(np.int32), (stop - start).astype(np.int32)


def overlaps(table: DataFrame) -> DataFrame:
    """(row, first): each row with the first holders of its longest shared stretches."""
    types = {"row": pa.int64(), "doc_id": pa.int64(), "h": pa.int64(), "spot": pa.int32(), "length": pa.int32()}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        lines, rare = got.column("lines"), got.column("rare")
        doc = np.repeat(np.arange(got.num_rows), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
        owner, h, spot, length = stretches(lines.flatten().to_numpy(), rare.flatten().to_numpy(zero_copy_only=False), doc)
        owner = pa.array(owner)
        return batch(types, {"row": got.column("row").take(owner), "doc_id": got.column("doc_id").take(owner), "h": h, "spot": spot, "length": length})

    filed = arrow_map(table.select("row", "doc_id", "lines", "rare"), rows, "row long, doc_id long, h long, spot int, length int")
    first = filed.groupBy("h").agg(F.min(F.struct("doc_id", "row")).alias("at"), F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo < hi").select("h", F.col("at.row").alias("first"))
    first = materialise(first, "first-holders")  # written first, so that the join can split a hot stretch
    later = filed.drop("doc_id").join(first, "h").where("row <> first")
    longest = later.groupBy("row", "spot").agg(F.max_by("first", F.struct("length", "first")).alias("first"))
    return longest.select("row", "first").distinct()


def common_blocks(source: DataFrame) -> DataFrame:
    """(row, gone, n_removed): for rows that lose lines, whether each line goes, up to the last that does. ``source``: row, doc_id, text; rows are distinct."""
    table = materialise(line_table(source), "lines")
    earlier = table.select(F.col("row").alias("first"), F.col("lines").alias("first_lines"))
    types = {"row": pa.int64(), "start": pa.int32(), "stop": pa.int32()}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in types}
        for row, lines, rare, other in zip(*(got.column(c).to_pylist() for c in ("row", "lines", "rare", "first_lines")), strict=True):
            proof = {h for h, r in zip(lines, rare, strict=True) if r}.intersection(other)
            blocks = patience_blocks(other, lines)
            blocks += blocks_left_over(other, lines, blocks, proof)
            for _, j, n in blocks:
                if not proof.isdisjoint(lines[j : j + n]):
                    out["row"].append(row)
                    out["start"].append(j)
                    out["stop"].append(j + n)
        return batch(types, out)

    both = materialise(overlaps(table), "overlaps").join(earlier, "first").join(table, "row").select("row", "lines", "rare", "first_lines")
    aligned = arrow_map(both, rows, "row long, start int, stop int")
    runs = aligned.groupBy("row").agg(F.collect_set(F.struct("start", "stop")).alias("runs"))
    mask_types = {"row": pa.int64(), "gone": pa.list_(pa.bool_()), "n_removed": pa.int64()}

    def masks(got: pa.RecordBatch) -> pa.RecordBatch:
        gone = []
        for spans in got.column("runs").to_pylist():
            gone.append(np.zeros(max(r["stop"] for r in spans), bool))
            for r in spans:
                gone[-1][r["start"] : r["stop"]] = True
        return batch(mask_types, {"row": got.column("row"), "gone": gone, "n_removed": [int(x.sum()) for x in gone]})

    return arrow_map(runs, masks, "row long, gone array<boolean>, n_removed long")


def _cut(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """payload (all columns of ``df``), its text without the common blocks, n_lines, n_removed."""
    source = named(df, id_col).withColumn("text", F.col("payload").getField(text_col).cast("string"))
    gone = materialise(common_blocks(source), "common-blocks").hint("shuffle_hash")  # as large inputs join anyway: documents that lose lines grow with the input
    lines = F.split("text", "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    counts = [F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed")]
    return source.join(gone, "row", "left").select("payload", kept.alias("text"), *counts)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text without the common blocks, n_lines, n_removed for every row."""
    return _cut(df.select(id_col, text_col), id_col, text_col).select(F.col("payload").getField(id_col).alias("doc_id"), "text", "n_lines", "n_removed")


def drop_common_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, without the common blocks; a row that loses its last word goes."""
    left = _cut(df, id_col, text_col).where(r"n_removed = 0 OR text RLIKE '[^\\x20\\x09-\\x0D]'")
    return restored(left, df.columns, **{text_col: F.col("text")})
