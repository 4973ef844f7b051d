"""Periodic runs of words, found through minimizers at several scales.

A run is a stretch of words with smallest period q, at least ``max(12, 2 q)`` words
long, that no neighbouring word extends. Words become numbers; then

* periods below ``LAGS`` are read off direct scans: words equal to those q further on;
* longer periods go by scales, q in [P, 2P). Windows of P * 2/3 consecutive blocks of
  P / 4 words each keep their smallest hash (the minimizers). Inside a run the windows
  repeat at distance q, and so do their minima; pairs of equal minimizers that lie P to
  2P apart are seeds, extended word by word both ways.

Blocks that are periodic themselves (period of P / 8 at most) repeat all too often and
take no part. That loses nothing: they lie in runs that smaller scales have found, and
a run of period q without any other block consists of two such runs that touch; their
common lags follow from the two borders. A stretch that several lags describe has the
smallest of them as its period. So all runs are found, whatever the hashes; equal
hashes of different blocks only cost a comparison.

The documents of a batch are searched side by side with numpy, with a word of its own
between them. Nothing is shuffled and memory is bounded by a batch (see ``common``) or
by one text, at some hundred bytes a word.

Defined cases: a null or empty text and one without words have no run and collapse to
nothing; texts of any length are searched whole; equal rows give equal results, each
its own; a null id is an id; other columns, whatever their names, are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixspark.llm.common import arrow_map, texts
from mixspark.llm.neardup import mix
from mixspark.llm.quality import measures

#: Fewest words of a run; periods below this are scanned directly.
SHORTEST, LAGS = 12, 48

Run = tuple[int, int, int]  # start, length, period


def stretches(equal: np.ndarray, least: int) -> np.ndarray:
    """Starts and ends (two columns) of the stretches of at least ``least`` true values."""
    at = np.flatnonzero(equal)
    if len(at) < least:
        return np.empty((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(at) != 1)
    first, last = at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))]
    keep = last - first + 1 >= least
    return np.stack([first[keep], last[keep] + 1], axis=1)


def equal_ahead(words: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on, a < b."""
    total, step = 0, 64
    while b + total < len(words):
        n = min(step, len(words) - b - total)
        same = words[a + total : a + total + n] == words[b + total : b + total + n]
        if not same.all():
            return total + int(same.argmin())
        total, step = total + n, step * 2
    return total


def equal_behind(words: np.ndarray, a: int, b: int) -> int:
    """How many words just before ``a`` equal those just before ``b``, a < b."""
    total, step = 0, 64
    while a - total > 0:
        n = min(step, a - total)
        same = words[a - total - n : a - total] == words[b - total - n : b - total]
        if not same.all():
            return total + int(same[::-1].argmin())
        total, step = total + n, step * 2
    return total


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Extremes of all windows of ``width`` values, a power of two."""
    size = 1
    while size < width:
        values = best(values[:-size], values[size:])
        size *= 2
    return values


def minimizers(hashes: np.ndarray, usable: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the smallest usable one of some window of ``width`` places."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    top = np.uint64(2**64 - 1)
    held = np.where(usable, np.minimum(hashes, top - np.uint64(1)), top)
    least = sliding(held, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    most = sliding(np.concatenate((edge, least, edge)), width, np.maximum)  # of the windows that hold a place
    return np.flatnonzero(usable & (most == held))


def equal_pairs(hashes: np.ndarray, at: np.ndarray, near: int, far: int) -> np.ndarray:
    """Pairs (two columns) of the places ``at`` with equal hashes, ``near`` to ``far`` - 1 apart."""
    order = np.argsort(hashes[at], kind="stable")
    place, key = at[order], hashes[at][order]
    out, step = [], 1
    while step < len(place):
        within = (key[:-step] == key[step:]) & (place[step:] - place[:-step] < far)
        if not within.any():
            break
        take = within & (place[step:] - place[:-step] >= near)
        out.append(np.stack([place[:-step][take], place[step:][take]], axis=1))
        step += 1
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def shared_lag(words: np.ndarray, left: Run, right: Run) -> int | None:
    """d modulo the period, where words of ``left`` equal those d further on in ``right``; both have that period."""
    (a, _, q), (b, _, _) = left, right
    block, target = words[a : a + q], words[b : b + q]
    for o in np.flatnonzero(block == target[0]):
        if np.array_equal(target[: q - o], block[o:]) and np.array_equal(target[q - o :], block[:o]):
            return int(b - a - o) % q
    return None


class Finder:
    """All runs of one array of numbered words."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        """``lengths``: words of the documents; each is followed by a word found nowhere else."""
        self.words, self.lengths = words, lengths
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(lengths) else np.zeros(0, np.int64)
        self.found: dict[tuple[int, int], int] = {}

    def add(self, first: int, after: int, lag: int) -> None:
        """Words first .. after - 1 equal those ``lag`` further on; lags come in rising order."""
        if after - first >= max(lag, SHORTEST - lag):
            key = (first, after + lag)
            self.found[key] = min(lag, self.found.get(key, lag))

    def extend(self, pairs: np.ndarray) -> None:
        """Seeds, extended; one that lies in a stretch of its lag is passed over."""
        lag = pairs[:, 1] - pairs[:, 0]
        known, end = -1, -1
        for k in np.lexsort((pairs[:, 0], lag)).tolist():
            a, q = int(pairs[k, 0]), int(lag[k])
            if q == known and a < end:
                continue
            first, known = a - equal_behind(self.words, a, a + q), q
            end = a + equal_ahead(self.words, a, a + q)
            self.add(first, end, q)
            end = max(end, a + 1)

    def touching(self, near: int, far: int, least: int) -> None:
        """Lags between two runs of one short period that touch or overlap, both of at least ``least`` words."""
        by_period: dict[int, list[Run]] = {}
        for (a, b), q in self.found.items():
            if q <= near // 8 and b - a >= least:
                by_period.setdefault(q, []).append((a, b - a, q))
        for q, runs in by_period.items():
            runs.sort()
            for left, right in zip(runs, runs[1:]):
                (a, n, _), (b, m, _) = left, right
                if b > a + n or (rest := shared_lag(self.words, left, right)) is None:
                    continue
                seeds = []
                for lag in range(near + (rest - near) % q, min(far, n + 1, m + q + 1), q):
                    first, after = max(a, b - lag), min(a + n, b + m - lag)
                    if lag in (b - a, b + m - a - n):  # both borders at once: the words decide
                        seeds.append((first, first + lag))
                    elif first < after:
                        self.add(first, after, lag)
                if seeds:
                    self.extend(np.array(seeds, np.int64))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, lengths and periods of all runs, by start, then period; places count through all documents."""
        words, longest = self.words, int(self.lengths.max(initial=0))
        for lag in range(1, min(LAGS - 1, longest // 2) + 1):
            for first, after in stretches(words[lag:] == words[:-lag], max(lag, SHORTEST - lag)).tolist():
                self.add(first, after, lag)
        scale = LAGS
        while 2 * scale <= longest:
            self.search(scale)
            scale *= 2
        table = np.array([(a, b - a, q) for (a, b), q in self.found.items()], np.int64).reshape(-1, 3)
        table = table[np.lexsort((table[:, 2], table[:, 0]))]
        return table[:, 0], table[:, 1], table[:, 2]

    def search(self, scale: int) -> None:
        """Periods ``scale`` to 2 * ``scale`` - 1, in the documents that can hold them."""
        block = scale // 4
        fit = self.lengths >= 2 * scale
        # The part of the array that is looked at, and where each of its places comes from.
        origin = np.concatenate([np.arange(s, s + n + 1) for s, n in zip(self.starts[fit], self.lengths[fit], strict=True)])
        hashes, size = mix(self.words[origin].astype(np.uint64) + np.uint64(1)), 1
        while size < block:
            step = min(size, block - size)  # a block as two parts that overlap or touch
            hashes = mix(hashes[:-step] * np.uint64(0x9E3779B97F4A7C15) + mix(hashes[step:]) + np.uint64(step))
            size += step
        periodic = np.zeros(len(self.words) + 2, np.int32)
        for (a, b), q in self.found.items():
            if q <= block // 2 and b - a >= block:
                periodic[a] += 1
                periodic[b - block + 1] -= 1
        usable = np.cumsum(periodic)[origin[: len(hashes)]] == 0
        width = 1 << ((scale - block).bit_length() - 1)
        pairs = equal_pairs(hashes, minimizers(hashes, usable, width), scale, 2 * scale)
        pairs = origin[pairs]
        pairs = pairs[pairs[:, 1] - pairs[:, 0] < 2 * scale]  # not across a document that was left out
        owner = np.searchsorted(self.starts, pairs, "right")
        self.extend(pairs[owner[:, 0] == owner[:, 1]])
        self.touching(scale, 2 * scale, scale)


def runs_of(documents: list[list]) -> list[np.ndarray]:
    """For each list of words its runs: rows of start, length, period, by start, then period."""
    number: dict = {}
    lengths = np.array([len(d) for d in documents], np.int64)
    words = np.empty(int(lengths.sum()) + len(documents), np.int32)
    at = 0
    for k, d in enumerate(documents):
        words[at : at + len(d)] = [number.setdefault(w, len(number)) for w in d]
        words[at + len(d)] = -1 - k
        at += len(d) + 1
    finder = Finder(words, lengths)
    start, length, period = finder.runs()
    bounds = np.searchsorted(start, np.append(finder.starts, len(words) + 1))
    return [np.stack([start[a:b] - s, length[a:b], period[a:b]], axis=1) for a, b, s in zip(bounds, bounds[1:], finder.starts, strict=False)]


def collapsed(words: list, runs: np.ndarray) -> list:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (array of start, length, period, by start, then period) and collapsed: the text without repeats."""
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        split = [t.encode().split() if t else [] for t in got.column("text").to_pylist()]  # of bytes: ASCII white space only
        found = runs_of(split)
        flat = np.concatenate(found) if found else np.empty((0, 3), np.int64)
        offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
        structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run_type))
        kept = pa.array([b" ".join(collapsed(w, f)).decode() for w, f in zip(split, found, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([got.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), structs), kept], names=["doc_id", "runs", "collapsed"])

    return arrow_map(texts(df, id_col, text_col), rows, f"doc_id {dict(texts(df, id_col, text_col).dtypes)['doc_id']}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def longest_run(runs: Column) -> Column:
    """The longest run: the smallest start, then period, among equals; null without runs."""
    first = lambda a, b: (a["length"] > b["length"]) | ((a["length"] == b["length"]) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, lambda best, x: F.when(best.isNull() | first(x, best), x).otherwise(best))


def looped(df: DataFrame) -> DataFrame:
    """doc_id and text; each tenth document, by checksum of its id, repeats its last words from a place and at a period that the checksum names."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(h / 10)
    words = measures(F.coalesce(F.col("text").cast("string"), F.lit("")))["words"]
    n = F.size("words")
    chosen = df.select("doc_id", F.col("text").cast("string").alias("text"), g.alias("g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("loops"))
    cut = chosen.withColumn("words", F.when(F.col("loops"), words)).withColumn("a", F.when(n > 0, F.pmod("g", F.nullif(n, F.lit(0)))).cast("int"))
    sized = cut.withColumn("p", F.expr("CAST(1 + floor((size(words) - a) / (3 + g % 8)) AS INT)"))
    again = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(w))
    return sized.select("doc_id", F.when(F.col("loops") & (n > 0), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def run_report(df: DataFrame) -> DataFrame:
    """The columns that name a document's runs: their count, the longest one, and digests of all and of the collapsed text."""
    found = periodic_runs(df).withColumn("best", longest_run(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{k}").alias(k) for k in ("start", "length", "period")],
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
