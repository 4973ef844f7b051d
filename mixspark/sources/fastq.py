"""FASTQ files, four lines a record, put together inside the ranges that Spark reads.

A task knows the lines of its range but not where a record begins in a later part of a
file. It tries the four places and keeps the one at which names, separators and lengths
fit; the lines before it and the incomplete record at the end are joined with the
neighbours' ends, which has to give whole records. Where no place or more than one fits
(names and qualities may hold anything), the range's lines pass on and are counted off
from the record before, one file a task, as a stream. No sequence is shuffled otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixspark.sources.ranges import HEAD, TAIL, THROUGH, by_range, decoded, joined_ends, with_places

FASTQ_NAME = r"\.(fastq|fq)(\.gz)?$"
#: Records that one file can number; lines that tell where a record begins; lines in a row that pass on.
PER_FILE, LOOK, TOGETHER = 1 << 40, 256, 1000

_RECORDS = "path string, start long, idx long, name string, seq string, qual string"
_ENDS = "path string, start long, kind int, idx long, lines array<string>"


def first_record(lines: list[str]) -> int | None:
    """Which of the first four lines begins a record, if that is sure."""
    fits = []
    for p in range(4):
        whole = range(p, len(lines) - 3, 4)
        if whole and all(lines[i].startswith("@") and lines[i + 2].startswith("+") and len(lines[i + 1]) == len(lines[i + 3]) for i in whole):
            fits.append(p)
    return fits[0] if len(fits) == 1 else None


def _records(path: str, start: int, first: int, lines: pa.Array) -> pa.RecordBatch:
    """Lines, a multiple of four, as records."""
    n = len(lines) // 4
    line = lambda k: lines.take(pa.array(np.arange(n) * 4 + k))
    columns = [pa.array([path] * n, pa.string()), pa.array(np.full(n, start, np.int64)), pa.array(np.arange(first, first + n, dtype=np.int64)), line(0), line(1), line(3)]
    return pa.RecordBatch.from_arrays(columns, names=["path", "start", "idx", "name", "seq", "qual"])


class LineRange:
    """The lines of one range; gives its records or its ends."""

    def __init__(self, path: str, start: int, ends: bool):
        self.path, self.start, self.ends = path, start, ends
        self.held: pa.Array = pa.array([], pa.string())
        self.begun, self.passing, self.n = start == 0, False, 0

    def end(self, kind: int, lines: list[str]) -> pa.RecordBatch:
        columns = [pa.array([self.path]), pa.array([self.start], pa.int64()), pa.array([kind], pa.int32()), pa.array([self.n], pa.int64()), pa.array([lines], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=["path", "start", "kind", "idx", "lines"])

    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        self.held = pa.concat_arrays([self.held, values])
        yield from self.give(False)

    def give(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.begun and not self.passing and (last or len(self.held) >= LOOK):
            at = first_record(self.held.slice(0, LOOK).to_pylist())
            if at is None:
                self.passing = True
            else:
                if self.ends:
                    yield self.end(HEAD, self.held.slice(0, at).to_pylist())
                self.held, self.begun = self.held.slice(at), True
        if self.passing:
            while self.ends and len(self.held) and (last or len(self.held) >= TOGETHER):
                yield self.end(THROUGH, self.held.slice(0, TOGETHER).to_pylist())
                self.held, self.n = self.held.slice(TOGETHER), self.n + 1
            if not self.ends:
                self.held = self.held.slice(len(self.held))
        elif self.begun and (whole := len(self.held) // 4 * 4):
            if not self.ends:
                yield _records(self.path, self.start, self.n, self.held.slice(0, whole))
            self.held, self.n = self.held.slice(whole), self.n + whole // 4
        if last and self.begun and self.ends:
            yield self.end(TAIL, self.held.to_pylist())

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self.give(True)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records made of the ends of neighbouring ranges; an incomplete last one of a file is dropped."""
    path, held, start, n = None, [], 0, 0
    for got in batches:
        for r in got.to_pylist():
            if r["path"] != path:
                path, held, start, n = r["path"], [], 0, 0
            if r["kind"] == TAIL:
                held, start, n = r["lines"], r["start"], r["idx"]
                continue
            held += r["lines"]
            if whole := len(held) // 4 * 4:
                yield _records(path, start, n, pa.array(held[:whole], pa.string()))
                held, n = held[whole:], n + whole // 4
            if r["kind"] == HEAD and held:
                raise ValueError(f"{path}: no records of four lines where the range at {r['start']} begins")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """sample, ord, read, seq, qual: four lines a record, whatever they start with; an incomplete last one is dropped."""
    found = spark.read.options(recursiveFileLookup="true", pathGlobFilter="*.{fastq,fq,fastq.gz,fq.gz}").text(path)
    lines = found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    inside = lines.mapInArrow(lambda batches: by_range(batches, lambda p, s: LineRange(p, s, False)), _RECORDS)
    ends = lines.mapInArrow(lambda batches: by_range(batches, lambda p, s: LineRange(p, s, True)), _ENDS)
    across = joined_ends(ends, _joined, _RECORDS, "idx")
    records = with_places(inside.unionByName(across), found.inputFiles())
    sample = F.regexp_replace(decoded(F.regexp_extract("path", r"([^/]+)$", 1)), FASTQ_NAME, "")
    return records.select(sample.alias("sample"), (F.col("place") * PER_FILE + F.col("start") + F.col("idx")).alias("ord"), F.regexp_extract("name", r"^.\s*(\S*)", 1).alias("read"), "seq", "qual")
