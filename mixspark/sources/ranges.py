"""Records that may cross the borders of file ranges.

Spark's text source hands out ranges of large files. A record that lies inside a range
is put together by the task that reads the range; only what a range has before its
first border and after its last one travels, to be joined with its neighbours. A task
that can't tell its first border by looking (it does not know what came before) may
pass its whole range on. Joined ends have to make whole records, which proves that the
borders were found rightly.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds of rows, in the order of a range's ends: before its first border, a range without one, after its last border.
HEAD, THROUGH, TAIL = 0, 1, 2


class RangeParser(Protocol):
    def feed(self, values: pa.Array) -> Iterator[pa.RecordBatch]: ...

    def finish(self) -> Iterator[pa.RecordBatch]: ...


def by_range(batches: Iterator[pa.RecordBatch], opened: Callable[[str, int], RangeParser], value: str = "value") -> Iterator[pa.RecordBatch]:
    """Feed the rows (path, start, value) of each range, in order, to a parser of its own."""
    current, parser = None, None
    for got in batches:
        start = got.column("start").to_numpy()
        path = got.column("path").dictionary_encode()
        code = path.indices.to_numpy()
        changes = np.flatnonzero((np.diff(start) != 0) | (np.diff(code) != 0)) + 1
        for lo, hi in zip([0, *changes.tolist()], [*changes.tolist(), got.num_rows], strict=True):
            if lo == hi:
                continue
            key = (path.dictionary[int(code[lo])].as_py(), int(start[lo]))
            if key != current:
                if parser:
                    yield from parser.finish()
                current, parser = key, opened(*key)
            yield from parser.feed(got.column(value).slice(lo, hi - lo))
    if parser:
        yield from parser.finish()


def joined_ends(ends: DataFrame, joined: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, *order: str) -> DataFrame:
    """``ends`` (path, start, kind and more) of each file in order, through ``joined``; a few rows a range."""
    return ends.repartition("path").sortWithinPartitions("path", "start", "kind", *order).mapInArrow(joined, schema)


def decoded(name: Column) -> Column:
    """A file name or path of Spark's metadata as it is on disk."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


#: The start of a path with an empty authority, which not all of Spark writes.
EMPTY = r"^([^:/]+):///"


def bare(path: Column) -> Column:
    return F.regexp_replace(path, EMPTY, "$1:/")


def file_places(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, place): the bare paths of ``files`` and their places in their order; one row a file, which the driver lists anyway."""
    return spark.createDataFrame([(re.sub(EMPTY, r"\1:/", p), i) for i, p in enumerate(sorted(files))], "path string, place long")


def with_places(df: DataFrame, files: list[str]) -> DataFrame:
    """``df`` (path and more) with place, the file's place among the sorted ``files`` of a source."""
    places = file_places(df.sparkSession, files).withColumnRenamed("path", "_at")
    return df.join(places, bare(F.col("path")) == F.col("_at")).drop("_at")
