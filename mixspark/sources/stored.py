"""Read scores as a stored table in buckets of (sample, read).

What the estimators do with a read needs all its scores together. A table written in
buckets keeps them so: steps over it group, rank and normalise reads without a shuffle
by read, in this session and in any later one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixspark.operators.graph import parts_of, written
from mixspark.sources.joining import file_system

COLUMNS = {"sample": "string", "read": "string", "tax_id": "bigint", "log_score": "double"}
BY = ["sample", "read"]


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}.buckets"


def store_scores(scores: DataFrame, path: str, buckets: int = 200, rows: int | None = None) -> DataFrame:
    """Write ``scores`` (sample, read, tax_id, log_score) to ``path`` in at least ``buckets`` sorted buckets and return the table.

    A bucket is one file: rows are dealt to its task first. A read's scores share a
    bucket; a sample of any size is spread over all of them. A bucket is sorted by one
    task here and by one of each step over it, so there are more of them for many rows,
    about a million in each. ``rows``: how many there are, or at most, if known; else the
    scores are written once before and counted.
    """
    spark = scores.sparkSession
    if rows is None:
        scores = written(scores, "read-scores")
        rows = scores.count()
    buckets = max(buckets, parts_of(rows))
    placed = scores.select(*[F.col(c).cast(t).alias(c) for c, t in COLUMNS.items()]).repartition(buckets, *BY)
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    placed.write.bucketBy(buckets, *BY).sortBy(*BY).format("parquet").option("path", path).mode("overwrite").saveAsTable(_name(path))
    fs, at = file_system(spark, path)
    out = fs.create(at(_beside(path)), True)
    out.write(bytearray(str(buckets).encode()))
    out.close()
    return spark.table(_name(path))


def stored_scores(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``store_scores`` wrote to ``path``, in this session or an earlier one."""
    if not spark.catalog.tableExists(_name(path)):
        (buckets,) = [r.value for r in spark.read.text(_beside(path)).collect()]
        columns = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY ({', '.join(BY)}) SORTED BY ({', '.join(BY)}) INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    return spark.table(_name(path))


def _name(path: str) -> str:
    """A table's name in the session's catalog, for its path."""
    return "read_scores_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()
