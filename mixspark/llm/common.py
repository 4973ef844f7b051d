"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of text that a function of a batch gets at once (a row over the bytes comes alone).
SLICE, SLICE_BYTES = 500, 1 << 20

#: Bytes of a batch between the JVM and Python.
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only in a local session that names none a folder of our own is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for df in tables:
        path = getattr(df, "written_to", None)
        if path:
            jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(jsc.hadoopConfiguration()).delete(target, True)


def bounded_batches(spark: SparkSession) -> None:
    """Limit the bytes of the batches that Python workers get."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(got: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of at most ``SLICE`` rows and ``SLICE_BYTES`` of strings."""
    size = np.zeros(got.num_rows, np.int64)
    for column in got.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(size), 0
    while at < len(size):
        before = int(total[at - 1]) if at else 0
        end = min(at + SLICE, max(at + 1, int(np.searchsorted(total, before + SLICE_BYTES, "right"))))
        yield got.slice(at, end - at)
        at = end


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with a function of a few hundred rows at a time, which bounds memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole):
                if (out := rows(part)) is not None and out.num_rows:
                    yield out

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def payload(df: DataFrame) -> Column:
    """All columns as one struct, so that no name of theirs can clash with a name of ours."""
    return F.struct(*[df["`" + c.replace("`", "``") + "`"] for c in df.columns]).alias("payload")


def named(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """row (names the row), doc_id (the id as a long) and payload (all columns).

    Ids name rows unless one repeats or is null; then the rows are written once and
    named by their place in that table, so equal ids are never gathered in one task.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), payload(df))
    if rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").take(1):
        return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "named-rows")
    return rows.withColumn("row", F.col("doc_id"))


def restored(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``payload`` again, but for those that are changed."""
    return df.select(*[(changed[c] if c in changed else F.col("payload").getField(c)).alias(c) for c in columns])


def batch(types: dict[str, pa.DataType], columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in types.items()], names=list(types))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; other columns can't clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
