"""A corpus pipeline: five of the training-data operators, one after the other.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept;
all but the last return the columns of ``documents``, with ``n_chars`` as the text
now is. Between stages the rows are written as Parquet and read again.

1. toxicity: documents predicted toxic go. The machine learns from labelled rows
   that are not held out.
2. line dedup: common blocks of lines go from later documents; a document that has
   no word left after that goes.
3. near-dedup: of each group of near copies the document with the smallest id stays.
4. suffix dedup: strings of 200 bytes and more that came earlier go.
5. packing: the texts as pieces of sequences of 2048 tokens.

Documents without text or words pass all stages. Rows of equal ids are told apart by
line and suffix dedup and are one document to near-dedup, so all of them stay or go;
rows without an id pass near-dedup, which needs one to name them. Equal rows with ids
of their own are copies: one stays. Texts of any length are treated whole. Ties go to
the smallest id, then to the place in the input. Columns beyond those of ``documents``,
whatever their names, come through all stages but the last, which returns pieces. An
empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixspark.llm import linededup, neardup, packing, suffix, toxicity
from mixspark.llm.common import documents, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, machine)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.drop_common_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = neardup.near_duplicates(docs)
    dropped = materialise(verdict.where("doc_id IS NOT NULL AND NOT kept").select(F.col("doc_id").alias("near_copy")).distinct(), "near-copies")
    return docs.join(dropped, docs["doc_id"] == dropped["near_copy"], "left_anti")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.dedup_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]

#: Near-copies, string kernels and byte spans have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
