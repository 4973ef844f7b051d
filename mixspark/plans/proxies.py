"""The domain's tables as deterministic views of the star-schema tables.

Alignments come from order lines (sample: order status, read: order, species:
supplier), taxonomies from suppliers, nations and regions, reference sequences from
document texts. Nothing is sampled or cut: each view covers its whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixspark.operators.graph import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_and_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both tables; many lines (counted in their files' footers) are dealt out by order with as many partitions as they need."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    rows = lines.count()
    return dealt(lines, rows, "l_orderkey"), dealt(orders, rows, "o_orderkey")


def alignments(spark: SparkSession, sf_dir: str, skewed: bool = False) -> DataFrame:
    """Raw alignment records; orders without lines are unmapped reads.

    ``skewed``: ten species in place of one a supplier, the first with a third of all
    records and the last with a twentieth, so that the estimators have some to prune.
    """
    species = F.floor(F.pow(F.col("l_suppkey") % 100, 2) / 1000) if skewed else F.col("l_suppkey")
    lines, orders = lines_and_orders(spark, sf_dir)
    whole = lambda c: F.round(c).cast("long")
    ins, dele = whole(F.col("l_discount") * 100), whole(F.col("l_tax") * 100)
    clip, sub = F.col("l_quantity").cast("long") % 5, F.col("l_quantity").cast("long") % 7
    length = F.lit(1000) + F.col("l_partkey") % 500
    number = F.col("l_linenumber")
    bare, key = F.col("l_orderkey").isNull(), F.col("o_orderkey")
    on_line = lambda c: F.when(~bare, c)
    # one join gives both kinds, so that lines are dealt out by order once
    return orders.join(lines, key == F.col("l_orderkey"), "left").select(
        F.col("o_orderstatus").alias("sample"),
        F.when(bare, key * 8).otherwise(key * 8 + number).cast("long").alias("ord"),
        key.cast("string").alias("read"),
        F.when(bare, 4).when(number == 1, 0).when(number < 5, 256).otherwise(2048).alias("flag"),
        on_line(F.concat_ws(":", species.cast("string"), F.lit("db"), number.cast("string"))).alias("ref"),
        on_line(F.concat(clip.cast("string"), F.lit("S"), length.cast("string"), F.lit("M"), ins.cast("string"), F.lit("I"), dele.cast("string"), F.lit("D"))).alias("cigar"),
        on_line(ins + dele + sub).alias("nm"),
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per supplier but for a few without one; some species are blank."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).where("s_suppkey % 11 <> 5")
    key = F.col("s_suppkey")
    name = F.concat(F.when(key % 10 == 0, "Candidatus ").otherwise(""), "n_name", F.lit(" sp"), (key % 7).cast("string"), F.lit(" strain"), key.cast("string"))
    return joined.select(key.cast("string").alias("tax_id"), F.when(key % 13 == 6, "").otherwise(name).alias("species"), F.col("n_name").alias("genus"), F.col("r_name").alias("family"), F.lit("").alias("order"), F.lit("").alias("class"), F.col("r_name").alias("phylum"), F.col("r_name").alias("superkingdom"))


def identical(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    names = F.concat("n_name", F.lit(" sp0; "), "n_name", F.lit(" sp1"))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).where("s_suppkey % 3 = 0").select(F.col("s_suppkey").cast("string").alias("tax_id"), names.alias("identical_16s_species"))


def estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number weights in place of abundances, so that sums are exact in any order."""
    lines, orders = lines_and_orders(spark, sf_dir)
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    n = F.count("*")
    return joined.groupBy(F.col("o_orderstatus").alias("sample"), F.col("l_suppkey").alias("tax_id")).agg(n.cast("double").alias("abundance"), n.cast("double").alias("expected_reads"), F.count_if(F.col("l_quantity").cast("long") % 3 == 0).cast("double").alias("shared_reads"), (n + 1).cast("double").alias("alpha"), F.lit(7).cast("long").alias("below_detection"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    hit = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("hit")).distinct()
    return orders.join(hit, "o_orderkey", "left").groupBy(F.col("o_orderstatus").alias("sample")).agg(F.count("hit").alias("assigned"), F.count_if(F.col("hit").isNull()).alias("unassigned"))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ord, header, seq (the letters of a document), source, lang; some headers can't be read."""
    d = table(spark, sf_dir, "documents")
    key = F.col("doc_id")
    suffix = F.when(key % 3 == 0, "").when(key % 3 == 1, "_A").otherwise("_B")
    lineage = F.concat(F.lit("d__Bacteria;p__"), "lang", F.lit(";c__;o__;f__"), "source", F.lit(";g__"), "lang", F.lit("_C;s__"), "source", suffix, F.lit(" "), "lang")
    header = F.when(key % 17 == 3, F.concat(F.lit(">g"), key.cast("string"))).otherwise(F.concat(F.lit(">g"), key.cast("string"), F.lit("~c1 "), lineage, F.lit(" [n=1]")))
    return d.select(key.alias("ord"), header.alias("header"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"), "source", "lang")


def carried(spark: SparkSession, sf_dir: str, genus: str) -> tuple[DataFrame, DataFrame]:
    """Sequences with ids, and a taxonomy with a species for each (source, language)."""
    rows = sequences(spark, sf_dir).withColumn("tax_id", F.crc32(F.concat_ws("/", "source", "lang").cast("binary")).cast("string"))
    named = rows.select("ord", F.concat_ws(":", "tax_id", F.lit("db"), F.col("ord").cast("string")).alias("seq_id"), "seq")
    taxa = rows.select("tax_id", F.concat_ws(" ", "source", "lang").alias("species"), F.col(genus).alias("genus"), F.col("source").alias("family"), F.col("lang").alias("phylum")).distinct()
    return named, taxa


def tree(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ids, nodes, names): strain, species, genus, superkingdom and root."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    key = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    level = lambda df, at, parent, rank, name: df.select(at.alias("tax_id"), parent.alias("parent"), F.lit(rank).alias("rank"), name.alias("name"))
    nodes = level(s, key("t", "s_suppkey"), key("s", "s_suppkey"), "strain", F.concat("s_name", F.lit(" strain")))
    for more in (level(s, key("s", "s_suppkey"), key("n", "s_nationkey"), "species", F.col("s_name")), level(n, key("n", "n_nationkey"), key("r", "n_regionkey"), "genus", F.col("n_name")), level(r, key("r", "r_regionkey"), F.lit("1"), "superkingdom", F.col("r_name")), level(r.limit(1), F.lit("1"), F.lit("1"), "no rank", F.lit("root"))):
        nodes = nodes.unionByName(more)
    return s.select(key("t", "s_suppkey").alias("tax_id")), nodes.select("tax_id", "parent", "rank"), nodes.select("tax_id", "name")


def samplesheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    ext = F.when(k % 3 == 0, ".fastq.gz").when(k % 3 == 1, ".fq").otherwise(".txt")
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("s"), (k % 500).cast("string"), F.when(k % 97 == 0, "!").otherwise("")).alias("sample"), F.concat(F.lit("/d"), (k % 5).cast("string"), F.lit("/s"), (k % 500).cast("string"), ext).alias("fastq"))
