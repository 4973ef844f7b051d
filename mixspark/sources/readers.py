"""Readers of the domain's files as DataFrames.

Text formats use Spark's own readers, which split large plain files into ranges and
decompress packed ones as a stream: lines for SAM and tables, stretches up to the next
header mark for FASTA. ``ord`` keeps the order of records: the file's place
in the sorted list of paths, then the range's start, then the place in the range. BAM
and FASTQ files, whose records take more than a line, have modules of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mixspark.operators.graph import written
from mixspark.schema import SAMPLESHEET
from mixspark.sources.bam import read_bam  # noqa: F401
from mixspark.sources.fastq import FASTQ_NAME, read_fastq  # noqa: F401
from mixspark.sources.ranges import decoded

#: Records that one file can number; ranges (of some 100 MB) of which what comes before is broadcast.
PER_FILE, FEW_RANGES = 1 << 40, 100_000
SAMPLE_ID = r"^[A-Za-z0-9._-]+$"


def _places(paths: DataFrame) -> DataFrame:
    """path and place of each file; names only, one row a file."""
    return paths.distinct().withColumn("place", F.row_number().over(Window.orderBy("path")) - 1)


def in_file_order(found: DataFrame) -> DataFrame:
    """``found`` (rows of a file source, as read) with file (its name), ord, and n: the row's number in its file.

    A range of a file is read in order by one task; the starts and row counts of the
    ranges, one small row each, give what comes before; they are counted when this is
    called. A record has at least one byte, so range start plus place in the range
    never passes the next range's start.
    """
    at = {"_file": "file_name", "_path": "file_path", "_start": "file_block_start"}
    marked = found.select("*", *[F.col(f"_metadata.{v}").alias(k) for k, v in at.items()], F.monotonically_increasing_id().alias("_id"))
    ranges = marked.groupBy("_path", "_start").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = written(ranges.join(_places(ranges.select(F.col("_path").alias("path"))), F.col("_path") == F.col("path")).select("_path", "_start", "_first", "place", before.alias("_before")), "file-ranges")
    inside = F.col("_id") - F.col("_first")
    few = ranges.limit(FEW_RANGES + 1).count() <= FEW_RANGES  # else the join shuffles
    out = marked.join(F.broadcast(ranges) if few else ranges, ["_path", "_start"])
    return out.select(*found.columns, F.col("_file").alias("file"), (F.col("place") * PER_FILE + F.col("_start") + inside).alias("ord"), (F.col("_before") + inside).alias("n"))


def _text(spark: SparkSession, path: str, pattern: str = "*", **options) -> DataFrame:
    return in_file_order(spark.read.options(recursiveFileLookup="true", pathGlobFilter=pattern, **options).text(path))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """ord, header (without '>'), seq; plain or gzipped files. Text before the first header is dropped."""
    chunks = _text(spark, path, lineSep="\n>")
    # only the first stretch of a file still has its mark, or has none to have
    record = F.when(F.col("n") > 0, F.col("value")).when(F.startswith("value", F.lit(">")), F.substring("value", 2, 1 << 30))
    parts = chunks.select("ord", record.alias("record")).where("record IS NOT NULL").select("ord", F.split("record", "\n", 2).alias("f"))
    seq = F.regexp_replace(F.coalesce(F.get("f", F.lit(1)), F.lit("")), r"\s*\n|\s+$", "")
    return parts.select("ord", F.regexp_replace(F.get("f", F.lit(0)), r"\s+$", "").alias("header"), seq.alias("seq"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """sample (file name), ord, read, flag, ref, cigar, nm. Header-only files have no rows."""
    lines = _text(spark, path, "*.sam").select("value", F.regexp_replace(decoded(F.col("file")), r"\.sam$", "").alias("sample"), "ord")
    parts = lines.where(~F.col("value").startswith("@") & (F.col("value") != "")).withColumn("f", F.split("value", "\t"))
    star = lambda i: F.when(F.col("f")[i] != "*", F.col("f")[i])
    nm = F.regexp_extract("value", r"\tNM:i:(-?\d+)", 1)
    return parts.select("sample", "ord", F.col("f")[0].alias("read"), F.col("f")[1].cast("int").alias("flag"), star(2).alias("ref"), star(5).alias("cigar"), F.when(nm != "", nm.cast("long")).alias("nm"))


def read_samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """sample and fastq; a sheet without rows is an error. No line is a comment."""
    sheet = spark.read.csv(path, header=True, schema=SAMPLESHEET, mode="FAILFAST")
    if not sheet.take(1):
        raise ValueError(f"the sample sheet {path} has no rows")
    return sheet


def samplesheet_faults(sheet: DataFrame) -> DataFrame:
    """(sample, fault) for ids and file names against the rules, and repeated samples."""
    bad = sheet.select("sample", F.array_compact(F.array(
        F.when(F.col("sample").isNull() | ~F.col("sample").rlike(SAMPLE_ID), F.lit("bad sample id")),
        F.when(F.col("fastq").isNull() | ~F.col("fastq").rlike(FASTQ_NAME), F.lit("not a FASTQ name")),
    )).alias("x")).select("sample", F.explode("x").alias("fault"))
    twice = sheet.groupBy("sample").count().where("count > 1").select("sample", F.lit("sample more than once").alias("fault"))
    return bad.unionByName(twice)


def discovered_samples(paths: DataFrame) -> DataFrame:
    """(sample, paths) of FASTQ files found in a folder; ``paths``: path. Sorted lists, for the clash report."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    fastq = paths.where(name.rlike(FASTQ_NAME)).withColumn("sample", F.regexp_replace(name, FASTQ_NAME, ""))
    return fastq.groupBy("sample").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def sample_clashes(paths: DataFrame) -> DataFrame:
    return discovered_samples(paths).where(F.size("paths") > 1)


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths below a folder of any file system that Spark knows; empty files too, which its readers skip."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found, paths = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True), []
    while found.hasNext():
        paths.append((found.next().getPath().toString(),))
    return spark.createDataFrame(paths, "path string")


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of a folder; clashing or bad names are an error that lists the files."""
    paths = listed_files(spark, folder)
    clash = sample_clashes(paths).limit(20).collect()
    if clash:
        raise ValueError("samples with more than one file: " + "; ".join(f"{r.sample}: {', '.join(r.paths)}" for r in clash))
    bad = discovered_samples(paths).where(~F.col("sample").rlike(SAMPLE_ID)).limit(20).collect()
    if bad:
        raise ValueError("bad sample ids: " + ", ".join(r.sample for r in bad))
    return discovered_samples(paths).select("sample", F.col("paths")[0].alias("fastq")).orderBy("sample")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, with ``ord``; empty fields are null."""
    return in_file_order(spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote="")).drop("file", "n")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path)


def read_dump(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A '|'-separated dump file: the first columns, trimmed."""
    parts = F.split("value", r"\|")
    return spark.read.text(path).where(F.trim("value") != "").select(*[F.trim(F.regexp_replace(parts[i], "\t", "")).alias(c) for i, c in enumerate(columns)])


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return read_dump(spark, path, ["tax_id", "parent", "rank"])


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Scientific names only."""
    return read_dump(spark, path, ["tax_id", "name", "unique_name", "class"]).where("class = 'scientific name'").select("tax_id", "name")


def read_seq2tax(spark: SparkSession, path: str) -> DataFrame:
    """Exactly two tab-separated fields a line."""
    parts = _text(spark, path).select(F.split("value", "\t").alias("f"), "ord")
    wrong = F.raise_error(F.concat(F.lit("not two fields: "), F.array_join("f", "\t"))).cast("string")
    return parts.select(F.when(F.size("f") == 2, F.col("f")[0]).otherwise(wrong).alias("seq_id"), F.col("f")[1].alias("tax_id"), "ord")


def read_identical(spark: SparkSession, path: str | None) -> DataFrame | None:
    """None: no column wanted. '' or a file of another form: an empty table, which gives an empty column."""
    empty = spark.createDataFrame([], "tax_id string, identical_16s_species string")
    if path is None:
        return None
    if path == "":
        return empty
    got = read_tsv(spark, path)
    return got.select("tax_id", "identical_16s_species") if {"tax_id", "identical_16s_species"} <= set(got.columns) else empty


def read_sample_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All *_rel-abundance.tsv of a folder, told apart by ``sample``; text columns as written. None is an error."""
    if not listed_files(spark, folder).where(F.col("path").rlike(r"_rel-abundance\.tsv$")).take(1):
        raise ValueError(f"no *_rel-abundance.tsv in {folder}")
    lines = _text(spark, folder, "*_rel-abundance.tsv").where("value <> ''").select("file", "ord", "n", F.floor(F.col("ord") / PER_FILE).alias("place"), F.split("value", "\t", -1).alias("f"))
    heads = lines.where("n = 0").select("place", F.col("f").alias("head"))
    columns = list(dict.fromkeys(c for r in heads.select("head").distinct().collect() for c in r.head))  # a file each has its own
    named = lines.where("n > 0").join(heads, "place").select("file", "ord", F.map_from_arrays("head", F.slice("f", F.lit(1), F.size("head"))).alias("x"))
    sample = F.regexp_replace("file", r"_rel-abundance\.tsv$", "")
    return named.select(decoded(sample).alias("sample"), F.col("ord").alias("row_ord"), *[F.nullif(F.element_at("x", F.lit(c)), F.lit("")).alias(c) for c in columns])


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """assigned and unassigned of one-object JSON files, the sample from the file name."""
    got = spark.read.json(path, schema="assigned_count long, unassigned_count long", multiLine=True)
    return got.select(F.regexp_extract("_metadata.file_name", r"^(.+?)(_counts)?\.json$", 1).alias("sample"), F.col("assigned_count").alias("assigned"), F.col("unassigned_count").alias("unassigned"))


def read_estimates(spark: SparkSession, path: str) -> DataFrame:
    """Estimates of one-object JSON files (abundance, below_detection_count and maybe read_summary), the sample from the file name.

    A sample without a reported species has one row with a null tax_id.
    """
    fields = "expected_reads double, shared_reads double, alpha double"
    got = spark.read.json(path, schema=f"abundance map<string, double>, below_detection_count long, read_summary map<string, struct<{fields}>>", multiLine=True)
    sample = F.regexp_extract("_metadata.file_name", r"^(.+?)(_abundance)?\.json$", 1).alias("sample")
    rows = got.select(sample, F.explode_outer("abundance").alias("tax_id", "abundance"), "read_summary", F.col("below_detection_count").alias("below_detection"))
    own = F.element_at("read_summary", F.col("tax_id"))
    return rows.select("sample", F.col("tax_id").cast("long").alias("tax_id"), "abundance", *[own[c].alias(c) for c in ("expected_reads", "shared_reads", "alpha")], "below_detection")
