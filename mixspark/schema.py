"""Column names, rank lists and labels that the whole engine shares."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of table columns and of the two placeholder rows.
HIGHER_RANKS = ["genus", "family", "order", "class", "phylum", "superkingdom"]
RANKS = ["species", *HIGHER_RANKS]
BELOW_DETECTION, UNASSIGNED = "Below detection", "Unassigned"
BELOW_DETECTION_ID, UNASSIGNED_ID = "below_detection", "unassigned"
UNKNOWN_TAXID = "Unknown taxid"

ALIGNMENT = T.StructType([
    T.StructField("sample", T.StringType()),
    T.StructField("ord", T.LongType()),
    T.StructField("read", T.StringType()),
    T.StructField("flag", T.IntegerType()),
    T.StructField("ref", T.StringType()),
    T.StructField("cigar", T.StringType()),
    T.StructField("nm", T.LongType()),
])
READ = T.StructType([T.StructField(c, T.StringType()) for c in ("sample", "read", "seq", "qual")])
SEQUENCE = T.StructType([T.StructField("ord", T.LongType()), T.StructField("header", T.StringType()), T.StructField("seq", T.StringType())])
TAXONOMY = T.StructType([T.StructField(c, T.StringType()) for c in ("tax_id", *RANKS)])
SAMPLESHEET = T.StructType([T.StructField(c, T.StringType()) for c in ("sample", "fastq")])
