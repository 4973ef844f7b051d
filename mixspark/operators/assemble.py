"""Per-sample tables: lineages, row sums, integer counts, flags and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixspark.functions import expr
from mixspark.functions.special import beta_interval
from mixspark.schema import BELOW_DETECTION, BELOW_DETECTION_ID, HIGHER_RANKS, RANKS, UNASSIGNED, UNASSIGNED_ID, UNKNOWN_TAXID


def first_lineages(taxonomy: DataFrame) -> DataFrame:
    """One row a tax_id: the first by ``ord`` (or any equal one without it); missing ranks are 'Unknown'."""
    ranks = [F.col(r) if r in taxonomy.columns else F.lit("Unknown").alias(r) for r in HIGHER_RANKS]
    if "species" not in taxonomy.columns:
        raise ValueError("the taxonomy has no species column")
    order = F.col("ord") if "ord" in taxonomy.columns else F.lit(0)
    rows = taxonomy.select(F.col("tax_id").cast("string").alias("tax_id"), F.struct(order.alias("ord"), "species", *ranks).alias("x"))
    return rows.groupBy("tax_id").agg(F.min("x").alias("x")).select("tax_id", *[f"x.{r}" for r in RANKS])


def with_lineage(rows: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Left join on tax_id; rows without a lineage get their labels. The smaller side is left to Spark to broadcast."""
    joined = rows.join(first_lineages(taxonomy), "tax_id", "left")
    labelled = expr.labelled_lineage(F.col("tax_id"))
    return joined.select(*rows.columns, *[c.alias(r) for r, c in labelled.items()])


def cut_names(rows: DataFrame, binomial: bool) -> DataFrame:
    if not binomial:
        return rows
    fixed = expr.is_placeholder(F.col("species")) | F.col("species").startswith(f"{UNKNOWN_TAXID} ")
    out = rows.withColumn("species", F.when(fixed, F.col("species")).otherwise(expr.binomial_name(F.col("species"))))
    if "identical" in rows.columns:
        out = out.withColumn("identical", F.array_join(F.transform(F.filter(F.split("identical", "; "), lambda n: n != ""), expr.binomial_name), "; "))
    return out


def row_keys(tax_ids: DataFrame, taxonomy: DataFrame, binomial: bool = False) -> DataFrame:
    """(tax_id, row_key): equal keys are one row of the table."""
    named = cut_names(with_lineage(tax_ids.select(F.col("tax_id").cast("string").alias("tax_id")).distinct(), taxonomy), binomial)
    return named.select(F.col("tax_id").cast("long").alias("tax_id"), F.xxhash64(*RANKS).alias("row_key"))


def summed_rows(rows: DataFrame) -> DataFrame:
    """Rows of one sample with the same names become one; their identical species are united without the own name."""
    summed = [F.sum(c).alias(c) for c in ("abundance", "expected_reads", "shared_reads", "alpha") if c in rows.columns]
    named = []
    if "identical" in rows.columns:
        named = [expr.joined_set(F.flatten(F.collect_list(F.split("identical", "; "))), F.first("species")).alias("identical")]
    return rows.groupBy("sample", *RANKS).agg(*summed, *named)


def largest_remainder(rows: DataFrame, weight: str, total: str, by: list[str], order: list[str], name: str) -> DataFrame:
    """Whole numbers in proportion to weights that add up to the total, per group.

    Floors first; what is left goes one each to the largest fractions, ties to the
    earlier row. Without a positive weight every row gets 0. A group is the taxa of
    one sample.
    """
    group = Window.partitionBy(*by)
    whole = F.sum(weight).over(group)
    raw = F.when(whole > 0, F.col(weight) / whole * F.col(total)).otherwise(0.0)
    out = rows.withColumn("_raw", raw).withColumn("_floor", F.floor("_raw"))
    left = F.when(whole > 0, F.col(total) - F.sum("_floor").over(group)).otherwise(0)
    out = out.withColumn("_left", left).withColumn("_n", F.count("*").over(group))
    place = F.row_number().over(group.orderBy(F.desc(F.col("_raw") - F.col("_floor")), *order))
    extra = F.floor(F.col("_left") / F.col("_n")) + F.when(place <= F.pmod("_left", "_n"), 1).otherwise(0)
    return out.withColumn(name, (F.col("_floor") + extra).cast("long")).drop("_raw", "_floor", "_left", "_n")


def sample_tables(estimates: DataFrame, counts: DataFrame, taxonomy: DataFrame, identical: DataFrame | None = None, keep_counts: bool = True, intervals: bool = False, binomial: bool = False) -> DataFrame:
    """All per-sample tables in one DataFrame, with ``row_ord`` for the fixed order.

    ``counts`` (sample, assigned, unassigned) names the samples: each has its two
    placeholder rows, whatever was reported.
    """
    below = estimates.groupBy("sample").agg(F.max("below_detection").alias("below"))
    totals = counts.join(below, "sample", "left").withColumn("below", F.coalesce("below", F.lit(0)))
    taxa = estimates.where("tax_id IS NOT NULL").select("sample", F.col("tax_id").cast("string").alias("tax_id"), "abundance", "expected_reads", "shared_reads", "alpha")
    blank = [F.lit(0.0).alias(c) for c in ("abundance", "expected_reads", "shared_reads", "alpha")]
    places = counts.select("sample", F.explode(F.array(F.lit(BELOW_DETECTION_ID), F.lit(UNASSIGNED_ID))).alias("tax_id"), *blank)
    rows = taxa.unionByName(places)
    if identical is not None:
        rows = rows.join(identical.select(F.col("tax_id").cast("string").alias("tax_id"), F.col("identical_16s_species").alias("identical")), "tax_id", "left").withColumn("identical", F.coalesce("identical", F.lit("")))
    table = summed_rows(cut_names(with_lineage(rows, taxonomy), binomial)).withColumn("_class", expr.row_class(F.col("species")))
    placeholder = F.col("_class") > 0
    columns = ["sample", "species", "abundance", *HIGHER_RANKS]
    table = table.join(totals, "sample")
    if keep_counts:
        table = table.withColumn("_taxa_total", F.when(~placeholder, F.col("assigned") - F.col("below")).otherwise(0))
        table = largest_remainder(table, "abundance", "_taxa_total", ["sample", "_class"], RANKS, "_counts")
        table = table.withColumn("estimated_counts", F.when(F.col("_class") == 1, F.col("below")).when(F.col("_class") == 2, F.col("unassigned")).otherwise(F.col("_counts")).cast("long"))
        columns.append("estimated_counts")
    if identical is not None:
        table = table.withColumnRenamed("identical", "identical_16s_species")
        columns.append("identical_16s_species")
    table = table.withColumn("shared_read_fraction", F.when(placeholder, F.lit(None)).when(F.col("expected_reads") > 0, F.col("shared_reads") / F.col("expected_reads")).otherwise(0.0))
    columns.append("shared_read_fraction")
    if intervals:
        rest = F.sum("alpha").over(Window.partitionBy("sample")) - F.col("alpha")
        table = table.withColumn("_ci", beta_interval(F.when(~placeholder, F.col("alpha")), rest)).withColumn("ci_lower", F.col("_ci.lower")).withColumn("ci_upper", F.col("_ci.upper"))
        columns += ["ci_lower", "ci_upper"]
    order = Window.partitionBy("sample").orderBy("_class", *RANKS)
    return table.withColumn("row_ord", F.row_number().over(order)).select("row_ord", *columns)
