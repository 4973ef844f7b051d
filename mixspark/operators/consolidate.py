"""Tables across samples: consolidated matrices, collapse and combination by rank. Writers put rows in order."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixspark.functions import expr
from mixspark.schema import BELOW_DETECTION, HIGHER_RANKS, RANKS, UNASSIGNED


def check_rank(rank: str) -> list[str]:
    if rank not in RANKS:
        raise ValueError(f"rank must be one of {RANKS}")
    return RANKS[RANKS.index(rank) :]


def normal_rows(tables: DataFrame) -> DataFrame:
    """Per-sample rows with normal species names, numbers as numbers, and clean ranks."""
    ranks = [F.when(F.trim(F.coalesce(F.col(r), F.lit(""))) == "nan", "").otherwise(F.trim(F.coalesce(F.col(r), F.lit("")))).alias(r) for r in HIGHER_RANKS]
    counts = [expr.truncated_count(F.col("estimated_counts")).alias("estimated_counts")] if "estimated_counts" in tables.columns else []
    order = [F.col("row_ord")] if "row_ord" in tables.columns else [F.lit(0).alias("row_ord")]
    return tables.select("sample", *order, expr.normal_species(F.col("species")).alias("species"), expr.number_or_zero(F.col("abundance")).alias("abundance"), *counts, *ranks)


def species_order() -> list:
    return [expr.row_class(F.col("species")), F.col("species")]


def _matrix(rows: DataFrame, samples: list[str], metric: str, zero) -> DataFrame:
    """Species by sample; the unassigned row is always there. Samples are columns, so their list must be known."""
    own = rows.select("species", "sample", metric)
    blank = rows.sparkSession.createDataFrame([(UNASSIGNED, s, zero) for s in samples], own.select("species", "sample", F.col(metric)).schema)
    return own.unionByName(blank).groupBy("species").pivot("sample", samples).agg(F.sum(metric)).na.fill(zero)


def matrix_arrays(rows: DataFrame, keys: list[str], metric: str, samples: list[str], kind: str = "double") -> DataFrame:
    """``keys`` and values: for each of ``samples``, in that order, the sum of ``metric`` or 0.

    A row is gathered from the samples that have it and filled up as one array, so the
    number of samples is not that of columns or aggregates of a plan.
    """
    places = rows.sparkSession.createDataFrame([(s, i) for i, s in enumerate(samples)], "sample string, place int")
    sums = rows.groupBy(*keys, "sample").agg(F.sum(metric).alias("value")).join(places, "sample")
    width = len(samples)

    @F.pandas_udf(f"array<{kind}>")
    def filled(places: pd.Series, values: pd.Series) -> pd.Series:
        def one(at: np.ndarray, value: np.ndarray) -> np.ndarray:
            out = np.zeros(width, np.int64 if kind == "bigint" else float)
            out[at] = np.nan_to_num(np.asarray(value, float))
            return out

        return pd.Series([one(at, value) for at, value in zip(places, values, strict=True)], dtype=object)

    pairs = sums.groupBy(*keys).agg(F.collect_list(F.struct("place", F.coalesce("value", F.lit(0)).alias("value"))).alias("x"))
    return pairs.select(*keys, filled(F.col("x.place"), F.col("x.value")).alias("values"))


def otu_arrays(tables: DataFrame, samples: list[str], metric: str) -> DataFrame | None:
    """``otu_abundance`` or ``otu_counts`` with an array in place of columns; None where no sample has the metric."""
    if metric not in tables.columns:
        return None
    own = normal_rows(tables).select("species", "sample", metric)
    blank = own.sparkSession.createDataFrame([(UNASSIGNED, samples[0], 0)] if samples else [], "species string, sample string, value int")
    rows = own.unionByName(blank.select("species", "sample", F.col("value").cast(dict(own.dtypes)[metric]).alias(metric)))
    return matrix_arrays(rows, ["species"], metric, samples, "double" if metric == "abundance" else "bigint")


def combined_arrays(tables: DataFrame, rank: str, samples: list[str], counts: bool = False) -> DataFrame:
    """``combine`` with an array in place of columns."""
    rows, there, metric = _combined_rows(tables, rank, samples, counts)
    out = matrix_arrays(rows, there, metric, samples)
    return out.withColumn("values", F.transform("values", lambda v: F.bround(v, 0).cast("long"))) if counts else out


def otu_abundance(tables: DataFrame, samples: list[str]) -> DataFrame:
    return _matrix(normal_rows(tables), samples, "abundance", 0.0)


def otu_counts(tables: DataFrame, samples: list[str]) -> DataFrame | None:
    """None where no sample has counts."""
    return _matrix(normal_rows(tables), samples, "estimated_counts", 0) if "estimated_counts" in tables.columns else None


def modal_lineages(tables: DataFrame) -> DataFrame:
    """The most frequent lineage of each species over all samples; ties go to the one seen first.

    Rows are seen in order of sample, then row.
    """
    rows = normal_rows(tables)
    taxa = rows.where(~expr.is_placeholder(F.col("species")))
    tally = taxa.groupBy("species", *HIGHER_RANKS).agg(F.count("*").alias("n"), F.min(F.struct("sample", "row_ord")).alias("seen"))
    best = tally.groupBy("species").agg(F.min(F.struct((-F.col("n")).alias("n"), "seen", *HIGHER_RANKS)).alias("x")).select("species", *[f"x.{r}" for r in HIGHER_RANKS])
    found = rows.where(F.col("species") == BELOW_DETECTION).select("species").distinct()
    places = found.union(rows.sparkSession.createDataFrame([(UNASSIGNED,)], "species string"))
    return best.unionByName(places.select("species", *[F.lit("").alias(r) for r in HIGHER_RANKS]))


def sample_metadata(tables: DataFrame) -> DataFrame:
    """sample, total_abundance, n_taxa_detected, assigned_counts, unassigned_counts."""
    rows = normal_rows(tables)
    counts = F.col("estimated_counts") if "estimated_counts" in rows.columns else F.lit(0)
    cells = rows.groupBy("sample", "species").agg(F.sum("abundance").alias("a"), F.sum(counts).cast("long").alias("c"))
    unassigned = F.col("species") == UNASSIGNED
    return cells.groupBy("sample").agg(
        F.bround(F.sum(F.when(~unassigned, F.col("a")).otherwise(0.0)), 8).alias("total_abundance"),
        F.count_if((F.col("a") > 0) & ~expr.is_placeholder(F.col("species"))).alias("n_taxa_detected"),
        F.sum(F.when(~unassigned, F.col("c")).otherwise(0)).alias("assigned_counts"),
        F.sum(F.when(unassigned, F.col("c")).otherwise(0)).alias("unassigned_counts"),
    )


def collapse(table: DataFrame, rank: str) -> DataFrame:
    """Sums of abundance (and counts, as doubles) by a rank and all above it; null ranks are a group."""
    ranks = check_rank(rank)
    zero = lambda c: F.when(F.col(c).cast("string") == "-", F.lit(0.0)).otherwise(F.col(c).cast("double"))
    metrics = ["abundance"] + ["estimated_counts"] * ("estimated_counts" in table.columns)
    by = ["sample"] * ("sample" in table.columns) + ranks
    clean = [F.when(F.col(r) == "-", "0").otherwise(F.col(r)).alias(r) for r in ranks]
    return table.select(*by[: len(by) - len(ranks)], *clean, *[zero(m).alias(m) for m in metrics]).groupBy(*by).agg(*[F.sum(m).alias(m) for m in metrics])


def combine(tables: DataFrame, rank: str, samples: list[str], counts: bool = False, split: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """One column a sample: a union and a pivot stand for the chain of full outer joins."""
    rows, there, metric = _combined_rows(tables, rank, samples, counts)
    wide = rows.groupBy(*there).pivot("sample", samples).agg(F.sum(metric)).na.fill(0.0)
    if counts:
        wide = wide.select(*there, *[F.bround(f"`{s}`", 0).cast("long").alias(s) for s in samples])
    return (wide.select(*there), wide.select(rank, *[f"`{s}`" for s in samples])) if split else wide


def _combined_rows(tables: DataFrame, rank: str, samples: list[str], counts: bool) -> tuple[DataFrame, list[str], str]:
    """Rows with the ranks that the tables have, those ranks, and the metric's name."""
    ranks, metric = check_rank(rank), "estimated_counts" if counts else "abundance"
    if not samples:
        raise ValueError("no per-sample tables")
    for c in (rank, metric):
        if c not in tables.columns:
            raise ValueError(f"column {c} not found" + " (were counts kept?)" * (c == "estimated_counts"))
    there = [r for r in ranks if r in tables.columns]
    return tables.select("sample", *[F.coalesce(r, F.lit("")).alias(r) for r in there], expr.number_or_zero(F.col(metric)).alias(metric)), there, metric


def sample_names(tables: DataFrame) -> list[str]:
    """In order; a name each in the head of a matrix, which the driver writes."""
    return [r.sample for r in tables.select("sample").distinct().orderBy("sample").collect()]
