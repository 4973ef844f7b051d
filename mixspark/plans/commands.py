"""The engine's commands from files to files; alignments come as SAM or BAM, one file a sample."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mixspark.functions import expr
from mixspark.operators import assemble, consolidate, refdb
from mixspark.operators.graph import written
from mixspark.plans import api
from mixspark.schema import RANKS
from mixspark.sources import readers, writers


def listed_samples(spark: SparkSession, source: str) -> DataFrame:
    """sample and fastq of a sample sheet (*.csv) or of a folder of FASTQ files; faults are errors that name them."""
    if not source.endswith(".csv"):
        return readers.discover(spark, source)
    sheet = readers.read_samplesheet(spark, source)
    faults = readers.samplesheet_faults(sheet).limit(20).collect()
    if faults:
        raise ValueError("sample sheet: " + "; ".join(f"{r.sample}: {r.fault}" for r in faults))
    return sheet


def read_alignments(spark: SparkSession, folder: str) -> DataFrame:
    """All SAM and BAM files of a folder."""
    ends = {r.e for r in readers.listed_files(spark, folder).select(F.regexp_extract("path", r"\.(sam|bam)$", 1).alias("e")).distinct().collect()} - {""}
    if not ends:
        raise ValueError(f"no SAM or BAM file in {folder}")
    found = [{"sam": readers.read_sam, "bam": readers.read_bam}[e](spark, folder) for e in sorted(ends)]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _observed(tables: DataFrame, counted: Column, name: str) -> tuple[DataFrame, Callable[[], list[str]]]:
    """``tables``, and the samples without a row of ``counted``, known once a job has gone through the tables; at most 100 names.

    The names of all samples and of those with such a row come with that job's metrics.
    """
    seen = Observation(name)
    sample = F.col("sample")
    watched = tables.observe(seen, F.collect_set(sample).alias("every"), F.collect_set(F.when(counted, sample)).alias("some"))
    return watched, lambda: sorted(set(seen.get["every"]) - set(seen.get["some"]))[:100]


def abundance(spark: SparkSession, alignments: str, taxonomy: str, out: str, samples: str | None = None, identical: str | None = None, **options) -> DataFrame:
    """Alignment files to a table for each sample and the tables across samples, in the folder ``out``.

    ``samples``: a sample sheet or FASTQ folder whose samples all get a table, also
    without an alignment; else those of the alignment files. ``identical``: as
    ``read_identical``. options: as ``api.abundance``. Returns the per-sample tables.
    """
    records = read_alignments(spark, alignments)
    names = None if samples is None else listed_samples(spark, samples).select("sample")
    if names is None:
        names = readers.listed_files(spark, alignments).select(F.regexp_extract("path", r"([^/]+)\.(sam|bam)$", 1).alias("sample")).where("sample <> ''").distinct()
    got = api.abundance(records.join(names, "sample", "left_semi"), readers.read_taxonomy(spark, taxonomy), readers.read_identical(spark, identical), names, **options)
    return _write_tables(got, out)


def tables_of_estimates(spark: SparkSession, estimates: str, counts: str, taxonomy: str, out: str, identical: str | None = None, keep_counts: bool = True, credible_intervals: bool = False, binomial_names: bool = False) -> DataFrame:
    """Estimate and count files (JSON, one of each a sample) to tables, as ``abundance`` writes them."""
    found = readers.read_estimates(spark, estimates)
    if credible_intervals and found.where("tax_id IS NOT NULL AND alpha IS NULL").take(1):
        raise ValueError("intervals need estimates of the variational estimator")
    got = assemble.sample_tables(found, readers.read_counts(spark, counts), readers.read_taxonomy(spark, taxonomy), readers.read_identical(spark, identical), keep_counts, credible_intervals, binomial_names)
    return _write_tables(got, out)


def _write_tables(got: DataFrame, out: str) -> DataFrame:
    """All files of the tables; names samples no read of which was assigned (their table has the two placeholder rows alone)."""
    watched, empty = _observed(got, ~expr.is_placeholder(F.col("species")), "assigned")
    tables = written(watched, "tables")
    for sample in empty():
        warnings.warn(f"sample {sample}: no read was assigned; all are reported as unassigned", stacklevel=3)
    writers.write_sample_tables(tables, f"{out}/samples")
    writers.write_consolidated(tables, out)
    return tables


def consolidated(spark: SparkSession, folder: str, out: str) -> None:
    """Per-sample tables of a folder to the tables across samples; names samples without counts where others have them, as they count as 0."""
    tables = readers.read_sample_tables(spark, folder)
    if "estimated_counts" in tables.columns:
        watched, bare = _observed(tables, F.col("estimated_counts").isNotNull(), "counted")
        tables = written(watched, "read-tables")
        for sample in bare():
            warnings.warn(f"sample {sample} has no counts; they are taken as 0", stacklevel=2)
    writers.write_consolidated(tables, out)


def collapsed(spark: SparkSession, table: str, rank: str, out: str) -> str:
    """One table of a sample, summed by a rank; returns the path."""
    base = table.rstrip("/").rsplit("/", 1)[-1].removesuffix(".tsv")
    return writers.write_collapsed(readers.read_tsv(spark, table).drop("ord"), rank, out, base)


def combined(spark: SparkSession, folder: str, rank: str, out: str, counts: bool = False, split: bool = False) -> list[str]:
    """Per-sample tables of a folder side by side, a column each; returns the paths."""
    tables = readers.read_sample_tables(spark, folder)
    return writers.write_combined(tables, rank, consolidate.sample_names(tables), out, counts, split)


def build_database(spark: SparkSession, sequences: str, seq2tax: str, db_name: str, out: str, taxonomy_list: str | None = None, dump_folder: str | None = None) -> dict[str, DataFrame]:
    """A FASTA file and a map of its sequences to the files of a database, in the folder ``out``."""
    listed = None if taxonomy_list is None else readers.read_tsv(spark, taxonomy_list)
    nodes, names = (None, None) if dump_folder is None else (readers.read_nodes(spark, f"{dump_folder}/nodes.dmp"), readers.read_names(spark, f"{dump_folder}/names.dmp"))
    got = api.build_database(readers.read_fasta(spark, sequences), readers.read_seq2tax(spark, seq2tax), db_name, listed, nodes, names)
    writers.write_fasta(got["sequences"], f"{out}/species_taxid.fasta", wrap=60)
    order = [F.col("ord")] if listed is not None else expr.tax_id_order(F.col("tax_id"))
    ordered = got["taxonomy"].orderBy(*order)
    writers.write_tsv(ordered.drop("ord"), f"{out}/taxonomy.tsv")
    _write_reports(got["identical"], got["cross_genus"], f"{out}/identical_16s.tsv", f"{out}/cross_genus_identical.tsv")
    return got


def _write_reports(identical: DataFrame, cross_genus: DataFrame | None, groups_path: str, cross_path: str | None) -> None:
    """Groups by number, their species by name, then id; sequences across genera as first seen."""
    number = F.coalesce(F.expr("try_cast(tax_id AS DECIMAL(38, 0))"), F.lit(0))
    writers.write_tsv(identical, groups_path, [F.length("group"), F.col("group"), F.col("species"), number, F.col("tax_id")])
    if cross_path:
        writers.write_tsv(written(cross_genus.orderBy("ord").drop("ord"), "cross-genus"), cross_path)


def identical_reports(spark: SparkSession, fasta: str, taxonomy: str, groups_path: str, cross_path: str | None = None) -> dict[str, DataFrame]:
    """The reports of identical sequences for an existing database: its FASTA (ids 'taxid:db:n') and taxonomy.tsv."""
    sequences = readers.read_fasta(spark, fasta).select("ord", expr.sequence_id(F.col("header")).alias("seq_id"), "seq")
    blank = [F.coalesce(F.col(r), F.lit("")).alias(r) for r in RANKS]
    carried = refdb.carriers(sequences, readers.read_taxonomy(spark, taxonomy).select("tax_id", *blank))
    got = {"identical": refdb.identical_groups(carried), "cross_genus": refdb.cross_genus(carried)}
    _write_reports(got["identical"], got["cross_genus"], groups_path, cross_path)
    return got


#: The columns of the report of merged names.
MERGED_COLUMNS = {"tax_id": "tax_id", "species": "species", "n_sources": "gtdb_species_merged", "source_species": "gtdb_species", "source_genera": "gtdb_genera", "conflict_ranks": "ranks_in_conflict", "lineage_from": "lineage_from"}


def build_lineage_database(spark: SparkSession, sequences: str, db_name: str, out: str, min_length: int = 900, merge_suffixes: bool = False) -> None:
    """A FASTA file whose headers carry lineages (plain or packed) to the files of a database, in the folder ``out``.

    species_taxid.fasta, taxonomy.tsv, the two reports of identical sequences and, if
    clade suffixes are merged, merged_species.tsv.
    """
    parsed = written(refdb.parsed_headers(readers.read_fasta(spark, sequences), merge_suffixes), "parsed")
    ids = written(refdb.species_ids(parsed).select("tax_id", *RANKS), "species")
    kept = refdb.dedup_within_species(parsed.join(ids.select("species", "tax_id"), "species"), min_length)
    writers.write_fasta(refdb.number_sequences(kept, db_name).select("n", "seq_id", "seq"), f"{out}/species_taxid.fasta")
    writers.write_tsv(ids, f"{out}/taxonomy.tsv", expr.tax_id_order(F.col("tax_id")))
    identical_reports(spark, f"{out}/species_taxid.fasta", f"{out}/taxonomy.tsv", f"{out}/identical_16s.tsv", f"{out}/cross_genus_identical.tsv")
    if merge_suffixes:
        merged = refdb.merged_species(parsed, min_length).join(ids.select("species", "tax_id"), "species")
        writers.write_tsv(merged.select(*[F.col(c).alias(k) for c, k in MERGED_COLUMNS.items()]), f"{out}/merged_species.tsv", [F.col("species")])
