"""The engine's commands as functions of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixspark.operators import assemble, consolidate, estimate, refdb, scoring
from mixspark.operators.graph import written


def abundance(alignments: DataFrame, taxonomy: DataFrame, identical: DataFrame | None = None, samples: DataFrame | None = None, estimator: str = "vb", keep_counts: bool = True, credible_intervals: bool = False, binomial_names: bool = False, **options) -> DataFrame:
    """Alignments of any number of samples to their tables, in one DataFrame.

    options: min_abundance, and alpha_prior, tolerance, max_iterations for 'vb' or
    gain for 'em'.
    """
    if credible_intervals and estimator != "vb":
        raise ValueError("intervals need the variational estimator")
    if not 0 <= options.get("min_abundance", 0.001) < 1:
        raise ValueError("min_abundance must be at least 0 and below 1")
    # One row a (read, species), written once: scores, counts and row keys come from it.
    best = written(scoring.best_scores(scoring.scored_alignments(written(scoring.with_counts(alignments), "counted"))), "best-scores")
    scores = best.where("score IS NOT NULL").withColumnRenamed("score", "log_score")
    counts = scoring.read_counts(best, samples if samples is not None else best.select("sample"))
    keys = assemble.row_keys(scores.select("tax_id"), taxonomy, binomial_names)
    estimates = estimate.estimate_abundances(scores, estimator, keys, stored=True, **options)
    return assemble.sample_tables(estimates, counts, taxonomy, identical, keep_counts, credible_intervals, binomial_names)


def consolidated(tables: DataFrame) -> dict[str, DataFrame | None]:
    """The four tables across samples; the given ones are written once, as each output reads them."""
    tables = written(tables, "sample-tables")
    samples = consolidate.sample_names(tables)
    return {
        "otu_abundance": consolidate.otu_abundance(tables, samples),
        "otu_counts": consolidate.otu_counts(tables, samples),
        "tax_table": consolidate.modal_lineages(tables),
        "sample_metadata": consolidate.sample_metadata(tables),
    }


def build_database(sequences: DataFrame, seq2tax: DataFrame, db_name: str, taxonomy_list: DataFrame | None = None, nodes: DataFrame | None = None, names: DataFrame | None = None) -> dict[str, DataFrame]:
    """Numbered unique sequences, their taxonomy and the reports of identical sequences.

    Exactly one of ``taxonomy_list`` and (``nodes``, ``names``) is given. The taxonomy
    holds every id of ``seq2tax``, also without a sequence.
    """
    if (taxonomy_list is None) == (nodes is None):
        raise ValueError("give either a taxonomy list or a tree")
    if nodes is not None:
        ids = seq2tax.select("tax_id").distinct()
        ranked = refdb.ranked_ancestor(ids, nodes)
        seq2tax = seq2tax.join(ranked, "tax_id").select("seq_id", F.col("ranked_id").alias("tax_id"), "ord")
        taxonomy = refdb.lineages(seq2tax.select("tax_id"), nodes, names)
    else:
        taxonomy = refdb.direct_taxonomy(taxonomy_list, seq2tax)
    # keys stand for the sequences, which join no map
    keyed = sequences.select("ord", "header", refdb.sequence_key(F.col("seq")).alias("key"))
    rows = refdb.sequence_to_species(keyed, seq2tax).select("ord", "tax_id", F.col("header").alias("description"), "key")
    # written once: every output comes from the sequences, and both reports from who carries them
    fasta = written(refdb.reduced_fasta(refdb.unique_sequences(rows, sequences), db_name), "numbered-sequences")
    carried = written(refdb.carriers(fasta.select(F.col("n").alias("ord"), "seq_id", "seq"), taxonomy), "carriers")
    return {"sequences": fasta, "taxonomy": taxonomy, "identical": refdb.identical_groups(carried), "cross_genus": refdb.cross_genus(carried)}


collapse, combine = consolidate.collapse, consolidate.combine
