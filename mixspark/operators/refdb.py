"""Reference databases: deduplication, numbering, lineages and identical groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixspark.functions import expr
from mixspark.operators.graph import linked_groups, numbered, walked, written
from mixspark.schema import HIGHER_RANKS, RANKS


def parsed_headers(sequences: DataFrame, merge_suffixes: bool = False) -> DataFrame:
    """ord, seq, genome, the seven ranks and species and genus as named in the source; unreadable headers go."""
    parts = expr.lineage_of_header(F.col("header"))
    rows = sequences.select("ord", "seq", parts["genome"].alias("genome"), parts["lineage"].alias("lineage")).where("lineage IS NOT NULL")
    ranks = {r: expr.lineage_rank(F.col("lineage"), r) for r in RANKS}
    named = rows.select("ord", "seq", "genome", ranks["species"].alias("source_species"), ranks["genus"].alias("source_genus"), *[(expr.strip_suffix(c) if merge_suffixes else c).alias(r) for r, c in ranks.items()])
    return named.where("species <> ''")


def species_ids(parsed: DataFrame) -> DataFrame:
    """Ids 1..n in alphabetical order over all species, each with its first lineage. One row a species."""
    first = parsed.groupBy("species").agg(F.min(F.struct("ord", *HIGHER_RANKS)).alias("x")).select("species", *[f"x.{r}" for r in HIGHER_RANKS])
    return numbered(first, [F.col("species")], "tax_id").withColumn("tax_id", F.col("tax_id").cast("string"))


def dedup_within_species(rows: DataFrame, min_length: int = 900) -> DataFrame:
    """The first of each (tax_id, sequence), case apart, among those long enough."""
    kept = rows.where(F.length("seq") >= min_length).withColumn("md5", expr.sequence_md5(F.col("seq")))
    first = kept.groupBy("tax_id", "md5").agg(F.min("ord").alias("ord"))
    return kept.join(first, ["tax_id", "md5", "ord"])


def number_sequences(rows: DataFrame, db_name: str) -> DataFrame:
    """seq_id 'taxid:db:n' in file order. Only (ord, tax_id) pass the numbering; sequences are joined after."""
    n = numbered(rows.select("ord", "tax_id"), [F.col("ord"), F.col("tax_id")], "n")
    return rows.join(n, ["ord", "tax_id"]).withColumn("seq_id", F.concat_ws(":", "tax_id", F.lit(db_name), F.col("n").cast("string")))


def build_from_lineages(sequences: DataFrame, db_name: str, min_length: int = 900, merge_suffixes: bool = False) -> tuple[DataFrame, DataFrame]:
    """(numbered sequences, taxonomy) of a database whose headers carry lineages."""
    parsed = parsed_headers(sequences, merge_suffixes)
    ids = species_ids(parsed)
    kept = dedup_within_species(parsed.join(ids.select("species", "tax_id"), "species"), min_length)
    return number_sequences(kept, db_name).select("n", "seq_id", "tax_id", "seq"), ids.select("tax_id", *RANKS)


def merged_species(parsed: DataFrame, min_length: int = 900) -> DataFrame:
    """Names that unite two or more source species with a sequence: sources and their genera, conflict ranks, whose lineage counts.

    The lineage is that of the first source in the input, with or without a sequence.
    """
    conflicts = [F.when(F.count_distinct(expr.strip_suffix(F.col(r))) > 1, F.lit(r)) for r in HIGHER_RANKS]
    held = parsed.where(F.length("seq") >= min_length)
    groups = held.groupBy("species").agg(F.array_sort(F.collect_set("source_species")).alias("sources"), F.array_sort(F.collect_set("source_genus")).alias("genera"), F.array_compact(F.array(*conflicts)).alias("ranks"))
    first = parsed.groupBy("species").agg(F.min(F.struct("ord", "source_species")).alias("x")).select("species", F.col("x.source_species").alias("lineage_from"))
    many = groups.where(F.size("sources") > 1).join(first, "species")
    return many.select("species", F.size("sources").alias("n_sources"), F.array_join("sources", ";").alias("source_species"), F.array_join("genera", ";").alias("source_genera"), F.array_join("ranks", ",").alias("conflict_ranks"), "lineage_from")


def sequence_key(seq: Column) -> Column:
    """The same for a sequence and its reverse complement; case counts."""
    return F.md5(F.least(seq, expr.reverse_complement(seq)))


def unique_sequences(rows: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """One row per (sequence, tax_id): a sequence and its reverse complement are one, case counts.

    ``rows``: ord (a record's own number), tax_id, description, and seq or its key. The
    first orientation is kept; seq_ord and tax_ord are the places where the sequence and,
    in it, the tax_id came first. Keys alone are grouped; the first of equal sequences
    is taken by its number from ``sequences`` (ord, seq; else from ``rows``).
    """
    keyed = rows if "key" in rows.columns else rows.withColumn("key", sequence_key(F.col("seq")))
    first = keyed.groupBy("key").agg(F.min("ord").alias("seq_ord"))
    per_tax = keyed.groupBy("key", "tax_id").agg(F.min("ord").alias("tax_ord"), F.array_sort(F.collect_list(F.struct("ord", "description"))).alias("x"))
    texts = (rows if sequences is None else sequences).select(F.col("ord").alias("seq_ord"), "seq")
    return per_tax.join(first, "key").join(texts, "seq_ord").select("seq_ord", "tax_ord", "tax_id", "seq", F.transform("x", lambda x: x["description"]).alias("descriptions"))


def reduced_fasta(unique: DataFrame, db_name: str) -> DataFrame:
    """Records numbered by sequence, then tax_id, in order of first sight."""
    order = numbered(unique.select("seq_ord", "tax_ord"), [F.col("seq_ord"), F.col("tax_ord")], "n")
    out = unique.join(order, ["seq_ord", "tax_ord"])
    return out.select("n", F.concat_ws(":", "tax_id", F.lit(db_name), F.col("n").cast("string")).alias("seq_id"), "tax_id", F.array_join("descriptions", "; ").alias("description"), "seq")


def lineages(ids: DataFrame, nodes: DataFrame, names: DataFrame) -> DataFrame:
    """tax_id and its seven ranks ('' where the tree has none, the root's own left out); an id outside the tree is an error."""
    found = walked(ids, nodes, RANKS)
    steps = found.select("tax_id", F.explode("tops").alias("rank", "at"))
    named = steps.join(names.select(F.col("tax_id").alias("at"), "name"), "at")
    wide = named.groupBy("tax_id").agg(*[F.min(F.when(F.col("rank") == r, F.col("name"))).alias(r) for r in RANKS])
    missing = F.raise_error(F.concat(F.lit("tax_id not in the tree: "), F.col("tax_id").cast("string")))
    there = found.select("tax_id", F.lit(True).alias("_there"))
    out = ids.select("tax_id").distinct().join(there, "tax_id", "left").join(wide, "tax_id", "left")
    return out.select("tax_id", *[F.when(F.col("_there"), F.coalesce(F.col(r), F.lit(""))).otherwise(missing.cast("string")).alias(r) for r in RANKS])


def ranked_ancestor(ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tax_id, ranked_id): the nearest node at or above with one of the seven ranks; none is an error."""
    near = walked(ids, nodes, RANKS).select("tax_id", F.col("near").alias("ranked_id"))
    missing = F.raise_error(F.concat(F.lit("no ranked ancestor: "), F.col("tax_id").cast("string")))
    return ids.select("tax_id").distinct().join(near, "tax_id", "left").select("tax_id", F.coalesce("ranked_id", missing.cast("string")).alias("ranked_id"))


def direct_taxonomy(listed: DataFrame, used: DataFrame) -> DataFrame:
    """The listed rows whose id is used, all columns kept (``ord`` too, the file order); the first column is the id."""
    first = next(c for c in listed.columns if c != "ord")
    return listed.withColumnRenamed(first, "tax_id").join(used.select("tax_id").distinct(), "tax_id", "left_semi")


def sequence_to_species(sequences: DataFrame, seq2tax: DataFrame) -> DataFrame:
    """Sequences with their tax_id; those without one go. Of repeated ids the last counts."""
    last = seq2tax.groupBy("seq_id").agg(F.max_by("tax_id", "ord").alias("tax_id"))
    return sequences.withColumn("seq_id", expr.sequence_id(F.col("header"))).join(last, "seq_id")


def carriers(sequences: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """md5, tax_id, its ranks and first place, for sequences of species with a genus; ``sequences``: ord, seq_id, seq."""
    rows = sequences.select("ord", "seq_id", F.element_at(F.split("seq_id", ":"), 1).alias("tax_id"), expr.sequence_md5(F.col("seq")).alias("md5"))
    known = taxonomy.where(F.trim("genus") != "").select("tax_id", "species", "genus", "family", "phylum", expr.strip_suffix(F.col("genus")).alias("genus_key"))
    return rows.join(known, "tax_id")


def identical_groups(carried: DataFrame) -> DataFrame:
    """Species of one genus linked by shared sequences: tax_id, species, genus, group, group_size, identical_16s_species.

    Links are stars through a sequence's smallest id. The names of a sequence's species
    are gathered once and joined back, as each of them is to list the others.
    """
    own = carried.groupBy("md5", "genus_key", "tax_id").agg(F.min("species").alias("species"), F.min("genus").alias("genus"))
    held = own.groupBy("md5", "genus_key").agg(F.min("tax_id").alias("first"), F.array_sort(F.collect_list(F.struct("tax_id", "species"))).alias("holders")).where(F.size("holders") > 1)
    held = written(held, "shared-sequences")  # read for the links and for the names
    placed = own.join(held, ["md5", "genus_key"])
    groups = linked_groups(placed.where("tax_id <> first").select(F.col("tax_id").alias("a"), F.col("first").alias("b")))
    others = F.filter(F.flatten(F.collect_set("holders")), lambda x: x["tax_id"] != F.col("tax_id"))
    names = placed.groupBy("tax_id", "species", "genus").agg(expr.joined_set(F.transform(others, lambda x: x["species"])).alias("identical_16s_species"))
    placed = names.join(groups.withColumnRenamed("node", "tax_id"), "tax_id")
    sizes = placed.groupBy("group").agg(F.count("*").alias("group_size"), F.min("species").alias("first"))
    labels = numbered(sizes, [F.desc("group_size"), F.col("first"), F.col("group")], "n").withColumn("label", F.concat(F.lit("G"), F.col("n").cast("string"))).drop("n")
    return placed.join(labels, "group").select("tax_id", "species", "genus", F.col("label").alias("group"), "group_size", "identical_16s_species")


def cross_genus(carried: DataFrame) -> DataFrame:
    """Sequences that species of more than one genus carry; ord: where one was seen first."""
    ids = F.array_sort(F.collect_list(F.struct("ord", "seq_id", "tax_id")))
    sets = [F.array_join(F.array_sort(F.collect_set(r)), ";").alias(n) for n, r in (("species", "species"), ("genera", "genus"), ("families", "family"), ("phyla", "phylum"))]
    found = carried.groupBy("md5").agg(F.count_distinct("genus_key").alias("n_genera"), F.count_distinct("tax_id").alias("species_count"), ids.alias("ids"), *sets).where("n_genera > 1")
    return found.select(F.col("ids")[0]["ord"].alias("ord"), "md5", "species_count", F.array_join(F.transform("ids", lambda x: x["seq_id"]), ";").alias("sequence_ids"), F.array_join(F.array_distinct(F.transform("ids", lambda x: x["tax_id"])), ";").alias("tax_ids"), "species", "genera", "families", "phyla")
