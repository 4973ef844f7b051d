"""Scalar expressions on DataFrame columns; all of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mixspark.schema import BELOW_DETECTION, BELOW_DETECTION_ID, HIGHER_RANKS, RANKS, UNASSIGNED, UNASSIGNED_ID, UNKNOWN_TAXID

#: Unmapped, secondary and supplementary flag bits.
NOT_PRIMARY, UNMAPPED = 4 | 256 | 2048, 4

# Nucleotide codes and their complements (S, W and N are their own).
CODES, COMPLEMENTS = "ACGTURYKMBDHVacgturykmbdhv", "TGCAAYRMKVHDBtgcaayrmkvhdb"
# Prefixes of a lineage string, highest rank first.
LINEAGE_PREFIXES = {"superkingdom": "d__", "phylum": "p__", "class": "c__", "order": "o__", "family": "f__", "genus": "g__", "species": "s__"}


def cigar_totals(cigar: Column) -> Column:
    """Struct of the total lengths of the operations M, I, D and S, in one pass; zeros for a null or empty CIGAR."""
    runs = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"\d+[MIDS]"), F.lit(0))
    none = F.struct(*[F.lit(0).cast("long").alias(op) for op in "MIDS"])

    def add(totals: Column, run: Column) -> Column:
        size = F.substring(run, F.lit(1), F.length(run) - 1).cast("long")
        return F.struct(*[(totals[op] + F.when(F.endswith(run, F.lit(op)), size).otherwise(0)).alias(op) for op in "MIDS"])

    return F.aggregate(runs, none, add)


def cigar_counts(totals: Column, nm: Column) -> dict[str, Column]:
    """Inserted, deleted, clipped and substituted bases, and the aligned length, from ``cigar_totals``.

    A missing NM counts as 0, so substitutions can come out negative.
    """
    edits = F.coalesce(nm, F.lit(0)).cast("long")
    return {"n_ins": totals["I"], "n_del": totals["D"], "n_clip": totals["S"], "n_sub": edits - totals["I"] - totals["D"], "aligned": totals["M"] + totals["I"] + totals["D"] + totals["S"]}


def is_primary(flag: Column) -> Column:
    return flag.bitwiseAND(NOT_PRIMARY) == 0


def is_mapped(flag: Column) -> Column:
    return flag.bitwiseAND(UNMAPPED) == 0


def tax_id_of(ref: Column) -> Column:
    """The number before the first colon; text there is an error."""
    return F.element_at(F.split(ref, ":"), 1).cast("long")


def mean_quality(qual: Column) -> Column:
    """Mean Phred score of a quality string (offset 33); null for an empty one."""
    total = F.aggregate(F.split(qual, ""), F.lit(0).cast("long"), lambda t, c: t + F.when(c == "", 0).otherwise(F.ascii(c) - 33))
    return F.when(F.length(qual) > 0, total / F.length(qual))


def binomial_name(name: Column) -> Column:
    """Genus and epithet; three words after Candidatus."""
    words = F.split(name, " ")
    return F.array_join(F.slice(words, 1, F.when(words[0] == "Candidatus", 3).otherwise(2)), " ")


def strip_suffix(name: Column) -> Column:
    """Drop clade suffixes: an underscore and one or two capitals at a word's end."""
    return F.trim(F.regexp_replace(name, r"_[A-Z]{1,2}(?=\s|$)", ""))


def lineage_rank(lineage: Column, rank: str) -> Column:
    """One rank of a lineage string (the last part with its prefix); '' if absent."""
    prefix = LINEAGE_PREFIXES[rank]
    parts = F.filter(F.transform(F.split(lineage, ";"), lambda p: F.trim(p)), lambda p: p.startswith(prefix))
    return F.coalesce(F.trim(F.substring(F.try_element_at(parts, F.lit(-1)), len(prefix) + 1, 1 << 20)), F.lit(""))


def lineage_of_header(header: Column) -> dict[str, Column]:
    """Genome and lineage of a header '>genome~contig d__...;s__... [k=v]'; null where it can't be read."""
    line = F.regexp_replace(header, "^>+", "")
    rest = F.trim(F.regexp_replace(F.substring_index(F.regexp_replace(line, r"^\S+ ", ""), "[", 1), r"\s+$", ""))
    fine = line.contains(" ") & rest.startswith("d__")
    genome = F.substring_index(F.substring_index(line, " ", 1), "~", 1)
    return {"genome": F.when(fine, genome), "lineage": F.when(fine, rest)}


def sequence_md5(seq: Column) -> Column:
    """Case does not count."""
    return F.md5(F.upper(seq))


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), CODES, COMPLEMENTS)


def sequence_id(header: Column) -> Column:
    """First token of a header, without the mark."""
    return F.element_at(F.split(F.regexp_replace(header, "^>", ""), r"\s+"), 1)


def tax_id_order(tax_id: Column) -> list[Column]:
    """Sort keys: numbers by value, then text."""
    return [(~tax_id.rlike(r"^\d+$")).asc(), tax_id.try_cast("decimal(38,0)").asc_nulls_last(), tax_id.asc()]


def labelled_lineage(tax_id: Column) -> dict[str, Column]:
    """Species and higher ranks with the labels of rows that have no lineage."""
    blank = F.col("species").isNull() | (F.trim("species") == "")
    label = F.when(tax_id == UNASSIGNED_ID, F.lit(UNASSIGNED)).when(tax_id == BELOW_DETECTION_ID, F.lit(BELOW_DETECTION)).when(blank, F.concat(F.lit(f"{UNKNOWN_TAXID} "), tax_id))
    ranks = {r: F.when(label.isNotNull() & (F.col(r).isNull() | (F.trim(r) == "")), label).otherwise(F.coalesce(r, F.lit(""))) for r in HIGHER_RANKS}
    return {"species": F.coalesce(label, F.col("species"))} | ranks


def is_placeholder(species: Column) -> Column:
    return species.isin(UNASSIGNED, BELOW_DETECTION)


def row_class(species: Column) -> Column:
    """0 for taxa, 1 below detection, 2 unassigned: the order of a table's rows."""
    return F.when(species == BELOW_DETECTION, 1).when(species == UNASSIGNED, 2).otherwise(0)


def normal_species(species: Column) -> Column:
    """Blank, 'nan' and any spelling of the label are the unassigned row."""
    name = F.trim(F.coalesce(species, F.lit("")))
    return F.when((name == "") | (name == "nan") | (F.lower(name) == UNASSIGNED.lower()), F.lit(UNASSIGNED)).otherwise(name)


def number_or_zero(c: Column) -> Column:
    """'-' and anything unreadable count 0."""
    return F.coalesce(c.cast("string").try_cast("double"), F.lit(0.0))


def truncated_count(c: Column) -> Column:
    return number_or_zero(c).cast("long")


def joined_set(names: Column, own: Column | None = None) -> Column:
    """Sorted distinct non-blank names, '; '-joined, without the row's own."""
    kept = F.filter(F.array_distinct(names), lambda n: (n != "") if own is None else (n != "") & (n != own))
    return F.array_join(F.array_sort(kept), "; ")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
