"""Writers of the domain's files. Final reports are single files in a fixed order."""

from __future__ import annotations

import struct
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixspark.operators.consolidate import check_rank, collapse, combined_arrays, modal_lineages, otu_arrays, sample_metadata, sample_names, species_order
from mixspark.operators.graph import numbered, written
from mixspark.sources import bam
from mixspark.sources.joining import join_by_sample, join_parts


def write_fasta(records: DataFrame, path: str, wrap: int | None = None) -> None:
    """``records``: n, seq_id, seq and maybe description; one file, sorted by n."""
    title = F.concat_ws(" ", "seq_id", "description") if "description" in records.columns else F.col("seq_id")
    body = F.regexp_replace("seq", f"(.{{{wrap}}})(?=.)", "$1\n") if wrap else F.col("seq")
    records.orderBy("n").select(F.concat(F.lit(">"), title, F.lit("\n"), body)).write.mode("overwrite").text(f"{path}.parts")
    join_parts(records.sparkSession, f"{path}.parts", path)


def write_tsv(table: DataFrame, path: str, order: list | None = None) -> None:
    """One file at ``path`` with a header, also where the table is empty, rows in ``order``; numbers as Spark prints them.

    Ranges of the order are sorted and written side by side, then joined.
    """
    rows = table.orderBy(*order) if order else table
    rows.write.mode("overwrite").csv(f"{path}.parts", sep="\t", header=False, emptyValue="", quote="")
    join_parts(table.sparkSession, f"{path}.parts", path, head=("\t".join(table.columns) + "\n").encode())


def _by_sample(rows: DataFrame, *order: str) -> DataFrame:
    """Rows in ranges of (sample, order); a sample of many rows is written by several tasks."""
    return rows.repartitionByRange("sample", *order).sortWithinPartitions("sample", *order)


def write_sample_tables(tables: DataFrame, path: str) -> None:
    """One file a sample, named for it, rows in their order."""
    columns = [c for c in tables.columns if c != "row_ord"]
    _by_sample(tables, "row_ord").select(*columns).write.partitionBy("sample").csv(path, sep="\t", header=False, emptyValue="", quote="")
    join_by_sample(tables.sparkSession, path, "_rel-abundance.tsv", head=("\t".join(c for c in columns if c != "sample") + "\n").encode())


def write_sample_lines(lines: DataFrame, path: str, ending: str) -> None:
    """``lines``: sample, ord, value. One text file a sample, named for it, in order."""
    _by_sample(lines, "ord").select("sample", "value").write.partitionBy("sample").text(path)
    join_by_sample(lines.sparkSession, path, ending)


def write_sample_bams(alignments: DataFrame, path: str) -> None:
    """``alignments`` (sample, ord, read, flag, ref, cigar, nm) as one BAM file a sample, without bases, in order.

    All files have the same references, in alphabetical order. Tasks write whole blocks
    as rows of text parted by the bytes that begin a block; joined, the parts of a
    sample are a BAM file. The records are written once before, as names, samples and
    the ranges of the order are all found in them.
    """
    alignments = written(alignments.select("sample", "ord", "read", "flag", "ref", "cigar", "nm"), "records")
    refs = written(numbered(alignments.where("ref IS NOT NULL").select("ref").distinct(), [F.col("ref")], "n").select("ref", (F.col("n") - 1).alias("ref_id")), "references")
    count = refs.agg(F.count("*").alias("n_refs"))
    samples = alignments.select("sample").distinct()
    none = {c: F.lit(None).cast(t) for c, t in (("read", "string"), ("flag", "int"), ("cigar", "string"), ("nm", "long"))}
    heads = samples.crossJoin(F.broadcast(count)).select("sample", F.lit(0).alias("step"), F.col("n_refs").alias("ord"), F.lit(-1).cast("long").alias("ref_id"), *[v.alias(c) for c, v in none.items()])  # one count
    named = samples.crossJoin(refs).select("sample", F.lit(1).alias("step"), F.col("ref_id").alias("ord"), F.lit(-1).cast("long").alias("ref_id"), F.col("ref").alias("read"), *[v.alias(c) for c, v in none.items() if c != "read"])  # each file lists all references
    records = alignments.join(refs, "ref", "left").select("sample", F.lit(2).alias("step"), "ord", F.coalesce("ref_id", F.lit(-1).cast("long")).alias("ref_id"), "read", F.col("flag").cast("int").alias("flag"), "cigar", F.col("nm").cast("long").alias("nm"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, held = None, bytearray()
        give = lambda values: pa.RecordBatch.from_arrays([pa.array([sample] * len(values), pa.string()), pa.array(values, pa.binary())], names=["sample", "value"])
        for got in batches:
            key, step = got.column("sample").dictionary_encode(), got.column("step").to_numpy()
            changes = np.flatnonzero((np.diff(key.indices.to_numpy()) != 0) | (np.diff(step) != 0)) + 1
            for lo, hi in zip([0, *changes.tolist()], [*changes.tolist(), got.num_rows], strict=True):
                if lo == hi:
                    continue
                if (name := got.column("sample")[lo].as_py()) != sample:
                    if held:
                        yield give([bam.packed(bytes(held))])
                    sample, held = name, bytearray()
                    yield give([b""])  # a part begins with what parts the rows
                rows = got.slice(lo, hi - lo)
                if step[lo] == 0:
                    held += b"BAM\1" + struct.pack("<ii", 0, rows.column("ord")[0].as_py())
                elif step[lo] == 1:
                    for name in rows.column("read").to_pylist():
                        name = name.encode() + b"\0"
                        held += struct.pack("<i", len(name)) + name + struct.pack("<i", 0)
                else:
                    held += bam.encoded_records(rows)
                whole = len(held) // bam.BLOCK * bam.BLOCK
                if whole:
                    yield give([bam.packed(bytes(held[i : i + bam.BLOCK])) for i in range(0, whole, bam.BLOCK)])
                    del held[:whole]
        if held:
            yield give([bam.packed(bytes(held))])

    rows = _by_sample(heads.unionByName(named).unionByName(records), "step", "ord").mapInArrow(blocks, "sample string, value binary")
    mark = bam.MARK.decode("latin-1")
    rows.select("sample", F.col("value").cast("string").alias("value")).write.partitionBy("sample").option("encoding", "ISO-8859-1").option("lineSep", mark).text(path)
    join_by_sample(alignments.sparkSession, path, ".bam", tail=bam.END, trim=len(bam.MARK))


def sam_lines(alignments: DataFrame) -> DataFrame:
    """sample, ord, value: alignment records as SAM lines (without bases, which scoring does not read)."""
    field = lambda c, none="*": F.coalesce(F.col(c).cast("string"), F.lit(none))
    nm = F.when(F.col("nm").isNotNull(), F.concat(F.lit("\tNM:i:"), F.col("nm").cast("string"))).otherwise("")
    value = F.concat(F.concat_ws("\t", "read", field("flag"), field("ref"), F.lit("1"), F.lit("0"), field("cigar"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*")), nm)
    return alignments.select("sample", "ord", value.alias("value"))


def fastq_lines(reads: DataFrame) -> DataFrame:
    """sample, ord, value: reads as FASTQ records."""
    return reads.select("sample", "ord", F.concat(F.lit("@"), "read", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value"))


def write_matrix(rows: DataFrame, samples: list[str], path: str, order: list, keys: list[str] | None = None) -> None:
    """``rows`` (keys and values, an array with one value a sample) as one file with a column a sample, in ``order``; ``keys``: those written."""
    keys = keys or [c for c in rows.columns if c != "values"]
    number = F.transform("values", lambda v: v.cast("string"))
    line = F.concat_ws("\t", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], number)
    rows.orderBy(*order).select(line.alias("value")).write.mode("overwrite").text(f"{path}.parts")
    join_parts(rows.sparkSession, f"{path}.parts", path, head=("\t".join([*keys, *samples]) + "\n").encode())


def write_consolidated(tables: DataFrame, folder: str) -> None:
    """The four tables across samples, from a written table; without counts in any sample their table is left out with a warning."""
    samples = sample_names(tables)
    for metric, name in (("abundance", "otu_table_abundance"), ("estimated_counts", "otu_table_counts")):
        matrix = otu_arrays(tables, samples, metric)
        if matrix is None:
            warnings.warn(f"no sample has counts; {name}.tsv is not written", stacklevel=2)
        else:
            write_matrix(matrix, samples, f"{folder}/{name}.tsv", species_order())
    write_tsv(modal_lineages(tables), f"{folder}/tax_table.tsv", species_order())
    write_tsv(sample_metadata(tables), f"{folder}/sample_metadata.tsv", [F.col("sample")])


def write_collapsed(table: DataFrame, rank: str, folder: str, base: str) -> str:
    """The collapsed table under its name; ranks of no name come last."""
    got, path = collapse(table, rank), f"{folder}/{collapsed_name(base, rank)}"
    write_tsv(got, path, [F.col(c).asc_nulls_last() for c in got.columns if c not in ("abundance", "estimated_counts")])
    return path


def write_combined(tables: DataFrame, rank: str, samples: list[str], folder: str, counts: bool = False, split: bool = False) -> list[str]:
    """The combined table under its name or, split, lineages and values in files of their own."""
    wide = written(combined_arrays(tables, rank, samples, counts), "combined")  # each part reads it
    ranks = [c for c in check_rank(rank) if c in wide.columns]
    parts = {"taxonomy": ranks, "abundance": [rank]} if split else {None: ranks}
    paths = [f"{folder}/{combined_name(rank, counts, part)}" for part in parts]
    for (part, columns), path in zip(parts.items(), paths, strict=True):
        if part == "taxonomy":
            write_tsv(wide.select(*columns), path, ranks)
        else:  # both parts have the rows in the order of all ranks
            write_matrix(wide.select(*ranks, "values"), samples, path, ranks, columns)
    return paths


def collapsed_name(base: str, rank: str) -> str:
    return f"{base}-{rank}.tsv"


def combined_name(rank: str, counts: bool = False, part: str | None = None) -> str:
    """Names of combined tables; the taxonomy part has no counts form."""
    suffix = "-counts" if counts and part != "taxonomy" else ""
    return f"vi-combined-{part + '-' if part else ''}{rank}{suffix}.tsv"
