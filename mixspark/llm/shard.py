"""Sharding along a Hilbert curve, with DataFrame functions only.

Several metadata dimensions are quantised to the same number of levels by the
corpus' own quantiles (strings in the order of whole strings, by exact counts of their
values), so that each row falls into a cell of a grid whose size is a parameter. Cells are ordered by
their index on the Hilbert curve and runs of that order are cut into shards of
equal row counts (law ``rows``). A shard's files thus cover few values of every
dimension and a reader can skip files by min/max statistics.

The global order needs no single sorted task: cells are counted first (at most
``2 ** (bits * dimensions)`` of them), a cell with many rows is split by a hash of
the id, and only the counts of those pieces are summed up in order. Their number
is bounded by parameters, which is why they may be broadcast.

Defined cases: a null dimension falls into the lowest level; a null text has no
bytes and checksum 0; an empty text likewise; long texts only count by their size;
rows of equal ids are ordered by checksum, then size, and equal rows take neighbouring
slots; an empty table gives an empty table; other columns come back unchanged from
``hilbert_shards``, whatever their names: a column named like a result (``names``) is an
error, as the two could not be told apart, and other names can be given to the results.
``document_shards`` ignores them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixspark.llm.common import materialise, payload

BITS = 4
#: Pieces that the fullest cells are split into, over all cells; least rows of a piece.
PIECES, PIECE_ROWS = 4096, 1000


def string_cuts(values: DataFrame, levels: int) -> Column:
    """Quantile cuts of the strings in column ``value``: one row, at most ``levels`` - 1 strings.

    Distinct values are counted, sorted by ranges side by side, and their counts summed
    up in order; a cut is the value at which a further share of all rows is reached.
    """
    counts = values.where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))
    ranged = materialise(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "string-ranges")
    sums = ranged.groupBy("part").agg(F.sum("n").alias("n"))
    unbounded = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("part", F.coalesce(F.sum("n").over(unbounded), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    run = F.sum("n").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("before")
    summed = ranged.join(F.broadcast(before), "part").select("value", run.alias("upto"), "n", "total")  # one row a range
    reached = lambda c: F.floor(c * levels / F.col("total"))
    cuts = summed.where((reached(F.col("upto")) > reached(F.col("upto") - F.col("n"))) & (F.col("upto") < F.col("total")))
    return cuts.agg(F.array_sort(F.collect_list("value")).alias("cuts"))


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a grid cell, by the transpose form of the curve."""
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << q).alias("q"), F.lit(i).alias("i")) for q in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        first, own = x[0], F.get(x, s["i"])
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        flip = own.bitwiseAND(s["q"]) != 0
        return F.transform(x, lambda v, k: F.when(flip, F.when(k == 0, v.bitwiseXOR(low)).otherwise(v)).when((k == 0) & (s["i"] == 0), v).when((k == 0) | (k == s["i"]), v.bitwiseXOR(swap)).otherwise(v))

    turned = F.aggregate(steps, F.array(*[a.cast("int") for a in axes]), undo)
    gray = lambda x: F.array(*[_xor_all([F.get(x, F.lit(k)) for k in range(i + 1)]) for i in range(n)])
    bits_down = F.array(*[F.lit(1 << q) for q in range(bits - 1, 0, -1)])

    def finish(x: Column) -> Column:
        carry = F.aggregate(bits_down, F.lit(0), lambda t, q: F.when(F.get(x, F.lit(n - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        places = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q in range(bits - 1, -1, -1) for i in range(n)])
        return F.aggregate(places, F.lit(0).cast("long"), lambda h, p: h * 2 + F.when(F.get(x, p["i"]).bitwiseXOR(carry).bitwiseAND(F.call_function("shiftleft", F.lit(1), p["q"])) != 0, F.lit(1)).otherwise(F.lit(0)).cast("long"))

    # Lambdas over a one-element array name each step's value once.
    grays = F.transform(F.array(turned), gray)
    return F.transform(grays, finish)[0]


def _xor_all(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out.bitwiseXOR(c)
    return out


def quantised(df: DataFrame, dims: Mapping[str, Column], bits: int = BITS) -> DataFrame:
    """``df`` with a level 0 to 2**bits - 1 for each dimension, in columns level_0, level_1, ..."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    # Approximate quantiles depend on the order of merging, so they are written once:
    # both readings of the levels, and retried tasks, then see the same cuts.
    typed = df.select(*[c.alias(f"d{i}") for i, c in enumerate(dims.values())])
    cuts = typed.select(*[F.percentile_approx(f"d{i}", shares, 10_000).alias(f"cuts_{i}") for i, t in enumerate(typed.dtypes) if t[1] != "string"] or [F.count("*").alias("rows")])
    for i, (name, kind) in enumerate(typed.dtypes):
        if kind == "string":
            cuts = cuts.crossJoin(string_cuts(typed.select(F.col(name).alias("value")), 1 << bits).select(F.col("cuts").alias(f"cuts_{i}")))  # one row each
    joined = df.crossJoin(F.broadcast(materialise(cuts, "level-cuts")))  # one row, 15 values a dimension
    level = lambda i, c: F.coalesce(F.size(F.filter(F.col(f"cuts_{i}"), lambda cut: cut < c)), F.lit(0))
    return joined.select(*df.columns, *[F.when(c.isNull() | F.col(f"cuts_{i}").isNull(), F.lit(0)).otherwise(level(i, c)).alias(f"level_{i}") for i, c in enumerate(dims.values())])


def hilbert_shards(df: DataFrame, dims: Mapping[str, Column], n_shards: int, tie: list[str], bits: int = BITS, names: tuple[str, str] = ("shard", "slot")) -> DataFrame:
    """``df`` with two more columns, shard and slot or ``names``; ``tie`` orders rows within a cell, its first column splits full cells."""
    if taken := {c.lower() for c in names} & {c.lower() for c in df.columns}:
        raise ValueError(f"the input has columns named {sorted(taken)}; give other names to the results")
    ties = [f"tie_{i}" for i in range(len(tie))]
    rows = df.select(payload(df), *[df[c].alias(k) for c, k in zip(tie, ties, strict=True)], *[c.alias(f"dim_{i}") for i, c in enumerate(dims.values())])
    levels = [f"level_{i}" for i in range(len(dims))]
    placed = quantised(rows, {k: F.col(f"dim_{i}") for i, k in enumerate(dims)}, bits).withColumn("part", F.xxhash64(ties[0]))
    keys = placed.select(*levels, "part")
    cells = keys.groupBy(*levels).agg(F.count("*").alias("n")).withColumn("h", hilbert_index([F.col(c) for c in levels], bits))
    every = Window.partitionBy()
    size = F.greatest(F.ceil(F.sum("n").over(every) / PIECES), F.lit(PIECE_ROWS))
    cells = cells.withColumn("pieces", F.ceil(F.col("n") / size)).select(*levels, "h", "pieces")
    piece = F.pmod("part", F.col("pieces"))
    counts = keys.join(F.broadcast(cells), levels).groupBy(*levels, "h", "pieces", piece.alias("piece")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("h", "piece").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*levels, "piece", "pieces", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(every).alias("total"))
    # At most PIECES + 2 ** (bits * dimensions) rows of numbers.
    ranked = placed.join(F.broadcast(offsets), [*[placed[c].eqNullSafe(offsets[c]) for c in levels], F.pmod("part", F.col("pieces")) == F.col("piece")]).drop(*[offsets[c] for c in levels])
    row = F.row_number().over(Window.partitionBy(*levels, "piece").orderBy(*ties))
    out = ranked.withColumn("rank", (F.col("before") + row - 1).cast("long")).withColumn("shard", F.expr(f"CAST((rank * {n_shards}) DIV total AS INT)"))
    first = F.expr(f"(shard * total + {n_shards} - 1) DIV {n_shards}")
    return out.select(*[F.col("payload").getField(c).alias(c) for c in df.columns], F.col("shard").alias(names[0]), (F.col("rank") - first).alias(names[1]))


def document_shards(df: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: language, source and length on the curve."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = df.select("doc_id", "lang", "source", "n_chars", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dims = {"lang": F.col("lang").cast("string"), "source": F.col("source").cast("string"), "n_chars": F.col("n_chars").cast("double")}
    out = hilbert_shards(rows, dims, n_shards, ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, dims: Mapping[str, Column], n_shards: int, tie: list[str], path: str, names: tuple[str, str] = ("shard", "slot")) -> None:
    """All rows of ``df`` as one folder a shard, files in slot order, for file pruning; rows of equal or null ids stay rows."""
    shard, slot = names
    placed = hilbert_shards(df, dims, n_shards, tie, names=names)
    placed.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
