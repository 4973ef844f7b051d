"""Prefix trie of conversations by fixed-length block hashing.

Every distinct sequence of first turns is a node. Turns become two 64-bit hashes, so a
text moves nowhere. A conversation's turns are cut into blocks of ``BLOCK`` turns; a
block's digest combines its turns' hashes with their places, and the digest of all
blocks before it names the node at which it starts. Equal blocks that start at one node
are counted first, whatever the number of conversations that share them. Where only one
block follows a node, all nodes within it have its members. Where siblings diverge (or
a conversation ends), and only there, the boundaries of single turns within the
following blocks are counted.

Sums over subtrees need no walk up the tree: the smallest member owns a node, the nodes
that a conversation owns are the end of its path, and each conversation adds what it
owns at a depth and below to every node of its path, which is as many rows as turns.

Groups of any size: counts and smallest members combine on the map side; running sums
along a conversation are taken in ranges side by side, plus the sums of the ranges
before (one number a range and column); ids that end at one node are put in order in
ranges and hashed as a stream of pieces of at most ``PIECE`` bytes. A node's digest of
ids is one hash over all of them, so its pieces, not its rows, pass one task.

Defined cases: turns are ordered with null first, ties by their hashes, and equal rows
are turns of their own; a null role or text is empty; rows without a conversation id
belong to none and are left out; texts of any length count; other columns, whatever
their names, are ignored; without conversations there is no node, not even the root.
Turns are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixspark.llm.common import bounded_batches, materialise

BLOCK = 8
#: Bytes of joined ids that move as one row.
PIECE = 1 << 16
#: Of the rebuilt conversations: ids that share one opening; most shared turns and one.
FAMILY, OPENINGS = 5, 9

SUM = (F.sum, lambda a, b: a + b)
XOR = (F.bit_xor, lambda a, b: a.bitwiseXOR(b))
_KEY = ["x", "y"]


def before(df: DataFrame, key: str, order: list[Column], totals: dict[str, tuple[Column, tuple[Callable, Callable]]], name: str) -> DataFrame:
    """``df`` with columns that combine a value over the rows of the same ``key`` that come earlier (0 without any).

    No task sees all rows of a key: ranges of the order are worked on side by side. At
    most one key of a range began in an earlier one, so what is broadcast is one row a
    range at most.
    """
    tied = df.select("*", *[v.alias(f"value_{c}") for c, (v, _) in totals.items()], F.monotonically_increasing_id().alias("tie"))
    ranged = materialise(tied.repartitionByRange(F.col(key), *order, F.col("tie")).withColumn("part", F.spark_partition_id()), name)
    sums = ranged.groupBy("part", key).agg(*[f(f"value_{c}").alias(c) for c, (_, (f, _)) in totals.items()])
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("part", F.col(key).alias("of"), *[f(c).over(earlier).alias(f"carried_{c}") for c, (_, (f, _)) in totals.items()])
    carried = carried.where(" OR ".join(f"carried_{c} IS NOT NULL" for c in totals))
    own = Window.partitionBy("part", key).orderBy(*order, "tie").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[f(f"value_{c}").over(own).alias(f"local_{c}") for c, (_, (f, _)) in totals.items()])
    both = local.join(F.broadcast(carried.withColumnRenamed("part", "in_part")), (F.col("part") == F.col("in_part")) & (F.col(key) == F.col("of")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return both.select(*df.columns, *[combine(zero(f"carried_{c}"), zero(f"local_{c}")).alias(c) for c, (_, (_, combine)) in totals.items()])


def ordered_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """conv, pos (from 0), a and b (hashes of role and text), bytes (of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), "turn", F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"), F.octet_length(text).cast("long").alias("bytes")
    )
    return before(turns, "conv", [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")], {"pos": (F.lit(1).cast("long"), SUM)}, "turns").drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with turns of another one: their turns, and their ids with the number of turns.

    The first h turns come from the conversation whose id is the next multiple of
    ``FAMILY`` towards 0 (as many as it has), the others are the own ones after the
    first h; h is the checksum of the id modulo ``OPENINGS``.
    """
    turns = materialise(turns, "numbered-turns")
    sizes = materialise(turns.groupBy("conv").agg((F.max("pos") + 1).alias("n")), "conversations")
    h = F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % OPENINGS
    other = sizes.where(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("opening"), F.col("n").alias("held"))
    named = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("opening")).join(other, "opening", "left")
    shared = F.least("h", F.coalesce("held", F.lit(0)))
    convs = materialise(named.select("conv", "h", shared.alias("shared"), (shared + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")), "openings")
    own = turns.join(convs, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "a", "b", "bytes")
    near = F.array(*[F.try_add(F.col("conv"), F.lit(i)) for i in range(1 - FAMILY, FAMILY)])
    family = F.filter(near, lambda c: c.isNotNull() & (c - c % FAMILY == F.col("conv")))
    lent = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < OPENINGS - 1)).select(F.explode(family).alias("conv"), "pos", "a", "b", "bytes")
    lent = lent.join(convs, "conv").where("pos < h").select("conv", "pos", "a", "b", "bytes")
    return own.union(lent), convs.select("conv", "n_turns")


def place_hash(turn: Column, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), turn["pos"], turn["a"], turn["b"])


def blocks_of(turns: DataFrame) -> DataFrame:
    """conv, k, turns (at most ``BLOCK``, in order), the digest dx, dy of the block and x, y of all blocks before it."""
    listed = turns.groupBy("conv", F.expr(f"pos DIV {BLOCK}").alias("k")).agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "bytes"))).alias("turns"))
    digest = lambda salt: F.aggregate("turns", F.lit(0).cast("long"), lambda d, t: d.bitwiseXOR(place_hash(t, salt)))
    digests = listed.select("*", digest(1).alias("dx"), digest(2).alias("dy"))
    return before(digests, "conv", [F.col("k")], {"x": (F.col("dx"), XOR), "y": (F.col("dy"), XOR)}, "blocks")


def boundaries(blocks: DataFrame, *columns: str) -> DataFrame:
    """One row a turn of ``blocks``: px, py (the node before it), x, y (the node after it), depth, bytes and ``columns``."""
    upto = lambda n, salt, c: F.aggregate(F.slice("turns", 1, n), F.col(c), lambda d, t: d.bitwiseXOR(place_hash(t, salt)))
    node = lambda t, i: F.struct(upto(i, 1, "x").alias("px"), upto(i, 2, "y").alias("py"), upto(i + 1, 1, "x").alias("x"), upto(i + 1, 2, "y").alias("y"), (t["pos"] + 1).alias("depth"), t["bytes"].alias("bytes"))
    return blocks.select(*columns, F.inline(F.transform("turns", node)))


def trie_nodes(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """x, y, px, py, depth, bytes, n_convs, conv (the smallest member): one row a node, the root included."""
    edges = blocks.groupBy("x", "y", "dx", "dy", "k").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.any_value("turns").alias("turns"))
    edges = materialise(edges, "block-edges")
    forks = edges.where("k > 0").groupBy(*_KEY).agg(F.count("*").alias("siblings")).where("siblings > 1")
    later = edges.where("k > 0").join(forks, _KEY, "left")
    later = materialise(later, "block-siblings")
    kept = ["n_convs", "conv"]
    alone = boundaries(later.where("siblings IS NULL"), *kept)
    apart = boundaries(edges.where("k = 0").select("x", "y", "turns", *kept).union(later.where("siblings > 1").select("x", "y", "turns", *kept)), *kept)
    counted = apart.groupBy("x", "y", "px", "py", "depth", "bytes").agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0").select(zero.alias("x"), zero.alias("y"), none.alias("px"), none.alias("py"), zero.alias("depth"), zero.alias("bytes"), "n_convs", "conv")
    columns = root.columns
    return materialise(root.unionByName(alone.select(*columns)).unionByName(counted.select(*columns)), "nodes")


def id_digests(ends: DataFrame) -> DataFrame:
    """``ends``: x, y, conv. Returns x, y and ends_sha256: the hash of the node's ids, ascending, joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            out: list[list] = []
            for x, y, conv in zip(*(got.column(c).to_pylist() for c in ("x", "y", "conv")), strict=True):
                if out and out[-1][:2] == [x, y] and out[-1][4] < PIECE:
                    out[-1][3].append(str(conv))
                    out[-1][4] += len(out[-1][3][-1]) + 1
                else:
                    out.append([x, y, conv, [str(conv)], 0])
            if out:
                x, y, first, ids, _ = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(first, pa.int64()), pa.array(map(",".join, ids), pa.string())], names=["x", "y", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(rows: list) -> pa.RecordBatch:
            x, y, digest = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(digest, pa.string())], names=["x", "y", "ends_sha256"])

        node, state = None, None
        for got in batches:
            out = []
            for x, y, ids in zip(*(got.column(c).to_pylist() for c in ("x", "y", "ids")), strict=True):
                if (x, y) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (x, y), hashlib.sha256(ids.encode())
            if out:
                yield finished(out)
        if node:
            yield finished([(*node, state.hexdigest())])

    bounded_batches(ends.sparkSession)
    sorted_ids = ends.repartitionByRange("x", "y", "conv").sortWithinPartitions("x", "y", "conv")
    joined = sorted_ids.mapInArrow(pieces, "x long, y long, first long, ids string")
    return joined.repartition("x", "y").sortWithinPartitions("x", "y", "first").mapInArrow(hashed, "x long, y long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of all conversations ``convs`` (conv, n_turns) with their ``turns`` (conv, pos, a, b, bytes).

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256.
    """
    blocks = materialise(blocks_of(turns), "blocks-before")
    nodes = trie_nodes(blocks, convs)
    children = nodes.where("depth > 0").groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    children = materialise(children, "children")

    whole = blocks.groupBy("conv").agg(F.bit_xor("dx").alias("x"), F.bit_xor("dy").alias("y")).select(*_KEY, "conv")
    zero = F.lit(0).cast("long")
    ends = id_digests(whole.union(convs.where("n_turns = 0").select(zero, zero, "conv")))

    owned = nodes.join(children, _KEY, "left").select("conv", "depth", zero.alias("x"), zero.alias("y"), F.lit(0).alias("step"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("weight"), F.col("n_children").isNull().cast("long").alias("leaf"))
    steps = boundaries(blocks, "conv").select("conv", "depth", "x", "y").union(convs.select("conv", zero, zero, zero))
    rows = owned.union(steps.select("conv", "depth", "x", "y", F.lit(1), zero, zero))
    summed = before(rows, "conv", [F.col("depth").desc(), F.col("step")], {"saved": (F.col("weight"), SUM), "leaves": (F.col("leaf"), SUM)}, "paths")
    below = summed.where("step = 1").groupBy(*_KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    told = nodes.join(children, _KEY, "left").join(below, _KEY).join(ends, _KEY, "left")
    told = materialise(told, "told-nodes")
    parents = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv").alias("parent_conv_id")).join(children.select(F.col("x").alias("px"), F.col("y").alias("py")), ["px", "py"], "left_semi")
    out = told.join(materialise(parents, "parents"), ["px", "py"], "left")
    return out.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The prefix trie of a table of turns (``id_col``, turn, role, text), as they are."""
    turns = materialise(ordered_turns(df, id_col), "numbered-turns")
    return prefix_trie(turns, turns.groupBy("conv").agg((F.max("pos") + 1).alias("n_turns")))


def rebuilt_trie(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The prefix trie of the conversations that ``rebuilt`` makes of a table of turns."""
    return prefix_trie(*rebuilt(ordered_turns(df, id_col)))
