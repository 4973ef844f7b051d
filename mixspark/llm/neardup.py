"""MinHash near-duplicate detection with one-permutation hashing.

A document's set holds the hashes of its distinct shingles (five words; with
fewer words the whole sequence). One permutation is cut into bins; an empty bin
takes the value of the first filled bin in its own random order (optimal
densification). Rows of bins make bands; documents with an equal band share a
bucket. Equal sets are one class from the start. In each bucket a star joins all
members to one centre, the one that shares most buckets with others, so a bucket of
n members gives n - 1 candidate edges; each is confirmed on the two full sets.

A star can miss links between two members that are both unlike the centre. So each
bucket that then still holds more than one component is searched to the end: members
outside its largest component meet each other and those inside, in cells of two
blocks of some ``BLOCK`` members or ``BLOCK_SHINGLES`` shingles (a larger text is a
block of its own). Those inside never meet: one outsider among n members moves about n
rows. A cell counts common shingles for many members at once over its own inverted
index and gives only links, no pairs. Every link inside a bucket is found; a link is
missed only if its two documents share no band (5e-6 at a similarity of 0.75). Where
most members are outsiders (a bucket of unlinked texts), the counting and the blocks
that a text is sent to grow with their square. Sets whose sizes alone rule a link out
are not compared.

Defined cases: a null or empty text, or one without words, has no shingles and is
linked with nothing; a document without an id takes no part and is not kept;
rows with equal ids count as one document whose links are those of each row;
repeated rows fall into one class; whole texts count; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixspark.llm.common import arrow_map, batch, bounded_batches, materialise, release, slices, texts
from mixspark.llm.components import connected_components

SHINGLE, BANDS, ROWS = 5, 32, 4
BINS = BANDS * ROWS

#: Members of a bucket, and shingles of theirs, in one block; a cell holds two.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


@lru_cache(1)
def _probes() -> np.ndarray:
    """For each bin the other bins in the order in which it borrows from them."""
    order = mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(77 << 32)).reshape(BINS, BINS)
    return np.argsort(order, axis=1)


def shingle_sets(all_texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [(t or "").encode().lower().split() for t in all_texts]
    counts = np.array([len(w) for w in words], np.int64)
    total = int(counts.sum())
    flat = np.empty(total, object)
    flat[:] = [w for doc in words for w in doc]
    hashes = pd.util.hash_array(flat, categorize=False) if total else np.empty(0, np.uint64)
    odd, at = _odd(SHINGLE, 1), 0
    width = max(0, total - SHINGLE + 1)
    rolled = np.zeros(width, np.uint64)
    for k in range(SHINGLE):
        rolled += hashes[k : k + width] * odd[k]
    rolled, out = mix(rolled), []
    for n in counts.tolist():
        if n >= SHINGLE:
            out.append(np.unique(rolled[at : at + n - SHINGLE + 1]))
        elif n:
            out.append(mix((hashes[at : at + n] * odd[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of band keys for each set (zeros where a set is empty)."""
    shift = np.uint64(64 - (BINS - 1).bit_length())
    edges = np.arange(BINS, dtype=np.uint64) << shift
    values, filled = np.zeros((len(sets), BINS), np.uint64), np.zeros((len(sets), BINS), bool)
    for i, s in enumerate(sets):
        if len(s):
            first = np.minimum(np.searchsorted(s, edges), len(s) - 1)
            values[i] = s[first]
            filled[i] = (values[i] >> shift) == np.arange(BINS, dtype=np.uint64)
    rows, bins = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    for lo in range(0, len(rows), 20_000):
        r, b = rows[lo : lo + 20_000], bins[lo : lo + 20_000]
        order = _probes()[b]
        values[r, b] = values[r, order[np.arange(len(r)), filled[r[:, None], order].argmax(axis=1)]]
    grouped = (values.reshape(len(sets), BANDS, ROWS) * _odd(ROWS, 2)).sum(axis=2, dtype=np.uint64)
    return mix(grouped + _odd(BANDS, 3))


def signatures(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, and the band keys."""
    types = {"doc_id": pa.int64(), "n_shingles": pa.int64(), "k1": pa.int64(), "k2": pa.int64(), "bands": pa.list_(pa.int64())}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        all_texts, out = got.column("text").to_pylist(), {k: [] for k in types}
        for at in range(0, len(all_texts), 256):
            sets = shingle_sets(all_texts[at : at + 256])
            out["n_shingles"] += [len(s) for s in sets]
            out["k1"] += [int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            out["k2"] += [int(mix(s + np.uint64(9)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            out["bands"] += list(band_keys(sets).view(np.int64))
        return batch(types, out | {"doc_id": got.column("doc_id")})

    return arrow_map(df, rows, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def confirm(pairs: DataFrame, candidates: DataFrame, per_cent: int) -> DataFrame:
    """(a, b, linked): the similarity of the two full sets against the threshold."""
    left = candidates.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    right = candidates.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    types = {"a": pa.int64(), "b": pa.int64(), "linked": pa.bool_()}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        linked, a, b = [], got.column("a_text"), got.column("b_text")
        for at in range(0, len(a), 128):
            for x, y in zip(shingle_sets(a[at : at + 128].to_pylist()), shingle_sets(b[at : at + 128].to_pylist()), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= per_cent * max(len(x), len(y)) else 0
                linked.append(both > 0 and 100 * both >= per_cent * (len(x) + len(y) - both))
        return batch(types, {"a": got.column("a"), "b": got.column("b"), "linked": linked})

    return arrow_map(pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text"), rows, "a long, b long, linked boolean")


def cell_links(sets: list[np.ndarray], comp: np.ndarray, block: np.ndarray, outside: np.ndarray, per_cent: int) -> list[tuple[int, int]]:
    """Linked pairs of a cell, by place: of two components, one member outside the largest, of both blocks if there are two."""
    size = np.array([len(s) for s in sets], np.int64)
    shingle, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    by_shingle = np.argsort(which, kind="stable")
    holders, start = owner[by_shingle], np.searchsorted(which[by_shingle], np.arange(len(shingle) + 1))
    first, two_blocks, out = np.cumsum(size) - size, block.min() != block.max(), []
    for i in np.nonzero(outside)[0].tolist():
        other = (comp != comp[i]) & (100 * np.minimum(size, size[i]) >= per_cent * np.maximum(size, size[i]))
        other &= ~outside | (np.arange(len(sets)) < i)  # of two outside members the later one looks
        if two_blocks:
            other &= block != block[i]
        if not other.any():
            continue
        mine = which[first[i] : first[i] + size[i]]
        lo, n = start[mine], start[mine + 1] - start[mine]
        common = np.bincount(holders[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())], minlength=len(sets))
        linked = other & (common > 0) & (100 * common >= per_cent * (size + size[i] - common))
        out += [(i, j) for j in np.nonzero(linked)[0].tolist()]
    return out


def dealt_cells(members: DataFrame, block: int, shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """band, key, x, y, own, rep, comp, outside: each member in all its cells. ``members``: band, key, rep, comp, largest and of the two sides of the bucket n_in, n_out, s_in, s_out (members, shingles)."""
    of = lambda n, s: F.greatest(F.ceil(F.col(n) / block), F.ceil(F.col(s) / shingles))
    outside, h = F.col("comp") != F.col("largest"), F.xxhash64("rep")
    sized = members.withColumns({"outside": outside, "b_out": of("n_out", "s_out"), "b_in": of("n_in", "s_in")})
    own = F.when(F.col("outside"), F.pmod(h, F.col("b_out"))).otherwise(F.col("b_out") + F.pmod(h, F.col("b_in")))
    met = F.when(F.col("outside"), F.col("b_out") + F.col("b_in")).otherwise(F.col("b_out"))
    dealt = sized.select("band", "key", "rep", "comp", "outside", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), met - 1)).alias("other"))
    return dealt.select("band", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "rep", "comp", "outside")


def links_within(members: DataFrame, candidates: DataFrame, per_cent: int, block: int) -> DataFrame:
    """(a, b): all components linked within open buckets. ``members`` as in ``dealt_cells``."""
    cells = dealt_cells(members, block)
    whole = cells.join(candidates.select(F.col("doc_id").alias("rep"), "text"), "rep")
    keys = ["band", "key", "x", "y"]
    types = {"a": pa.int64(), "b": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def links() -> pa.RecordBatch:
            comp, own, outside, sets = (list(x) for x in zip(*held, strict=True))
            found = cell_links(sets, np.array(comp), np.array(own), np.array(outside), per_cent) if len(set(comp)) > 1 else []
            pairs = {(max(comp[i], comp[j]), min(comp[i], comp[j])) for i, j in found}
            return batch(types, {"a": [a for a, _ in pairs], "b": [b for _, b in pairs]})

        for whole_batch in batches:
            for got in slices(whole_batch):
                sets = shingle_sets(got.column("text").to_pylist())
                places = zip(*(got.column(k).to_pylist() for k in keys), strict=True)
                for place, row in zip(places, zip(*(got.column(k).to_pylist() for k in ("comp", "own", "outside")), sets, strict=True), strict=True):
                    if place != now:
                        if held:
                            yield links()
                        now, held = place, []
                    held.append(row)
        if held:
            yield links()

    bounded_batches(members.sparkSession)
    found = whole.repartition(*keys).sortWithinPartitions(*keys, "rep").select(*keys, "comp", "own", "outside", "text").mapInArrow(run, "a long, b long")
    return found.distinct()


def near_duplicates(df: DataFrame, per_cent: int = 75, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``df``."""
    source = texts(df, id_col, text_col)
    signed = materialise(signatures(source), "signatures")
    whole = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = whole.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    first = materialise(first, "first-of-class")
    member = materialise(whole.join(first, ["k1", "k2", "n_shingles"]).select("doc_id", "rep", "n_shingles", F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands")), "classes")

    items = member.where("bands IS NOT NULL").select("rep", "n_shingles", F.posexplode("bands").alias("band", "key"))
    shared = items.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(shared, "shared-buckets")  # written first, so that the join can split a hot bucket
    bucketed = materialise(items.join(shared, ["band", "key"]), "buckets")
    known = materialise(bucketed.groupBy("rep").agg(F.sum("n").alias("weight")), "weights")
    candidates = materialise(source.join(known.select(F.col("rep").alias("doc_id")), "doc_id"), "candidates")

    # A star in each bucket, from the member that shares most buckets.
    weighed = bucketed.join(known, "rep")
    centre = weighed.groupBy("band", "key").agg(F.max(F.struct("weight", "rep", "n_shingles")).alias("c")).select("band", "key", F.col("c.rep").alias("c"), F.col("c.n_shingles").alias("c_size"))
    centre = materialise(centre, "centres")
    alike = F.lit(100) * F.least("n_shingles", "c_size") >= F.lit(per_cent) * F.greatest("n_shingles", "c_size")
    pairs = bucketed.join(centre, ["band", "key"]).where(F.col("rep") != F.col("c")).where(alike).select(F.greatest("rep", "c").alias("a"), F.least("rep", "c").alias("b")).distinct()
    links = confirm(materialise(pairs, "pairs"), candidates, per_cent).where("linked").select("a", "b")
    nodes = known.select("rep")
    several = member.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).where("b < most").select("doc_id", "b")
    if several.take(1):  # an id with different texts links their classes
        links = links.unionByName(member.join(several, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct())
        nodes = member.select("rep").distinct()
    roots = connected_components(links).select(F.col("node").alias("rep"), "root")

    # Buckets that still hold more than one component.
    state = nodes.join(roots, "rep", "left").select("rep", F.coalesce("root", "rep").alias("comp"))
    placed = bucketed.join(state, "rep")
    part = placed.groupBy("band", "key", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    sides = part.groupBy("band", "key").agg(F.max(F.struct("n", "comp", "s")).alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("comps")).where("comps > 1")
    open_ = sides.selectExpr("band", "key", "top.comp AS largest", "top.n AS n_in", "n - top.n AS n_out", "top.s AS s_in", "s - top.s AS s_out")
    open_ = materialise(open_, "open-buckets")
    more = materialise(links_within(placed.drop("n").join(open_, ["band", "key"]), candidates, per_cent, block), "more-links")
    if more.take(1):  # the components are the nodes now
        further = connected_components(more).select(F.col("node").alias("comp"), F.col("root").alias("far"))
        state = state.join(further, "comp", "left").select("rep", F.coalesce("far", "comp").alias("comp"))
    release(bucketed, candidates)
    classed = member.select("doc_id", "rep").distinct().join(state, "rep", "left").select("doc_id", F.coalesce("comp", "rep").alias("class_root")).groupBy("doc_id").agg(F.min("class_root").alias("class_root"))
    out = signed.select("doc_id", "n_shingles").join(classed, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("class_root")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
