"""Exact top-k search by inner product over a pivot-distance index.

Vectors of norm at most M are lifted onto a sphere by one more coordinate,
sqrt(M^2 - |x|^2), and queries get zero there; then the largest inner product is
the smallest distance: d^2 = |q|^2 + M^2 - 2 q.x. Every row is keyed by its nearest
pivot and its distance to it; rows sorted by that key are packed into blocks, each
an annulus (pivot, smallest and largest distance). A query's home block gives its
first k scores. It then meets the other annuli, nearest first; by the triangle
inequality an annulus whose distances to the pivot differ from the query's own by
b holds no row nearer than b, and it is skipped once that can't beat the k-th score.

The bounds act before vectors move: queries of neighbouring blocks make a side, and
for each side and pivot the distances that any of its queries could still need make
an interval. Only blocks whose annulus meets the interval are sent to the side, in
cells of ``CELL_BLOCKS`` neighbouring blocks and the queries of ``SIDE_BLOCKS``; within
a cell each query has its own bound. Only a cell's best k pass on. Rows are dealt by
range of (pivot, distance, id), so a vector that a third of all rows share is cut into
many blocks.

Pivots come from a bounded sample (``SAMPLE`` rows with the smallest hash of the
id); they steer speed alone, since every row is indexed and bounds are exact.

Defined cases: rows with a null id, a null vector or a null or non-finite component
take no part; vectors meet only those of their own length; rows of the query's own
id are never its candidates; ties go to the smaller id, then equal rows repeat; an
empty table or fewer than k candidates give what there is; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixspark.llm.common import batch, materialise

SAMPLE, PIVOTS, BLOCK = 2048, 32, 1024
#: Neighbouring blocks that a cell holds, and whose queries make a side.
CELL_BLOCKS, SIDE_BLOCKS = 16, 80


def whole_vectors(df: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and floor(scale * x) of each component, as whole doubles."""
    fine = ~F.exists(F.col(vec_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    # floor() gives a long; doubles from 2**52 on are whole as they are
    down = lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(F.col(vec_col), lambda x: down(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first among the sample's lifted points."""
    chosen = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))[:, None]])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact also where doubles would round."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2.0**53:
        return a @ b.T
    exact = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    return exact.astype(np.int64)


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, -np.inf)
        self.rows, self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, queries: np.ndarray, own: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        r, c = np.nonzero((scores >= self.floor[queries][:, None]) & (own[:, None] != ids[None, :]))
        rows = np.concatenate([self.rows, queries[r]])
        got = np.concatenate([self.scores, scores[r, c].astype(np.int64)])
        whom = np.concatenate([self.ids, ids[c]])
        order = np.lexsort((whom, -got, rows))
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = order[place < self.k]
        rank = place[place < self.k]
        self.rows, self.scores, self.ids = rows[place < self.k], got[keep], whom[keep]
        full = rank == self.k - 1
        self.floor[self.rows[full]] = self.scores[full]


def _matrix(raw: bytes, d: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8").reshape(-1, d)


def build_index(vectors: DataFrame, d: int, top: float, pivots: np.ndarray) -> DataFrame:
    """Blocks of the sorted (pivot, distance, id) order: one row each."""
    keyed_types = {"vec_id": pa.int64(), "pivot": pa.int32(), "dist": pa.float64(), "vec": pa.binary()}
    block_types = {"block": pa.int64(), "pivot": pa.int32(), "lo": pa.float64(), "hi": pa.float64(), "ids": pa.binary(), "vecs": pa.binary()}

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            if got.num_rows:
                x = got.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                far = np.sqrt(np.maximum(2 * top - 2 * lift(x, top) @ pivots.T, 0))
                near = far.argmin(axis=1)
                yield batch(keyed_types, {"vec_id": got.column("vec_id"), "pivot": near.astype(np.int32), "dist": far[np.arange(len(x)), near], "vec": [row.tobytes() for row in x]})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for got in batches:
            pivot = got.column("pivot").to_numpy()
            cuts = np.concatenate(([0], np.nonzero(np.diff(pivot))[0] + 1, [len(pivot)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                for lo in range(a, b, BLOCK):
                    one = got.slice(lo, min(BLOCK, b - lo))
                    dist = one.column("dist").to_numpy()
                    yield batch(block_types, {"block": [(part << 32) + made], "pivot": [int(pivot[lo])], "lo": [float(dist.min())], "hi": [float(dist.max())], "ids": [one.column("vec_id").to_numpy().astype("<i8").tobytes()], "vecs": [b"".join(one.column("vec").to_pylist())]})
                    made += 1

    keyed = vectors.mapInArrow(key, "vec_id long, pivot int, dist double, vec binary")
    order = ["pivot", "dist", "vec_id"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, "block long, pivot int, lo double, hi double, ids binary, vecs binary")


def _search(vectors: DataFrame, d: int, k: int, every: int) -> DataFrame:
    top = float(vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0])
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    pivots = choose_pivots(lift(np.array([r.v for r in sample], float), top), PIVOTS)
    index = materialise(build_index(vectors, d, top, pivots), "annuli")
    query_types = {"home": pa.int64(), "qids": pa.binary(), "qvecs": pa.binary(), "floors": pa.binary(), "near": pa.list_(pa.float64()), "far": pa.list_(pa.float64())}

    def reach(q: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distances to the pivots, squared norms, and how far from a query a row can be and still reach its floor."""
        norms = (q * q).sum(axis=1)
        to_pivots = np.sqrt(np.maximum(norms[:, None] + top - 2 * q @ pivots[:, :d].T, 0))
        slack = 1e-9 * (norms + top) + 1e-6
        return to_pivots, norms, np.sqrt(np.maximum(norms + top + 2 * slack - 2 * floor, 0))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The queries of each block with the k-th score that their own block gives."""
        for got in batches:
            for block, raw_ids, raw in zip(got.column("block").to_pylist(), got.column("ids").to_pylist(), got.column("vecs").to_pylist(), strict=True):
                ids, x = np.frombuffer(raw_ids, "<i8"), _matrix(raw, d)
                mine = np.nonzero(ids % every == 0)[0]
                if len(mine):
                    best = Best(len(mine), k)
                    best.add(np.arange(len(mine)), ids[mine], products(x[mine], x), ids)
                    to_pivots, _, radius = reach(x[mine], best.floor)
                    near, far = (to_pivots - radius[:, None]).min(axis=0), (to_pivots + radius[:, None]).max(axis=0)
                    yield batch(query_types, {"home": [block], "qids": [ids[mine].tobytes()], "qvecs": [x[mine].tobytes()], "floors": [best.floor.tobytes()], "near": [near], "far": [far]})

    def together(block: str, n: int) -> Column:
        """Neighbouring blocks of one range get one number."""
        return (F.shiftleft(F.shiftright(block, 32), 32) + F.floor(F.col(block).bitwiseAND((1 << 32) - 1) / n)).cast("long")

    found_home = index.mapInArrow(home, "home long, qids binary, qvecs binary, floors binary, near array<double>, far array<double>")
    queries = materialise(found_home.withColumn("h", together("home", SIDE_BLOCKS)), "queries")
    spans = queries.select("h", F.posexplode(F.arrays_zip("near", "far")).alias("pivot", "x")).groupBy("h", "pivot").agg(F.min("x.near").alias("near"), F.max("x.far").alias("far"))
    placed = index.select("block", "pivot", "lo", "hi", together("block", CELL_BLOCKS).alias("g"))
    needed = materialise(placed.join(spans, "pivot").where("lo <= far AND hi >= near").select("block", "g", "h"), "needed-blocks")
    result_types = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}

    def cell(blocks: pa.Table, asked: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], t) for c, t in result_types.items()})
        if not blocks.num_rows or not asked.num_rows:
            return empty
        qids = np.concatenate([np.frombuffer(x, "<i8") for x in asked.column("qids").to_pylist()])
        q = np.vstack([_matrix(x, d) for x in asked.column("qvecs").to_pylist()])
        best = Best(len(qids), k)
        best.floor = np.concatenate([np.frombuffer(x, "<f8") for x in asked.column("floors").to_pylist()])
        far, norms, radius = reach(q, best.floor)
        slack = 1e-9 * (norms + top) + 1e-6
        pivot, lo, hi = (blocks.column(c).to_numpy() for c in ("pivot", "lo", "hi"))
        apart = np.maximum(np.maximum(far[:, pivot] - hi, lo - far[:, pivot]), 0)
        order = np.argsort(apart.min(axis=0), kind="stable")  # annuli nearest to a query first
        for b in order[(apart <= radius[:, None]).any(axis=0)[order]].tolist():
            bound = (norms + top - apart[:, b] ** 2) / 2
            live = np.nonzero(bound + slack >= best.floor)[0]
            if len(live):
                ids, x = np.frombuffer(blocks.column("ids")[b].as_py(), "<i8"), _matrix(blocks.column("vecs")[b].as_py(), d)
                best.add(live, qids[live], products(q[live], x), ids)
        return pa.table({"query_id": pa.array(qids[best.rows], pa.int64()), "vec_id": pa.array(best.ids, pa.int64()), "score": pa.array(best.scores, pa.int64())})

    left = index.join(needed, "block")
    cells = needed.select(F.col("g").alias("part"), F.col("h").alias("side")).distinct()
    right = queries.drop("near", "far").join(cells, F.col("h") == F.col("side")).drop("h")
    found = left.groupBy("g", "h").cogroup(right.groupBy("part", "side")).applyInArrow(cell, "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


def top_k(df: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for each row whose id is divisible by ``every``."""
    vectors = whole_vectors(df, scale, id_col, vec_col)
    sizes = [r.d for r in vectors.select(F.size("v").alias("d")).distinct().collect()]  # as a rule one
    out = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for d in sorted(sizes):
        out = out.unionByName(_search(vectors.where(F.size("v") == d), d, k, every))
    return out
