"""Quality by a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` bytes that overlap by the width of
a filter less one, so each window of the whole text lies in one chunk. Learned filters
over embedded bytes are max-pooled within a chunk; a hidden layer turns the pooled
values of a chunk into features, which are max-pooled and averaged over all chunks and
combined into one probability. A chunk's pooled values also tell what it lacks (text
that repeats a word moves few filters), which is what the hidden layer is for.

Training, on the driver: at most ``sample`` rows of the rarer label and twice as many of
the other, those with the smallest hash of the id; of each text at most ``spread``
chunks, spread evenly over it, cut on the executors, so the driver gets bounded bytes.
Backpropagation with Adam from a fixed seed; the intercept is set back to the labels'
own shares at the end. Filters and embeddings are merged into one table a byte of the
filter's width, so scoring is ``WIDTH`` lookups a byte, without a shuffle.

Defined cases: a null or empty text counts as ``WIDTH`` zero bytes; texts of any length
count whole; label rows that are null or match no document are left out; of an id with
several texts the smallest trains; without labels of both kinds every score is the share
of good labels (0.5 without any); repeated rows repeat; an empty table gives an empty
table; labels, language, source and id never enter a score; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixspark.llm.common import arrow_map, batch, texts
from mixspark.llm.toxicity import held_out

#: Rows of the rarer label that train at most (of the other one twice as many); chunks of one text that train.
SAMPLE, SPREAD = 1500, 24
CHUNK, WIDTH, EMBEDDED, FILTERS, HIDDEN = 256, 7, 8, 24, 16
#: Windows of a chunk; chunks that are convolved at once.
WINDOWS, GROUP = CHUNK - WIDTH + 1, 32
#: Rounds over the sample and least number of steps, of so many documents each; largest rate of a step.
EPOCHS, STEPS, DOCUMENTS, RATE = 6, 800, 32, 0.01


def chunk_starts(size: int) -> np.ndarray:
    return np.arange(0, max(1, size - WIDTH + 1), WINDOWS)


def spread_chunks(data: bytes, most: int) -> list[bytes]:
    """All chunks of a text, or ``most`` that are spread evenly from its first to its last."""
    starts = chunk_starts(len(data))
    if len(starts) > most:
        starts = starts[np.linspace(0, len(starts) - 1, most).round().astype(int)]
    return [data[s : s + CHUNK] for s in starts.tolist()]


def chunk_table(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the chunks, padded with zeros, and how many windows each one has."""
    table = np.frombuffer(b"".join(c.ljust(CHUNK, b"\0") for c in chunks), np.uint8).reshape(-1, CHUNK)
    return table, np.array([max(1, len(c) - WIDTH + 1) for c in chunks])


class Network:
    """Parameters, and both passes over them."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        scaled = lambda *shape, fan: (rng.standard_normal(shape) * math.sqrt(2 / fan)).astype(np.float32)
        self.weights = {
            "embedding": scaled(256, EMBEDDED, fan=2.0),
            "filters": scaled(WIDTH, EMBEDDED, FILTERS, fan=WIDTH * EMBEDDED),
            "filter_bias": np.zeros(FILTERS, np.float32),
            "hidden": scaled(FILTERS, HIDDEN, fan=FILTERS),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": scaled(2 * HIDDEN, fan=2 * HIDDEN),
            "out_bias": np.zeros(1, np.float32),
        }

    def tables(self) -> np.ndarray:
        """For each place of a filter and each byte, what it adds to all filters."""
        return np.einsum("be,kef->kbf", self.weights["embedding"], self.weights["filters"])

    def pooled(self, table: np.ndarray, windows: np.ndarray, tables: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The largest response of each filter within each chunk, and where it is."""
        best = np.empty((len(table), FILTERS), np.float32)
        at = np.empty((len(table), FILTERS), np.int64) if places else None
        for lo in range(0, len(table), GROUP):
            part = table[lo : lo + GROUP]
            response = tables[0].take(part[:, :WINDOWS], axis=0)
            for k in range(1, WIDTH):
                response += tables[k].take(part[:, k : k + WINDOWS], axis=0)
            short = windows[lo : lo + GROUP] < WINDOWS
            if short.any():
                response[np.arange(WINDOWS)[None, :] >= windows[lo : lo + GROUP, None]] = -np.inf
            if places:
                at[lo : lo + GROUP] = where = response.argmax(axis=1)
                best[lo : lo + GROUP] = np.take_along_axis(response, where[:, None, :], axis=1)[:, 0]
            else:
                best[lo : lo + GROUP] = response.max(axis=1)
        return best + self.weights["filter_bias"], at

    def combined(self, pooled: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Log-odds of documents, whose chunks begin at ``first``, and what the way back needs."""
        w = self.weights
        z = np.maximum(pooled, 0)
        h = np.maximum(z @ w["hidden"] + w["hidden_bias"], 0)
        count = np.diff(np.append(first, len(h)))
        most, mean = np.maximum.reduceat(h, first), np.add.reduceat(h, first) / count[:, None]
        both = np.hstack([most, mean])
        return both @ w["out"] + w["out_bias"][0], {"z": z, "h": h, "count": count, "most": most, "both": both}

    def gradients(self, table: np.ndarray, windows: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of some documents."""
        w, tables = self.weights, self.tables()
        pooled, at = self.pooled(table, windows, tables, places=True)
        odds, kept = self.combined(pooled, first)
        error = ((1 / (1 + np.exp(-odds)) - y) / len(y)).astype(np.float32)
        out = {"out": kept["both"].T @ error, "out_bias": np.array([error.sum()])}
        d_most, d_mean = np.split(error[:, None] * w["out"][None, :], 2, axis=1)
        owner = np.repeat(np.arange(len(y)), kept["count"])
        top = (kept["h"] == kept["most"][owner]) & (kept["h"] > 0)
        ties = np.maximum(np.add.reduceat(top.astype(np.float32), first), 1)
        d_h = (top * (d_most / ties)[owner] + (d_mean / kept["count"][:, None])[owner]) * (kept["h"] > 0)
        out |= {"hidden": kept["z"].T @ d_h, "hidden_bias": d_h.sum(axis=0)}
        d_z = (d_h @ w["hidden"].T) * (pooled > 0)
        out["filter_bias"] = d_z.sum(axis=0)
        d_tables, column = np.empty((WIDTH, 256, FILTERS), np.float32), np.arange(FILTERS)
        for k in range(WIDTH):
            byte = np.take_along_axis(table, at + k, axis=1).astype(np.int64)
            d_tables[k] = np.bincount((byte * FILTERS + column).ravel(), d_z.ravel(), 256 * FILTERS).reshape(256, FILTERS)
        out["embedding"] = np.einsum("kbf,kef->be", d_tables, w["filters"])
        out["filters"] = np.einsum("be,kbf->kef", w["embedding"], d_tables)
        return out


class Scorer:
    """A trained network, ready to score; without one, a constant."""

    def __init__(self, network: Network | None, share: float):
        self.network, self.share = network, share
        self.tables = network.tables() if network else None

    def scores(self, documents: list[bytes]) -> np.ndarray:
        if not self.network or not documents:
            return np.full(len(documents), self.share)
        pooled, counts, waiting, held = [], [], [], 0
        for data in documents:
            starts = chunk_starts(len(data))
            counts.append(len(starts))
            for s in starts.tolist():
                waiting.append(data[s : s + CHUNK])
                if len(waiting) == 4096:
                    pooled.append(self.network.pooled(*chunk_table(waiting), self.tables)[0])
                    waiting = []
        if waiting:
            pooled.append(self.network.pooled(*chunk_table(waiting), self.tables)[0])
        # In double precision and rounded, a score does not depend on the rows beside it.
        odds, _ = self.network.combined(np.concatenate(pooled).astype(np.float64), np.concatenate(([0], np.cumsum(counts)[:-1])))
        return np.round(1 / (1 + np.exp(-np.clip(odds, -30, 30))), 9)


def fit(documents: list[list[bytes]], good: np.ndarray, share: float) -> Scorer:
    """Train on the chunks of labelled documents; ``share`` of good ones among all labels. Deterministic."""
    if not good.any() or good.all():
        return Scorer(None, share)
    network, rng = Network(), np.random.default_rng(2)
    table, windows = chunk_table([c for d in documents for c in d])
    counts = np.array([len(d) for d in documents])
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.weights.items()}
    a_round = -(-len(documents) // DOCUMENTS)
    rounds = max(EPOCHS, -(-STEPS // a_round))
    step, steps = 0, rounds * a_round
    for _ in range(rounds):
        order = rng.permutation(len(documents))
        for lo in range(0, len(order), DOCUMENTS):
            some = order[lo : lo + DOCUMENTS]
            rows = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in some])
            first = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
            got = network.gradients(table[rows], windows[rows], first, good[some].astype(np.float32))
            step += 1
            rate = RATE * min(1.0, step / 20) * (1 - step / (steps + 1))
            for k, g in got.items():
                g = g + 1e-4 * network.weights[k]
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                network.weights[k] = (network.weights[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    network.weights["out_bias"][0] += math.log(share / (1 - share)) - math.log(good.mean() / (1 - good.mean()))
    return Scorer(network, share)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, spread: int = SPREAD, target: str = "quality") -> Scorer:
    """Fit on a bounded sample of labelled documents, none of them held out; one text an id."""
    usable = labels.where(f"doc_id IS NOT NULL AND {target} IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(target).alias("good"))
    whole = {r.good: r.n for r in usable.groupBy("good").agg(F.count("*").alias("n")).collect()}
    share = whole.get(1, 0) / sum(whole.values()) if whole else 0.5
    rare = min((0, 1), key=lambda k: whole.get(k, 0))
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.where(F.col("good") == rare).orderBy(*by).limit(sample).union(usable.where(F.col("good") == 1 - rare).orderBy(*by).limit(2 * sample))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            pieces = [spread_chunks((t or "").encode(), spread) for t in got.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([got.column("doc_id"), got.column("good"), pa.array(pieces, pa.list_(pa.binary()))], names=["doc_id", "good", "chunks"])

    # At most 3 * sample rows of ids; of texts, at most 3 * sample * spread * CHUNK bytes.
    held = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).join(F.broadcast(chosen.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("good").cast("int").alias("good"))), "doc_id")
    one = held.groupBy("doc_id").agg(F.min("good").alias("good"), F.min("text").alias("text"))
    got = sorted(one.mapInArrow(cut, "doc_id long, good int, chunks array<binary>").collect())
    return fit([list(map(bytes, r.chunks)) for r in got], np.array([r.good == 1 for r in got], bool), share)


def quality_scores(docs: DataFrame, scorer: Scorer, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted for every row; narrow, no shuffle."""
    types = {"doc_id": pa.int64(), "score": pa.float64(), "predicted": pa.int32()}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        score = scorer.scores([(t or "").encode() for t in got.column("text").to_pylist()])
        return batch(types, {"doc_id": got.column("doc_id"), "score": score, "predicted": (score >= threshold).astype(np.int32)})

    return arrow_map(texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")), rows, "doc_id long, score double, predicted int")
