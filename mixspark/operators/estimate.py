"""Mixture estimators over read scores: variational Bayes and expectation-maximisation.

Three paths give the same numbers:

* samples of at most ``ONE_TASK`` scores: one sample a task, as arrays;
* larger ones: reads stay spread over the cluster in blocks. An iteration of all such
  samples is one job, which sums the responsibilities of a species in tasks and moves
  one number a sample, species and task; a sample that is done is left out;
* the steps as DataFrame operations, one iteration each, for plans and checks.

So no task ever holds more than ``ONE_TASK`` scores or one block, however large a
sample is; the driver holds a few numbers a species of ``TOGETHER`` samples at a time.

The estimators that both of the first paths share are written as generators: they ask
for a sum over a sample's reads and go on when it is there, be it at once (``alone``) or
with those of other samples (``together``).
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixspark.functions.special import digamma, digamma_column, log_gamma, log_gamma_column
from mixspark.operators.graph import dealt, shared_folder, written

#: Outer rounds of pruning; iterations between two looks at the bound; slack of a falling bound.
MAX_PRUNES, BOUND_EVERY, SLACK = 10, 100, 1e-9
#: Inner iterations of EM and the change in frequencies that ends them.
EM_INNER, EM_CHANGE = 20, 5e-4
#: Most scores of a sample that one task estimates (some 100 MB as arrays); larger samples estimated together.
ONE_TASK, TOGETHER = 2_000_000, 1000


@dataclass
class Scores:
    """Scores by read: entries of read r are start[r]:start[r + 1], sorted by species."""

    start: np.ndarray
    species: np.ndarray
    score: np.ndarray
    n_species: int

    @classmethod
    def of(cls, read: np.ndarray, species: np.ndarray, score: np.ndarray, n_species: int, n_reads: int) -> Scores:
        """Of repeated (read, species) the best counts; minus infinity is no score; reads may have none."""
        fine = score > -np.inf
        read, species, score = read[fine], species[fine], score[fine]
        order = np.lexsort((-score, species, read))
        read, species, score = read[order], species[order], score[order]
        first = np.ones(len(read), bool)
        first[1:] = (read[1:] != read[:-1]) | (species[1:] != species[:-1])
        read, species, score = read[first], species[first], score[first]
        return cls(np.searchsorted(read, np.arange(n_reads + 1)), species, score, n_species)

    @property
    def read(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    @property
    def n_scored(self) -> int:
        return int(np.count_nonzero(np.diff(self.start)))

    def only(self, keep: np.ndarray) -> Scores:
        """The species in ``keep`` (ascending), renumbered; reads stay."""
        place = np.full(self.n_species, -1)
        place[keep] = np.arange(len(keep))
        fine = place[self.species] >= 0
        return Scores(np.concatenate(([0], np.cumsum(fine)))[self.start], place[self.species[fine]], self.score[fine], len(keep))

    def by_read(self, ufunc: np.ufunc, x: np.ndarray) -> np.ndarray:
        """Reduce over each read that has entries; other reads are left out."""
        lo = self.start[:-1][np.diff(self.start) > 0]
        return ufunc.reduceat(x, lo) if len(lo) else np.empty(0)

    def spread(self, per_read: np.ndarray) -> np.ndarray:
        sizes = np.diff(self.start)
        return np.repeat(per_read, sizes[sizes > 0])

    @property
    def n_reads(self) -> int:
        return len(self.start) - 1

    def em_sums(self, freq: np.ndarray) -> tuple[np.ndarray, float]:
        """Responsibilities summed by species, and the log likelihood; species at 0 stay out."""
        with np.errstate(divide="ignore"):
            x = self.score + np.log(freq)[self.species]
        top = self.by_read(np.maximum, x)
        live = np.isfinite(top)
        y = np.exp(x - self.spread(np.where(live, top, 0.0)))
        total = self.by_read(np.add, y)
        column = np.bincount(self.species, y / self.spread(np.where(live, total, 1.0)), len(freq))
        return column, float((top[live] + np.log(total[live])).sum())


@dataclass
class Ask:
    """A vector to be summed over all reads of a sample."""

    of: Callable[[Scores], np.ndarray]
    size: int


Steps = Generator[Ask, np.ndarray]


def alone(steps: Steps, scores: Scores):
    """The result of an estimator whose sample is in memory."""
    answer = None
    while True:
        try:
            answer = steps.send(answer).of(scores)
        except StopIteration as end:
            return end.value


def responsibilities(scores: Scores, weight: np.ndarray) -> np.ndarray:
    """Softmax over each read's species of score plus the species' log weight."""
    x = scores.score + weight[scores.species]
    top = scores.by_read(np.maximum, x)
    x = np.exp(x - scores.spread(np.where(np.isfinite(top), top, 0.0)))
    total = scores.by_read(np.add, x)
    return x / scores.spread(np.where(total > 0, total, 1.0))


def expected_log(alpha: np.ndarray) -> np.ndarray:
    return digamma(alpha) - digamma(np.array([alpha.sum()]))


def updated_alpha(scores: Scores, phi: np.ndarray, prior: float) -> np.ndarray:
    return prior + np.bincount(scores.species, phi, scores.n_species)


def bound_of_reads(scores: Scores, phi: np.ndarray, e: np.ndarray) -> float:
    """The part of the bound that is summed over reads."""
    live = phi > 0
    return float((phi[live] * (scores.score[live] + e[scores.species[live]] - np.log(phi[live]))).sum())


def bound_of_weights(alpha: np.ndarray, prior: float) -> float:
    """The part of the bound that only species enter."""
    s = len(alpha)
    gamma = math.lgamma(prior * s) - s * math.lgamma(prior) - math.lgamma(float(alpha.sum())) + float(log_gamma(alpha).sum())
    return gamma + float(((prior - alpha) * expected_log(alpha)).sum())


def bound(scores: Scores, phi: np.ndarray, alpha: np.ndarray, prior: float) -> float:
    """Evidence lower bound of one state."""
    return bound_of_reads(scores, phi, expected_log(alpha)) + bound_of_weights(alpha, prior)


def checked_bound(value: float, last: float) -> float:
    """``value``, with a warning if it fell by more than rounding explains."""
    if value < last - SLACK * abs(last):
        warnings.warn(f"the bound fell from {last} to {value}", stacklevel=3)
    return value


def bound_is_due(step: int, done: bool, max_iterations: int) -> bool:
    return step == 1 or step % BOUND_EVERY == 0 or done or step == max_iterations


def converge(scores: Scores, alpha: np.ndarray, prior: float, tolerance: float, max_iterations: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Coordinate ascent until no mean moves by the tolerance: (alpha, phi, iterations)."""
    e, last, mean = expected_log(alpha), -np.inf, alpha / alpha.sum()
    phi = np.empty(0)
    for step in range(1, max_iterations + 1):
        phi = responsibilities(scores, e)
        alpha = updated_alpha(scores, phi, prior)
        e = expected_log(alpha)
        now = alpha / alpha.sum()
        done = np.abs(now - mean).max(initial=0) < tolerance
        mean = now
        if bound_is_due(step, done, max_iterations):
            last = checked_bound(bound(scores, phi, alpha, prior), last)
        if done:
            break
    return alpha, phi, step


@dataclass
class Estimate:
    """Kept species (numbers into the sample's list) and what is known of each; empty if none."""

    species: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    abundance: np.ndarray = field(default_factory=lambda: np.empty(0))
    alpha: np.ndarray | None = None
    below_detection: int = 0
    #: (read, species, phi) of the reported species, as shares of all survivors
    read: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    of: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    phi: np.ndarray = field(default_factory=lambda: np.empty(0))


def floor_of(n_reads: int, min_abundance: float) -> float:
    return max((10 if n_reads > 1000 else 1) / n_reads, min_abundance)


def _report(scores: Scores, names: np.ndarray, full: np.ndarray, phi: np.ndarray, min_abundance: float, alpha: np.ndarray | None) -> Estimate:
    """Renormalise, cut at the minimum (unless nothing is left), count reads without a reported species."""
    keep = np.nonzero(full >= min_abundance)[0] if min_abundance > 0 else np.arange(len(full))
    keep = keep if len(keep) else np.arange(len(full))
    mine = np.isin(scores.species, keep)
    held = np.bincount(scores.read, np.where(mine, phi, 0.0), len(scores.start) - 1)
    has = np.diff(scores.start) > 0
    live = mine & (phi > 0)
    return Estimate(names[keep], full[keep] / full[keep].sum(), None if alpha is None else alpha[keep], int(np.count_nonzero(has & (held == 0))), scores.read[live], names[scores.species[live]], phi[live])


def fit_vb(scores: Scores, min_abundance: float = 0.001, alpha_prior: float = 1.0, tolerance: float = 1e-7, max_iterations: int = 1000) -> Estimate:
    """Dirichlet-categorical mixture with rounds of pruning below the detection floor."""
    n_reads = len(scores.start) - 1
    if not n_reads:
        raise ValueError("no reads to estimate from")
    tau = floor_of(n_reads, min_abundance)
    names = np.unique(scores.species)
    if not len(names):
        return Estimate()
    all_scores, n_scored = scores, scores.n_scored
    scores, prior, alpha = scores.only(names), 0.0, None
    for prunes in range(MAX_PRUNES + 1):
        before, prior = prior, alpha_prior / len(names)
        alpha = np.full(len(names), prior + n_scored / len(names)) if alpha is None else prior + (alpha - before)
        alpha, phi, _ = converge(scores, alpha, prior, tolerance, max_iterations)
        mean = alpha / alpha.sum()
        keep = np.nonzero(mean >= tau)[0]
        keep = keep if len(keep) else np.array([int(mean.argmax())])
        if len(keep) == len(names):
            break
        if prunes == MAX_PRUNES:
            warnings.warn("species are still below the detection floor after the last round", stacklevel=2)
            break
        alpha, names = alpha[keep], names[keep]
        scores = scores.only(keep)
    estimate = _report(scores, names, mean, phi, min_abundance, alpha)
    # reads whose candidates were all pruned have no entries any more
    lost = np.count_nonzero((np.diff(all_scores.start) > 0) & (np.diff(scores.start) == 0))
    estimate.below_detection += int(lost)
    return estimate


def em_round(scores: Scores | Spread, freq: np.ndarray) -> Steps:
    """Updated frequencies and the log likelihood of the old ones."""
    got = yield Ask(lambda x: np.append(*x.em_sums(freq)), scores.n_species + 1)
    column = got[:-1]
    return column / max(column.sum(), 1e-300), float(got[-1])


def em_inner(scores: Scores | Spread, freq: np.ndarray, iterations: int = EM_INNER, change: float = EM_CHANGE) -> Steps:
    for _ in range(iterations):
        new, _ = yield from em_round(scores, freq)
        moved, freq = np.abs(new - freq).sum(), new
        if moved < change:
            break
    return freq


def em_course(scores: Scores | Spread, min_abundance: float, gain: float, n_start: int | None) -> Steps:
    """Frequencies of the species that survive the floor, and of those that are reported.

    Inner loops are repeated until the likelihood gains less than ``gain``; then the
    cut at the floor and, if it is higher and leaves any, at the minimum, each refitted.
    """
    if not scores.n_reads:
        raise ValueError("no reads to estimate from")
    freq, last = np.full(scores.n_species, 1 / (n_start or max(scores.n_species, 1))), -np.inf
    while scores.n_scored:
        freq = yield from em_inner(scores, freq)
        _, value = yield from em_round(scores, freq)
        if value < last - SLACK * abs(last):
            raise ValueError("the log likelihood fell")
        if value - last < gain:
            break
        last = value

    def cut(least: float) -> Steps:
        kept = np.where(freq >= least, freq, 0.0)
        return (yield from em_inner(scores, kept / kept.sum())) if kept.any() else kept

    least = (10 if scores.n_reads > 1000 else 1) / scores.n_reads
    freq = yield from cut(least)
    tighter = (yield from cut(min_abundance)) if min_abundance > least and freq.any() else freq
    return freq, tighter if tighter.any() else freq


def em_frequencies(scores: Scores, min_abundance: float, gain: float, n_start: int | None) -> tuple[np.ndarray, np.ndarray]:
    """``em_course`` of one sample in memory."""
    return alone(em_course(scores, min_abundance, gain, n_start), scores)


def fit_em(scores: Scores, min_abundance: float = 0.001, gain: float = 1e-4, n_start: int | None = None) -> Estimate:
    """Expectation-maximisation of one sample in memory; reads are shared out among all survivors of the floor."""
    full, freq = em_frequencies(scores, min_abundance, gain, n_start)
    has = np.diff(scores.start) > 0
    names, reported = np.nonzero(full > 0)[0], np.nonzero(freq > 0)[0]
    if not len(names):
        return Estimate(below_detection=int(has.sum()))
    alive = scores.only(names)
    phi = responsibilities(alive, np.log(full[names]))
    live = np.isin(names[alive.species], reported) & (phi > 0)
    below = np.count_nonzero(has & (np.diff(scores.only(reported).start) == 0))
    return Estimate(reported, freq[reported] / freq[reported].sum(), None, int(below), alive.read[live], names[alive.species[live]], phi[live])


def table_rows(tax_ids: np.ndarray, rows: dict[int, int] | None) -> np.ndarray:
    """A number for each species; those of one output row share it."""
    row = np.array([rows.get(int(t), -i - 1) if rows else i for i, t in enumerate(tax_ids)], np.int64)
    return np.unique(row, return_inverse=True)[1]


def summed_reads(read: np.ndarray, of: np.ndarray, phi: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected and shared reads of each species, from responsibilities of reported ones.

    What a read gives to species that are not reported counts for nobody; only whether
    it is split is judged by its shares among the reported ones.
    """
    if not len(read):
        return np.zeros(len(row)), np.zeros(len(row))
    even = phi / np.bincount(read, phi)[read]
    _, key = np.unique(read * (row.max() + 1) + row[of], return_inverse=True)
    share = np.bincount(key, even)[key]
    return np.bincount(of, phi, len(row)), np.bincount(of, np.where(share <= 0.99, phi, 0.0), len(row))


def frames_of(estimate: Estimate, sample: str, tax_ids: np.ndarray, rows: dict | None) -> pd.DataFrame:
    """A row per reported species with its expected and shared reads."""
    expected, shared = summed_reads(estimate.read, estimate.of, estimate.phi, table_rows(tax_ids, rows))
    s = estimate.species
    alpha = np.full(len(s), np.nan) if estimate.alpha is None else estimate.alpha
    return pd.DataFrame({"sample": sample, "tax_id": tax_ids[s], "abundance": estimate.abundance, "expected_reads": expected[s], "shared_reads": shared[s], "alpha": alpha, "below_detection": estimate.below_detection})


ESTIMATE_SCHEMA = "sample string, tax_id long, abundance double, expected_reads double, shared_reads double, alpha double, below_detection long"


def estimate_abundances(read_scores: DataFrame, estimator: str = "vb", row_keys: DataFrame | None = None, one_task: int = ONE_TASK, stored: bool = False, **options) -> DataFrame:
    """A row per sample and reported species, and one with a null tax_id if none is reported.

    ``row_keys`` (tax_id, row_key) says which species share a row of the output
    table; reads split only within a row do not count as shared. Samples of more
    than ``one_task`` scores stay spread over the cluster; they are estimated when this
    is called and their reported species, a row each, are then held by the driver.
    ``stored``: the scores are a written table already, else they are written once.
    """
    if estimator not in ("vb", "em"):
        raise ValueError("estimator must be 'vb' or 'em'")
    fit: Callable[..., Estimate] = fit_vb if estimator == "vb" else fit_em
    scores = read_scores.select("sample", "read", "tax_id", "log_score")
    scores = scores if stored else written(scores, "read-scores")
    large = [r.sample for r in scores.groupBy("sample").agg(F.count("*").alias("n")).where(F.col("n") > one_task).select("sample").collect()]
    keys = None if row_keys is None else row_keys.select("tax_id", F.col("row_key").cast("long").alias("row_key"))

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        tax_ids, species = np.unique(pdf["tax_id"].to_numpy(np.int64), return_inverse=True)
        read = pd.factorize(pdf["read"], sort=True)[0]
        held = Scores.of(read, species, pdf["log_score"].to_numpy(float), len(tax_ids), int(read.max()) + 1)
        known = pdf.dropna(subset=["row_key"]).drop_duplicates("tax_id")
        rows = {int(t): int(k) for t, k in zip(known["tax_id"], known["row_key"], strict=True)}
        estimate = fit(held, **options)
        out = frames_of(estimate, str(pdf["sample"].iloc[0]), tax_ids, rows)
        if not len(out):
            out = pd.DataFrame([{"sample": str(pdf["sample"].iloc[0]), "below_detection": estimate.below_detection}])
        return out.reindex(columns=[c.split()[0] for c in ESTIMATE_SCHEMA.split(", ")]).astype({"tax_id": "Int64"})

    small = scores.where(~F.col("sample").isin(large)) if large else scores
    small = small.withColumn("row_key", F.lit(None).cast("long")) if keys is None else small.join(keys, "tax_id", "left").select(*scores.columns, "row_key")
    out = small.groupBy("sample").applyInPandas(kernel, ESTIMATE_SCHEMA)
    if large:
        blocks = read_blocks(scores.where(F.col("sample").isin(large)))
        known = None if keys is None else {r.tax_id: r.row_key for r in keys.join(blocks.select(F.explode("tax_ids").alias("tax_id")).distinct(), "tax_id", "left_semi").where("row_key IS NOT NULL").collect()}
        found = together(blocks, large, lambda spread: spread_rows(spread, estimator, known, options))
        out = out.unionByName(read_scores.sparkSession.createDataFrame(found, ESTIMATE_SCHEMA))
    return out


# -- samples that stay spread over the cluster --------------------------------

BLOCKS = "sample string, start array<long>, tax_ids array<long>, score array<double>"


def read_blocks(scores: DataFrame) -> DataFrame:
    """Rows of some thousand reads of one sample as flat arrays, in a table of the shared folder by sample; ``scores`` is written, as it is counted first."""
    reads = dealt(scores, scores.count(), "sample", "read").groupBy("sample", "read").agg(F.collect_list(F.struct("tax_id", "log_score")).alias("hits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            names, which = np.unique(got.column("sample").to_numpy(zero_copy_only=False), return_inverse=True)
            out: dict[str, list] = {"sample": names.tolist(), "start": [], "tax_ids": [], "score": []}
            for k in range(len(names)):
                hits = got.column("hits").take(pa.array(np.nonzero(which == k)[0]))
                read, flat = np.repeat(np.arange(len(hits)), np.diff(hits.offsets.to_numpy())), hits.flatten()
                held = Scores.of(read, flat.field("tax_id").to_numpy(), flat.field("log_score").to_numpy(zero_copy_only=False), 0, len(hits))
                out["start"].append(held.start)
                out["tax_ids"].append(held.species)
                out["score"].append(held.score)
            yield pa.RecordBatch.from_arrays([pa.array(out["sample"], pa.string()), pa.array(out["start"], pa.list_(pa.int64())), pa.array(out["tax_ids"], pa.list_(pa.int64())), pa.array(out["score"], pa.list_(pa.float64()))], names=list(out))

    path = shared_folder(scores.sparkSession, "read-blocks")
    reads.mapInArrow(pack, BLOCKS).write.partitionBy("sample").parquet(path)
    return scores.sparkSession.read.schema(BLOCKS).parquet(path)


@dataclass
class Spread:
    """A sample whose reads stay in blocks; sums over them are asked for."""

    sample: str
    tax_ids: np.ndarray
    n_reads: int = 0
    n_scored: int = 0

    @property
    def n_species(self) -> int:
        return len(self.tax_ids)

    def phi_sums(self, weight: np.ndarray) -> Steps:
        return (yield Ask(lambda x: np.bincount(x.species, responsibilities(x, weight), x.n_species), self.n_species))

    def bound_of_reads(self, weight: np.ndarray, e: np.ndarray) -> Steps:
        got = yield Ask(lambda x: np.array([bound_of_reads(x, responsibilities(x, weight), e)]), 1)
        return float(got[0])

    def summary(self, weight: np.ndarray, reported: np.ndarray, row: np.ndarray, by_candidate: bool) -> Steps:
        """Expected and shared reads of each species and the number of scored reads without a reported one.

        ``by_candidate``: a reported candidate is enough; else the read must give it a share.
        """

        def of(x: Scores) -> np.ndarray:
            phi, read = responsibilities(x, weight), x.read
            mine = np.isin(x.species, reported)
            live = mine & (phi > 0)
            held = np.bincount(read[mine], None if by_candidate else phi[mine], x.n_reads)
            below = np.count_nonzero((np.diff(x.start) > 0) & (held == 0))
            return np.concatenate((*summed_reads(read[live], x.species[live], phi[live], row), [below]))

        n = self.n_species
        got = yield Ask(of, 2 * n + 1)
        return got[:n], got[n : 2 * n], round(got[-1])


def sums_of(blocks: DataFrame, asks: dict[str, tuple[Spread, Ask]]) -> dict[str, np.ndarray]:
    """What is asked for, of all samples in one job; a task sends one number a sample and slot."""
    wanted = {k: (spread.tax_ids, ask.of, ask.size) for k, (spread, ask) in asks.items()}

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for got in batches:
            for i, sample in enumerate(got.column("sample").to_pylist()):
                if sample in wanted:
                    tax_ids, of, size = wanted[sample]
                    start, species, score = (got.column(c)[i].values.to_numpy() for c in ("start", "tax_ids", "score"))
                    value = of(Scores(start, np.searchsorted(tax_ids, species), score, len(tax_ids)))
                    totals[sample] = totals.get(sample, np.zeros(size)) + value
        for sample, total in totals.items():
            slots = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array([sample] * len(slots), pa.string()), pa.array(slots, pa.int64()), pa.array(total[slots])], names=["sample", "slot", "x"])

    out = {k: np.zeros(ask.size) for k, (_, ask) in asks.items()}
    summed = blocks.mapInArrow(part, "sample string, slot long, x double").groupBy("sample", "slot").agg(F.sum("x").alias("x"))
    got = summed.toArrow()  # columns, as there is a number a sample and species in every iteration
    key = got.column("sample").combine_chunks().dictionary_encode()
    order = np.argsort(key.indices.to_numpy(), kind="stable")
    code, slot, x = (c.to_numpy()[order] for c in (key.indices, got.column("slot"), got.column("x")))
    for i, sample in enumerate(key.dictionary.to_pylist()):
        mine = slice(*np.searchsorted(code, [i, i + 1]))
        out[sample][slot[mine]] = x[mine]
    return out


def together(blocks: DataFrame, samples: list[str], of: Callable[[Spread], Steps]) -> list[tuple]:
    """The rows that ``of`` gives for each sample; all samples of a wave take each step in the same job.

    The number of jobs is that of the sample with most steps. When half of the samples
    are done, the blocks of the others are picked out.
    """
    rows: list[tuple] = []
    for lo in range(0, len(samples), TOGETHER):
        wave = sorted(samples)[lo : lo + TOGETHER]
        now = blocks.where(F.col("sample").isin(wave)).persist()
        species: dict[str, list[int]] = {k: [] for k in wave}
        for r in now.select("sample", F.explode("tax_ids").alias("t")).distinct().collect():
            species[r.sample].append(r.t)
        spreads = {k: Spread(k, np.array(sorted(v), np.int64)) for k, v in species.items()}
        count = Ask(lambda x: np.array([x.n_reads, x.n_scored], float), 2)
        for k, got in sums_of(now, {k: (x, count) for k, x in spreads.items()}).items():
            spreads[k].n_reads, spreads[k].n_scored = int(got[0]), int(got[1])
        steps, answers, held = {k: of(x) for k, x in spreads.items()}, dict.fromkeys(wave), len(wave)
        while steps:
            asks = {}
            for k in list(steps):
                try:
                    asks[k] = (spreads[k], steps[k].send(answers[k]))
                except StopIteration as end:
                    rows += end.value
                    del steps[k]
            if steps and 2 * len(steps) <= held:
                now.unpersist()
                now, held = blocks.where(F.col("sample").isin(sorted(steps))).persist(), len(steps)
            answers = sums_of(now, asks) if asks else {}
        now.unpersist()
    return rows


def vb_spread(scores: Spread, min_abundance: float = 0.001, alpha_prior: float = 1.0, tolerance: float = 1e-7, max_iterations: int = 1000) -> Steps:
    """As ``fit_vb``: live species, their means, alpha, and all log weights of the last step."""
    tau = floor_of(scores.n_reads, min_abundance)
    names, prior, alpha, mean, weight = np.arange(scores.n_species), 0.0, None, np.empty(0), np.empty(0)
    for prunes in range(MAX_PRUNES + 1 if len(names) else 0):
        before, prior = prior, alpha_prior / len(names)
        alpha = np.full(len(names), prior + scores.n_scored / len(names)) if alpha is None else prior + (alpha - before)
        mean, value = alpha / alpha.sum(), -np.inf
        for step in range(1, max_iterations + 1):
            weight = np.full(scores.n_species, -np.inf)
            weight[names] = expected_log(alpha)
            alpha = prior + (yield from scores.phi_sums(weight))[names]
            last, mean = mean, alpha / alpha.sum()
            done = np.abs(mean - last).max() < tolerance
            if bound_is_due(step, done, max_iterations):
                e = np.zeros(scores.n_species)
                e[names] = expected_log(alpha)
                value = checked_bound((yield from scores.bound_of_reads(weight, e)) + bound_of_weights(alpha, prior), value)
            if done:
                break
        keep = np.nonzero(mean >= tau)[0]
        keep = keep if len(keep) else np.array([int(mean.argmax())])
        if len(keep) == len(names):
            break
        if prunes == MAX_PRUNES:
            warnings.warn("species are still below the detection floor after the last round", stacklevel=2)
            break
        alpha, names = alpha[keep], names[keep]
    return names, mean, alpha, weight


def spread_rows(scores: Spread, estimator: str, known: dict[int, int] | None, options: dict) -> Steps:
    """The rows of ``ESTIMATE_SCHEMA`` of one spread sample."""
    if estimator == "vb":
        names, full, alpha, weight = yield from vb_spread(scores, **options)
        least = options.get("min_abundance", 0.001)
        keep = np.nonzero(full >= least)[0]
        keep = keep if len(keep) else np.arange(len(full))
    else:
        survivors, freq = yield from em_course(scores, options.get("min_abundance", 0.001), options.get("gain", 1e-4), options.get("n_start"))
        names, alpha = np.nonzero(freq > 0)[0], None
        full, keep = freq[names], np.arange(len(names))
        with np.errstate(divide="ignore"):
            weight = np.log(survivors)
    if not len(keep):
        return [(scores.sample, None, None, None, None, None, scores.n_scored)]
    reported = names[keep]
    expected, shared, below = yield from scores.summary(weight, reported, table_rows(scores.tax_ids, known), estimator == "em")
    abundance = full[keep] / full[keep].sum()
    return [(scores.sample, int(scores.tax_ids[s]), float(a), float(expected[s]), float(shared[s]), None if alpha is None else float(alpha[k]), below) for s, a, k in zip(reported, abundance, keep, strict=True)]


def fit_vb_distributed(read_scores: DataFrame, **options) -> DataFrame:
    """The variational estimator with every sample spread over tasks: sample, tax_id, abundance, alpha."""
    return estimate_abundances(read_scores, one_task=0, **options).where("tax_id IS NOT NULL").select("sample", "tax_id", "abundance", "alpha")


def em_rounds(read_scores: DataFrame, rounds: int) -> DataFrame:
    """Frequencies after a fixed number of rounds from even ones, every sample spread over tasks."""
    blocks = read_blocks(written(read_scores, "read-scores"))

    def frequencies(scores: Spread) -> Steps:
        freq = yield from em_inner(scores, np.full(scores.n_species, 1 / scores.n_species), rounds, 0.0)
        return [(scores.sample, int(t), float(f)) for t, f in zip(scores.tax_ids, freq, strict=True)]

    out = together(blocks, [r.sample for r in blocks.select("sample").distinct().collect()], frequencies)
    return read_scores.sparkSession.createDataFrame(out, "sample string, tax_id long, freq double")


# -- steps as DataFrame operations ------------------------------------------


def start_state(read_scores: DataFrame, alpha_prior: float = 1.0) -> DataFrame:
    """sample, tax_id, prior, alpha before the first variational step."""
    sizes = read_scores.groupBy("sample").agg(F.count_distinct("tax_id").alias("s"), F.count_distinct("read").alias("n"))
    species = read_scores.select("sample", "tax_id").distinct()
    return species.join(sizes, "sample").select("sample", "tax_id", (F.lit(alpha_prior) / F.col("s")).alias("prior"), ((F.lit(alpha_prior) + F.col("n")) / F.col("s")).alias("alpha"))


def vb_responsibilities(read_scores: DataFrame, state: DataFrame) -> DataFrame:
    """sample, read, tax_id, phi, log_score and the state's columns."""
    whole = state.groupBy("sample").agg(F.sum("alpha").alias("total"))
    e = state.join(whole, "sample").select("sample", "tax_id", "prior", "alpha", (digamma_column(F.col("alpha")) - digamma_column(F.col("total"))).alias("e"))
    by_read = Window.partitionBy("sample", "read")
    x = read_scores.join(e, ["sample", "tax_id"]).withColumn("x", F.col("log_score") + F.col("e"))
    y = x.withColumn("y", F.exp(F.col("x") - F.max("x").over(by_read)))
    return y.withColumn("phi", F.col("y") / F.sum("y").over(by_read)).select("sample", "read", "tax_id", "phi", "log_score", "prior", "alpha", "e")


def vb_step(read_scores: DataFrame, state: DataFrame) -> DataFrame:
    """One coordinate-ascent step: the state with a new alpha."""
    phi = vb_responsibilities(read_scores, state)
    return phi.groupBy("sample", "tax_id").agg(F.min("prior").alias("prior"), (F.min("prior") + F.sum("phi")).alias("alpha"))


def em_start(read_scores: DataFrame) -> DataFrame:
    sizes = read_scores.groupBy("sample").agg(F.count_distinct("tax_id").alias("s"))
    return read_scores.select("sample", "tax_id").distinct().join(sizes, "sample").select("sample", "tax_id", (F.lit(1.0) / F.col("s")).alias("freq"))


def em_step(read_scores: DataFrame, state: DataFrame) -> DataFrame:
    """One expectation and maximisation: sample, tax_id, freq."""
    by_read = Window.partitionBy("sample", "read")
    live = read_scores.join(state.where("freq > 0"), ["sample", "tax_id"]).withColumn("x", F.col("log_score") + F.log("freq"))
    y = live.withColumn("y", F.exp(F.col("x") - F.max("x").over(by_read)))
    phi = y.withColumn("phi", F.col("y") / F.sum("y").over(by_read))
    column = phi.groupBy("sample", "tax_id").agg(F.sum("phi").alias("c"))
    return column.withColumn("freq", F.col("c") / F.sum("c").over(Window.partitionBy("sample"))).drop("c")


def read_summary(phi: DataFrame, row_keys: DataFrame | None = None, most: float = 0.99) -> DataFrame:
    """Expected and shared reads of each reported species, relationally.

    ``phi``: sample, read, tax_id, phi of reported species. A read counts as shared
    for a species if the row it belongs to holds at most ``most`` of what the read
    gives to reported species.
    """
    keyed = phi.withColumn("row_key", F.col("tax_id")) if row_keys is None else phi.join(row_keys, "tax_id", "left").withColumn("row_key", F.coalesce("row_key", F.col("tax_id")))
    even = keyed.withColumn("even", F.col("phi") / F.sum("phi").over(Window.partitionBy("sample", "read")))
    share = F.sum("even").over(Window.partitionBy("sample", "read", "row_key"))
    return even.withColumn("share", share).groupBy("sample", "tax_id").agg(F.sum("phi").alias("expected_reads"), F.sum(F.when(F.col("share") <= most, F.col("phi")).otherwise(0.0)).alias("shared_reads"))


def evidence_bound(read_scores: DataFrame, state: DataFrame) -> DataFrame:
    """(sample, elbo) after one step from ``state``: old responsibilities with the new alpha."""
    phi = vb_responsibilities(read_scores, state).select("sample", "read", "tax_id", "phi", "log_score")
    new = phi.groupBy("sample", "tax_id").agg(F.sum("phi").alias("phi")).join(state, ["sample", "tax_id"]).select("sample", "tax_id", "prior", (F.col("prior") + F.col("phi")).alias("alpha"))
    whole = new.groupBy("sample").agg(F.sum("alpha").alias("total"), F.count("*").alias("s"), F.min("prior").alias("p"), F.sum(log_gamma_column(F.col("alpha"))).alias("lg"))
    e = new.join(whole, "sample").withColumn("e", digamma_column(F.col("alpha")) - digamma_column(F.col("total")))
    reads = phi.where("phi > 0").join(e.select("sample", "tax_id", "e"), ["sample", "tax_id"]).groupBy("sample").agg(F.sum(F.col("phi") * (F.col("log_score") + F.col("e") - F.log("phi"))).alias("reads"))
    pull = e.groupBy("sample").agg(F.sum((F.col("prior") - F.col("alpha")) * F.col("e")).alias("pull"))
    gamma = log_gamma_column(F.col("p") * F.col("s")) - F.col("s") * log_gamma_column(F.col("p")) - log_gamma_column(F.col("total")) + F.col("lg")
    return whole.join(reads, "sample").join(pull, "sample").select("sample", (F.col("reads") + gamma + F.col("pull")).alias("elbo"))
