import math

import numpy as np
import pytest

from mixspark.functions.special import digamma
from mixspark.operators import estimate, graph
from mixspark.operators.estimate import Scores


def simulated(seed=0, n=900, s=8):
    rng = np.random.default_rng(seed)
    share = rng.dirichlet(np.ones(s) * 8)
    read, species, score = [], [], []
    for r in range(n):
        own = rng.choice(s, p=share)
        top = -40 + rng.normal(0, 2)
        read, species, score = [*read, r], [*species, own], [*score, top]
        for d in rng.choice(s, rng.integers(0, 3), replace=False):
            if d != own:
                read, species, score = [*read, r], [*species, int(d)], [*score, top - rng.exponential(3)]
    return np.array(read), np.array(species), np.array(score, float), s, n, share


def of(*case):
    return Scores.of(*case[:5])


def dense_vb(read, species, score, s, n, tolerance=1e-7, prior=1.0):
    table = np.full((n, s), -np.inf)
    np.maximum.at(table, (read, species), score)
    a0 = prior / s
    alpha = np.full(s, a0 + n / s)
    while True:
        x = table + digamma(alpha) - digamma(np.array([alpha.sum()]))
        phi = np.exp(x - x.max(axis=1, keepdims=True))
        phi /= phi.sum(axis=1, keepdims=True)
        new = a0 + phi.sum(axis=0)
        moved = np.abs(new / new.sum() - alpha / alpha.sum()).max()
        alpha = new
        if moved < tolerance:
            return alpha / alpha.sum()


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_sparse_equals_dense(seed):
    case = simulated(seed)
    got = estimate.fit_vb(of(*case), min_abundance=0.0)
    assert len(got.species) == 8 and np.abs(got.abundance - dense_vb(*case[:5])).max() < 1e-9


def test_proportions_come_back():
    case = simulated(3, 4000)
    for fit in (estimate.fit_vb, estimate.fit_em):
        got = fit(of(*case))
        full = np.zeros(8)
        full[got.species] = got.abundance
        assert np.abs(full - case[5]).max() < 0.03


def test_em_and_vb_agree():
    case = simulated(4, 4000)
    a, b = estimate.fit_vb(of(*case)), estimate.fit_em(of(*case))
    assert a.species.tolist() == b.species.tolist() and np.abs(a.abundance - b.abundance).max() < 2e-3


def test_three_paths(spark):
    case = simulated(5, 600)
    rows = [("s", f"r{r}", int(t), float(x)) for r, t, x in zip(*case[:3], strict=True)]
    frame = spark.createDataFrame(rows, "sample string, read string, tax_id long, log_score double")
    want = estimate.fit_vb(of(*case), min_abundance=0.0)
    grouped = {r.tax_id: r.abundance for r in estimate.estimate_abundances(frame, min_abundance=0.0).collect()}
    spread = {r.tax_id: r.abundance for r in estimate.fit_vb_distributed(frame, min_abundance=0.0).collect()}
    for t, x in zip(want.species, want.abundance, strict=True):
        assert abs(grouped[t] - x) < 1e-9 and abs(spread[t] - x) < 1e-9
    state = estimate.start_state(frame)
    step = {r.tax_id: r.alpha for r in estimate.vb_step(frame, state).collect()}
    scores = of(*case)
    alpha = np.full(8, 1 / 8 + 600 / 8)
    phi = estimate.responsibilities(scores, estimate.expected_log(alpha))
    assert np.allclose([step[t] for t in range(8)], estimate.updated_alpha(scores, phi, 1 / 8), atol=1e-9)
    bound = estimate.evidence_bound(frame, state).first().elbo
    assert abs(bound - estimate.bound(scores, phi, estimate.updated_alpha(scores, phi, 1 / 8), 1 / 8)) < 1e-6


@pytest.mark.parametrize("estimator", ["vb", "em"])
@pytest.mark.parametrize("least", [0.0, 0.001, 0.05])
def test_spread_sample_equals_one_task(spark, estimator, least):
    case = simulated(7, 1200, 12)
    rows = [("s", f"r{r}", int(t) + 40, float(x)) for r, t, x in zip(*case[:3], strict=True)]
    rows += [("s", "r1", 41, -90.0), ("s", "none", 42, float("-inf")), ("s", "odd", 99, -7.0), ("small", "a", 41, -1.0)]
    frame = spark.createDataFrame(rows, "sample string, read string, tax_id long, log_score double")
    keys = spark.createDataFrame([(40, 1), (41, 1), (42, 2)], "tax_id long, row_key long")
    one = estimate.estimate_abundances(frame, estimator, keys, min_abundance=least).collect()
    spread = estimate.estimate_abundances(frame, estimator, keys, one_task=1, min_abundance=least).collect()
    want, got = ({(r.sample, r.tax_id): r for r in x} for x in (one, spread))
    assert want.keys() == got.keys() and len(one) == len(want) == len(spread)
    for k, w in want.items():
        assert got[k].below_detection == w.below_detection
        for c in ("abundance", "expected_reads", "shared_reads", "alpha"):
            a, b = w[c], got[k][c]
            assert (b is None or math.isnan(b)) if a is None or math.isnan(a) else abs(a - b) < 1e-6


def test_spread_sample_without_a_species(spark):
    rows = [("s", f"r{t}-{k}", t, -1.0) for t in range(300) for k in range(4)]
    frame = spark.createDataFrame(rows, "sample string, read string, tax_id long, log_score double")
    one, spread = (estimate.estimate_abundances(frame, "em", one_task=n).collect() for n in (10_000, 10))
    assert [(r.tax_id, r.below_detection) for r in one] == [(r.tax_id, r.below_detection) for r in spread] == [(None, 1200)]


def certain(counts):
    species = np.repeat(np.array(list(counts)), list(counts.values()))
    n = len(species)
    return Scores.of(np.arange(n), species, np.full(n, -1.0), max(counts) + 1, n)


def test_floor_and_below_detection():
    got = estimate.fit_vb(certain({1: 2000, 2: 5}))
    assert got.species.tolist() == [1] and got.below_detection == 5
    got = estimate.fit_em(certain({1: 2000, 2: 984, 4: 15, 3: 1}))
    assert got.species.tolist() == [1, 2, 4] and got.below_detection == 1
    assert estimate.floor_of(1000, 0) == 1 / 1000 and estimate.floor_of(1001, 0) == 10 / 1001


def test_nothing_clears_the_floor():
    got = estimate.fit_vb(certain({0: 2, 1: 2}), min_abundance=0.9)
    assert len(got.species) == 1 and got.below_detection == 2
    many = certain(dict.fromkeys(range(300), 4))
    got = estimate.fit_em(many)
    assert not len(got.species) and got.below_detection == 1200


def test_best_of_repeats_and_missing_scores():
    scores = Scores.of(np.array([0, 0, 1, 2]), np.array([0, 0, 1, 0]), np.array([-3.0, -1.0, -2.0, -np.inf]), 2, 4)
    assert scores.score.tolist() == [-1.0, -2.0] and scores.n_scored == 2 and np.diff(scores.start).tolist() == [1, 1, 0, 0]


def test_no_reads():
    with pytest.raises(ValueError):
        estimate.fit_vb(Scores(np.array([0]), np.empty(0, int), np.empty(0), 0))


def test_summary_by_hand(spark):
    phi = [("s", "a", 10, 1.0), ("s", "b", 10, 0.6), ("s", "b", 20, 0.4), ("s", "c", 10, 0.995), ("s", "c", 20, 0.005)]
    got = {r.tax_id: r for r in estimate.read_summary(spark.createDataFrame(phi, "sample string, read string, tax_id long, phi double")).collect()}
    assert got[10].expected_reads == pytest.approx(2.595) and got[10].shared_reads == pytest.approx(0.6)
    assert got[20].expected_reads == pytest.approx(0.405) and got[20].shared_reads == pytest.approx(0.405)
    keys = spark.createDataFrame([(10, 1), (20, 1)], "tax_id long, row_key long")
    got = estimate.read_summary(spark.createDataFrame(phi, "sample string, read string, tax_id long, phi double"), keys).collect()
    assert all(r.shared_reads == 0 for r in got)


def by_hand():
    """Three reads over species 10, 20 and 30 at frequencies 0.6, 0.3 and 0.1; 30 is not reported."""
    candidates, freq = [(10, 30), (10,), (10, 20)], {10: 0.6, 20: 0.3, 30: 0.1}
    phi = [("s", str(r), t, freq[t] / sum(freq[x] for x in own)) for r, own in enumerate(candidates) for t in own]
    want = {10: (0.6 / 0.7 + 1 + 0.6 / 0.9, 0.6 / 0.9), 20: (0.3 / 0.9, 0.3 / 0.9)}  # the first read is split with 30 alone
    return phi, want


def test_what_goes_to_dropped_species_counts_for_nobody(spark):
    phi, want = by_hand()
    mine = [p for p in phi if p[2] != 30]
    got = estimate.read_summary(spark.createDataFrame(mine, "sample string, read string, tax_id long, phi double")).collect()
    assert {r.tax_id for r in got} == {10, 20} and all((r.expected_reads, r.shared_reads) == pytest.approx(want[r.tax_id]) for r in got)
    read, of_ = np.array([int(p[1]) for p in mine]), np.array([{10: 0, 20: 1}[p[2]] for p in mine])
    expected, shared = estimate.summed_reads(read, of_, np.array([p[3] for p in mine]), np.arange(2))
    assert list(zip(expected, shared, strict=True)) == [pytest.approx(want[t]) for t in (10, 20)]


def test_em_shares_reads_out_among_survivors():
    """600 reads of shares 0.53, 0.43 and 0.04, the last below the minimum: its part of split reads is lost to the others."""
    reads = [(0,)] * 306 + [(0, 2)] * 24 + [(1,)] * 258 + [(2,)] * 12
    read = np.array([r for r, own in enumerate(reads) for _ in own])
    species = np.array([t for own in reads for t in own])
    scores = Scores.of(read, species, np.full(len(read), -1.0), 3, len(reads))
    full, freq = estimate.em_frequencies(scores, 0.05, 1e-9, None)
    assert (full > 0).tolist() == [True, True, True] and (freq > 0).tolist() == [True, True, False]
    got = estimate.fit_em(scores, 0.05, 1e-9)
    expected, shared = estimate.summed_reads(got.read, got.of, got.phi, np.arange(3))
    assert expected[:2] == pytest.approx([306 + 24 * full[0] / (full[0] + full[2]), 258]) and shared.sum() == 0
    assert expected[0] < 330 and got.below_detection == 12


def test_spread_bound_warns_as_the_other(spark, monkeypatch):
    """Both routes look at the bound on the same steps."""
    case, seen = simulated(8, 300), {"one": [], "spread": []}
    frame = spark.createDataFrame([("s", f"r{r}", int(t), float(x)) for r, t, x in zip(*case[:3], strict=True)], "sample string, read string, tax_id long, log_score double")
    original = estimate.checked_bound
    for route in seen:
        monkeypatch.setattr(estimate, "checked_bound", lambda value, last, route=route: seen[route].append(value) or original(value, last))
        if route == "one":
            estimate.fit_vb(of(*case), min_abundance=0.0)
        else:
            estimate.estimate_abundances(frame, one_task=0, min_abundance=0.0).collect()
    assert len(seen["one"]) == len(seen["spread"]) > 1 and np.allclose(seen["one"], seen["spread"], rtol=1e-9)


def test_bound_rises():
    scores = of(*simulated(6))
    alpha, values = np.full(8, 1 / 8 + 900 / 8), []
    for _ in range(12):
        phi = estimate.responsibilities(scores, estimate.expected_log(alpha))
        alpha = estimate.updated_alpha(scores, phi, 1 / 8)
        values.append(estimate.bound(scores, phi, alpha, 1 / 8))
    assert all(b >= a - 1e-9 * abs(a) for a, b in zip(values, values[1:], strict=False)) and math.isfinite(values[-1])


def test_jobs_do_not_grow_with_the_number_of_large_samples(spark):
    """The same sample once and seven times takes the same number of jobs and gives the same numbers."""
    rng = np.random.default_rng(8)
    one = [(f"r{i}", int(t), float(-rng.random() * 9)) for i in range(300) for t in rng.choice(12, 3, replace=False)]

    def run(samples, group, **options):
        frame = spark.createDataFrame([(s, *r) for s in samples for r in one], "sample string, read string, tax_id long, log_score double")
        spark.sparkContext.setJobGroup(group, group)
        try:
            out = estimate.estimate_abundances(frame, one_task=0, **options).collect()
            return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    for k, options in enumerate(({"estimator": "em"}, {"tolerance": 1e-4})):
        alone, jobs = run(["a"], f"one-{k}", **options)
        seven, more = run([f"s{i}" for i in range(7)], f"seven-{k}", **options)
        assert jobs == more > 5
        for i in range(7):
            got = {r.tax_id: r for r in seven if r.sample == f"s{i}"}
            assert got.keys() == {r.tax_id for r in alone}
            assert all(abs(got[r.tax_id].abundance - r.abundance) < 1e-12 and got[r.tax_id].below_detection == r.below_detection for r in alone)


def test_samples_that_end_early_are_left_out(spark):
    """Samples of different length of the course: the blocks of those that go on are picked out."""
    rng = np.random.default_rng(9)
    rows = [("short", f"r{i}", 1, -1.0) for i in range(40)] + [("lone", "r", 5, -2.0)]
    rows += [("long", f"r{i}", int(t), float(-rng.random())) for i in range(200) for t in rng.choice(9, 4, replace=False)]
    frame = spark.createDataFrame(rows, "sample string, read string, tax_id long, log_score double")
    for name in ("vb", "em"):
        spread = {(r.sample, r.tax_id): r for r in estimate.estimate_abundances(frame, name, one_task=0).collect()}
        small = {(r.sample, r.tax_id): r for r in estimate.estimate_abundances(frame, name).collect()}
        assert spread.keys() == small.keys()
        assert all(abs(spread[k].abundance - small[k].abundance) < 1e-6 and spread[k].below_detection == small[k].below_detection for k in small)


def test_partitions_of_blocks_grow_with_the_scores(spark, monkeypatch):
    """Blocks are written by as many tasks as the scores need; estimates stay the same."""
    rows = [(s, f"r{i}", t, -float((i * t) % 5)) for s in ("a", "b") for i in range(200) for t in (1, 2, 3)]
    scores = spark.createDataFrame(rows, "sample string, read string, tax_id long, log_score double").cache()
    files = lambda df: len(df.inputFiles())
    want = {(r.sample, r.tax_id): r.abundance for r in estimate.fit_vb_distributed(scores).collect()}
    few = files(estimate.read_blocks(scores))
    monkeypatch.setattr(graph, "ROWS", 100)
    assert files(estimate.read_blocks(scores)) > max(few, 8)
    assert {(r.sample, r.tax_id): r.abundance for r in estimate.fit_vb_distributed(scores).collect()} == pytest.approx(want, abs=1e-9)


def test_sums_come_as_columns(spark, monkeypatch):
    """What is summed is not made into rows on the driver, and each sample gets its own."""
    rows = [(s, f"r{i}", t, 0.0) for s, n in (("b", 30), ("a", 20)) for i in range(n) for t in (3, 5 + i % 2)]
    blocks = estimate.read_blocks(spark.createDataFrame(rows, "sample string, read string, tax_id long, log_score double"))
    spreads = {"a": estimate.Spread("a", np.array([3, 5, 6])), "b": estimate.Spread("b", np.array([3, 5, 6])), "none": estimate.Spread("none", np.array([3]))}
    ask = estimate.Ask(lambda x: np.bincount(x.species, minlength=3).astype(float), 3)
    monkeypatch.setattr(type(blocks), "collect", lambda self: pytest.fail("rows were collected"))
    got = estimate.sums_of(blocks, {k: (v, ask) for k, v in spreads.items()})
    assert {k: v.tolist() for k, v in got.items()} == {"a": [20, 10, 10], "b": [30, 15, 15], "none": [0, 0, 0]}
