import itertools
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from mixspark.llm import quality, shard, topk, toxicity
from tests.llm import brute
from tests.llm.data import corpus, prose, table


def test_top_k(spark):
    rng = random.Random(0)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.9]) * rng.random() for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(150)] + [(2000, [1.0, 2.0]), (2020, [2.0, 1.0]), (2040, None), (2060, [None, 1.0]), (2080, [float("nan")] * 6), (2100, [float("inf")] * 6), (2120, []), (None, [0.1] * 6)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 20).collect()
    assert sorted(map(tuple, got)) == brute.top(rows, 20, 20)


def test_top_k_beyond_doubles(spark):
    rows = [(i, [1e7 + i, 3e7 - i]) for i in range(0, 60)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 20).collect()
    assert sorted(map(tuple, got)) == brute.top(rows, 5, 20)


def test_products_are_exact():
    a = np.array([[2.0**40 + 1, 3.0]])
    assert topk.products(a, np.array([[1024.0, 1.0]]))[0, 0] == (2**40 + 1) * 1024 + 3


def test_hilbert_neighbours_touch(spark):
    cells = spark.range(512).select(*[F.expr(f"int((id div {8**k}) % 8)").alias(c) for k, c in enumerate("abc")])
    got = cells.withColumn("h", shard.hilbert_index([F.col(c) for c in "abc"], 3)).orderBy("h").toPandas()
    assert got.h.tolist() == list(range(512))
    assert (np.abs(np.diff(got[["a", "b", "c"]].to_numpy(), axis=0)).sum(axis=1) == 1).all()


def test_shards(spark):
    docs = corpus(4) | {5000: None}
    got = shard.document_shards(table(spark, docs), 24).toPandas()
    assert len(got) == len(docs)
    sizes = got.groupby("shard").slot.agg(["min", "max", "count"])
    assert (sizes["min"] == 0).all() and (sizes["max"] + 1 == sizes["count"]).all() and sizes["count"].max() - sizes["count"].min() <= 1
    for r in got.itertuples():
        raw = (docs[r.doc_id] or "").encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)


def hilbert(axes, bits):
    """Index on the curve by turning the cube level by level, from the coarsest bit down."""
    x, n = list(axes), len(axes)
    for q in range(bits - 1, 0, -1):
        for i in range(n):
            low = (1 << q) - 1
            if x[i] >> q & 1:
                x[0] ^= low
            else:
                t = (x[0] ^ x[i]) & low
                x[0] ^= t
                x[i] ^= t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = 0
    for q in range(bits - 1, 0, -1):
        if x[-1] >> q & 1:
            t ^= (1 << q) - 1
    x = [v ^ t for v in x]
    return int("".join(str(v >> q & 1) for q in range(bits - 1, -1, -1) for v in x), 2)


def test_the_plain_curve_has_no_jumps():
    for n, bits in ((2, 3), (3, 2)):
        order = sorted(itertools.product(range(1 << bits), repeat=n), key=lambda a: hilbert(a, bits))
        assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in itertools.pairwise(order))


def test_rows_stand_in_curve_order(spark):
    """Slots against a plain sort by the curve; levels against exact quantiles of whole strings that begin alike."""
    rng = random.Random(11)
    rows = [(i, "x", rng.choice(["en", "de", "fr", None]), f"https://common.example/{rng.choice('abcdefgh')}", rng.randrange(5000)) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    dims = {"lang": F.col("lang"), "source": F.col("source"), "n_chars": F.col("n_chars").cast("double")}
    levelled = {r.doc_id: (r.level_0, r.level_1, r.level_2) for r in shard.quantised(frame, dims).collect()}
    for k in (2, 3):  # source: whole strings; lang: nulls lowest
        values = sorted(r[k] for r in rows if r[k] is not None)
        total, cuts = len(values), set()
        for v in sorted(set(values)):
            below, upto = sum(x < v for x in values), sum(x <= v for x in values)
            if upto * 16 // total > below * 16 // total and upto < total:
                cuts.add(v)
        for r in rows:
            assert levelled[r[0]][k - 2] == (0 if r[k] is None else sum(c < r[k] for c in cuts))
    assert len({levelled[r[0]][1] for r in rows}) == 8
    got = sorted((r.shard, r.slot, r.doc_id) for r in shard.document_shards(frame, 24).collect())
    curve = [hilbert(levelled[i], shard.BITS) for *_, i in got]
    assert curve == sorted(curve)
    for _, same in itertools.groupby(zip(curve, got, strict=True), key=lambda x: x[0]):
        ids = [i for _, (*_, i) in same]
        assert ids == sorted(ids)


def test_full_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(shard, "PIECE_ROWS", 7)
    got = shard.document_shards(table(spark, {i: "same" for i in range(500)}), 24).toPandas()
    assert sorted(got["shard"] * 1000 + got.slot) == [s * 1000 + k for s in range(24) for k in range((500 * (s + 1) + 23) // 24 - (500 * s + 23) // 24)]


def test_measures(spark):
    docs = corpus(5) | {900: "a b c a b c a b c d", 901: "x\nx\n \nx y", 902: "# a|b <c> $%&*", 903: None, 904: "a b a b a"}
    got = quality.document_measures(table(spark, docs)).collect()
    for r in got:
        want = brute.measures(docs[r.doc_id])
        assert {k: r[k] for k in want} == want, r.doc_id


def test_binomial_tail(spark):
    cases = [(0, 10, 0.1), (3, 10, 0.1), (10, 10, 0.1), (40, 2000, 0.02), (5, 90000, 0.001)]
    for k, n, p in cases:
        got = spark.range(1).select(quality.log_binomial_cdf(F.lit(k), F.lit(n), p)).first()[0]
        want = math.log(math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1)))
        assert abs(got - want) < 1e-8 * max(1, abs(want))


def test_binomial_tail_of_many_labels(spark):
    """Ten million rejections and more need no array of that length."""
    cases = [(10**7, 4 * 10**9, 0.003), (3 * 10**7 - 60_000, 10**10, 0.003), (10**7, 10**9, 0.003)]
    frame = spark.createDataFrame(cases, "k long, n long, p double")
    got = {(r.k, r.n): r.c for r in frame.select("k", "n", quality.log_binomial_cdf(F.col("k"), F.col("n"), 0.003).alias("c")).collect()}
    for k, n, p in cases:
        z = (k + 0.5 - n * p) / math.sqrt(n * p * (1 - p))
        want = 0.0 if k >= n * p else math.log(math.erfc(-z / math.sqrt(2)) / 2) if z > -30 else None
        assert got[k, n] < -1000 if want is None else abs(got[k, n] - want) < 0.02 * max(1, abs(want))


def test_thresholds_hold_the_risk(spark):
    rng = random.Random(7)
    good = {i: prose(rng, 80) for i in range(3000)}
    bad = {i: prose(rng, 60) + " ###" * 20 for i in range(3000, 3300)}
    labels = spark.createDataFrame([(i, 1) for i in good] + [(i, 0) for i in bad], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_verdicts(table(spark, good | bad), labels, risk=0.2).collect()}
    assert not any(got[i].kept for i in bad)
    assert sum(not got[i].kept for i in good) <= 0.2 * len(good)
    few = spark.createDataFrame([(i, 1) for i in list(good)[:5]], "doc_id long, quality int")
    assert all(r.kept for r in quality.quality_verdicts(table(spark, good), few).collect())  # too few labels prove nothing


def test_settings_are_nested():
    for level in range(1, quality.LEVELS):
        assert all(quality.setting(level)[rule] <= cut for rule, cut in quality.setting(level - 1).items())
    assert all(quality.setting(0)[rule] == max(cuts) and quality.setting(quality.LEVELS - 1)[rule] == min(cuts) for rule, (_, cuts) in quality.RULES.items())


def test_rules_act_at_the_default_risk(spark):
    """300 good documents of a language prove a setting, 100 none; the walk stops where good ones would go."""
    rng = random.Random(17)
    clean = {i: prose(rng, 60) for i in range(300)}
    noisy = {i: prose(rng, 60) + " !!!" * (4 if i % 10 == 0 else 0) for i in range(300, 600)}  # a tenth holds many points
    rare = {i: prose(rng, 60) for i in range(600, 700)}
    junk = {i: prose(rng, 60) + " ###" * 60 for i in range(700, 730)}
    lang = lambda i: ("xx" if i < 300 else "yy" if i < 600 else "zz") if i < 700 else ("xx", "yy", "zz")[i % 3]
    docs = clean | noisy | rare | junk
    frame = spark.createDataFrame([(k, v, lang(k), "s", len(v)) for k, v in docs.items()], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < 700)) for i in docs], "doc_id long, quality int")
    measured = quality.document_measures(frame).withColumn("base_failed", F.lit(False))
    got = {r.stratum: r for r in quality.thresholds(measured, labels).collect()}
    assert set(got) == {"xx", "yy"} and got["xx"].n_good == got["yy"].n_good == 300
    plain = {r.doc_id: {rule: r[f"v_{rule}"] for rule in quality.RULES} for r in measured.select("doc_id", *[value().alias(f"v_{rule}") for rule, (value, _) in quality.RULES.items()]).collect()}
    out = lambda i, level: any(plain[i][rule] > cut for rule, cut in quality.setting(level).items())
    for stratum, held in (("xx", clean), ("yy", noisy)):
        best = None
        for level in range(quality.LEVELS):
            k = sum(out(i, level) for i in held)
            if math.fsum(math.comb(300, j) * 0.02**j * 0.98 ** (300 - j) for j in range(k + 1)) > 0.05 / 3:
                break
            best = (level, k)
        assert (got[stratum].level, got[stratum].n_rejected) == best
    assert got["yy"].level < quality.LEVELS - 1
    kept = {r.doc_id: r.kept for r in quality.quality_verdicts(frame, labels).collect()}
    assert {i: kept[i] for i in junk} == {i: i % 3 == 2 for i in junk}
    assert all(kept[i] == (not out(i, got[lang(i)].level)) for i in [*clean, *noisy]) and all(kept[i] for i in rare)


def test_toxicity_on_held_out_words(spark):
    rng = random.Random(8)
    insults = ["blockhead", "numskull", "dimwit"]
    docs, labels = {}, []
    for i in range(1200):
        w, bad = prose(rng, 60).split(), i % 4 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(insults))
        docs[i] = " ".join(w)
        labels.append((i, int(bad)))
    frame = table(spark, docs)
    machine = toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.toxicity(frame, machine).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].predicted == dict(labels)[i] for i in held) > 0.97 * len(held)
    clean = prose(rng, 50)
    plain, bent, dotted, apart = machine.scores([clean, clean + " blockxhead blockxhead", clean + " n.u.m.s.k.u.l.l d-i-m-w-i-t", clean + " d i m w i t"])
    assert plain < 0.3 < min(bent, dotted, apart)


def test_toxicity_trains_on_long_texts(spark):
    """Texts beyond the characters that train give stretches; where no text fits the machine still learns."""
    rng = random.Random(9)
    docs = {}
    for i in range(1000):
        w = prose(rng, 200).split()
        for _ in range(0 if i % 4 else 8):
            w.insert(rng.randrange(len(w)), rng.choice(["blockhead", "numskull", "dimwit"]))
        docs[i] = " ".join(w)
    assert min(map(len, docs.values())) > 900
    frame = table(spark, docs)
    machine = toxicity.train(frame, spark.createDataFrame([(i, int(i % 4 == 0)) for i in docs], "doc_id long, toxic int"), longest=900)
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r.predicted == int(r.doc_id % 4 == 0) for r in toxicity.toxicity(frame, machine).collect() if r.doc_id in held]
    assert sum(right) > 0.97 * len(held)


def test_spread(spark):
    words = [f"w{k}" for k in range(5000)]
    rows = [("short text.",), (" ".join(words),), ("x" * 9000,), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(toxicity.spread(F.col("t"), 6400)).collect()]
    assert got[0] == rows[0][0] and got[3] is None and set(got[2]) == {"x", "\n"}
    pieces = got[1].split("\n")
    assert len(pieces) == 14 and len(got[1]) <= 6400 and {w for p in pieces for w in p.split()} <= set(words)
    assert int(pieces[0].split()[0][1:]) < 20 and int(pieces[-1].split()[-1][1:]) > 4980


def test_kernel_tolerates_gaps():
    words = ["idiot", "idxiot", "carpet"]
    places, weights = toxicity.subsequences(words)
    scale = toxicity.norms(places, weights)
    phi = np.zeros((3, toxicity.TABLE))
    for k in range(3):
        np.add.at(phi[k], places[k], weights[k] / scale[k])
    same = phi @ phi.T
    assert np.allclose(np.diag(same), 1) and same[0, 1] > 0.4 > 0.1 > same[0, 2]


def plain_kernel(u, v):
    """Sum over common subsequences of three characters, each weighed by its span in either word, normalised."""

    def weights(w):
        w, out = f"\x02{w}\x03", {}
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < toxicity.SPAN:
                out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + toxicity.DECAY ** (k - i + 1)
        return out

    a, b = weights(u), weights(v)
    dot = lambda x, y: sum(n * y.get(s, 0) for s, n in x.items())
    return dot(a, b) / math.sqrt(dot(a, a) * dot(b, b))


def test_kernel_against_enumeration():
    words = ["idiot", "idxiot", "i", "ab", "carpet", "carpets", "blockhead", "blokhead", "aaaa", "numskull"]
    places, weights = toxicity.subsequences(words)
    scale = toxicity.norms(places, weights)
    phi = np.zeros((len(words), toxicity.TABLE))
    for k in range(len(words)):
        np.add.at(phi[k], places[k], weights[k] / scale[k])
    got = phi @ phi.T
    want = np.array([[plain_kernel(u, v) for v in words] for u in words])
    assert np.abs(got - want).max() < 0.02  # places are hashed: a few may clash
    assert np.median(np.abs(got - want)) < 1e-12
    features = toxicity.Nystrom(words)(words)  # over themselves as landmarks nothing is lost
    assert np.abs(features @ features.T - got).max() < 1e-3


def test_a_machine_is_its_features():
    words = ["idiot", "idxiot", "carpet", "blockhead"]
    nystrom = toxicity.Nystrom(words)
    w = np.arange(nystrom.half.shape[1] + 1) / 7
    machine = nystrom.machine(w)
    more = ["idiots", "car", "blockheads", "xylophone"]
    assert np.allclose(machine.judge(more), np.maximum(nystrom(more) @ w[:-1] + w[-1], -1))


def test_sentences():
    assert toxicity.sentences("One two. Three-3 one!\n n.i.t done") == [["one", "two"], ["one", "three"], ["done", "nit"], ["nit"]]
