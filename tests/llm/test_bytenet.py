"""The byte network: gradients by differences, chunks that cover a text, held-out labels, odd inputs."""

import random

import numpy as np
import pytest

from mixspark.llm import bytenet
from mixspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    docs = [[rng.integers(0, 256, rng.integers(1, 256)).astype(np.uint8).tobytes() for _ in range(rng.integers(1, 4))] for _ in range(5)]
    net, y = bytenet.Network(4), np.array([1, 0, 1, 1, 0], np.float32)
    net.weights = {k: v.astype(np.float64) + 0.01 for k, v in net.weights.items()}
    table, windows = bytenet.chunk_table([c for d in docs for c in d])
    first = np.concatenate(([0], np.cumsum([len(d) for d in docs])[:-1]))

    def loss():
        odds, _ = net.combined(net.pooled(table, windows, net.tables())[0].astype(np.float64), first)
        return np.mean(np.log1p(np.exp(-odds)) * y + np.log1p(np.exp(odds)) * (1 - y))

    got = net.gradients(table, windows, first, y)
    for name, g in got.items():
        flat = net.weights[name].reshape(-1)
        for i in np.argsort(-np.abs(g.ravel()))[:3]:
            held, flat[i] = flat[i], flat[i] + 1e-2
            up, flat[i] = loss(), held - 1e-2
            down, flat[i] = loss(), held
            assert (up - down) / 2e-2 == pytest.approx(g.ravel()[i], rel=0.1, abs=2e-4), name


@pytest.mark.parametrize("size", [0, 1, 6, 7, 8, 249, 250, 255, 256, 257, 506, 507, 1000])
def test_each_window_lies_in_one_chunk(size):
    data = bytes(i % 251 for i in range(size))
    chunks = [data[s : s + bytenet.CHUNK] for s in bytenet.chunk_starts(size).tolist()]
    windows = [c[i : i + bytenet.WIDTH] for c in chunks for i in range(min(bytenet.WINDOWS, max(1, len(c) - bytenet.WIDTH + 1)))]
    assert windows == [data[i : i + bytenet.WIDTH] for i in range(max(1, size - bytenet.WIDTH + 1))]


def test_pooling_equals_a_plain_convolution():
    net, rng = bytenet.Network(1), np.random.default_rng(0)
    data = rng.integers(0, 256, 300).astype(np.uint8).tobytes()
    got = net.pooled(*bytenet.chunk_table(bytenet.spread_chunks(data, 99)), net.tables())[0].max(axis=0)
    e = net.weights["embedding"][np.frombuffer(data, np.uint8)]
    want = np.max([np.einsum("ke,kef->f", e[i : i + bytenet.WIDTH], net.weights["filters"]) for i in range(300 - bytenet.WIDTH + 1)], axis=0)
    assert np.allclose(got, want + net.weights["filter_bias"], atol=1e-4)


def test_one_bad_place_in_a_long_text_is_seen_anywhere():
    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(n))
    junk = " ".join("###%%%" for _ in range(60))
    made = [(prose(rng.randint(20, 900)), 1) for _ in range(100)] + [(prose(rng.randint(0, 450)) + junk + prose(rng.randint(0, 450)), 0) for _ in range(100)]
    scorer = bytenet.fit([bytenet.spread_chunks(t.encode(), 24) for t, _ in made], np.array([y == 1 for _, y in made]), 0.5)
    clean = prose(3000)
    scores = scorer.scores([clean.encode(), (clean + junk).encode(), (junk + clean).encode(), (clean[:9000] + junk + clean[9000:]).encode()])
    assert scores[0] > 0.7 and (scores[1:] < 0.1).all()


def test_held_out_labels_of_the_query(spark):
    got = {r.doc_id: r for r in QUERIES["op12_byte_quality"](spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(r.score, labels[k]) for k, r in got.items() if r.held_out and k in labels]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad) > 0.95
    assert np.mean([s >= 0.7 for s in good]) > 0.95 and np.mean([s >= 0.7 for s in bad]) < 0.2
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_odd_rows_and_labels(spark):
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "c"), (None, "text é", "d"), (3, "ab " * 50_000, "e"), (4, "good words here", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(2, 0), (4, 1), (3, 1), (1, None), (None, 1), (99, 0)], "doc_id long, quality int")
    got = bytenet.quality_scores(docs, bytenet.train(docs, labels)).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 2, 3, 4] and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1  # null and empty
    one = bytenet.train(docs, labels.where("quality = 1"))
    assert {r.score for r in bytenet.quality_scores(docs, one).collect()} == {1.0}
    none = bytenet.train(docs, labels.limit(0))
    assert {r.score for r in bytenet.quality_scores(docs, none).collect()} == {0.5}
    assert bytenet.quality_scores(docs.limit(0), none).count() == 0


def test_training_is_bounded_and_repeats_itself(spark):
    docs = spark.range(60).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 4000) AS text")
    labels = spark.range(60).selectExpr("id AS doc_id", "IF(id % 3 = 0, 0, 1) AS quality")
    a, b = (bytenet.train(docs, labels, sample=5, spread=3) for _ in range(2))
    assert all(np.array_equal(a.network.weights[k], b.network.weights[k]) for k in a.network.weights)
