"""Runs against a scan of all periods, on texts that are all junctions, repeats and near repeats."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from mixspark.llm import periodic
from tests.llm.data import corpus


def plain_runs(words):
    """All (start, length, period) from the definition: every period, every maximal stretch, smallest period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def texts_of(rng):
    """One list of words: nested powers, junctions of periodic parts, long blocks twice, noise."""
    kind = rng.randrange(6)
    letters = "ab" if kind < 3 else "abcdefghij"
    block = lambda n: [rng.choice(letters) for _ in range(n)]
    if kind == 0:
        return block(rng.randint(0, 400))
    if kind == 1:  # one short period on both sides of a border
        p = block(rng.randint(1, 5))
        return block(rng.randint(0, 3)) + p * rng.randint(20, 90) + block(rng.randint(0, 2)) + p * rng.randint(20, 90) + block(rng.randint(0, 9))
    if kind == 2:  # powers of powers
        p = block(rng.randint(2, 4)) * rng.randint(2, 30) + block(rng.randint(0, 3))
        return (p * rng.randint(2, 4) + block(2)) * rng.randint(1, 3)
    if kind == 3:  # a long block again, now and then with a changed word
        p = [str(rng.randrange(10**6)) for _ in range(rng.randint(40, 400))]
        out = block(rng.randint(0, 30)) + p * rng.randint(2, 3) + p[: rng.randrange(len(p))] + block(rng.randint(0, 30))
        if rng.random() < 0.4:
            out[rng.randrange(len(out))] = "changed"
        return out
    if kind == 4:
        p, r = block(rng.randint(1, 60)), block(rng.randint(1, 60))
        return p * rng.randint(1, 8) + r * rng.randint(1, 8) + p * rng.randint(1, 8)
    return block(rng.randint(0, 300))


@pytest.mark.parametrize("seed", range(12))
def test_all_runs_are_found(seed):
    rng = random.Random(seed)
    docs = [texts_of(rng) for _ in range(25)]
    docs += [docs[0], docs[1], docs[1]]  # copies side by side
    for words, got in zip(docs, periodic.runs_of(docs), strict=True):
        assert [tuple(r) for r in got.tolist()] == plain_runs(words), words


def test_fibonacci_words_and_one_word():
    a, b = ["a"], ["a", "b"]
    while len(b) < 900:
        a, b = b, b + a
    docs = [b, ["x"] * 700, ["x"] * 11, ["x"] * 12, [], ["x"]]
    for words, got in zip(docs, periodic.runs_of(docs), strict=True):
        assert [tuple(r) for r in got.tolist()] == plain_runs(words)


def test_long_text_is_not_quadratic():
    rng = random.Random(1)
    part = [str(rng.randrange(50_000)) for _ in range(150_000)]
    words = part + part + ["a", "b"] * 100_000 + ["a"] + ["a", "b"] * 20
    (got,) = periodic.runs_of([words])
    rows = {tuple(r) for r in got.tolist()}
    assert (0, 300_000, 150_000) in rows and (300_000, 200_001, 2) in rows


def plain_report(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_report_of_a_table(spark):
    rng = random.Random(4)
    docs = corpus(4, 60) | {900: None, 901: "", 902: " \n\t ", 903: "a\x0bb\x1cc d " * 15, None: "w " * 30}
    docs |= {1000 + i: " ".join(texts_of(rng)) for i in range(80)}
    rows = [(k, v, "x", -1) for k, v in docs.items()] + [(5, docs[5], "again", -2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int").repartition(3)
    got = sorted((tuple(r) for r in periodic.run_report(periodic.looped(frame)).collect()), key=str)
    assert got == sorted((plain_report(k, v) for k, v, *_ in rows), key=str)
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, *_ in rows) > 5
    assert periodic.run_report(periodic.looped(frame.limit(0))).count() == 0


def test_runs_and_collapsed_text(spark):
    frame = spark.createDataFrame([(1, "so " + "la di da " * 5 + "end")], "doc_id int, text string")
    (row,) = periodic.periodic_runs(frame).collect()
    assert row.doc_id == 1 and [tuple(r) for r in row.runs] == [(1, 15, 3)] and row.collapsed == "so la di da end"


def test_minimizers_repeat_with_the_text():
    rng = np.random.default_rng(0)
    part = rng.integers(0, 1 << 62, 200).astype(np.uint64)
    at = periodic.minimizers(np.tile(part, 3), np.ones(600, bool), 32)
    inner = {int(x) for x in at if 200 <= x < 360}
    assert inner and inner == {int(x) - 200 for x in at if 400 <= x < 560} and len(at) < 100
