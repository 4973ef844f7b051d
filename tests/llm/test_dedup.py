import hashlib
import random

import numpy as np
import pytest

from mixspark.llm import linededup, neardup, suffix
from mixspark.llm.components import connected_components
from tests.llm import brute
from tests.llm.data import corpus, prose, table


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500, x) for x in range(300, 400)] + [(x, x + 1) for x in range(1000, 1040)]
    root = {x: x for e in edges for x in e}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates(spark, seed):
    docs = corpus(seed)
    want = brute.components(docs)
    got = neardup.near_duplicates(table(spark, docs)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(brute.shingles(docs[r.doc_id])) and r.kept == (r.doc_id == want[r.doc_id]) for r in got)


def test_cells_of_an_open_bucket(spark):
    """Outsiders meet all, those inside only outsiders; one outsider moves about as many rows as there are members."""
    side = ["0 band", "0L key", "id rep", "IF(id >= n_in, id, -1L) comp", "-1L largest"]
    for n_in, n_out, s in ((20_000, 1, 10), (300, 50, 10), (10, 40, 1000)):
        members = spark.range(n_in + n_out).selectExpr("id", f"{n_in}L n_in").selectExpr(*side, "n_in", f"{n_out}L n_out", f"n_in * {s} s_in", f"{n_out}L * {s} s_out")
        got = neardup.dealt_cells(members, 1024 if n_in > 1000 else 16, 10**6 if s == 10 else 5000).collect()
        assert len(got) < 20_100 or n_in < 1000
        cells = {}
        for r in got:
            cells.setdefault((r.x, r.y), []).append(r)
        met = {(a.rep, b.rep) for held in cells.values() if n_in < 1000 for a in held if a.outside for b in held if a.rep != b.rep and (a.own != b.own or a.x == a.y)}
        assert n_in > 1000 or met == {(a, b) for a in range(n_in, n_in + n_out) for b in range(n_in + n_out) if a != b}


def test_near_duplicates_in_a_chain(spark):
    """Each version differs a little from the one before; the ends share nothing."""
    rng = random.Random(5)
    w, docs = prose(rng, 120).split(), {}
    for i in range(40):
        docs[i] = " ".join(w)
        w[rng.randrange(len(w))] = f"new{i}"
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(spark, docs)).collect()}
    assert got == brute.components(docs)


@pytest.mark.parametrize("mode", ["all", "later"])
@pytest.mark.parametrize("part_bytes", [suffix.PART, 400])
def test_repeats(spark, mode, part_bytes):
    """A small part makes files large: their strings are counted by the shuffle."""
    docs = corpus(2)
    want = brute.repeats({k: v.encode() for k, v in docs.items()}, mode)
    got = suffix.remove_repeats(table(spark, docs), mode, columns=("kept_bytes", "kept_sha256", "spans"), part_bytes=part_bytes).collect()
    for r in got:
        assert bytes(r.kept_bytes) == want[r.doc_id], r.doc_id
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id]).hexdigest()
        assert r.n_removed == len(docs[r.doc_id].encode()) - len(want[r.doc_id]) == sum(b - a for a, b in r.spans)
        assert r.n_spans == len(r.spans)


def test_repeats_keep_whole_characters(spark):
    docs = {1: "é" * 300 + "a", 2: "b" + "é" * 300}
    got = {r.doc_id: r.text for r in suffix.dedup_repeats(table(spark, docs)).collect()}
    assert len(got[2]) < 20 and set(got[1] + got[2]) <= set("éab")


def test_previous_factors():
    """Against the definition; what is shorter than half the length may come out shorter still."""
    rng = random.Random(3)
    for _ in range(200):
        length, letters = rng.choice([1, 3, 7, 8, 9, 16, 20, 33, 50]), rng.choice([b"a", b"ab", b"abc", bytes([0, 97, 255])])
        raw = bytes(rng.choice(letters) for _ in range(rng.randint(length, 150)))
        starts = [i for i in range(len(raw) - length + 1) if rng.random() < 0.8]
        got = suffix.previous_factors(suffix.SuffixOrder(np.frombuffer(raw, np.uint8), length), np.array(starts, np.int64)).tolist()
        for i, g in zip(starts, got, strict=True):
            want = max((next((k for k in range(length) if raw[i + k] != raw[j + k]), length) for j in starts if j < i), default=0)
            assert g == want or g < want < max(length / 2, 1)


def test_suffix_ranks_are_in_order():
    rng = random.Random(4)
    raw = bytes(rng.choice([0, 97, 98, 255]) for _ in range(400))
    for length in (3, 7, 8, 20):
        rank = suffix.SuffixOrder(np.frombuffer(raw, np.uint8), length).rank
        strings = [raw[i : i + length] for i in range(len(raw) - length + 1)]
        order = {r: strings[i] for i, r in enumerate(rank[: len(strings)].tolist())}
        assert [order[r] for r in sorted(order)] == sorted(set(strings))


def test_nearest_smaller():
    rng = random.Random(5)
    for n in (0, 1, 2, 50):
        x = rng.sample(range(100), n)
        want = [max((j for j in range(i) if x[j] < x[i]), default=-1) for i in range(n)]
        assert suffix.nearest_smaller(np.array(x, np.int64)).tolist() == want


def test_long_stretches_are_cut():
    files, first, n, own = suffix.segments(b"ab " * 3000, stretch=1000)
    assert n.max() <= 1000 and n.sum() == 9000 - 199 and own.all()
    assert (first == np.cumsum(n) - n).all() and len(files) == len(n)


def test_patience_blocks():
    rng = random.Random(6)
    for _ in range(200):
        a = [rng.randrange(30) for _ in range(rng.randrange(25))]
        b = a[:]
        for _ in range(rng.randrange(6)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(30))
        at = (0, 0)
        for i, j, n in linededup.patience_blocks(a, b):
            assert a[i : i + n] == b[j : j + n] and n > 0 and i >= at[0] and j >= at[1]
            at = (i + n, j + n)
    assert linededup.patience_blocks([1, 2, 3], [1, 2, 3]) == [(0, 0, 3)]
    assert linededup.patience_blocks([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1, 2)]


def test_line_dedup(spark):
    line = "this line has quite enough words to be rare"
    docs = {
        5: f"head five\n{line}\ntail five",
        1: f"head one\n{line}\ntail one",
        7: f"{line}\n\nalso that line is in the other one\nown words of the seventh document here",
        8: f"{line}\n\nalso that line is in the other one",
        9: "short\nlines",
        10: "short\nlines",
    }
    got = {r.doc_id: r for r in linededup.dedup_lines(table(spark, docs)).collect()}
    assert got[1].text == docs[1] and got[1].n_removed == 0
    assert got[5].text == "head five\ntail five"
    assert got[7].text == "\nalso that line is in the other one\nown words of the seventh document here"
    assert got[8].text == ""
    assert got[9].text == docs[9] and got[10].text == docs[10]


@pytest.mark.parametrize("holders", [3, 70, 700])
def test_lines_that_many_hold(spark, holders):
    """Copies, wrapped passages and short lines go from all later documents, however many hold them."""
    passage = prose(random.Random(2), 60).split()
    wrapped = "\n".join(" ".join(passage[k : k + 12]) for k in range(0, 60, 12))
    docs = {i: f"own words {i} are here to stay\n{wrapped}\nown tail {i}" for i in range(holders)}
    docs |= {1000 + i: "a small text of six words" for i in range(holders)}
    docs |= {2000 + i: f"first words {i} of this one\nthese are just five words\nonly four words here" for i in range(holders)}
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(table(spark, docs)).collect()}
    assert all(got[i] == 0 for i in (0, 1000, 2000))
    assert {got[i] for i in range(1, holders)} == {5}
    assert {got[i] for i in range(1001, 1000 + holders)} == {1}
    assert {got[i] for i in range(2001, 2000 + holders)} == {2}  # the short line stands beside the shared one


def test_equal_ids_are_documents_of_their_own(spark):
    rows = [(1, "shared line of quite enough words"), (2, "shared line of quite enough words"), (2, "a text that shares nothing at all"), (None, "null ids have their own words too"), (None, "null ids have their own words too")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, ""), (0, rows[3][1]), (1, rows[0][1]), (2, ""), (2, rows[2][1])]


def test_alignment_against_a_longest_common_subsequence(spark):
    """Where lines stand once and in order, the common blocks are those of a longest common subsequence."""
    rng = random.Random(7)
    pool = [prose(rng, rng.choice([2, 3, 6, 9])) for _ in range(40)]
    docs = {}
    for i in range(12):
        lines = [pool[k] if rng.random() < 0.6 else prose(rng, 6) for k in sorted(rng.sample(range(40), 14))]
        docs[i] = "\n".join(lines)
    got = {r.doc_id: r.text for r in linededup.dedup_lines(table(spark, docs)).collect()}
    assert got == brute.line_dedup(docs)


def test_overlap_of_two_later_documents(spark):
    """A stranger that held the rare line first does not keep the copy of a whole block."""
    line = "one rare line of quite enough words"
    docs = {1: f"stranger\n{line}\nits end", 2: f"two\nalpha\nbeta\n{line}\ngamma\ndelta\ntwo", 3: f"three\nalpha\nbeta\n{line}\ngamma\ndelta\nthree", 4: f"four\nbeta\n{line}\ngamma\nfour"}
    got = {r.doc_id: r.text for r in linededup.dedup_lines(table(spark, docs)).collect()}
    assert got == {1: docs[1], 2: "two\nalpha\nbeta\ngamma\ndelta\ntwo", 3: "three\nthree", 4: "four\nfour"}
    assert got == brute.line_dedup(docs)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_line_dedup_against_all_pairs(spark, seed):
    """Blocks of short and rare lines, held by many: as if every pair had been aligned."""
    rng = random.Random(seed)
    pool = [f"{k} {prose(rng, rng.choice([1, 1, 2, 7]))}" for k in range(60)]
    docs = {}
    for i in range(40):
        lines, at = [], 0
        while at < 60:
            on = at + rng.randrange(1, 9)
            lines += pool[at:on] if rng.random() < 0.5 else [f"own {i} {at}"]
            at = on
        docs[i] = "\n".join(lines)
    got = {r.doc_id: r.text for r in linededup.dedup_lines(table(spark, docs)).collect()}
    assert got == brute.line_dedup(docs)


def test_stretches():
    rng = random.Random(3)
    docs = [([rng.randrange(5) for _ in range(n)], [rng.random() < 0.3 for _ in range(n)]) for n in (rng.randrange(1, 15) for _ in range(300))]
    want = {}
    for d, (lines, rare) in enumerate(docs):
        n = len(lines)
        want |= {(d, i + 1, j - i): tuple(lines[i:j]) for i in range(n) for j in range(i + 1, n + 1) if rare[i] and not any(rare[i + 1 : j])}
        want |= {(d, -j - 1, j + 1 - i): tuple(lines[i : j + 1]) for j in range(n) for i in range(j) if rare[j] and not any(rare[i:j])}
    flat = [np.array([x for doc in docs for x in doc[k]]) for k in (0, 1)]
    owner, h, spot, length = (x.tolist() for x in linededup.stretches(*flat, np.repeat(np.arange(300), [len(x) for x, _ in docs])))
    got = dict(zip(zip(owner, spot, length, strict=True), h, strict=True))
    assert len(h) == len(got) and got.keys() == want.keys()
    assert len({(got[k], want[k]) for k in got}) == len(set(got.values())) == len(set(want.values()))


def test_very_many_lines(spark):
    body = "\n".join(f"line {k} of a text that goes on and on" if k % 2 else str(k) for k in range(200_000))
    got = {r.doc_id: (r.n_lines, r.n_removed, len(r.text)) for r in linededup.dedup_lines(table(spark, {1: body, 2: f"own\n{body}\nend"})).collect()}
    assert got == {1: (200_000, 0, len(body)), 2: (200_002, 200_000, 7)}


def test_repeated_and_moved_lines(spark):
    """Shared lines go however often either side has them and in whatever order."""
    x, y, z = (f"{name} line of a passage that is long enough to count" for name in ("first", "second", "third"))
    docs = {
        1: f"one\n{x}\nmiddle one\n{x}\nend one\n{y}\n\n{z}\nlast one",
        2: f"two\n{x}\nleft two",  # twice in the first holder only
        3: f"three\n{y}\nthen\n{y}\nleft three",  # twice in the later document only
        4: f"four\n{x}\nthen\n{x}\nleft\n{x}\nfour",  # on both sides
        5: f"five\n{z}\nmoved\n{y}\nleft\n{x}\nfive",  # in another order; "left" and the line after it are a run of the fourth document
        6: f"six\n{y}\n\n{z}\nleft\n{y}\n\n{z}\nsix",  # a whole run twice
    }
    got = {r.doc_id: r.text for r in linededup.dedup_lines(table(spark, docs)).collect()}
    assert got[1] == docs[1]
    assert [got[i] for i in range(2, 7)] == ["two\nleft two", "three\nthen\nleft three", "four\nthen\nleft\nfour", "five\nmoved\nfive", "six\nleft\nsix"]


def test_blocks_left_over():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(25))] for _ in range(2))
        shared = set(a) & set(b) & set(range(8))
        blocks = linededup.patience_blocks(a, b)
        seen = [k for _, j, n in blocks for k in range(j, j + n)]
        for i, j, n in linededup.blocks_left_over(a, b, blocks, shared):
            assert a[i : i + n] == b[j : j + n] and n > 0
            seen += range(j, j + n)
        assert len(seen) == len(set(seen)) and {j for j, h in enumerate(b) if h in shared} <= set(seen)


def test_many_edits_of_one_original(spark):
    """Each edit is linked with the original only, which is not the smallest id; none may be lost."""
    rng = random.Random(12)
    w, docs = prose(rng, 400).split(), {}
    for i in range(600):
        edit = w[:]
        for k in rng.sample(range(5, 390, 6), 10):
            edit[k] = f"new{i}x{k}"
        docs[i] = " ".join(edit)
    docs[900] = " ".join(w)
    sets = {k: brute.shingles(t) for k, t in docs.items()}
    assert all(100 * len(s & sets[900]) >= 75 * len(s | sets[900]) for s in sets.values())
    assert 100 * len(sets[0] & sets[1]) < 70 * len(sets[0] | sets[1])
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(spark, docs)).collect()}
    assert set(got.values()) == {0}


def test_few_links_among_many_unlinked_pages(spark):
    """1,200 pages of one template, at 0.70 to each other, with 40 planted pairs at 0.756: none may be lost."""
    rng = random.Random(13)
    template = [f"t{i}" for i in range(400)]
    tails = [[f"p{k}x{i}" for i in range(85)] for k in range(1200)]
    for k in range(0, 80, 2):
        tails[k + 1][:18] = tails[k][:18]
    ids = rng.sample(range(100_000), 1200)
    docs = {i: " ".join(template + tail) for i, tail in zip(ids, tails, strict=True)}
    near = lambda x, y: len(x & y) / len(x | y)
    a, b, c = (brute.shingles(docs[ids[k]]) for k in (0, 1, 90))
    assert 0.755 < near(a, b) < 0.757 and 0.69 < near(a, c) < 0.71
    want = {i: i for i in ids} | {i: min(ids[k], ids[k + 1]) for k in range(0, 80, 2) for i in ids[k : k + 2]}
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(table(spark, docs)).collect()} == want
    small = {i: docs[i] for i in ids[:150]}
    got = neardup.near_duplicates(table(spark, small), block=16)  # buckets of many cells
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: want[i] for i in small}
