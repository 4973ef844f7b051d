"""The prefix trie against one built turn by turn in a dictionary."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from mixspark.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """Lists of (role, text) by id, turns in order, null first."""
    found = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        found.setdefault(conv, []).append((role or "", text or ""))
    return found


def rebuilt(found):
    out = {}
    for c, own in found.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = found.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, held in members.items():
        below = [v for v in members if v[: len(node)] == node]
        childless = [v for v in below if not any(len(u) == len(v) + 1 and u[:-1] == v for u in below)]
        ends = ",".join(map(str, sorted(c for c in held if len(convs[c]) == len(node))))
        saved = sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in below if v)
        out.add((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), sum(len(v) == len(node) + 1 for v in below), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def made(seed):
    rng = random.Random(seed)
    pool = ["hi", "hello é", "", None, "why?", "because"]
    rows = []
    for c in [*range(40), 77, 1000, -7, -3, 12345]:
        n = rng.choice([1, 2, 3, 8, 9, 16, 17, 25])
        script = random.Random(rng.randrange(4))
        for t in range(n):
            text = script.choice(pool) if rng.random() < 0.93 else rng.choice(pool)
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    for c in range(200, 230):  # copies
        rows += [(c, t, "user", f"same {t}") for t in range(11)]
    rows += [(300, None, None, "first"), (300, 0, "user", "second"), (300, -1, "user", None), (None, 0, "user", "nobody's")]
    rows += [(400, 1, "user", "twice"), (400, 1, "user", "twice"), (401, 0, "user", "x" * 100_000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "e", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, x int").repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_of_the_rebuilt_conversations(spark, seed):
    rows = made(seed)
    got = trie.rebuilt_trie(frame(spark, rows))
    assert got.columns == COLUMNS
    found = [tuple(r) for r in got.collect()]
    want = plain_trie(rebuilt(ordered(rows)))
    assert len(found) == len(want) and set(found) == want


def test_nodes_of_conversations_as_they_are(spark):
    rows = made(3)
    found = [tuple(r) for r in trie.conversation_trie(frame(spark, rows)).collect()]
    want = plain_trie(ordered(rows))
    assert len(found) == len(want) and set(found) == want


def test_turnless_and_no_conversations(spark):
    rows = [(1, 0, "user", "a"), (9, 0, "user", "b"), (5, 0, "user", "c")]  # short ones lose all turns to their openings
    found = {tuple(r) for r in trie.rebuilt_trie(frame(spark, rows)).collect()}
    assert found == plain_trie(rebuilt(ordered(rows)))
    assert trie.rebuilt_trie(frame(spark, rows).limit(0)).count() == 0


def test_ids_of_a_node_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 50)
    ends = spark.range(3000).selectExpr("0L AS x", "id % 2 AS y", "3000 - id AS conv")
    got = {r.y: r.ends_sha256 for r in trie.id_digests(ends).collect()}
    for y in (0, 1):
        ids = ",".join(str(3000 - i) for i in range(2999, -1, -1) if i % 2 == y)
        assert got[y] == hashlib.sha256(ids.encode()).hexdigest()


def test_running_sums_across_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(2000).selectExpr("IF(id < 1500, 7, id) AS key", "id AS at", "id % 5 AS v")
        got = {r.at: r.s for r in trie.before(rows, "key", [F.col("at").desc()], {"s": (F.col("v"), trie.SUM)}, "sums").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 2000 and all(got[i] == sum(j % 5 for j in range(i + 1, 1500)) for i in range(0, 1500, 97)) and got[1999] == 0
