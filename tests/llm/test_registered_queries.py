"""The registered queries on a folder of small tables, against plain versions of what they return."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, models, normalizers

from mixspark.llm import tokencount
from mixspark.llm.bpe import read_ranks
from mixspark.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.data import corpus

RNG = random.Random(21)
DOCS = corpus(21, 50) | {500: None, 501: "", 502: "it was said: 'naïve'\n\n  twice  ", 503: "one two three\none two three"}
VECTORS = [(i, [RNG.choice([-1.0, -0.5, 0.0, 0.25, 0.9]) * RNG.random() for _ in range(8)]) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(40)] + [(340, None), (360, [None] * 8)]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, v, random.Random(k).choice(["en", "de", None]), "s", len(v or "")) for k, v in DOCS.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in DOCS], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return lambda name: {r[0]: r for r in QUERIES[name](spark, folder).collect()} if name not in ("op6_top_k", "op8_packing") else QUERIES[name](spark, folder).collect()


def test_op1(run):
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = run("op1_byte_bpe")
    assert got.keys() == DOCS.keys()
    for k, text in DOCS.items():
        ids = library.encode_ordinary(text or "")
        assert (got[k].n_tokens, got[k].ids_sha256, got[k].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(text or ""))


def test_op2(run):
    got, want = run("op2_minhash"), brute.components({k: v or "" for k, v in DOCS.items()})
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()} == {k: (len(brute.shingles(DOCS[k])), want[k], want[k] == k) for k in DOCS}


def test_op3(run):
    got = run("op3_hilbert_shards")
    by_shard = {}
    for k, r in got.items():
        raw = (DOCS[k] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert got.keys() == DOCS.keys() and all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert sorted(by_shard) == list(range(24)) and max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_op4(run):
    got = run("op4_line_dedup")
    want = brute.line_dedup({k: v for k, v in DOCS.items() if v is not None})
    assert got.keys() == DOCS.keys() and got[500].n_lines == 0
    for k, text in want.items():
        assert got[k].kept_sha256 == sha(text), k
        lines = DOCS[k].count("\n") + 1
        assert got[k].n_lines == lines and (got[k].n_removed == 0) == (text == DOCS[k])


def test_op5(run):
    library = Tokenizer(models.Unigram(tokencount.read_pieces(public_tokenizers.path("piece_bpe_32k.model")), 0, True))
    library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    assert {k: r.n_tokens for k, r in run("op5_token_counts").items()} == {k: len(library.encode(v or "").ids) for k, v in DOCS.items()}


def test_op6(run):
    assert sorted(tuple(r) for r in run("op6_top_k")) == brute.top(VECTORS, 20, 20)


def test_op7(run):
    got = run("op7_quality")
    assert got.keys() == DOCS.keys()
    for k, r in got.items():
        want = brute.measures(DOCS[k])
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert {c: r[c] for c in want} == want and r.base_failed == failed and r.kept == (not failed)  # too few labels prove a cutoff


def test_op8(run):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {k: [*library.encode(v or "", add_special_tokens=False).ids, 1] for k, v in DOCS.items()}
    got, places, held = run("op8_packing"), {}, {}
    for p in got:
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == brute.crc(ids[p.doc_id][p.start : p.start + p.length]) and p.offset + p.length <= 2048
        places.setdefault(p.doc_id, []).append((p.start, p.length))
        held.setdefault(p.sequence_id, []).append((p.offset, p.length))
    gapless = lambda pieces, total: np.cumsum([0, *[n for _, n in sorted(pieces)]]).tolist() == [*[a for a, _ in sorted(pieces)], total]
    assert places.keys() == DOCS.keys() and all(gapless(v, len(ids[k])) for k, v in places.items())
    assert all(gapless(v, sum(n for _, n in v)) for v in held.values()) and len(held) == -(-sum(map(len, ids.values())) // 2048)


def test_op9(run):
    got = run("op9_toxicity")
    assert {k: r.held_out for k, r in got.items()} == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in DOCS}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_op10(run):
    got, want = run("op10_suffix_dedup"), brute.repeats({k: (v or "").encode() for k, v in DOCS.items()}, "all")
    for k, kept in want.items():
        size = len((DOCS[k] or "").encode())
        assert (got[k].n_bytes, got[k].n_removed, got[k].kept_sha256) == (size, size - len(kept), sha(kept))


def test_fractional_scores_equal_the_library():
    """A made-up vocabulary with scores that round; unknown characters and the unknown piece itself too."""
    rng = random.Random(5)
    pieces = [("<unk>", 0.0), *((c, -rng.random() * 9) for c in "▁abcdef")]
    pieces += [(p, -rng.random() * 14) for p in sorted({"".join(rng.choice("▁abcdef") for _ in range(rng.randint(2, 5))) for _ in range(300)})]
    counter, library = tokencount.CountViterbi(pieces), Tokenizer(models.Unigram(pieces, 0, False))
    library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    for _ in range(600):
        text = "".join(rng.choice(["a", "b", "c", "d", "e", "f", " ", "z", "é", "\n", "<unk>"]) for _ in range(rng.randint(1, 40)))
        assert counter.count(text)[0] == len(library.encode(text).ids), text
