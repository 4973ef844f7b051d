import zlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers

from mixspark.llm import bpe, packing, tokencount
from tests.llm.data import corpus, table

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TREE = bpe.TreeBpe(bpe.read_ranks(RANKS), PATTERN, leaf_chars=7, leaf_bytes=5)
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = tokencount.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
VITERBI = tokencount.CountViterbi(PIECES)
UNIGRAM = Tokenizer(models.Unigram(PIECES, 0, True))
UNIGRAM.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
some_text = st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "'s", "é", "1", "!!", "the", "\t", "\x1c", "日本", "ab", "▁"]), max_size=120).map("".join) | st.text(max_size=60)


@settings(max_examples=300, deadline=None)
@given(some_text)
def test_tree_equals_library(text):
    want = TREE.leaf.encode_ordinary(text)
    assert TREE.encode(text) == want
    assert TREE.decode(want).decode() == text


def test_tree_on_long_runs():
    for text in ("a" * 9000, "ab" * 4000, " " * 3000, "the" * 3000 + "\n" * 60, "x\n" * 3000):
        assert TREE.encode(text) == TREE.leaf.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(some_text)
def test_word_cache_equals_library(text):
    cache = packing.word_cache(WORDS)
    assert cache.encode([text])[0] == np.asarray(cache.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(some_text | some_text.map(lambda t: t.replace("the", "<unk>")))
def test_counts_equal_library(text):
    assert VITERBI.count(text)[0] == len(UNIGRAM.encode(text).ids)


def test_ties_and_unknowns():
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0)]
    for fallback in (False,):
        library = Tokenizer(models.Unigram(pieces, 0, fallback))
        library.normalizer = UNIGRAM.normalizer
        for text in ("ab", "abab cc", "ccc", "a c b", "é", "a▁b"):
            assert tokencount.CountViterbi(pieces).count(text)[0] == len(library.encode(text).ids), text


def test_roundtrip_query(spark):
    docs = corpus()
    library = tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = bpe.bpe_roundtrip(table(spark, docs), RANKS, PATTERN).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.ids == library.encode_ordinary(docs[r.doc_id]) and bytes(r.decoded).decode() == docs[r.doc_id] and r.n_tokens == len(r.ids)


def test_packing(spark):
    docs = corpus() | {1000: None, 1001: "word " * 5000}
    pieces = packing.pack(table(spark, docs).repartition(5), WORDS, 128, keep_ids=True).collect()
    library = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.asarray(p.ids, "<u4").tobytes())
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for k, text in docs.items():
        parts = sorted(by_doc[k], key=lambda p: p.start)
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert [i for p in parts for i in p.ids] == want
        assert all(p.doc_tokens == len(want) for p in parts)
        assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, parts in by_sequence.items():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
        assert sum(p.length for p in parts) == 128 or s == max(by_sequence)
