"""Nulls in any column, empty and long texts, repeated rows, empty tables, clashing names."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mixspark.llm import bpe, linededup, neardup, packing, quality, shard, suffix, tokencount, topk, toxicity

LONG = " ".join(f"w{i % 977} x{i}" for i in range(20000))
CLASHES = "row long, rep string, removed string, band int, _row long, spans string, stratum string, payload string, raw long, comp long, shard int, n_removed string, `a.b` int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
ROWS = [
    (1, "a b c d e f g h", "en", "s", 10),
    (2, None, None, None, None),
    (3, "", "en", "s", 0),
    (1, "a b c d e f g h", "en", "s", 10),
    (None, "some text here", "en", "s", 3),
    (5, LONG, "de", "s", 9),
    (6, LONG + " tail", "de", "s", 9),
    (7, " \n\t\n ", "en", "s", 3),
    (8, "x" * 20000, "en", None, 1),
    (9, "é" * 300 + "日本語" * 200, "ja", "s", 4),
]


def docs(spark, empty):
    return spark.createDataFrame([] if empty else [(*r, k, "z", "q", 3, 111 * k, "k", "st", f"p{k}", 7, 8, 9, "n", k) for k, r in enumerate(ROWS)], SCHEMA)


def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (3, 0, 0), (None, 1, 0), (99, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "bpe": lambda d, _: bpe.bpe_roundtrip(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN),
    "neardup": lambda d, _: neardup.near_duplicates(d),
    "shard": lambda d, _: shard.document_shards(d),
    "linededup": lambda d, _: linededup.dedup_lines(d),
    "tokencount": lambda d, _: tokencount.token_counts(d, P.path("piece_bpe_32k.model")),
    "quality": quality.quality_verdicts,
    "toxicity": lambda d, y: toxicity.toxicity(d, toxicity.train(d, y)),
    "suffix": lambda d, _: suffix.remove_repeats(d, "all"),
    "suffix_later": lambda d, _: suffix.dedup_repeats(d),
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("empty", [False, True])
def test_every_row_comes_back(spark, name, empty):
    got = OPERATORS[name](docs(spark, empty), labels(spark)).collect()
    assert len(got) == (0 if empty else len(ROWS))


@pytest.mark.parametrize("empty", [False, True])
def test_packing(spark, empty):
    got = packing.pack(docs(spark, empty), P.path("word_bpe_49k.json")).collect()
    assert sum(r.length for r in got if r.doc_id in (2, 3, 7)) == (0 if empty else 3)


def test_top_k_of_nothing(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>, rank int")).collect() == []


def test_defined_results(spark):
    near = {r.doc_id: r for r in neardup.near_duplicates(docs(spark, False)).collect()}
    assert near[2].n_shingles == 0 and near[2].component_id == 2 and near[2].kept
    assert near[6].component_id == 5 and not near[6].kept
    assert near[None].component_id is None and not near[None].kept
    counts = {r.doc_id: r.n_tokens for r in tokencount.token_counts(docs(spark, False), P.path("piece_bpe_32k.model")).collect()}
    assert counts[2] == counts[3] == 0


def test_query_column_names(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "suffix_dedup", "packing"]


#: Functions that return the rows of their input, all columns; the texts that they leave, by row (None: the row goes).
KEEPERS = {
    "toxicity": (lambda d, y: toxicity.reject_toxic(d, toxicity.train(d, y)), {}),
    "line_dedup": (lambda d, _: linededup.drop_common_lines(d), {3: None}),  # an equal row loses all its words
    "near_dedup": (lambda d, _: corpus_pipeline.drop_near_copies(d.sparkSession, d, ""), {6: None}),
    "suffix_dedup": (lambda d, _: suffix.dedup_repeats(d), {6: " tail"}),
    "sharding": (lambda d, _: shard.hilbert_shards(d, {"lang": F.col("lang")}, 3, ["doc_id", "row"], names=("to_shard", "to_slot")), {}),
}


@pytest.mark.parametrize("name", KEEPERS)
def test_rows_keep_their_columns(spark, name):
    keep, changed = KEEPERS[name]
    frame = docs(spark, False)
    got = {r["row"]: r for r in keep(frame, labels(spark)).select(*[f"`{c}`" for c in frame.columns]).collect()}
    assert set(got) == {k for k in range(len(ROWS)) if changed.get(k, "") is not None}
    for k, r in got.items():
        want = {c: v for c, v in frame.where(F.col("row") == k).first().asDict().items() if c not in ("shard", "text", "n_chars")}
        assert {c: r[c] for c in want} == want
        text = ROWS[k][1]
        if name == "suffix_dedup" and k in changed:
            assert len(r.text) < 500 and (not changed[k] or r.text.endswith(changed[k]))
        elif name != "suffix_dedup" or len((text or "").encode()) < 400:
            assert r.text == text
    assert keep(docs(spark, True), labels(spark)).count() == 0


def test_equal_ids_in_suffix_dedup(spark):
    """Rows of one id are told apart: a copy within them is a copy, and both stay rows."""
    passage = " ".join(f"w{i}" for i in range(120))
    rows = [(1, passage), (1, "own words " + passage), (None, passage + " end"), (None, None)]
    got = sorted((r.doc_id or 0, r.text or "", r.k) for r in suffix.dedup_repeats(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, k int")).collect())
    assert [k for *_, k in sorted(got, key=lambda r: r[2])] == [0, 1, 2, 3]
    assert sum(len(t) >= len(passage) for _, t, _ in got) == 1  # the null id comes first
    assert {k: t for _, t, k in got}[2] == passage + " end" and {k: t for _, t, k in got}[1].startswith("own words")


def test_near_copies_through_an_id_with_two_texts(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, one + " tail"), (2, one), (2, two), (5, two + " tail")]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 5: 1}


@pytest.mark.parametrize("name", ["shard", "slot", "SLOT"])
def test_sharding_refuses_columns_named_like_its_results(spark, name):
    frame = spark.createDataFrame([(1, "x")], f"doc_id long, `{name}` string")
    with pytest.raises(ValueError, match="other names"):
        shard.hilbert_shards(frame, {"id": F.col("doc_id")}, 2, ["doc_id"])
    assert set(shard.hilbert_shards(frame, {"id": F.col("doc_id")}, 2, ["doc_id"], names=("a", "b")).columns) == {"doc_id", name, "a", "b"}


def test_written_shards_keep_equal_and_null_ids(spark, tmp_path):
    rows = [(1, "en", "a"), (1, "en", "b"), (None, "de", "c"), (None, "de", "c"), (2, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, slot string")
    shard.write_shards(frame, {"lang": F.col("lang")}, 2, ["doc_id", "slot"], str(tmp_path / "out"), names=("to", "place"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(((r.doc_id, r.lang, r.slot) for r in got), key=str) == sorted(rows, key=str)
    for k in {r.to for r in got}:
        assert sorted(r.place for r in got if r.to == k) == list(range(sum(r.to == k for r in got)))
