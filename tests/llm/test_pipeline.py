"""The pipeline's rows against plain versions of its stages."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from mixspark.llm import toxicity
from tests.llm import brute
from tests.llm.data import corpus, prose, table


@pytest.fixture
def folder(spark, tmp_path):
    rng, docs = random.Random(9), corpus(9)
    labels = []
    for i in range(2000, 2400):
        bad = i % 4 == 0
        docs[i] = prose(rng, 50) + (" blockhead numskull blockhead" if bad else "")
        labels.append((i, 1, int(bad)))
    docs = {k: v for k, v in docs.items() if v.strip()}
    line = "a line that three documents share and that is long enough"
    for i in (3000, 3001, 3002):
        docs[i] = f"{prose(rng, 20)}\n{line}\n{prose(rng, 20)}"
    table(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), docs


def plain_lines(docs):
    out = brute.line_dedup(docs)
    return {k: v for k, v in out.items() if v == docs[k] or brute.words(v)}


def test_stages_and_run(spark, folder):
    path, docs = folder
    frame = spark.read.parquet(f"{path}/documents.parquet")
    machine = toxicity.train(frame, spark.read.parquet(f"{path}/labels.parquet"))
    scores = dict(zip(docs, machine.scores(list(docs.values())), strict=True))
    want = {k: v for k, v in docs.items() if scores[k] < 0.3}
    assert 95 <= len(docs) - len(want) <= 105
    lined = plain_lines(want)
    assert sum(len(v) for v in lined.values()) < sum(len(v) for v in want.values())
    roots = brute.components(lined)
    single = {k: v for k, v in lined.items() if roots[k] == k}
    assert len(single) < len(lined)
    left = brute.repeats({k: v.encode() for k, v in single.items()}, "later")
    got = corpus_pipeline.run(spark, path).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids: dict[int, list[int]] = {}
    for p in sorted(got, key=lambda p: (p.doc_id, p.start)):
        ids.setdefault(p.doc_id, []).extend(p.ids)
    assert set(ids) == set(single)
    for k, raw in left.items():
        text = raw.decode(errors="ignore")
        assert ids[k] == [*library.encode(text, add_special_tokens=False).ids, 1], k
    total = sum(map(len, ids.values()))
    assert max(p.sequence_id for p in got) == (total - 1) // 2048
    assert np.bincount([p.sequence_id for p in got], [p.length for p in got])[:-1].tolist() == [2048.0] * ((total - 1) // 2048)
