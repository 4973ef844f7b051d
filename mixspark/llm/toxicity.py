"""Toxicity by a subsequence string-kernel support vector machine.

Words are compared by their gapped subsequences of three characters (word edges
count as characters), each weighed down by the span it takes; so a word with
characters left out or put in between stays close to itself. Punctuation within a
word is dropped and letters spelled out one by one are joined first.

Training, on the driver, on a bounded sample of labelled rows (``SAMPLE`` toxic and
twice as many clean ones, those with the smallest hash of the id). Of a text of more
than ``LONGEST`` characters stretches spread evenly over it, of that many together,
train (the labels say which documents, not which stretches, are toxic, so an insult
between them teaches nothing); scoring reads whole texts. Landmarks are words
that separate the two kinds of sentences best and common clean ones; Nyström features
over them feed linear machines with squared hinge loss. The machine starts from
labelled sentences, compared by the mean of their words' kernels (``SENTENCES`` of each
kind). A sentence inherits its document's label, which is true of at least one sentence
of a toxic document; so rounds of multiple-instance training follow: of each toxic
document the sentences that the machine finds most toxic stand for it by their best
words, against the best words of clean sentences and a spread of all clean words. A
logistic curve over the best words and their share, fitted on sample documents that did
not train the machine, gives the score.

The machine is linear in the explicit subsequences, so scoring needs one weight
table of fixed size, looked up once for each distinct word of a task.

Defined cases: a null or empty text has no words and gets the score of no evidence;
whole texts of any length count; words of any length count in overlapping parts;
label rows that are null or match no document are left out; of an id with several
texts the smallest trains;
without labels of both kinds, or without a word that tells them apart, every score is
0 and ``reject_toxic`` keeps all; repeated rows repeat; an empty table gives an empty
table; labels, language, source and id never enter a score; other columns, whatever
their names, are ignored by ``toxicity`` and come back from ``reject_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixspark.llm.common import SLICE, arrow_map, batch, bounded_batches, texts
from mixspark.llm.neardup import mix

#: Toxic rows that train at most (clean ones are twice as many), and characters of each that do at most.
SAMPLE, LONGEST = 1500, 30_000
SPAN, DECAY, TABLE = 6, 0.7, 1 << 16
LANDMARKS, PART, WORDS_KEPT = 96, 32, 400_000
#: Of training: sentences of each kind that start the machine; rounds; sentences that stand for a toxic document; clean words, hardest and spread, in a round.
SENTENCES, ROUNDS, WITNESSES, HARD, SPREAD = 3000, 3, 2, 2000, 6000
#: Word values that are counted in a document.
STEPS = (-0.5, 0.0, 0.4, 0.8)

_SENTENCE_END = re.compile(r"[.!?]+\s+|\n+")
_SPELLED = re.compile(r"(?<!\w)(?:\w[\s.*_-]{1,2}){2,}\w(?!\w)")
_OFFSETS = [(a, b) for a, b in combinations(range(1, SPAN), 2)]


def normal(word: str) -> str:
    """Lower case, letters only."""
    word = word.lower()
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def spelled(text: str) -> list[str]:
    """Words spelled out letter by letter."""
    return ["".join(c for c in m[0] if c.isalnum()) for m in _SPELLED.finditer(text)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table places and weights of each word's subsequences, padded with weight 0."""
    size = max(len(w) for w in words) + 2
    chars = np.zeros((len(words), size + SPAN), np.uint64)
    for i, w in enumerate(words):
        chars[i, : len(w) + 2] = np.frombuffer(f"\x02{w}\x03".encode("utf-32-le"), "<u4")
    places, weights = [], []
    for a, b in _OFFSETS:
        first, second, third = chars[:, :size], chars[:, a : a + size], chars[:, b : b + size]
        code = (first << np.uint64(42)) ^ (second << np.uint64(21)) ^ third
        places.append(mix(code + np.uint64(1)) & np.uint64(TABLE - 1))
        weights.append(np.where(third > 0, DECAY ** (b + 1), 0.0))
    return np.hstack(places).astype(np.int64), np.hstack(weights)


def norms(places: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square roots of the words' kernels with themselves."""
    row, col = np.nonzero(weights)
    key = row * TABLE + places[row, col]
    order = np.argsort(key)
    ordered = key[order]
    if not len(ordered):
        return np.ones(len(places))
    first = np.concatenate(([0], np.nonzero(np.diff(ordered))[0] + 1))
    sums = np.add.reduceat(weights[row, col][order], first)
    return np.sqrt(np.maximum(np.bincount(ordered[first] // TABLE, sums * sums, len(places)), 1e-12))


def parts_of(word: str) -> list[str]:
    return [word[i : i + PART] for i in range(0, max(1, len(word) - PART // 2), PART // 2)] if len(word) > PART else [word]


class Machine:
    def __init__(self, table: np.ndarray, bias: float, curve: np.ndarray):
        self.table, self.bias, self.curve, self.known = table, bias, curve, {}

    def __getstate__(self):
        return {"table": self.table, "bias": self.bias, "curve": self.curve, "known": {}}

    def judge(self, words: list[str]) -> np.ndarray:
        """Distance from the margin's middle for normal words."""
        out = np.full(len(words), -1.0)
        split = [(i, p) for i, w in enumerate(words) if len(w) > 1 for p in parts_of(w)]
        split.sort(key=lambda x: len(x[1]))
        for lo in range(0, len(split), 2048):
            some = split[lo : lo + 2048]
            places, weights = subsequences([p for _, p in some])
            value = (self.table[places] * weights).sum(axis=1) / norms(places, weights) + self.bias
            np.maximum.at(out, [i for i, _ in some], value)
        return np.maximum(out, -1.0)

    def values(self, all_words: list[list[str]]) -> list[np.ndarray]:
        known = self.known
        new = {w for words in all_words for w in words if w not in known}
        if len(known) + len(new) > WORDS_KEPT:
            known.clear()
            new = {w for words in all_words for w in words}
        listed = list(new)
        shape = list({normal(w) for w in listed})
        found = dict(zip(shape, self.judge(shape).tolist(), strict=True))
        for w in listed:
            known[w] = found[normal(w)]
        return [np.fromiter(map(known.__getitem__, words), float, len(words)) for words in all_words]

    def evidence(self, all_texts: list[str]) -> np.ndarray:
        """For each text: its three best words, how many different words pass each step, and how many there are."""
        out = np.zeros((len(all_texts), 4 + len(STEPS)))
        for i, v in enumerate(self.values([sorted({*t.split(), *spelled(t)}) for t in all_texts])):
            if len(v):
                best = np.sort(v)[-3:] + 1
                out[i, : len(best)] = np.minimum(best[::-1], 2.5)
                out[i, 3:-1] = [math.log1p(np.count_nonzero(v >= step)) for step in STEPS]
                out[i, -1] = math.log1p(len(v))
        return out

    def scores(self, all_texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(all_texts) @ self.curve[:-1] + self.curve[-1], -30, 30)))


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 25) -> np.ndarray:
    """Linear machine by Newton steps on its support vectors; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, held = np.zeros(x.shape[1]), None
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        if held is not None and np.array_equal(inside, held):
            break
        held, s = inside, x[inside] * weight[inside, None]
        w = np.linalg.solve(penalty + s.T @ x[inside], s.T @ y[inside])
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(penalty + (x * (p * (1 - p))[:, None]).T @ x, x.T @ (p - y) + penalty @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sentences(text: str) -> list[list[str]]:
    """Distinct normal words of each sentence; words spelled out letter by letter make one of their own."""
    found = [sorted({normal(v) for v in x.split()} - {""}) for x in _SENTENCE_END.split(text)]
    found.append(sorted({normal(v) for v in spelled(text)} - {""}))
    return [x for x in found if x]


def bent(words: list[str]) -> list[str]:
    """Each word with a letter put in, and with one left out or doubled, at a place that the word decides."""
    out = []
    for v in words:
        if len(v) > 4:
            for k in (1, 2):
                at = 1 + (len(v) * 7 + k * 3) % (len(v) - 2)
                out.append(v[:at] + "xqzwkvjb"[(ord(v[0]) + k + len(v)) % 8] + v[at:])
            at = 1 + (len(v) * 5) % (len(v) - 2)
            out.append(v[:at] + v[at] + v[at:])
            out.append(v[:at] + v[at + 1 :])
    return out


class Nystrom:
    """Features of words over landmarks: inner products are kernel values, as far as landmarks span them."""

    def __init__(self, landmarks: list[str]):
        places, weights = subsequences(landmarks)
        self.base = np.zeros((len(landmarks), TABLE))
        for j, scale in enumerate(norms(places, weights)):
            np.add.at(self.base[j], places[j], weights[j] / scale)
        values, vectors = np.linalg.eigh(self.base @ self.base.T)
        keep = values > 1e-6 * values.max()
        self.half = vectors[:, keep] / np.sqrt(values[keep])

    def __call__(self, words: list[str]) -> np.ndarray:
        kernel = np.zeros((len(words), len(self.base)))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for lo in range(0, len(order), 2048):
            part = order[lo : lo + 2048]
            places, weights = subsequences([words[i] for i in part])
            scale = norms(places, weights)
            for j in range(len(self.base)):
                kernel[part, j] = (self.base[j][places] * weights).sum(axis=1) / scale
        return kernel @ self.half

    def machine(self, w: np.ndarray) -> Machine:
        """A linear machine on features as one on subsequences."""
        return Machine((self.half @ w[:-1]) @ self.base, float(w[-1]), np.zeros(5 + len(STEPS)))


def landmarks_of(bad: Counter, good: Counter, n_bad: int, n_good: int) -> list[str]:
    """Words whose shares of toxic and clean documents differ most surely, then common clean ones; none without the former."""

    def surprise(w: str) -> float:
        a, b = bad[w], good[w]
        rate = (a + b) / (n_bad + n_good)
        if a / n_bad <= rate:
            return 0.0
        term = lambda k, n: k * math.log(k / (n * rate)) if k else 0.0
        return 2 * (term(a, n_bad) + term(b, n_good) + term(n_bad - a, n_bad * (1 - rate) / rate) + term(n_good - b, n_good * (1 - rate) / rate))

    ranked = sorted(((surprise(w), w) for w in bad if bad[w] > 2), reverse=True)
    apart = [w for s, w in ranked[: LANDMARKS * 2 // 3] if s > 12]
    common = [w for w, _ in sorted(good.items(), key=lambda x: (-x[1], x[0])) if w not in apart and len(w) > 1]
    return [p for w in apart + common[: LANDMARKS - len(apart)] for p in parts_of(w)][:LANDMARKS] if apart else []


def fit(all_texts: list[str], toxic: np.ndarray) -> Machine | None:
    """All of training; deterministic. None without documents of both kinds or a word that tells them apart."""
    if not toxic.any() or toxic.all():
        return None
    one: dict[str, str] = {}  # a word that many documents hold is kept once
    fits = np.arange(len(all_texts)) % 5 < 3  # the others fit the curve
    bags = [[[one.setdefault(v, v) for v in x] for x in sentences(t)] if use else [] for t, use in zip(all_texts, fits, strict=True)]
    del one
    bad, good = Counter(), Counter()
    for bag, y in zip(bags, toxic, strict=True):
        (bad if y else good).update({v for x in bag for v in x})
    n_bad, n_good = max(1, int((toxic & fits).sum())), max(1, int((~toxic & fits).sum()))
    landmarks = landmarks_of(bad, good, n_bad, n_good)
    if not landmarks:
        return None
    features = Nystrom(landmarks)

    # Labelled sentences, by the mean of their words' features: the shortest say most of a word.
    start = []
    for kind in (True, False):
        own = sorted((x for bag, y in zip(bags, toxic, strict=True) if y == kind for x in bag), key=lambda x: (len(x), x))
        start += [(x, kind) for x in own[:: max(1, len(own) // SENTENCES)][:SENTENCES]]
    listed = sorted({v for x, _ in start for v in x})
    split = [(i, p) for i, v in enumerate(listed) for p in parts_of(v)]
    rows = features([p for _, p in split]).astype(np.float32)
    owner, row_of = np.array([i for i, _ in split]), {v: i for i, v in enumerate(listed)}
    word_rows = np.zeros((len(listed), rows.shape[1]), np.float32)
    np.add.at(word_rows, owner, rows / np.bincount(owner)[owner][:, None])
    x = np.array([word_rows[[row_of[v] for v in words]].mean(axis=0) for words, _ in start], float)
    y = np.array([1.0 if kind else -1.0 for _, kind in start])
    machine = features.machine(squared_hinge(x, y, np.where(y > 0, (y < 0).sum() / max(1, (y > 0).sum()), 1.0), 0.03))
    del start, listed, split, rows, word_rows, x

    # Multiple instances: the best words of the most toxic sentences against clean words.
    clean = [w for w, _ in sorted(good.items(), key=lambda x: (-x[1], x[0])) if len(w) > 1]
    vocabulary = sorted({*bad, *good})
    for _ in range(ROUNDS):
        value = dict(zip(vocabulary, machine.judge(vocabulary).tolist(), strict=True))
        seen = Counter()
        for bag, toxic_ in zip(bags, toxic, strict=True):
            if toxic_:
                best = sorted(((value[v], v) for v in {max(x, key=lambda v: (value[v], v)) for x in bag}), reverse=True)
                seen.update(v for _, v in best[:WITNESSES] if bad[v] / n_bad > 3 * good[v] / n_good)
        witnesses = sorted(seen)
        if not witnesses:
            return None
        hard = sorted(good, key=lambda v: (-value[v], v))[:HARD]
        negative = sorted({v for v in hard if bad[v] / n_bad <= 3 * good[v] / n_good} | set(clean[:: max(1, len(clean) // SPREAD)][:SPREAD]))
        more = [v for v in bent(witnesses) if not good[v]]
        some = [(p, 1.0, n) for v, n in [*((v, math.sqrt(seen[v])) for v in witnesses), *((v, 1.0) for v in more)] for p in parts_of(v)]
        some += [(p, -1.0, 1.0) for v in negative for p in parts_of(v)]
        y, n = np.array([k for _, k, _ in some]), np.array([n for *_, n in some])
        weight = n * np.where(y > 0, (y < 0).sum() / n[y > 0].sum() / 4, 1.0)
        machine = features.machine(squared_hinge(features([p for p, *_ in some]), y, weight, 0.3))
    del bags, vocabulary, value, hard, clean, bad, good, features, some
    evidence = np.vstack([machine.evidence(all_texts[i : i + 200]) for i in range(0, len(all_texts), 200)])
    held = ~fits if (toxic & ~fits).any() and (~toxic & ~fits).any() else np.ones(len(all_texts), bool)
    machine.curve = logistic(evidence[held], toxic[held].astype(float))
    machine.known = {}
    return machine


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def spread(text: Column, longest: int) -> Column:
    """A text of at most ``longest`` characters as it is; of a longer one stretches of some 450, evenly spread, without the cut words and sentences at their ends where they hold others."""
    pieces = max(2, longest // 450)
    part = longest // pieces - 1
    at = lambda k: F.floor(k * (F.length(text) - part) / (pieces - 1)).cast("int") + 1
    edges = rf"^(?:[^\n.!?]{{0,{part // 2}}}[\n.!?]\s+|\S*\s)|\s\S*$"
    piece = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda k: F.regexp_replace(F.substring(text, at(k), F.lit(part)), edges, ""))
    return F.when(text.isNull() | (F.length(text) <= longest), text).otherwise(F.array_join(piece, "\n"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Machine | None:
    """Fit on at most ``sample`` toxic and twice as many clean labelled documents, none held out; one text an id, ``longest`` characters of it."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    whole = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = usable.where("toxic = 1").orderBy(*by).limit(sample).union(usable.where("toxic = 0").orderBy(*by).limit(2 * sample))
    whole_texts = texts(docs).where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    got = sorted(whole_texts.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min("text").alias("text")).select("doc_id", "toxic", spread(F.col("text"), longest).alias("text")).collect())  # at most 3 * sample rows
    toxic = np.array([r.toxic == 1 for r in got], bool)
    machine = fit([r.text for r in got], toxic)
    if machine:  # the sample has more toxic rows than the labels do
        machine.curve[-1] += math.log(whole[1] / whole[0]) - math.log(toxic.mean() / (1 - toxic.mean()))
    return machine


def toxicity(docs: DataFrame, machine: Machine | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted for every row; narrow, no shuffle."""
    types = {"doc_id": pa.int64(), "score": pa.float64(), "predicted": pa.int32()}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        all_texts = [t or "" for t in got.column("text").to_pylist()]
        score = machine.scores(all_texts) if machine else np.zeros(len(all_texts))
        return batch(types, {"doc_id": got.column("doc_id"), "score": score, "predicted": (score >= threshold).astype(np.int32)})

    return arrow_map(texts(docs, id_col, text_col), rows, "doc_id long, score double, predicted int")


def reject_toxic(df: DataFrame, machine: Machine | None, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that are not predicted toxic."""

    @F.arrow_udf("boolean")
    def clean(all_texts: pa.Array) -> pa.Array:
        out = [machine.scores([t or "" for t in all_texts.slice(at, SLICE).to_pylist()]) < threshold for at in range(0, len(all_texts), SLICE)]
        return pa.array(np.concatenate(out) if out else [], pa.bool_())

    bounded_batches(df.sparkSession)
    return df.where(clean(F.col(text_col).cast("string"))) if machine else df
