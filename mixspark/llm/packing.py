"""Packing token streams into sequences: concatenate and cut.

Pass one tokenises; each task writes its documents' ids with the count of ids
before them in its partition. The partition totals (one number a partition) are
summed up to global offsets. Pass two cuts the one long stream at fixed windows:
a document that crosses a window's end leaves a boundary record in each window.
All sequences but the last are full, so padding is less than one sequence.

Defined cases: a null text counts as empty; an empty text is its end id alone;
a document of any length is cut freely; repeated rows and rows of equal ids are packed
each as a document of its own; an empty table gives no pieces; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import json
import os
import string
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mixspark.llm.common import arrow_map, batch, bounded_batches, materialise, slices, texts

#: Distinct words whose ids a Python worker remembers (a speed matter only).
WORDS_KEPT = 500_000

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark spreads the work, not the tokenizer


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class RankedWords:
    """A merge table with word ends as a rank table, for common Latin words.

    A word end becomes byte 0xFF, which UTF-8 never holds, joined to the last byte
    before anything else. Merging by ranks gives what merging by listed pairs does
    as long as every token in the table is what its own bytes merge to; tokens that
    are not can never come up and are left out.
    """

    END = b"\xff"

    def __init__(self, model: dict, pattern: str):
        letters, suffix, vocab = byte_letters(), model["end_of_word_suffix"], model["vocab"]
        pairs = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + self.END: 256 + b for b in range(256) if b != 255}
        self.ids = {b: vocab[c] for c, b in letters.items()} | {256 + b: vocab[c + suffix] for c, b in letters.items()}
        for (left, right), i in pairs.items():
            token = left + right
            ends = token.endswith(suffix)
            body = token[: -len(suffix)] if ends else token
            if self._merged([*body[:-1], body[-1] + suffix * ends], pairs) == [token]:
                ranks[bytes(letters[c] for c in body) + self.END * ends] = 512 + i
                self.ids[512 + i] = vocab[token]
        self.core = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})
        self.parts = regex.compile(pattern)
        self.common = regex.compile("[!-~\u00a1-\u00ac\u00ae-\u024f]+")
        words = [string.ascii_lowercase, "naïve", *("a s re ve m ll d".split())]
        self.letters_stay = all(self.parts.findall(x + c) == [x, c][: 1 + len(c)] for x in words for c in ("", *string.punctuation))
        self.ends = {c: self._ids(c) for c in string.punctuation}

    def _ids(self, part: str) -> list[int]:
        return list(map(self.ids.__getitem__, self.core._encode_single_piece(part.encode() + self.END)))

    @staticmethod
    def _merged(symbols: list[str], pairs: dict) -> list[str]:
        while len(symbols) > 1:
            rank, at = min((pairs.get(p, len(pairs)), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == len(pairs):
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    def encode(self, word: str) -> bytes | None:
        """None: not a word of this kind."""
        if self.letters_stay and word:  # letters, or letters and one mark: no need to search for parts
            low, end = word.lower(), self.ends.get(word[-1])
            body = low if end is None else low[:-1]
            if body.isalpha() and (body.isascii() or max(body) <= "\u024f"):
                return array("I", self._ids(body) + (end or [])).tobytes()
        if not self.common.fullmatch(word):
            return None
        if not word.isascii():
            word = "".join(c.lower() for c in unicodedata.normalize("NFC", word))
        out: list[int] = []
        for part in self.parts.findall(word.lower() if word.isascii() else word):
            out += self._ids(part)
        return array("I", out).tobytes()


class WordCache(dict):
    """Ids of words (little-endian unsigned 32-bit), for tokenizers that drop white space between words.

    Such a tokenizer treats each stretch between spaces and line feeds by itself,
    so a stretch is encoded once and its ids are looked up after that. Common words
    are merged by a rank table, all others by the tokenizer itself. Words of the last
    generation that come up again stay known.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.before: dict[str, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        steps = spec["pre_tokenizer"].get("pretokenizers", [{}])
        plain = [n["type"] for n in spec["normalizer"].get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and spec["model"].get("end_of_word_suffix") and steps[0].get("invert")
        self.ranked = RankedWords(spec["model"], steps[0]["pattern"]["Regex"]) if plain else None

    def __missing__(self, word: str) -> bytes:
        got = self.before.get(word)
        if got is None and self.ranked:
            got = self.ranked.encode(word)
        if got is None:
            got = np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = got
        return got

    def encode(self, texts_: list[str]) -> list[bytes]:
        """Ids of each text."""
        out = []
        for t in texts_:
            out.append(b"".join(map(self.__getitem__, t.replace("\n", " ").split(" "))))
            if len(self) > WORDS_KEPT // 2:
                self.before = dict(self)
                self.clear()
        return out


@lru_cache(2)
def word_cache(path: str) -> WordCache:
    return WordCache(path)


def token_stream(df: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its ids and the ids before it in its partition."""
    types = {"part": pa.int32(), "before": pa.int64(), "doc_id": pa.int64(), "doc_tokens": pa.int64(), "ids": pa.binary()}
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for whole in batches:
            for got in slices(whole):
                ids = [x + end for x in word_cache(tokenizer_path).encode([t or "" for t in got.column("text").to_pylist()])]
                counts = np.asarray([len(x) // 4 for x in ids], np.int64)
                before = total + np.cumsum(counts) - counts
                total += int(counts.sum())
                yield batch(types, {"part": [part] * len(ids), "before": before, "doc_id": got.column("doc_id"), "doc_tokens": counts, "ids": ids})

    bounded_batches(df.sparkSession)
    return texts(df, id_col, text_col).mapInArrow(run, "part int, before long, doc_id long, doc_tokens long, ids binary")


def pack(df: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 1, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    spark = df.sparkSession
    stream = materialise(token_stream(df, tokenizer_path, end_id, id_col, text_col), "token-stream")
    # One number a partition: the only thing that passes the driver.
    totals = sorted((r.part, r.total) for r in stream.groupBy("part").agg(F.sum("doc_tokens").alias("total")).collect())
    base, at = [], 0
    for part, total in totals:
        base.append((part, at))
        at += total
    bases = spark.createDataFrame(base, "part int, base long")
    types = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
    if keep_ids:
        types["ids"] = pa.list_(pa.int32())

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in types}
        for doc, first, total, ids in zip(*(got.column(c).to_pylist() for c in ("doc_id", "at", "doc_tokens", "ids")), strict=True):
            view, start = memoryview(ids), 0
            while start < total:
                sequence, offset = divmod(first + start, length)
                n = min(length - offset, total - start)
                piece = view[4 * start : 4 * (start + n)]
                for k, v in (("doc_id", doc), ("start", start), ("length", n), ("ids_crc32", zlib.crc32(piece)), ("doc_tokens", total), ("sequence_id", sequence), ("offset", offset)):
                    out[k].append(v)
                if keep_ids:
                    out["ids"].append(np.frombuffer(piece, "<u4").astype(np.int32))
                start += n
        return batch(types, out)

    placed = stream.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("at"), "doc_tokens", "ids")
    return arrow_map(placed, rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * keep_ids)
