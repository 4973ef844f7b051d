"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved down to leaves; each leaf is encoded alone and neighbours are
joined by encoding a window round the cut again. The window grows until the
tokens outside it provably stay as they are:

* between documents' words a window edge is proven by the split pattern: no
  match of the pattern goes from a non-space to the white space after it, so
  encoding is a homomorphism at such a place whatever stands further off;
* within one match (a very long run without spaces) an edge is proven by pairs:
  a token sequence is the BPE encoding of its bytes if and only if each pair of
  neighbours is, so only the two pairs at the window's edges need a look.

Decoding concatenates token bytes up the same kind of tree.

Defined cases: a null text counts as empty; an empty text has no ids; whole
texts of any length are encoded; repeated rows give repeated results; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from mixspark.llm.common import arrow_map, batch, texts

#: Characters of a leaf; bytes of a leaf within one match.
LEAF_CHARS, LEAF_BYTES = 2048, 256

_FIELDS = {
    "n_tokens": (pa.int64(), "long"),
    "ids": (pa.list_(pa.int32()), "array<int>"),
    "decoded": (pa.binary(), "binary"),
    "ids_sha256": (pa.string(), "string"),
    "decoded_sha256": (pa.string(), "string"),
}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class TreeBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        self.leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.matches = regex.compile(pattern)
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(len(self.tokens))]
        self.pair_stands = lru_cache(1 << 16)(self._pair_stands)

    # -- texts ------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        return self._text(text, 0, len(text))

    def _text(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf_chars:
            return self.leaf.encode_ordinary(text[lo:hi])
        if self._cut_after(text, lo + 1, hi) is None:
            return self._run(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, lo, mid, hi, self._text(text, lo, mid), self._text(text, mid, hi))

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        """Encode the window between the nearest proven edges again."""
        width, start, end = 16, None, None
        while start is None:
            start = self._cut_before(text, max(lo + 1, mid - width), mid) or (lo if mid - width <= lo else None)
            width *= 2
        width = 16
        while end is None:
            end = self._cut_after(text, mid, min(hi, mid + width)) or (hi if mid + width >= hi else None)
            width *= 2
        spare, keep = len(text[start:mid].encode()), len(left)
        while spare > 0:
            keep -= 1
            spare -= len(self.tokens[left[keep]])
        over, drop = len(text[mid:end].encode()), 0
        while over > 0:
            over -= len(self.tokens[right[drop]])
            drop += 1
        if spare or over:
            raise AssertionError("a proven window edge must be a token edge")
        window = text[start:end]
        middle = self._run(window) if len(window) > self.leaf_chars else self.leaf.encode_ordinary(window)
        return left[:keep] + middle + right[drop:]

    @staticmethod
    def _cut_after(text: str, lo: int, hi: int) -> int | None:
        """First p in [lo, hi) with a non-space before and a space or line feed at p."""
        while lo < hi:
            found = [p for p in (text.find(" ", lo, hi), text.find("\n", lo, hi)) if p >= 0]
            if not found:
                return None
            p = min(found)
            if p and not text[p - 1].isspace():
                return p
            lo = p + 1
        return None

    @staticmethod
    def _cut_before(text: str, lo: int, hi: int) -> int | None:
        while lo < hi:
            p = max(text.rfind(" ", lo, hi), text.rfind("\n", lo, hi))
            if p <= 0:
                return None
            if not text[p - 1].isspace():
                return p
            hi = p
        return None

    # -- one match of the pattern -------------------------------------------

    def _run(self, text: str) -> list[int]:
        out: list[int] = []
        for match in self.matches.finditer(text):
            out += self.encode_match(match[0].encode())
        return out

    def encode_match(self, piece: bytes) -> list[int]:
        if len(piece) <= self.leaf_bytes:
            return self.leaf._encode_single_piece(piece)
        mid = len(piece) // 2
        return self._join_match(self.encode_match(piece[:mid]), self.encode_match(piece[mid:]))

    def _join_match(self, left: list[int], right: list[int]) -> list[int]:
        a = b = 4
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = b"".join(self.tokens[i] for i in left[len(left) - a :] + right[:b])
            middle = self.leaf._encode_single_piece(window)
            left_stands = a == len(left) or self.pair_stands(left[-a - 1], middle[0])
            right_stands = b == len(right) or self.pair_stands(middle[-1], right[b])
            if left_stands and right_stands:
                return left[: len(left) - a] + middle + right[b:]
            a, b = a if left_stands else 2 * a, b if right_stands else 2 * b

    def _pair_stands(self, a: int, b: int) -> bool:
        return self.leaf._encode_single_piece(self.tokens[a] + self.tokens[b]) == [a, b]

    # -- decoding -----------------------------------------------------------

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 4 * self.leaf_chars:
            return b"".join(map(self.tokens.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@lru_cache(4)
def tree_bpe(path: str, pattern: str) -> TreeBpe:
    """One per Python worker."""
    return TreeBpe(read_ranks(path), pattern)


def bpe_roundtrip(df: DataFrame, ranks_path: str, pattern: str, columns: tuple[str, ...] = ("n_tokens", "ids", "decoded"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text and decode the ids again; ``columns`` of ``_FIELDS`` follow the id.

    Narrow: no shuffle, one pass, memory of one Arrow batch.
    """
    source = texts(df, id_col, text_col)
    types = {"doc_id": pa.int64()} | {c: _FIELDS[c][0] for c in columns}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        bpe = tree_bpe(ranks_path, pattern)
        out: dict[str, list] = {c: [] for c in _FIELDS}
        for text in got.column("text").to_pylist():
            ids = bpe.encode(text or "")
            out["n_tokens"].append(len(ids))
            if "ids" in columns:
                out["ids"].append(ids)
            if "ids_sha256" in columns:
                out["ids_sha256"].append(hashlib.sha256(" ".join(map(bpe.names.__getitem__, ids)).encode()).hexdigest())
            if "decoded" in columns or "decoded_sha256" in columns:
                decoded = bpe.decode(ids)
                out["decoded"].append(decoded)
                out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
        return batch(types, {"doc_id": got.column("doc_id"), **out})

    return arrow_map(source, rows, "doc_id long, " + ", ".join(f"{c} {_FIELDS[c][1]}" for c in columns))
