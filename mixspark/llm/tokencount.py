"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece in a stretch of text; the
dynamic programme carries only the best score and its number of tokens for each
end position. Rules are those of the unigram model of the ``tokenizers`` library:
a piece wins an end position only with a strictly higher score, starts are tried
in order; a character that is no piece by itself is unknown at the lowest score
less ten; unknown characters in a row fuse, and count one token for each byte
(byte fallback).

A text becomes one sequence: a mark before it, spaces turned into marks. Where no
piece has a mark after another character, every segmentation is cut before each mark
that follows something else. With whole-number scores sums are exact in any order, so
the stretches between such cuts are solved apart, each distinct one once a worker.
With other scores a tie depends on how the sum up to there was rounded, so a text is
solved whole and added up from its start, in the library's order.

Defined cases: a null text counts as empty; an empty text has no tokens; whole
texts of any length are counted; repeated rows repeat; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from mixspark.llm.common import arrow_map, batch, texts

MARK = "▁"
#: Distinct stretches that a Python worker remembers (a speed matter only).
STRETCHES_KEPT = 400_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, in order of ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class CountViterbi:
    """Token counts of one vocabulary; ``unknown``: the place of the piece for what is not in it."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int = 0):
        whole = all(score == int(score) for _, score in pieces)
        self.pieces = {p: int(s) if whole else float(s) for p, s in reversed(pieces) if p}
        self.unknown_piece, self.unknown = pieces[unknown][0], min(self.pieces.values()) - 10
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        crossing = not whole or MARK not in self.pieces or any(regex.search(f"[^{MARK}]{MARK}", p) for p in self.pieces)
        self.bytes_known = all(f"<0x{b:02X}>" in self.pieces for b in range(256))
        if crossing:
            cuts = ".+"
        elif self.bytes_known and not any("\n" in p for p in self.pieces):  # then a line feed always stands alone
            cuts = f"\n|{MARK}*[^{MARK}\n]+|{MARK}+"
        else:
            cuts = f"{MARK}*[^{MARK}]+|{MARK}+"
        self.stretch = regex.compile(cuts, regex.DOTALL)
        self.repeats = not crossing  # stretches that come up again are worth keeping
        self.known: dict[str, tuple[int, float]] = {}

    def solve(self, text: str) -> tuple[int, float]:
        """Tokens and score of the best segmentation of one stretch.

        The automaton lists the pieces by their ends, those of one end longest
        first, so a later start wins only with a strictly higher score.
        """
        n = len(text)
        best: list[float] = [0] * (n + 1)
        count = [0] * (n + 1)
        last, singles = -1, 0
        for end, (size, score) in self.automaton.iter(text):
            start = end + 1 - size
            total = best[start] + score
            if end != last or total > best[end + 1]:
                last, best[end + 1], count[end + 1] = end, total, count[start] + 1
            if size == 1:
                singles += 1
        return (count[n], best[n]) if singles == n else self._solve_unknown(text)

    def _solve_unknown(self, text: str) -> tuple[int, float]:
        """The same where some character is no piece by itself, or the unknown piece stands in the text.

        What is unknown in a row fuses: one token if it is that piece once or bytes are
        not known, else one for each byte.
        """
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, found in self.automaton.iter(text):
            ends[end + 1].append(found)
        best: list[float] = [0] * (n + 1)
        closed, run = [0] * (n + 1), [0] * (n + 1)  # tokens before the run of unknown characters that ends here, and its start + 1
        for end in range(1, n + 1):
            won, start, unknown = None, end - 1, False
            for size, score in ends[end]:
                total = best[end - size] + score
                if won is None or total > won:
                    won, start, unknown = total, end - size, text[end - size : end] == self.unknown_piece
            if not (ends[end] and ends[end][-1][0] == 1):
                total = best[end - 1] + self.unknown
                if won is None or total > won:
                    won, start, unknown = total, end - 1, True
            best[end] = won
            if unknown:
                run[end] = run[start] or start + 1
                closed[end] = closed[start]
            else:
                closed[end] = closed[start] + self._run_tokens(text, run[start], start) + 1
        return closed[n] + self._run_tokens(text, run[n], n), best[n]

    def _run_tokens(self, text: str, begin: int, end: int) -> int:
        if not begin:
            return 0
        stretch = text[begin - 1 : end]
        return len(stretch.encode()) if self.bytes_known and stretch != self.unknown_piece else 1

    def count(self, text: str) -> tuple[int, float]:
        tokens = total = 0
        known = self.known
        if not text:
            return 0, 0
        text = MARK + text.replace(" ", MARK)
        if self.unknown_piece in text:  # it can fuse with what stands on either side of a cut
            return self._solve_unknown(text)
        for stretch in self.stretch.findall(text):
            got = known.get(stretch)
            if got is None:
                got = self.solve(stretch)
                if self.repeats:
                    if len(known) >= STRETCHES_KEPT:
                        known.clear()
                    known[stretch] = got
            tokens += got[0]
            total += got[1]
        return tokens, total


@lru_cache(2)
def count_viterbi(path: str) -> CountViterbi:
    return CountViterbi(read_pieces(path))


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the score of the best segmentation; narrow, no shuffle."""
    types = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "score": pa.float64()}

    def rows(got: pa.RecordBatch) -> pa.RecordBatch:
        model = count_viterbi(model_path)
        counts = [model.count(t or "") for t in got.column("text").to_pylist()]
        return batch(types, {"doc_id": got.column("doc_id"), "n_tokens": [c for c, _ in counts], "score": [float(s) for _, s in counts]})

    return arrow_map(texts(df, id_col, text_col), rows, "doc_id long, n_tokens long, score double")
