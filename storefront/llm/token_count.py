"""Operator 10: token counts of a unigram tokenizer by a count-only Viterbi.

The vocabulary is that of a sentencepiece model file with its scores.  A text is
cut into words at white space and each word gets the word mark before it, so
words are independent.  For one word, an Aho-Corasick automaton lists the pieces
that end at each character, longest first; the dynamic program carries the best
score and the number of pieces, but no path.

Ties are the tokenizer's own: of paths to the same place the first found stays
unless a later one is better, and they are found from the leftmost start on.  A
character that is no piece counts as unknown with the least score less 10, and
unknown characters in a row are one token.

Every distinct word is solved once in a worker; texts are sums over their words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv

WORD_MARK = "▁"
UNKNOWN_PENALTY = 10.0
_WIDE_BLANK = re.compile("[\u0085   -     　]+")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a sentencepiece model and their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class CountViterbi:
    """Best score and piece count of single words."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def solve(self, word: str) -> tuple[int, float]:
        """Number of pieces and score of ``word`` with the word mark before it."""
        text = WORD_MARK + word
        n = len(text)
        best, count, fused = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0  # places whose matches are all in

        def unknown_to(end: int, single: bool, top: float | None) -> None:
            """Close place ``end``: the unknown character is the last candidate."""
            if not single:
                score = best[end - 1] + self.unknown
                if top is None or score > top:
                    best[end], fused[end] = score, True
                    count[end] = count[end - 1] + (not fused[end - 1])

        top, single = None, False
        for last, (length, piece_score) in self.automaton.iter(text):
            end = last + 1
            if end != done + 1:
                unknown_to(done + 1, single, top)
                for skipped in range(done + 2, end):
                    unknown_to(skipped, False, None)
                done, top, single = end - 1, None, False
            start = end - length
            score = best[start] + piece_score
            if top is None or score > top:
                top = best[end] = score
                count[end], fused[end] = count[start] + 1, False
            single = single or length == 1
        unknown_to(done + 1, single, top)
        for skipped in range(done + 2, n + 1):
            unknown_to(skipped, False, None)
        return count[n], best[n]

    def solve_bytes(self, word: bytes) -> tuple[int, int, float]:
        """Words, pieces and score of an ASCII word, which may hold other white space."""
        text = word.decode("utf-8")
        parts = [text] if text.isascii() else [p for p in _WIDE_BLANK.split(text) if p]
        solved = [self.solve(p) for p in parts]
        return len(parts), sum(c for c, _ in solved), sum(s for _, s in solved)


class SliceCounter:
    """Counts for whole slices of documents; distinct words are kept in a bounded table."""

    def __init__(self, path: str):
        self.viterbi = CountViterbi(vocabulary(path))
        self._empty()

    def _empty(self) -> None:
        self.known = tv.KeyTable()
        places = len(self.known.keys)
        self.words, self.pieces = np.zeros(places, np.int32), np.zeros(places, np.int32)
        self.score = np.zeros(places)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, pieces and score of each text."""
        n = len(offsets) - 1
        starts, ends, doc = tv.words(data, offsets)
        if len(starts) == 0:
            return np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        h = tv.word_hashes(data, starts, ends)
        h[h == 0] = 1
        keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        place = self.known.find(keys)
        new = np.flatnonzero(place < 0)
        raw = data.tobytes()
        if len(new) and not self.known.room(len(new)):
            self._empty()
            place[:] = -1
            new = np.arange(len(keys))
        solved = [self.viterbi.solve_bytes(raw[starts[i]:ends[i]]) for i in first[new]]
        w, p, s = (np.array([x[k] for x in solved]) for k in range(3))
        words, pieces, score = self.words[place], self.pieces[place], self.score[place]
        if len(new):
            words[new], pieces[new], score[new] = w, p, s
            if self.known.room(len(new)):  # else one very long text; its words are not kept
                at = self.known.add(keys[new])
                self.words[at], self.pieces[at], self.score[at] = w, p, s
        return (np.bincount(doc, words[inverse], n).astype(np.int64),
                np.bincount(doc, pieces[inverse], n).astype(np.int64), np.bincount(doc, score[inverse], n))


@lru_cache(maxsize=2)
def slice_counter(path: str) -> SliceCounter:
    """One counter for each Python worker and model file."""
    return SliceCounter(path)


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text: the id column, ``n_words``, ``n_tokens``, ``score``.

    A null or empty text has no words, no tokens and the score 0.  Repeated rows
    and null ids are counted each, very long texts whole; an empty table gives an
    empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    schema = T.StructType([rows.schema[id_col], T.StructField("n_words", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = slice_counter(model_path)
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                words, pieces, score = counter.count(*tv.binary_view(part.column("_text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), pa.array(words), pa.array(pieces), pa.array(score)], names=schema.names)

    return rows.mapInArrow(run, schema)
