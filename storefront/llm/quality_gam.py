"""Operator 8: a generalised additive model with pairwise interactions for text quality.

The features are counts and shares over a text's bytes, words and lines, made
for whole slices of documents with numpy.  The model is fitted by cyclic
boosting: in each round every feature in turn gets one shallow tree on its
histogram of gradients, and the trees of a feature add up to one lookup table.
Then the pairs of features with the largest gain on what is left get tables of
their own in the same way.  Scoring is a sum of table entries.

The model is fitted on the driver on a bounded sample of the labelled rows
(``Fit.max_rows``); features and scores of all documents are made on the
executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .corpus_io import doc_crc

FEATURES = ("log_bytes", "upper", "digit", "blank", "newline", "sentence", "exclaim", "bar", "symbol", "quote",
            "other_sign", "high_byte", "words", "word_bytes", "long_word", "short_word", "sign_word", "upper_word",
            "distinct_word", "distinct_line", "line_words", "starts_upper", "ends_stop", "bracket")

_CLASS = np.zeros((12, 256), dtype=bool)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:?", b"!", b"|",
                             b"#$%&*@^~+=<>\\_", b"\"'`", b"-/", bytes(range(128, 256)), b"()[]{}")):
    _CLASS[_k, list(_chars)] = True
_SIGN = _CLASS[[5, 6, 7]].any(axis=0)
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text; an empty text has all zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0] = np.log1p(size)
    if len(data) == 0:
        return out
    some = np.maximum(size, 1)
    per_class = [np.diff(np.concatenate(([0], np.cumsum(c[data])))[offsets]) for c in _CLASS]
    for k, column in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 23)):
        out[:, column] = per_class[k] / some
    starts, ends, doc = tv.words(data, offsets)
    count = np.bincount(doc, minlength=n)
    words = np.maximum(count, 1)
    length = ends - starts
    out[:, 12] = np.log1p(count)
    out[:, 13] = np.bincount(doc, length, n) / words
    out[:, 14] = np.bincount(doc, length > 12, n) / words
    out[:, 15] = np.bincount(doc, length <= 2, n) / words
    out[:, 16] = np.bincount(doc, _SIGN[data[ends - 1]], n) / words
    out[:, 17] = np.bincount(doc, _CLASS[0][data[starts]] & _CLASS[0][data[np.minimum(starts + 1, ends - 1)]], n) / words
    out[:, 18] = _distinct(tv.word_hashes(tv.LOWER[data], starts, ends), doc, n) / words
    line_start = np.zeros(len(data), dtype=bool)
    line_start[offsets[:-1][size > 0]] = True
    line_start[1:] |= data[:-1] == 10
    lines = np.flatnonzero(line_start)
    line_doc = np.searchsorted(offsets, lines, side="right") - 1
    n_lines = np.maximum(np.bincount(line_doc, minlength=n), 1)
    out[:, 19] = _distinct(tv.span_hashes(tv.BYTE_HASH[data], lines), line_doc, n) / n_lines
    out[:, 20] = np.log1p(count / n_lines)
    full = size > 0
    out[full, 21] = _CLASS[0][data[offsets[:-1][full]]]
    out[full, 22] = _STOP[data[offsets[1:][full] - 1]]
    return out


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct hashes in each document."""
    order = np.argsort(hashes)
    h, d = hashes[order], doc[order]
    order = np.argsort(d, kind="stable")
    h, d = h[order], d[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d, new, n)


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit; ``max_rows`` bounds the labelled rows that it sees."""

    max_rows: int = 30_000
    bins: int = 48
    pair_bins: int = 12
    rounds: int = 60
    pair_rounds: int = 20
    pairs: int = 8
    rate: float = 0.15
    leaf: int = 15
    shrink: float = 1.0


@dataclass
class Gam:
    """The fitted model: cut points and one table for each feature and chosen pair."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1, by sums of table entries."""
        z = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            z += table[np.searchsorted(self.cuts[k], x[:, k], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[np.searchsorted(self.pair_cuts[i], x[:, i], side="right"),
                       np.searchsorted(self.pair_cuts[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _cut_points(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_split(g: np.ndarray, h: np.ndarray, c: np.ndarray, fit: Fit) -> int:
    """Split of a histogram (last axis summed) with the largest gain, 0 for none."""
    gl, hl, cl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(c)[:-1]
    if len(gl) == 0:
        return 0
    gr, hr, cr = g.sum() - gl, h.sum() - hl, c.sum() - cl
    gain = gl ** 2 / (hl + fit.shrink) + gr ** 2 / (hr + fit.shrink) - g.sum() ** 2 / (h.sum() + fit.shrink)
    gain[(cl < fit.leaf) | (cr < fit.leaf)] = 0
    best = int(np.argmax(gain))
    return best + 1 if gain[best] > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, c: np.ndarray, fit: Fit, depth: int) -> np.ndarray:
    """Leaf values of a shallow tree on one feature's histogram."""
    at = _best_split(g, h, c, fit) if depth else 0
    if at == 0:
        return np.full(len(g), g.sum() / (h.sum() + fit.shrink))
    return np.concatenate((_tree(g[:at], h[:at], c[:at], fit, depth - 1), _tree(g[at:], h[at:], c[at:], fit, depth - 1)))


def _pair_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray, fit: Fit) -> np.ndarray:
    """Four leaves at most: one split of the first feature, then one of the second on each side."""
    at = _best_split(g.sum(1), h.sum(1), c.sum(1), fit)
    out = np.empty_like(g)
    for rows in ([slice(0, at), slice(at, None)] if at else [slice(None)]):
        out[rows] = _tree(g[rows].sum(0), h[rows].sum(0), c[rows].sum(0), fit, 1)[None, :]
    return out


def fit_gam(x: np.ndarray, y: np.ndarray, fit: Fit = Fit()) -> Gam:
    """Fit by cyclic boosting; without rows of both labels the model is a constant."""
    rows, n = x.shape
    share = (y.sum() + 1) / (rows + 2)
    model = Gam(float(np.log(share / (1 - share))), [np.zeros(0)] * n, [np.zeros(1)] * n)
    if rows == 0 or y.min() == y.max():
        return model
    model.cuts = [_cut_points(x[:, k], fit.bins) for k in range(n)]
    binned = [np.searchsorted(model.cuts[k], x[:, k], side="right") for k in range(n)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    z = np.full(rows, model.base)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(binned, model.tables, strict=True)]
    for _ in range(fit.rounds):
        for k in range(n):
            if len(model.tables[k]) == 1:
                continue
            g, h = gradients()
            size = len(model.tables[k])
            step = fit.rate * _tree(np.bincount(binned[k], g, size), np.bincount(binned[k], h, size), counts[k], fit, 2)
            model.tables[k] += step
            z += step[binned[k]]

    model.pair_cuts = [_cut_points(x[:, k], fit.pair_bins) for k in range(n)]
    coarse = [np.searchsorted(model.pair_cuts[k], x[:, k], side="right") for k in range(n)]

    def cells(i: int, j: int, w: np.ndarray | None) -> np.ndarray:
        a, b = len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1
        return np.bincount(coarse[i] * b + coarse[j], w, a * b).reshape(a, b)

    g, h = gradients()
    gains = {}
    for i, j in combinations([k for k in range(n) if len(model.pair_cuts[k])], 2):
        gg, hh, cc = cells(i, j, g), cells(i, j, h), cells(i, j, None)
        step = _pair_tree(gg, hh, cc, fit)
        gains[i, j] = float((2 * step * gg - step ** 2 * hh).sum())
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:fit.pairs]
    model.pair_tables = [np.zeros((len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1)) for i, j in model.pairs]
    for _ in range(fit.pair_rounds):
        for table, (i, j) in zip(model.pair_tables, model.pairs, strict=True):
            g, h = gradients()
            step = fit.rate * _pair_tree(cells(i, j, g), cells(i, j, h), cells(i, j, None), fit)
            table += step
            z += step[coarse[i], coarse[j]]
    return model


def _arrow(docs: DataFrame, keep: list[str], text_col: str, extra: T.StructField, make, where=None) -> DataFrame:
    """``keep`` and a column that ``make`` derives from the features of each slice of texts."""
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], extra])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                made = make(features(*tv.binary_view(part.column("_text"))))
                out = pa.RecordBatch.from_arrays([*part.columns[:-1], made], names=names)
                yield out if where is None else out.filter(where(made))

    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), label_col: str = "quality", text_col: str = "text") -> Gam:
    """Fit on the labelled rows outside the held-out fold, a bounded share of them by a hash of the id."""
    usable = (labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
              .filter(doc_crc(F.col("doc_id")) % 4 != 2).select("doc_id", F.col(label_col).cast("int").alias("y")))
    n = usable.count()
    if n > fit.max_rows:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * fit.max_rows / n))
    # about ``max_rows`` ids of 12 bytes: a proven bound for the broadcast
    rows = docs.select("doc_id", F.col(text_col).alias("text")).join(F.broadcast(usable), "doc_id")
    field_ = T.StructField("features", T.ArrayType(T.DoubleType()))

    def lists(x: np.ndarray) -> pa.Array:
        at = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
        return pa.ListArray.from_arrays(at, pa.array(x.ravel(), pa.float64()))

    seen = _arrow(rows, ["doc_id", "y"], "text", field_, lists).toPandas().sort_values(["doc_id", "y"])
    x = np.array(seen.features.tolist(), dtype=np.float64).reshape(len(seen), len(FEATURES))
    return fit_gam(x, seen.y.to_numpy(dtype=np.float64), fit)


def score(docs: DataFrame, model: Gam, keep: list[str], text_col: str = "text", least: float | None = None) -> DataFrame:
    """``keep`` and ``score``, the probability of label 1; with ``least``, only rows that reach it."""
    where = None if least is None else lambda made: pa.array(made.to_numpy() >= least)
    return _arrow(docs, keep, text_col, T.StructField("score", T.DoubleType()),
                  lambda x: pa.array(model.score(x), pa.float64()), where)


def classify(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), threshold: float = 0.7) -> DataFrame:
    """Score every document: ``doc_id, held_out, score, predicted``.

    Only labelled rows outside the held-out fold (crc32 of the id mod 4 is 2) are
    learned from.  Null and empty texts have all features zero and are scored like
    any other.  Repeated rows are scored each; rows with a null id are scored and
    not held out; a null label is not learned from; without usable labels every
    score is 0.5; an empty table gives an empty result.
    """
    return score(docs, train(docs, labels, fit), ["doc_id"]).select(
        "doc_id", F.coalesce(doc_crc(F.col("doc_id")) % 4 == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
