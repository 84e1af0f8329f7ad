"""Operator 5: toxicity by a weighted lexicon.

Texts are folded first: lower case, homoglyphs of Latin letters (Cyrillic, Greek,
full width) to the letter they resemble, digits and signs that stand for letters
to the letter, invisible characters out, all other signs to blanks.  The lexicon
holds word stems with weights.  One Aho-Corasick automaton finds all stems at the
beginning of words, of those at one word the heaviest counts, and stems inside an
exception phrase don't count.  A text's score is a logistic function of the sum of
weights and of that sum per word.

The lexicon, the exception phrases and the two coefficients are learned from
labelled rows outside the held-out fold.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .corpus_io import doc_crc

#: Letters of other scripts that look like a Latin one.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "α": "a", "β": "b", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
#: Digits and signs that stand for a letter.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "€": "e", "+": "t"}
INVISIBLE = (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0xFE00, 0xFE10))


@lru_cache(maxsize=1)
def fold_table() -> np.ndarray:
    """Code point to code point; 0 for characters that go."""
    table = np.full(0x110000, 0x20, dtype=np.uint32)
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp < 0xE000 or not (ch := chr(cp)).isalnum():
            continue
        wide = unicodedata.normalize("NFKC", ch) if 0xFF00 <= cp < 0xFFF0 or 0x1D400 <= cp < 0x1D800 else ch
        low = wide.lower()
        low = low if len(low) == 1 else ch
        low = HOMOGLYPHS.get(low, low)
        table[cp] = ord(SUBSTITUTES.get(low, low))
    for cp in range(0x80):
        low = chr(cp).lower()
        if low in SUBSTITUTES or low.isalnum():
            table[cp] = ord(SUBSTITUTES.get(low, low))
    for ch, low in SUBSTITUTES.items():
        table[ord(ch)] = ord(low)
    table[list(INVISIBLE)] = 0
    return table


def fold(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray]:
    """Folded texts as one string, each with a blank before it, and their offsets in it.

    The bytes must already begin every text with a blank.
    """
    cps, at = tv.code_points(data, offsets)
    folded = fold_table()[cps]
    gone = folded == 0
    if gone.any():
        at = at - np.concatenate(([0], np.cumsum(gone)))[at]
        folded = folded[~gone]
    return folded.astype("<u4").tobytes().decode("utf-32-le"), at


@dataclass(frozen=True)
class Learn:
    """Parameters of the fit; ``max_rows`` bounds the labelled rows that it sees."""

    max_rows: int = 20_000
    shortest: int = 4
    longest: int = 10
    least_share: float = 0.006
    least_rows: int = 3
    least_weight: float = 2.5
    most_entries: int = 4_000


@dataclass
class Lexicon:
    """Stems and their weights, exception phrases, and the logistic function."""

    stems: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    coef: tuple[float, float, float] = (-2.0, 1.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(" " + phrase + " ", (len(phrase) + 2, -1.0))
        for stem, weight in self.stems.items():
            found.add_word(" " + stem, (len(stem) + 1, weight))
        if len(found):
            found.make_automaton()
        return found


def hits(text: str, automaton: ahocorasick.Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Start and weight of every word that counts; of the stems at one word the heaviest."""
    if not len(automaton):
        return np.zeros(0, np.int64), np.zeros(0)
    raw = [(end - size + 1, weight, end) for end, (size, weight) in automaton.iter(text)]
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0)
    start = np.array([r[0] for r in raw], dtype=np.int64)
    weight = np.array([r[1] for r in raw])
    spared = weight < 0
    if spared.any():
        # words that begin inside an exception phrase don't count; the phrase's last blank is the next word's
        cover = np.zeros(len(text) + 2, dtype=np.int32)
        np.add.at(cover, start[spared], 1)
        np.add.at(cover, np.array([r[2] for r in raw], dtype=np.int64)[spared], -1)
        keep = (np.cumsum(cover)[start] == 0) & ~spared
        start, weight = start[keep], weight[keep]
    order = np.lexsort((-weight, start))
    start, weight = start[order], weight[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = start[1:] != start[:-1]
    return start[first], weight[first]


def measures(data: np.ndarray, offsets: np.ndarray, automaton: ahocorasick.Automaton) -> np.ndarray:
    """For each text: log of 1 + the sum of weights, and of 1 + 100 times that sum a word."""
    text, at = fold(data, offsets)
    start, weight = hits(text, automaton)
    n = len(offsets) - 1
    total = np.bincount(np.searchsorted(at, start, side="right") - 1, weight, n)
    starts, _, doc = tv.words(data, offsets)
    words = np.maximum(np.bincount(doc, minlength=n), 1)
    return np.column_stack((np.log1p(total), np.log1p(100 * total / words)))


def _binary(text_col: str) -> F.Column:
    return F.concat(F.lit(" "), F.coalesce(F.col(text_col), F.lit(""))).cast("binary")


_WORD = re.compile(r"\S+")


def _candidate_counts(rows: DataFrame, learn: Learn) -> DataFrame:
    """Toxic and clean documents that hold each stem (a word's first letters) or word pair."""
    schema = T.StructType([T.StructField("stem", T.StringType()), T.StructField("toxic", T.LongType()),
                           T.StructField("clean", T.LongType())])

    def flush(counts: Counter) -> pa.RecordBatch:
        stems = list({s for s, _ in counts})
        return pa.RecordBatch.from_arrays(
            [pa.array(stems, pa.string()), pa.array([counts.get((s, 1), 0) for s in stems], pa.int64()),
             pa.array([counts.get((s, 0), 0) for s in stems], pa.int64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                text, at = fold(*tv.binary_view(part.column("_text")))
                for k, y in enumerate(part.column("y").to_pylist()):
                    words = set(text[at[k]:at[k + 1]].split())
                    counts.update({(w[:n], y) for w in words for n in range(learn.shortest, learn.longest + 1)
                                   if len(w) >= n or n == learn.shortest})
                    if len(counts) > 300_000:
                        yield flush(counts)
                        counts = Counter()
        if counts:
            yield flush(counts)

    return rows.mapInArrow(run, schema).groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_stems(found: list[tuple[str, int, int]], toxic: int, clean: int, learn: Learn) -> dict[str, float]:
    """Keep the shortest stems that tell as much as the longer ones; weight: log odds."""
    weight = {s: float(np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))) for s, a, b in found}
    pure = {s: a / (a + b * (toxic + 1) / (clean + 1)) for s, a, b in found}
    chosen: dict[str, float] = {}
    for s, _, _ in sorted(found, key=lambda r: (len(r[0]), r[0])):
        if weight[s] < learn.least_weight:
            continue
        if any(s[:n] in chosen and pure[s[:n]] >= pure[s] - 0.02 for n in range(1, len(s))):
            continue
        chosen[s] = weight[s]
    top = sorted(chosen, key=lambda s: (-chosen[s], s))[:learn.most_entries]
    return {s: chosen[s] for s in top}


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> list[str]:
    """Word pairs around a stem that clean rows hold and toxic rows hardly do."""
    schema = T.StructType([T.StructField("phrase", T.StringType()), T.StructField("y", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                text, at = fold(*tv.binary_view(part.column("_text")))
                start, _ = hits(text, automaton)
                doc = np.searchsorted(at, start, side="right") - 1
                y = part.column("y").to_pylist()
                found = set()
                for s, d in zip(start.tolist(), doc.tolist(), strict=True):
                    after = [m.group() for _, m in zip(range(2), _WORD.finditer(text, s + 1, int(at[d + 1])), strict=False)]
                    before = text[max(int(at[d]), s - 40):s].split()[-1:]
                    for pair in (before + after[:1], after):
                        if len(pair) == 2:
                            found.add((" ".join(pair), d))
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()),
                                                  pa.array([y[d] for _, d in found], pa.int32())], names=schema.names)

    counted = rows.mapInArrow(run, schema).groupBy("phrase").agg(
        F.sum(F.col("y")).alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
    kept = counted.filter((F.col("clean") >= 3) & (F.col("clean") > 4 * F.col("toxic")))
    return [r.phrase for r in kept.orderBy(F.desc("clean"), "phrase").limit(2_000).collect()]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Newton's method with a small ridge."""
    a = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (y - p) - 0.05 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(h, g)
    return tuple(float(v) for v in w)


def learn_lexicon(docs: DataFrame, labels: DataFrame, learn: Learn = Learn(), text_col: str = "text") -> Lexicon:
    """Learn from labelled rows outside the held-out fold, a bounded share of them by a hash of the id."""
    usable = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .filter(doc_crc(F.col("doc_id")) % 3 != 1).select("doc_id", F.col("toxic").cast("int").alias("y")))
    n = usable.count()
    if n > learn.max_rows:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * learn.max_rows / n))
    # ``max_rows`` ids of 12 bytes: a proven bound for the broadcast
    rows = (docs.select("doc_id", _binary(text_col).alias("_text")).join(F.broadcast(usable), "doc_id")
            .select("_text", "y"))
    size = {r.y: r["count"] for r in usable.join(docs.select("doc_id"), "doc_id").groupBy("y").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    least = max(learn.least_rows, int(toxic * learn.least_share))
    odds = (F.col("toxic") + 0.5) / (toxic + 1) * (clean + 1) / (F.col("clean") + 0.5)
    found = (_candidate_counts(rows, learn).filter((F.col("toxic") >= least) & (odds >= float(np.exp(learn.least_weight))))
             .orderBy(F.desc(F.col("toxic") * F.log(odds)), "stem").limit(50 * learn.most_entries))
    stems = choose_stems([(r.stem, r.toxic, r.clean) for r in found.collect()], toxic, clean, learn)
    lexicon = Lexicon(stems)
    if not stems:
        return lexicon
    lexicon.exceptions = _exceptions(rows, lexicon)
    sample = _measured(rows, ["y"], lexicon).orderBy("y", "m0", "m1").toPandas()
    lexicon.coef = _logistic(sample[["m0", "m1"]].to_numpy(), sample.y.to_numpy(dtype=np.float64))
    return lexicon


def _measured(rows: DataFrame, keep: list[str], lexicon: Lexicon) -> DataFrame:
    """``keep`` and the two measures of column ``_text``."""
    schema = T.StructType([*(rows.schema[k] for k in keep), T.StructField("m0", T.DoubleType()),
                           T.StructField("m1", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                m = measures(*tv.binary_view(part.column("_text")), automaton)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(m[:, 0]), pa.array(m[:, 1])],
                                                 names=schema.names)

    return rows.select(*keep, "_text").mapInArrow(run, schema)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """Score every whole text: the id column, ``held_out``, ``score``, ``predicted``.

    A null or empty text has no hits and gets the base score.  Repeated rows and
    null ids are scored each (a null id is not held out); an empty table gives an
    empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col), _binary(text_col).alias("_text"))
    b, c0, c1 = lexicon.coef
    z = F.lit(b) + c0 * F.col("m0") + c1 * F.col("m1")
    return (_measured(rows, [id_col], lexicon).withColumn("score", 1 / (1 + F.exp(-z)))
            .select(id_col, F.coalesce(doc_crc(F.col(id_col)) % 3 == 1, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
