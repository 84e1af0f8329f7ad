"""Operator 3: benchmark decontamination by template canonicalisation.

Texts and benchmark items are cut into words and every word becomes its
canonical form: numbers, units after a number and names inside a sentence become
a typed placeholder, all other words their lower-case form without marks around
them.  Every run of ``Rule.window`` canonical words is hashed.  The windows of the
benchmark items are the build side of a hash join and are probed with the windows
of all documents in the scan's own tasks, so documents are not shuffled.

For the windows that meet, the words behind placeholders are set side by side:
a re-parameterised item must replace the same value by the same value everywhere.
A document holds an item if enough of the item's windows meet and enough of its
slots are consistent, at one occurrence (meetings of about one distance between the
document's and the item's word) or over all places together.

Items without a window of enough words that are no placeholder (short ones and those
dense in numbers, units and names) are met as a whole: one of their windows leads to the
place, where every word is compared in its canonical form.  Items of placeholders only
are met word for word.

The build side has a bound: items are taken in blocks of ``Rule.block_words`` words
at most, and every block meets all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv


@dataclass(frozen=True)
class Rule:
    """When a document holds a benchmark item."""

    window: int = 8
    #: Words of a window that must not be placeholders.
    literal: int = 5
    #: Share of an item's windows that must meet, but never more than ``windows`` of them.
    share: float = 0.5
    windows: int = 6
    #: Share of slots that must follow one substitution.
    consistent: float = 0.8
    block_words: int = 2_000_000


_TRIM = np.zeros(256, dtype=bool)
_TRIM[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_IN_NUMBER = _DIGIT.copy()
_IN_NUMBER[list(b".,%/:-+$")] = True
_END = np.zeros(256, dtype=bool)
_END[list(b".!?:;|")] = True
UNITS = ("mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "sec", "min", "h", "hr", "hours", "hour", "minutes",
         "seconds", "days", "day", "weeks", "week", "months", "month", "years", "year", "miles", "mile", "feet", "foot",
         "inches", "inch", "pounds", "pound", "ounces", "dollars", "dollar", "euros", "euro", "cents", "percent",
         "degrees", "meters", "metres", "grams", "liters", "litres", "kilometers", "kilograms")
#: Numbers in words; "one" and "a" are too often something else.
NUMBER_WORDS = ("zero", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
                "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty",
                "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion", "dozen")
PLACEHOLDERS = tv.mix64(np.array([11, 12, 13, 14], dtype=np.uint64))  # number, unit, name, number with its unit
NUMBER, UNIT, NAME, MEASURE = 1, 2, 3, 4
#: UTF-8 of currency signs that stand at a number.
CURRENCIES = ("€", "£", "¥")


@lru_cache(maxsize=1)
def _cases() -> tuple[np.ndarray, np.ndarray]:
    """Which of the code points under 0x800 (one or two bytes of UTF-8) are capitals and which small letters."""
    chars = [chr(c) for c in range(0x800)]
    return np.array([c.isupper() for c in chars]), np.array([c.islower() for c in chars])


def _code_point(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point (0 from 0x800 on) and number of bytes of the character at each place."""
    one, two = data[at].astype(np.int64), data[np.minimum(at + 1, len(data) - 1)].astype(np.int64)
    size = np.select([one < 0x80, one < 0xE0, one < 0xF0], [1, 2, 3], 4)
    return np.select([size == 1, size == 2], [one, (one & 0x1F) << 6 | two & 0x3F], 0), size


def _currency_bytes(data: np.ndarray) -> np.ndarray:
    """Bytes that belong to a currency sign."""
    out = np.zeros(len(data), dtype=bool)
    for sign in CURRENCIES:
        raw = np.frombuffer(sign.encode(), dtype=np.uint8)
        at = np.flatnonzero(data[:len(data) - len(raw) + 1] == raw[0]) if len(data) >= len(raw) else np.zeros(0, np.int64)
        for k in range(1, len(raw)):
            at = at[data[at + k] == raw[k]]
        for k in range(len(raw)):
            out[at + k] = True
    return out


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and documents of words, their own hashes, canonical hashes and kinds of placeholder."""
    starts, ends, doc = tv.words(data, offsets)
    if len(starts) == 0:
        return starts, ends, doc, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = tv.LOWER[data]
    # bytes that are marks at a word's beginning or end don't count
    solid = ~tv.SPACE[data] & ~_TRIM[data] & ~_currency_bytes(data)
    place = np.arange(len(data))
    first = np.minimum.reduceat(np.where(solid, place, len(data)), starts)
    last = np.maximum.reduceat(np.where(solid, place, -1), starts)
    empty = last < first
    first, last = np.where(empty, starts, first), np.where(empty, ends - 1, last)
    inner = np.zeros(len(data) + 1, dtype=np.int8)
    inner[first] += 1
    inner[last + 1] -= 1
    values = np.where(np.cumsum(inner[:-1]) > 0, tv.BYTE_HASH[low], np.uint64(0))
    # the hash weighs a byte by its place in the span: spans begin at the first byte that counts
    own = tv.span_hashes(values, first) ^ tv.mix64((last - first + 1).astype(np.uint64))
    digits = np.add.reduceat(_DIGIT[data].astype(np.int32) * (values != 0), first)
    numeric = np.add.reduceat((_IN_NUMBER[data] & (values != 0)).astype(np.int32), first)
    length = last - first + 1
    is_number = (digits > 0) & (numeric == length) | np.isin(own, _hashes_of(NUMBER_WORDS))
    # a number with its unit in one word: what follows its last digit is a unit
    is_measure = np.zeros(len(starts), dtype=bool)
    some = np.flatnonzero((digits > 0) & (numeric < length) & _DIGIT[data[first]])
    if len(some):
        tail = np.maximum.reduceat(np.where(_DIGIT[data] & (values != 0), place, -1), first)[some] + 1
        inner = np.zeros(len(data) + 1, dtype=np.int8)
        np.add.at(inner, tail, 1)
        np.add.at(inner, last[some] + 1, -1)
        ends_in = tv.span_hashes(np.where(np.cumsum(inner[:-1]) > 0, tv.BYTE_HASH[low], np.uint64(0)), tail)
        ends_in = ends_in ^ tv.mix64((last[some] + 1 - tail).astype(np.uint64))
        letters = length[some] - (last[some] + 1 - tail) == numeric[some]
        is_measure[some] = (tail <= last[some]) & letters & np.isin(ends_in, _hashes_of(UNITS))
    is_unit = np.zeros(len(starts), dtype=bool)
    is_unit[1:] = is_number[:-1] & (doc[1:] == doc[:-1]) & np.isin(own[1:], _hashes_of(UNITS))
    capital, small = _cases()
    letter, size = _code_point(data, first)
    second = np.minimum(first + size, len(data) - 1)
    longer = first + size <= last
    follows = np.zeros(len(starts), dtype=bool)
    follows[1:] = (doc[1:] == doc[:-1]) & ~_END[data[ends[:-1] - 1]] & (data[np.maximum(starts[1:] - 1, 0)] != 10)
    is_name = capital[letter] & longer & small[_code_point(data, second)[0]] & follows & ~is_number & ~is_measure
    kind = np.select([is_number, is_measure, is_unit, is_name], [NUMBER, MEASURE, UNIT, NAME], 0)
    return starts, ends, doc, own, np.where(kind > 0, PLACEHOLDERS[np.maximum(kind, 1) - 1], own), kind


@lru_cache(maxsize=8)
def _hashes_of(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    starts, ends, _ = tv.words(data, np.array([0, len(data)]))
    return tv.word_hashes(data, starts, ends)


@dataclass
class Index:
    """Windows of benchmark items: sorted hashes, the item and first word of each."""

    items: list
    hashes: np.ndarray
    item: np.ndarray
    word: np.ndarray
    n_windows: np.ndarray
    #: Items met as a whole: length of a window and whether of own hashes, to sorted hashes, the item and the window's place.
    whole: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray, np.ndarray]]
    own: np.ndarray
    canon: np.ndarray
    kind: np.ndarray
    first_word: np.ndarray


def _windows(canon: np.ndarray, kind: np.ndarray, doc: np.ndarray, n: int, literal: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the windows with enough words that are no placeholders."""
    h, first = tv.window_hashes(canon, doc, n)
    plain = np.concatenate(([0], np.cumsum(kind == 0)))
    keep = plain[first + n] - plain[first] >= min(n, literal)
    return h[keep], first[keep]


def _probes(own: np.ndarray, canon: np.ndarray, kind: np.ndarray, n: int) -> Iterator[tuple[bool, int, int]]:
    """Windows that lead to an item met as a whole: whether of own hashes, the hash and the place in the item."""
    n = min(n, len(kind))
    doc = np.zeros(n, np.int64)
    plain = kind == 0
    if not plain.any():
        yield True, int(tv.window_hashes(own[:n], doc, n)[0][0]), 0
        return
    at = int(np.argmax(np.convolve(plain, np.ones(n, np.int64), "valid")))
    # inside a document an item's first word can look like a name or unit
    heads = {int(canon[at])} | ({int(PLACEHOLDERS[k - 1]) for k in (UNIT, NAME)} if at == 0 else set())
    for head in sorted(heads):
        words = canon[at:at + n].copy()
        words[0] = head
        yield False, int(tv.window_hashes(words, doc, n)[0][0]), at


def build_index(items: list, texts: list[bytes], rule: Rule) -> Index:
    """Index the items of one block."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    _, _, doc, own, canon, kind = canonical(data, offsets)
    first_word = np.searchsorted(doc, np.arange(len(items) + 1))
    h, first = _windows(canon, kind, doc, rule.window, rule.literal)
    order = np.argsort(h, kind="stable")
    n_windows = np.bincount(doc[first], minlength=len(items)) if len(first) else np.zeros(len(items), np.int64)
    whole: dict[tuple[int, bool], list[tuple[int, int, int]]] = {}
    for i in np.flatnonzero((n_windows == 0) & (np.diff(first_word) > 0)).tolist():
        a, b = first_word[i], first_word[i + 1]
        for verbatim, value, at in _probes(own[a:b], canon[a:b], kind[a:b], rule.window):
            whole.setdefault((min(rule.window, int(b - a)), verbatim), []).append((value, i, at))
        n_windows[i] = 1
    sorted_whole = {}
    for key, known in whole.items():
        known.sort()
        value, item, at = zip(*known, strict=True)
        sorted_whole[key] = np.array(value, np.uint64), np.array(item), np.array(at)
    return Index(items, h[order], doc[first][order], first[order], n_windows, sorted_whole, own, canon, kind, first_word)


def _occurrences(met: list[tuple[int, int, int]], slack: int) -> list[list[tuple[int, int, int]]]:
    """The meetings of one document and item by occurrence: those of one distance, and runs of near distances.

    A run goes on with a later word of the document and of the item whose distance
    differs by at most ``slack`` words, the nearest one first.
    """
    lines: dict[int, list[tuple[int, int, int]]] = {}
    for m in met:
        lines.setdefault(m[0] - m[1], []).append(m)
    if len(lines) == 1:
        return list(lines.values())
    reach = 2 * max(w + n for _, w, n in met) + slack
    runs: list[list[tuple[int, int, int]]] = []
    live: list[list[tuple[int, int, int]]] = []
    here: dict[int, list[tuple[int, int, int]]] = {}
    for m in met:
        here.setdefault(m[0], []).append(m)
    for p in sorted(here):
        live = [r for r in live if p - r[-1][0] <= reach]
        pairs = sorted((abs(r[-1][0] - r[-1][1] - m[0] + m[1]), -r[-1][0], i, k) for i, r in enumerate(live)
                       for k, m in enumerate(here[p]) if r[-1][1] < m[1])
        grown, placed = set(), set()
        for far, _, i, k in pairs:
            if far <= slack and i not in grown and k not in placed:
                live[i].append(here[p][k])
                grown.add(i)
                placed.add(k)
        new = [[m] for k, m in enumerate(here[p]) if k not in placed]
        live += new
        runs += new
    return runs + list(lines.values())


def _meetings(known: np.ndarray, h: np.ndarray) -> Iterator[tuple[int, int]]:
    """Places in ``h`` and in the sorted ``known`` of equal hashes."""
    if len(known) == 0 or len(h) == 0:
        return
    a = np.searchsorted(known, h, side="left")
    met = np.flatnonzero(known[np.minimum(a, len(known) - 1)] == h)
    ends = np.searchsorted(known, h[met], side="right")
    for m, b in zip(met.tolist(), ends.tolist(), strict=True):
        for k in range(int(a[m]), b):
            yield m, k


def find(data: np.ndarray, offsets: np.ndarray, index: Index, rule: Rule) -> list[tuple]:
    """(document, item, windows met, windows of the item, slots, consistent slots, first byte, end byte)."""
    starts, ends, doc, own, canon, kind = canonical(data, offsets)
    pairs: dict[tuple[int, int], list[tuple[int, int, int]]] = {}  # (doc, item): (document's word, item's word, length)
    h, first = _windows(canon, kind, doc, rule.window, rule.literal)
    for m, k in _meetings(index.hashes, h):
        pairs.setdefault((int(doc[first[m]]), int(index.item[k])), []).append((int(first[m]), int(index.word[k]), rule.window))
    for (n, verbatim), (hashes, items, places) in index.whole.items():
        h, first = tv.window_hashes(own if verbatim else canon, doc, n)
        for m, k in _meetings(hashes, h):
            item, p = int(items[k]), int(first[m] - places[k])
            a, b = int(index.first_word[item]), int(index.first_word[item + 1])
            q = p + b - a
            if p < 0 or q > len(doc) or doc[p] != doc[q - 1]:
                continue
            same = own[p:q] == index.own[a:b]
            if not verbatim:
                same[1:] = canon[p + 1:q] == index.canon[a + 1:b]
                same[0] |= canon[p] == index.canon[a]
            if same.all():
                pairs.setdefault((int(doc[p]), item), []).append((p, a, b - a))
    found = []
    for (d, item), met in pairs.items():
        total = int(index.n_windows[item])
        least = min(rule.windows, max(1, np.ceil(rule.share * total)))

        def slots_of(part: list[tuple[int, int, int]]) -> tuple[int, int]:
            slots = {(int(index.own[w + k]), int(own[p + k])) for p, w, n in part for k in range(n) if index.kind[w + k]}
            to, of = Counter(x for x, _ in slots), Counter(y for _, y in slots)
            return len(slots), sum(to[x] == 1 and of[y] == 1 for x, y in slots)

        if len({w for _, w, _ in met}) < least:
            continue
        sized = [(len({w for _, w, _ in part}), part) for part in _occurrences(met, rule.window)]
        sized = sorted((x for x in sized if x[0] >= least), key=lambda x: (-x[0], x[1][0][0]))
        for windows, met in [*sized, (len({w for _, w, _ in met}), met)]:
            n_slots, good = slots_of(met)
            if good >= rule.consistent * n_slots:
                break
        else:
            continue
        begin, end = min(p for p, _, _ in met), max(p + n - 1 for p, _, n in met)
        found.append((d, item, windows, total, n_slots, good, int(starts[begin] - offsets[d]),
                      int(ends[end] - offsets[d])))
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and benchmark item that it holds.

    Returns ``doc_id, item_id, windows_met, item_windows, slots,
    consistent_slots, first_byte, end_byte`` (of the text's UTF-8 bytes).  Null
    and empty texts and items hold nothing and are held by nothing; items without
    a window of enough plain words are met as a whole, those of placeholders only word for word; repeated rows of documents are
    reported each, repeated items once; an empty table on either side gives an
    empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    items = (benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
             .filter(F.trim("text") != "").dropDuplicates())
    n_words = items.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first().n or 0
    blocks = -(-n_words // rule.block_words) or 1
    id_type, item_type = rows.schema["doc_id"].dataType, items.schema["item_id"].dataType
    names = ["windows_met", "item_windows", "slots", "consistent_slots", "first_byte", "end_byte"]
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("item_id", item_type),
                           *(T.StructField(n, T.LongType()) for n in names)])
    spark = docs.sparkSession

    def one_block(block: int) -> DataFrame:
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(build_index([r.item_id for r in own], [r.text.encode() for r in own], rule))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in tv.text_slices(batch, "_text"):
                    found = find(*tv.binary_view(part.column("_text")), index, rule)
                    if found:
                        ids = part.column("doc_id").take(pa.array([f[0] for f in found]))
                        item = pa.array([index.items[f[1]] for f in found])
                        yield pa.RecordBatch.from_arrays(
                            [ids, item, *(pa.array([f[k] for f in found], pa.int64()) for k in range(2, 8))], names=schema.names)

        return rows.mapInArrow(run, schema)

    return reduce(DataFrame.unionByName, [one_block(b) for b in range(blocks)])
