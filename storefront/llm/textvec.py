"""Vectorised text primitives on Arrow batches: words, piece cuts and 64-bit hashes.

Everything works on the concatenated bytes (or code points) of a slice of an
Arrow batch, so the cost per document is a few numpy passes and no Python loop
over characters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; working memory is about 60 times as much.
SLICE_BYTES = 1 << 18
U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and odd multiplications)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BASE = U64(0x9E3779B97F4A7C15)
BYTE_HASH = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``limit`` bytes of text, one document at least."""
    col = batch.column(column)
    if len(col) == 0:
        return
    ends = np.cumsum(binary_lengths(col))
    first, base = 0, 0
    while first < len(col):
        last = int(np.searchsorted(ends, base + limit, side="right"))
        last = max(last, first + 1)
        yield batch.slice(first, last - first)
        base = int(ends[last - 1])
        first = last


def binary_lengths(col: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset:col.offset + len(col) + 1]
    return np.diff(offsets.astype(np.int64))


def binary_view(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls, and offsets that start at 0."""
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8)[offsets[0]:offsets[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    low = np.full(1 << 16, BASE, dtype=U64)
    low[0] = 1
    low = np.multiply.accumulate(low)
    high = np.full(1 << 15, np.multiply.reduce(np.array([low[-1], BASE])), dtype=U64)
    high[0] = 1
    return low, np.multiply.accumulate(high)


def span_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each span of ``values`` (uint64, 0 where a value doesn't count).

    Spans begin at ``starts`` and reach to the next one; the last to the end.
    """
    if len(starts) == 0:
        return np.zeros(0, U64)
    lengths = np.diff(np.append(starts, len(values)))
    within = np.arange(starts[0], len(values), dtype=np.int64) - np.repeat(starts, lengths)
    low, high = _powers()
    weights = low[within & 0xFFFF]
    if int(lengths.max()) > 0xFFFF:
        weights = weights * high[(within >> 16) & 0x7FFF]
    return mix64(np.add.reduceat(values[starts[0]:] * weights, starts - starts[0]))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the document of each."""
    solid = ~SPACE[data]
    if not solid.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; the bytes between words don't count."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    values = BYTE_HASH[data]
    values[SPACE[data]] = 0
    return span_hashes(values, starts) ^ mix64((ends - starts).astype(U64))


_STEP = [U64(x) for x in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                          0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93)]


def window_hashes(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words inside one document, and the first word's index."""
    if len(hashes) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    m = len(hashes) - n + 1
    out = np.zeros(m, U64)
    for k in range(n):
        out = mix64(out + hashes[k:k + m] * _STEP[k % 8]) if k % 8 == 7 else out + hashes[k:k + m] * _STEP[k % 8]
    first = np.flatnonzero(doc[:m] == doc[n - 1:])
    return mix64(out[first]), first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each document (lower-cased A-Z).

    A document with fewer than n words has its whole sequence as its one
    shingle; one without words has the empty set.
    """
    data = LOWER[data]
    starts, ends, doc = words(data, offsets)
    h = word_hashes(data, starts, ends)
    grams, first = window_hashes(h, doc, n)
    n_docs = len(offsets) - 1
    gram_cut = np.searchsorted(doc[first], np.arange(n_docs + 1))
    word_cut = np.searchsorted(doc, np.arange(n_docs + 1))
    out = []
    for d in range(n_docs):
        a, b = gram_cut[d], gram_cut[d + 1]
        if b > a:
            out.append(np.unique(grams[a:b]))
            continue
        own = h[word_cut[d]:word_cut[d + 1]]
        if len(own) == 0:
            out.append(own)
            continue
        steps = np.array(_STEP[:len(own)], U64)
        out.append(mix64(np.add.reduce(own * steps, keepdims=True) + U64(len(own))))
    return out


class KeyTable:
    """Open addressing for 64-bit hashes: a numpy table that a worker keeps between batches."""

    def __init__(self, places: int = 1 << 22):
        self.mask = places - 1
        self.keys = np.zeros(places, U64)
        self.count = 0

    def room(self, more: int) -> bool:
        """Whether the table stays at most half full with ``more`` keys."""
        return self.count + more <= (self.mask + 1) // 2

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key (none may be 0), or -1."""
        place = (keys & U64(self.mask)).astype(np.int64)
        found = self.keys[place]
        open_ = np.flatnonzero(found != keys)
        place[open_[found[open_] == 0]] = -1
        open_ = open_[found[open_] != 0]
        while len(open_):
            nxt = (place[open_] + 1) & self.mask
            found = self.keys[nxt]
            place[open_] = np.where(found == 0, -1, nxt)
            open_ = open_[(found != keys[open_]) & (found != 0)]
        return place

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Put in distinct keys that are not there yet; their places."""
        place = (keys & U64(self.mask)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[place[left]] == 0]
            self.keys[place[free]] = keys[free]  # of several at one place the last stays
            left = left[self.keys[place[left]] != keys[left]]
            place[left] = (place[left] + 1) & self.mask
        self.count += len(keys)
        return place


# --- piece cuts of the byte-level BPE pattern -------------------------------------------------

LETTER, NUMBER, OTHER, BLANK = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _char_classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    for cp in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        table[cp] = BLANK
    return table


def piece_starts(cps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of the byte-level BPE's split pattern begin.

    ``cps`` are the code points of several texts one after the other; every text
    is cut on its own.  A run of letters, numbers or other signs takes one blank
    (U+0020) before it; of white space before such a run, the last sign stands
    apart; 's 't 're 've 'm 'll 'd are pieces of their own.
    """
    if len(cps) == 0:
        return np.zeros(0, np.int64)
    n = len(cps)
    kind = _char_classes()[cps]
    first = np.zeros(n, dtype=bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = kind == BLANK
    # the last white space before a run begins a piece
    run_next = np.zeros(n, dtype=bool)
    run_next[:-1] = blank[:-1] & ~blank[1:] & ~first[1:]
    start |= run_next
    # a run that follows U+0020 begins there
    joined = np.zeros(n, dtype=bool)
    joined[1:] = run_next[:-1] & (cps[:-1] == 0x20)
    start &= ~joined
    apostrophes = np.flatnonzero((cps == 0x27) & start)
    for i in apostrophes:
        end = int(offsets[np.searchsorted(offsets, i, side="right")])
        nxt = [int(c) for c in cps[i + 1:min(i + 3, end)]]
        if nxt and nxt[0] in (0x73, 0x74, 0x6D, 0x64):
            size = 2
        elif nxt in ([0x72, 0x65], [0x76, 0x65], [0x6C, 0x6C]):
            size = 3
        else:
            continue
        start[i + 1:i + size] = False
        if i + size < n:
            start[i + size] |= bool(kind[i + size] == LETTER)
    return np.flatnonzero(start)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-32 code points of UTF-8 bytes and the texts' offsets among them."""
    lead = (data & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(lead)))
    cps = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    return cps, before[offsets]
