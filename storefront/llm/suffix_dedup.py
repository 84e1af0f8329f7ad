"""Operator 4: repeated passages by common-prefix interval trees of suffix arrays.

A passage is repeated when a string of ``Rule.length`` bytes starts at two places
of the corpus.  The work is cut so that equal strings always meet in one task:

1. Every window of ``length`` bytes has an anchor, the k-gram with the least hash in
   it.  Equal windows have equal anchors, whatever stands around them.  Windows in
   a row with one anchor form a segment of 200 to 368 bytes.
2. Segments that are equal as a whole are repeated; one of them goes on to be
   compared with the others of its anchor.  Equal ones are found in the task that reads
   them, so one of each task goes on, and then by a join of these.  Anchors that
   occur once are dropped.
3. Different segments with one anchor meet in a block, for which an enhanced suffix
   array (suffix order and common prefix lengths) is built.  A stack scan lists
   the intervals of common prefixes of ``length`` bytes or more, and those with more
   than one byte to the left are the maximal repeats, with all their occurrences.
4. An anchor of very many different segments is not put into one block: its windows
   are halved again and again by where the anchor lies in them, each half keyed
   by the bytes that all its windows share, until a key has few segments or none
   but equal ones.

Bytes covered by a repeat are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .corpus_io import written

#: Bytes that are hashed at once; positions inside take this many bits.
CHUNK_BITS = 20


@dataclass(frozen=True)
class Rule:
    """Length of a repeated string, of the anchor's k-gram, and bounds of a block."""

    length: int = 200
    gram: int = 32
    #: Different segments of one anchor that go into a block as they are.
    block_segments: int = 512
    #: Bytes of one suffix array.
    block_bytes: int = 1 << 18


@lru_cache(maxsize=1)
def _position_powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    out = []
    for base in (int(tv.BASE), pow(int(tv.BASE), -1, 1 << 64)):
        p = np.full((1 << CHUNK_BITS) + 1, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def segments(data: np.ndarray, first: np.ndarray, last: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
    """Anchor segments of the windows that start in the ranges ``first`` to ``last`` (without).

    ``data`` has at most 2**20 bytes.  Returns each segment's start, length, the
    anchor's place in it, the anchor's hash and the segment's hash.
    """
    span = rule.length - rule.gram + 1
    h = tv.BYTE_HASH[data]
    size, step = 1, tv.BASE
    while size < rule.gram:
        h = h[:-size] * step + h[size:]
        size, step = 2 * size, np.multiply.reduce(np.array([step, step]))
    h = tv.mix64(h)
    low = np.uint64((1 << CHUNK_BITS) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[:len(least) - (span - size)], least[span - size:])
    start = np.repeat(first - (np.cumsum(last - first) - (last - first)), last - first) + np.arange(int((last - first).sum()))
    anchor = (least[start] & low).astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    begin, windows, anchor = start[at], np.diff(np.append(at, len(start))), anchor[at]
    length = windows + rule.length - 1
    power, inverse = _position_powers()
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tv.BYTE_HASH[data] * power[:len(data)])))
    own = (total[begin + length] - total[begin]) * inverse[begin]
    shape = (length << 16 | (anchor - begin)).astype(np.uint64)
    return begin, length, anchor - begin, h[anchor], tv.mix64(own ^ tv.mix64(shape))


def _chunks(offsets: np.ndarray, rule: Rule) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Cut a slice of texts into pieces of at most 2**20 bytes with whole windows.

    Gives the bytes from and to, the ranges of window starts and their documents.
    """
    most = (1 << CHUNK_BITS) - rule.length
    size = np.diff(offsets)
    held: list[tuple[int, int, int]] = []
    for d in np.flatnonzero(size >= rule.length).tolist():
        a, b = int(offsets[d]), int(offsets[d + 1]) - rule.length + 1
        while a < b:
            if held and min(b, held[0][0] + most) - held[0][0] <= 0 or held and a >= held[0][0] + most:
                yield _chunk(held, rule)
                held = []
            base = held[0][0] if held else a
            to = min(b, base + most)
            held.append((a, to, d))
            a = to
    if held:
        yield _chunk(held, rule)


def _chunk(held: list[tuple[int, int, int]], rule: Rule):
    first, last, doc = (np.array(x, dtype=np.int64) for x in zip(*held, strict=True))
    return int(first[0]), int(last[-1]) + rule.length - 1, first, last, doc


#: Places of the table of segments that a task remembers; it is emptied when half of them are taken.
SEEN_PLACES = 1 << 19


class SeenSegments:
    """Segments met before by a task: equal ones are repeated, and only the first goes on."""

    def __init__(self) -> None:
        self.empty()

    def empty(self) -> None:
        self.table = tv.KeyTable(SEEN_PLACES)
        self.anchor = np.zeros(SEEN_PLACES, np.uint64)
        self.k = np.zeros(SEEN_PLACES, np.int64)
        self.start = np.zeros(SEEN_PLACES, np.int64)
        self.length = np.zeros(SEEN_PLACES, np.int64)
        self.told = np.zeros(SEEN_PLACES, bool)

    def meet(self, k: np.ndarray, start: np.ndarray, length: np.ndarray, ah: np.ndarray, sh: np.ndarray) -> tuple[np.ndarray, ...]:
        """Which segments go on, which are repeated, and the spans of firsts that are found to be repeated now."""
        sh = np.where(sh == 0, np.uint64(1), sh)
        name, first, which = np.unique(sh, return_index=True, return_inverse=True)
        if not self.table.room(len(name)):
            self.empty()
        place = self.table.find(name)
        new = np.flatnonzero(place < 0)
        known = place >= 0
        if self.table.room(len(new)):  # else a very large chunk, whose segments are not remembered
            at = self.table.add(name[new])
            self.anchor[at], self.k[at], self.start[at], self.length[at] = (x[first[new]] for x in (ah, k, start, length))
            self.told[at] = False
            place[new] = at
        # segments equal, anchor and all, to the one in the table; of a new name, the first is that one
        of = place[which]
        same = of >= 0
        same[same] = self.anchor[of[same]] == ah[same]
        count = np.bincount(which[same], minlength=len(name)) + known
        again = same & (count[which] > 1)
        goes_on = ~same
        goes_on[first[~known]] = True
        repeated = (place >= 0) & (count > 1)
        late = place[repeated & known]
        late = late[~self.told[late]]
        self.told[place[repeated]] = True
        return goes_on, again, self.k[late], self.start[late], self.start[late] + self.length[late]


def _merged(k: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans in text order, with overlapping ones of a text as one."""
    if len(k) == 0:
        return k, start, end
    run = np.concatenate(([0], np.cumsum(k[1:] != k[:-1]))) << 40
    reach = np.maximum.accumulate(end + run)
    new = np.ones(len(k), bool)
    new[1:] = start[1:] + run[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return k[at], start[at], (reach - run)[np.append(at[1:], len(k)) - 1]


def anchor_table(rows: DataFrame, rule: Rule) -> DataFrame:
    """``k, start, len, a0, ah, sh`` of segments of every text, and spans ``k, start, len`` (``ah`` null).

    Of segments that a task has met before only the first goes on; the others, and
    that one, are repeated and become spans at once.  So a passage in very many texts
    is one row for each task (and for each time its table fills up), not one for each
    occurrence.
    """
    names = ["k", "start", "len", "a0", "ah", "sh"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = SeenSegments()
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                data, offsets = tv.binary_view(part.column("_text"))
                key = part.column("k").to_numpy()
                for a, b, first, last, doc in _chunks(offsets, rule):
                    begin, length, a0, ah, sh = segments(data[a:b], first - a, last - a, rule)
                    d = doc[np.searchsorted(first - a, begin, side="right") - 1]
                    k, start = key[d], begin + a - offsets[d]
                    on, again, *late = seen.meet(k, start, length, ah, sh)
                    own = _merged(k[again], start[again], (start + length)[again])
                    span_k, span_start, span_end = (np.concatenate(x) for x in zip(own, late, strict=True))
                    none = np.zeros(len(span_k), bool)
                    there = np.concatenate((np.ones(int(on.sum()), bool), none))
                    zeros = np.zeros(len(span_k), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate((k[on], span_k))), pa.array(np.concatenate((start[on], span_start)).astype(np.int32)),
                         pa.array(np.concatenate((length[on], span_end - span_start)).astype(np.int32)),
                         *(pa.array(np.concatenate((x[on], zeros)), kind, mask=~there) for x, kind in (
                             (a0, pa.int32()), (ah.view(np.int64), pa.int64()), (sh.view(np.int64), pa.int64())))], names=names)

    return rows.select("k", "_text").mapInArrow(run, "k long, start int, len int, a0 int, ah long, sh long")


# --- enhanced suffix array of a block -------------------------------------------------------------

def suffix_array(text: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``reach`` bytes or more, and common prefix lengths of neighbours.

    Prefix doubling from 8 bytes; the length at place i is that of suffixes i - 1 and i.
    """
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k:k + n]
    ranks = []
    size = 8
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        step = np.zeros(n, np.int32)
        step[1:] = np.cumsum(sorted_key[1:] != sorted_key[:-1])
        rank = np.empty(n, np.int32)
        rank[order] = step
        ranks.append((size, rank))
        if size >= reach or (n and step[-1] == n - 1):
            break
        after = np.zeros(n, np.int64)
        after[:max(0, n - size)] = rank[size:] + 1
        key = (rank.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        size *= 2
    lcp = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for size, rank in reversed(ranks):
        ok = (a < n) & (b < n)
        same = np.zeros(len(a), dtype=bool)
        same[ok] = rank[a[ok]] == rank[b[ok]]
        lcp[1:][same] += size
        a[same] += size
        b[same] += size
    # fewer than 8 bytes are left that may agree
    for _ in range(7):
        ok = (a < n) & (b < n)
        ok[ok] = text[a[ok]] == text[b[ok]]
        lcp[1:][ok] += 1
        a[ok] += 1
        b[ok] += 1
        if not ok.any():
            break
    return order, lcp


def maximal_repeats(order: np.ndarray, lcp: np.ndarray, left: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Intervals (common length, first, last) of suffixes with more than one left neighbour; inner ones first.

    ``left`` names the byte before each suffix of the order; a suffix at a
    segment's beginning has a name of its own.
    """
    change = np.concatenate(([0], np.cumsum(left[1:] != left[:-1])))
    inside = np.flatnonzero(lcp >= least)
    if len(inside) == 0:
        return
    breaks = np.flatnonzero(np.diff(inside) > 1)
    for a, b in zip(np.append(0, breaks + 1).tolist(), np.append(breaks, len(inside) - 1).tolist(), strict=True):
        low, high = int(inside[a]) - 1, int(inside[b])
        stack: list[tuple[int, int]] = []
        for i, now in enumerate([*lcp[low + 1:high + 1].tolist(), 0], start=low + 1):
            begin = i - 1
            while stack and stack[-1][0] > now:
                length, begin = stack.pop()
                if change[i - 1] != change[begin]:
                    yield length, begin, i - 1
            if now and (not stack or stack[-1][0] < now):
                stack.append((now, begin))


def block_repeats(parts: list[bytes], rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeats of one block of segments: (segment, place in it, length), one for each repeated suffix."""
    size = np.array([len(p) for p in parts], dtype=np.int64)
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", dtype=np.uint8)
    begin = np.cumsum(size + 1) - size - 1
    part = np.repeat(np.arange(len(parts)), size + 1)
    order, lcp = suffix_array(text, int(size.max()))
    rest = begin[part[order]] + size[part[order]] - order
    lcp[1:] = np.minimum(lcp[1:], np.minimum(rest[1:], rest[:-1]))
    at_start = order == begin[part[order]]
    left = np.where(at_start, 256 + order, text[order - 1].astype(np.int64))
    best = np.zeros(len(order), np.int64)
    for length, a, b in maximal_repeats(order, lcp, left, rule.length):
        own = best[a:b + 1]
        own[own == 0] = length
    found = np.flatnonzero(best)
    place = order[found]
    return part[place], place - begin[part[place]], best[found]


def _array_spans(rows: DataFrame, rule: Rule, tasks: int) -> DataFrame:
    """Spans ``k, start, end`` that suffix arrays find among segments with equal ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def solve() -> pa.RecordBatch:
            part, at, length = block_repeats([h[2] for h in held], rule)
            k = np.array([h[0] for h in held], dtype=np.int64)[part]
            begin = np.array([h[1] for h in held], dtype=np.int64)[part] + at
            # of spans at neighbouring places one goes on
            order = np.lexsort((begin, part))
            part, k, begin, end = part[order], k[order], begin[order], (begin + length)[order]
            new = np.ones(len(part), dtype=bool)
            new[1:] = (part[1:] != part[:-1]) | (begin[1:] > np.maximum.accumulate(end + part * (1 << 40))[:-1] - part[1:] * (1 << 40))
            at = np.flatnonzero(new)
            end = np.maximum.reduceat(end, at) if len(at) else end
            return pa.RecordBatch.from_arrays([pa.array(k[at]), pa.array(begin[at].astype(np.int32)),
                                               pa.array(end.astype(np.int32))], names=["k", "start", "end"])

        for batch in batches:
            for k, start, key, seg in zip(batch.column("k").to_pylist(), batch.column("start").to_pylist(),
                                          batch.column("key").to_pylist(), batch.column("seg"), strict=True):
                if key != last and size >= rule.block_bytes:
                    yield solve()
                    held, size = [], 0
                last = key
                held.append((k, start, seg.as_py()))
                size += len(held[-1][2]) + 1
        if held:
            yield solve()

    dealt = rows.select("k", "start", "key", "seg").repartition(tasks, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "k long, start int, end int")


def _halved(rows: DataFrame, rule: Rule) -> tuple[list[DataFrame], list[DataFrame]]:
    """Spans and small groups of segments from anchors with very many different segments.

    ``rows``: ``k, start, n, key, seg, a0``.  A window is named by the anchor's place
    ``a`` in it; a segment has windows ``lo`` to ``hi`` (without).  The node is a
    dyadic range of such places, and a half's key is the bytes that all its
    windows share.
    """
    live = rows.select("k", "start", "seg", "a0", "key", (F.col("a0") - F.octet_length("seg") + rule.length).alias("lo"),
                       (F.col("a0") + 1).alias("hi"), F.lit(0).alias("node"))
    spans: list[DataFrame] = []
    small: list[DataFrame] = []
    size = 256
    while size > 1:
        size //= 2
        halves = live.withColumn("node", F.explode(F.array("node", F.col("node") + size)))
        halves = halves.withColumn("lo", F.greatest("lo", "node")).withColumn("hi", F.least("hi", F.col("node") + size))
        halves = halves.filter("lo < hi")
        core = F.expr(f"substring(seg, a0 - node + 1, {rule.length + 1 - size})")
        hull = F.expr(f"substring(seg, a0 - hi + 2, hi - lo + {rule.length - 1})")
        halves = halves.select("k", "start", "seg", "a0", "lo", "hi", "node", F.xxhash64("key", "node", core).alias("key"),
                               F.col("start").alias("base")).withColumn("hull", F.xxhash64("key", "lo", "hi", hull))
        halves = written(halves, "repeat-halves")
        equal = halves.groupBy("key", "hull").agg(F.count("*").alias("m"), F.min(F.struct("k", "start")).alias("one"))
        kinds = equal.groupBy("key").agg(F.count("*").alias("kinds"))
        again = halves.join(equal.filter("m > 1").select("key", "hull"), ["key", "hull"])
        spans.append(again.select("k", (F.col("start") + F.col("a0") - F.col("hi") + 1).alias("start"),
                                  (F.col("start") + F.col("a0") - F.col("lo") + rule.length).alias("end")))
        ones = (halves.join(equal.select("hull", F.col("one.k").alias("k"), F.col("one.start").alias("start")),
                            ["hull", "k", "start"]).join(kinds.filter("kinds > 1"), "key"))
        ones = written(ones.dropDuplicates(["hull", "k", "start"]), "repeat-ones")
        small.append(ones.filter(F.col("kinds") <= rule.block_segments).select(
            "k", (F.col("start") + F.col("a0") - F.col("hi") + 1).cast("int").alias("start"), "key",
            F.expr(f"substring(seg, a0 - hi + 2, hi - lo + {rule.length - 1})").alias("seg")))
        live = ones.filter(F.col("kinds") > rule.block_segments).select("k", "start", "seg", "a0", "key", "lo", "hi", "node")
        if live.isEmpty():
            break
    return spans, small


def repeated_spans(rows: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``k, start, end`` of repeated bytes; ``rows``: ``k, _text``, where ``k`` names a row."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = written(anchor_table(rows, rule), "repeat-anchors")
    anchors = table.filter(F.col("ah").isNotNull())
    often = anchors.groupBy("ah").agg(F.count("*").alias("c")).filter("c > 1").select("ah")
    met = written(anchors.join(often, "ah"), "repeat-met")
    kinds = met.groupBy("ah", "sh").agg(F.count("*").alias("n"), F.min(F.struct("k", "start", "len", "a0")).alias("one"))
    kinds = written(kinds, "repeat-kinds")
    whole = met.join(kinds.filter("n > 1").select("ah", "sh"), ["ah", "sh"]).select(
        "k", "start", (F.col("start") + F.col("len")).alias("end"))
    mixed = kinds.groupBy("ah").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    wanted = kinds.join(mixed, "ah").groupBy("one.k").agg(F.collect_list(F.struct(
        F.col("one.start").alias("start"), F.col("one.len").alias("len"), F.col("one.a0").alias("a0"), "n", "ah",
        "kinds")).alias("wanted"))
    wanted = written(wanted, "repeat-wanted")
    cut = rows.join(wanted, "k").select("k", "_text", F.explode("wanted").alias("w")).select(
        "k", F.col("w.start").alias("start"), F.col("w.n").alias("n"), F.col("w.ah").alias("key"),
        F.expr("substring(_text, w.start + 1, w.len)").alias("seg"), F.col("w.a0").alias("a0"), F.col("w.kinds").alias("kinds"))
    cut = written(cut, "repeat-segments")
    hot = cut.filter(F.col("kinds") > rule.block_segments)
    blocks = [cut.filter(F.col("kinds") <= rule.block_segments).select("k", "start", "key", "seg")]
    spans = [table.filter(F.col("ah").isNull()).select("k", "start", (F.col("start") + F.col("len")).alias("end")), whole]
    if not hot.isEmpty():
        more, small = _halved(hot, rule)
        spans += more
        blocks += small
    together = blocks[0]
    for b in blocks[1:]:
        together = together.unionByName(b)
    spans.append(_array_spans(together, rule, tasks))
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s.select("k", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")))
    return out


def remove_repeats(docs: DataFrame, rule: Rule = Rule(), text_col: str = "text", whole_characters: bool = False) -> DataFrame:
    """All columns of ``docs`` and ``_kept`` (binary), ``_n_bytes``, ``_n_removed``, ``_n_spans``.

    Every byte covered by a string of ``rule.length`` bytes that also starts
    elsewhere is removed, in the same text or another; strings are judged on the
    input.  With ``whole_characters``, a character of which a byte goes is removed
    whole, so the kept bytes are UTF-8.

    The columns of ``docs`` may have any other names.  A null text counts as the
    empty one.  Texts shorter than ``rule.length`` lose
    nothing, equal rows lose all that is long enough, very long texts are cut
    into overlapping pieces, and an empty table gives an empty result.
    """
    ids = [c for c in docs.columns if c != text_col]
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    name = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ids if c == "doc_id"), body)
    rows = docs.withColumn("__repeat_text", body).withColumn("__repeat_key", name)
    keyed = rows.select(F.col("__repeat_key").alias("k"), F.col("__repeat_text").alias("_text"))
    spans = written(repeated_spans(keyed, rule), "repeat-spans")
    per_row = spans.groupBy(F.col("k").alias("__repeat_key")).agg(F.collect_list(F.struct("start", "end")).alias("__repeat_spans"))
    per_row = written(per_row, "repeat-rows")
    joined = rows.join(per_row, "__repeat_key", "left")
    schema = T.StructType([*docs.schema.fields, T.StructField("_kept", T.BinaryType()), T.StructField("_n_bytes", T.LongType()),
                           T.StructField("_n_removed", T.LongType()), T.StructField("_n_spans", T.LongType())])

    names, columns = schema.names, list(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.text_slices(batch, "__repeat_text", 8 << 20):
                data, offsets = tv.binary_view(part.column("__repeat_text"))
                kept, counts = [], []
                found = part.column("__repeat_spans")
                for d in range(part.num_rows):
                    text = data[offsets[d]:offsets[d + 1]]
                    own = found[d]
                    if not own.is_valid:
                        kept.append(text.tobytes())
                        counts.append((len(text), 0, 0))
                        continue
                    pieces = own.values
                    depth = np.zeros(len(text) + 1, np.int32)
                    np.add.at(depth, pieces.field(0).to_numpy(), 1)
                    np.add.at(depth, pieces.field(1).to_numpy(), -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    if whole_characters:
                        lead = np.flatnonzero((text & 0xC0) != 0x80)
                        gone = np.repeat(np.logical_or.reduceat(gone, lead), np.diff(np.append(lead, len(text))))
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept.append(text[~gone].tobytes())
                    counts.append((len(text), int(gone.sum()), runs))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), pa.array(kept, pa.binary()),
                     *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3))], names=names)

    return joined.select(*columns, "__repeat_text", "__repeat_spans").mapInArrow(run, schema)
