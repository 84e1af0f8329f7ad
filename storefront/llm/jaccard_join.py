"""Operator 6: exact Jaccard similarity join on word shingles by grouped prefixes.

1. All shingles of all documents are counted.  Shingles are then ordered: those
   of few documents first, by hash; the frequent ones last, by frequency.  The
   frequent ones are a bounded list (``Rule.frequent``), which is broadcast.  Any
   common order gives the same links; a good one gives few candidates.
2. Two similar sets share a shingle among the first of both (their prefixes).
   Documents with equal prefix and size are one *group*, and only groups are
   joined: groups that share a prefix shingle and whose sizes can be similar are
   candidates.
3. Groups are expanded to their classes (documents with equal sets), and every
   candidate pair of classes is verified on whole sets.

A shingle shared by many groups gives no pairs of all of them.  First each group
is compared with a few pivots of its size band.  What is connected then needs no more
comparison for the components; only lists whose members are still in different
components are joined with themselves, across components.  The postings of
a very frequent shingle are dealt to several buckets; the pivots of its parts then
meet each other, and its list is that of all parts.  Candidates must also
pass a bitmap filter: a bit that one set has and the other lacks is an element
outside the intersection, so sets whose bitmaps differ too much can't link.

Shingles travel as blocks of packed integers, one row for each task and bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .components import connected
from .corpus_io import maybe_broadcast, written


@dataclass(frozen=True)
class Rule:
    """Two sets link when ``den * intersection >= num * union``."""

    words: int = 5
    num: int = 75
    den: int = 100
    #: Most shingles in the broadcast list of frequent ones (5 bytes each).
    frequent: int = 4_000_000
    #: Postings of one frequent shingle that go to one bucket.
    bucket_postings: int = 2_000
    #: Groups of one list and size band that all others of the band are compared with first.
    pivots: int = 6
    #: 64-bit words of a set's bitmap.
    bitmap_words: int = 32
    #: Bytes of packed shingles that a task holds before it sends them on.
    flush_bytes: int = 6 << 20

    def probe_prefix(self, n: np.ndarray) -> np.ndarray:
        return n - (self.num * n + self.den - 1) // self.den + 1

    def index_prefix(self, n: np.ndarray) -> np.ndarray:
        a, b = 2 * self.num, self.num + self.den
        return n - (a * n + b - 1) // b + 1


def _blocks(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of 64-bit keys by their upper bits."""
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


class _Outbox:
    """Gathers columns of integers and cuts them into one row for each bucket."""

    def __init__(self, buckets: int, limit: int, names: list[str]):
        self.buckets, self.limit, self.names = buckets, limit, names
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, bucket: np.ndarray, *columns: np.ndarray) -> None:
        self.parts.append((bucket, *columns))
        self.size += sum(c.nbytes for c in columns)

    def full(self) -> bool:
        return self.size >= self.limit

    def flush(self) -> pa.RecordBatch:
        bucket, *columns = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        which, first = np.unique(bucket, return_index=True)
        cuts = np.append(first, len(bucket))
        out = [pa.array(which, pa.int32())]
        for c in columns:
            c = c[order]
            out.append(pa.array([c[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()))
        return pa.RecordBatch.from_arrays(out, names=["bucket", *self.names])


def _by_bucket(batches: Iterator[pa.RecordBatch], types: list) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of one bucket after the other; rows come sorted by bucket."""
    at, held = None, []
    for batch in batches:
        buckets = batch.column(0).to_pylist()
        for i, b in enumerate(buckets):
            if b != at and held:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held = []
            at = b
            held.append(tuple(np.frombuffer(batch.column(k + 1)[i].as_buffer(), dtype=t) for k, t in enumerate(types)))
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    """All rows of a bucket in one task, bucket after bucket."""
    return df.repartition(max(1, buckets // 4), "bucket").sortWithinPartitions("bucket")


def _n_buckets(docs: DataFrame) -> int:
    return 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def frequent_shingles(rows: DataFrame, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """The upper 32 bits of the most frequent shingles' hashes, sorted, and log2 of their counts.

    All shingles of all documents are counted by these 32 bits; the threshold is
    the least power of two that keeps the list within ``rule.frequent``.
    """
    buckets = _n_buckets(rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _Outbox(buckets, rule.flush_bytes, ["shingles"])
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                sets = tv.shingle_sets(*tv.binary_view(part.column("_text")), rule.words)
                h = np.concatenate(sets)
                box.add(_blocks(h, buckets), (h >> np.uint64(32)).astype(np.uint32))
                if box.full():
                    yield box.flush()
        if box.size:
            yield box.flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (h,) in _by_bucket(batches, [np.uint32]):
            value, times = np.unique(h, return_counts=True)
            keep = times >= 2
            level = np.floor(np.log2(times[keep])).astype(np.int32)
            value = value[keep]
            levels, sizes = np.unique(level, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(levels, pa.int32()), pa.array(sizes, pa.int64()),
                 pa.array([value[level == x].tobytes() for x in levels], pa.binary())], names=["level", "n", "shingles"])

    sent = _dealt(rows.mapInArrow(send, "bucket int, shingles binary"), buckets)
    counted = written(sent.mapInArrow(count, "level int, n long, shingles binary"), "shingle-counts")
    sizes = {r.level: r.n for r in counted.groupBy("level").agg(F.sum("n").alias("n")).collect()}
    lowest, total = 99, 0
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > rule.frequent:
            break
        lowest = level
    kept = counted.filter(F.col("level") >= lowest).select("level", "shingles").collect()  # ``rule.frequent`` times 4 bytes
    parts = [(np.frombuffer(r.shingles, dtype=np.uint32), r.level) for r in kept]
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint8)
    value = np.concatenate([p for p, _ in parts])
    level = np.concatenate([np.full(len(p), x, np.uint8) for p, x in parts])
    order = np.argsort(value)
    return value[order], level[order]


class _Prefixes:
    """Sets of a slice in the common order: sizes, prefixes, group and class hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], rule: Rule):
        sets = tv.shingle_sets(data, offsets, rule.words)
        self.n = np.array([len(s) for s in sets], dtype=np.int64)
        h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(sets)), self.n)
        value, level = frequent
        rank = np.zeros(len(h), np.uint8)
        if len(value) and len(h):
            top = (h >> np.uint64(32)).astype(np.uint32)
            at = np.minimum(np.searchsorted(value, top), len(value) - 1)
            rank = np.where(value[at] == top, level[at], 0).astype(np.uint8)
        some = np.flatnonzero(self.n)
        first = (np.cumsum(self.n) - self.n)[some]
        self.cls = np.zeros(len(sets), np.uint64)
        if len(h):
            self.cls[some] = tv.mix64(np.add.reduceat(tv.mix64(h), first) ^ tv.mix64(self.n[some].astype(np.uint64)))
        flags = np.zeros((len(sets), 64 * rule.bitmap_words), dtype=bool)
        flags[doc, ((h >> np.uint64(24)) % np.uint64(64 * rule.bitmap_words)).astype(np.int64)] = True
        self.bits = np.packbits(flags, axis=1).view(np.int64)
        order = np.lexsort((h, rank, doc))
        h, rank = h[order], rank[order]
        place = np.arange(len(h)) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        kept = place < rule.probe_prefix(self.n)[doc]
        self.shingle, self.doc, self.rank = h[kept], doc[kept], rank[kept]
        self.indexed = place[kept] < rule.index_prefix(self.n)[self.doc]
        size = np.bincount(self.doc, minlength=len(sets))
        self.group = np.zeros(len(sets), np.uint64)
        if len(h):
            own = tv.mix64(self.shingle)
            self.group[some] = tv.mix64(np.add.reduceat(own, (np.cumsum(size) - size)[some])
                                        + tv.mix64(self.n[some].astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def set_table(rows: DataFrame, frequent, rule: Rule) -> DataFrame:
    """``id, text_hash, n, cls, grp, bits`` of every document."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    names = ["id", "text_hash", "n", "cls", "grp", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                p = _Prefixes(*tv.binary_view(part.column("_text")), shared.value, rule)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_hash"), pa.array(p.n), _signed(p.cls),
                                                  _signed(p.group), pa.ListArray.from_arrays(
                                                      pa.array(np.arange(len(p.n) + 1, dtype=np.int32) * rule.bitmap_words),
                                                      pa.array(p.bits.ravel()))], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text_hash long, n long, cls long, grp long, bits array<long>")


def _candidates(rows: DataFrame, frequent, rule: Rule) -> DataFrame:
    """Candidate pairs of groups and, for longer lists, their members.

    ``kind`` 0: groups ``a, b`` to compare (each list's pivots with their bands).
    ``kind`` 1: ``a`` is the name of a list of three groups or more, ``b`` a member,
    ``n`` its size and ``indexed`` whether the shingle lies in its index prefix.
    ``kind`` 2: the same of a list that is dealt to several buckets, with ``a`` its shingle.
    ``kind`` 3: those of ``kind`` 2 that are pivots of their part.
    """
    buckets = _n_buckets(rows)
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    names = ["kind", "a", "b", "n", "indexed"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _Outbox(buckets, rule.flush_bytes, ["shingle", "grp", "n"])
        for batch in batches:
            for part in tv.text_slices(batch, "_text"):
                p = _Prefixes(*tv.binary_view(part.column("_text")), shared.value, rule)
                key, group = p.shingle, p.group[p.doc]
                # a very frequent shingle's postings are dealt to several buckets
                share = np.maximum(1, (np.uint64(2) << p.rank.astype(np.uint64)) // np.uint64(rule.bucket_postings))
                spread = share > 1
                if spread.any():
                    key = key.copy()
                    key[spread] = tv.mix64(key[spread] + group[spread] % share[spread])
                n = p.n[p.doc].astype(np.uint32) * np.uint32(4) + spread * np.uint32(2) + p.indexed
                box.add(_blocks(key, buckets), p.shingle, group, n.astype(np.uint32))
                if box.full():
                    yield box.flush()
        if box.size:
            yield box.flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shingle, group, n in _by_bucket(batches, [np.uint64, np.uint64, np.uint32]):
            for kind, a, b, size, indexed in _meet(shingle, group, n, rule):
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(a), kind, np.int32)), _signed(a), _signed(b), pa.array(size.astype(np.int64)),
                         pa.array(indexed.astype(np.int32))], names=names)

    sent = _dealt(rows.mapInArrow(send, "bucket int, shingle binary, grp binary, n binary"), buckets)
    return sent.mapInArrow(meet, "kind int, a long, b long, n long, indexed int")


def _fits(na, fa, nb, fb, rule: Rule):
    """Whether sizes can be similar and the shingle lies in the prefixes that must meet."""
    low, high = np.minimum(na, nb), np.maximum(na, nb)
    flagged = np.where(na < nb, fa, np.where(nb < na, fb, fa & fb)).astype(bool)
    return (rule.den * low >= rule.num * high) & flagged


def _meet(shingle: np.ndarray, group: np.ndarray, n: np.ndarray, rule: Rule, pairs_only: bool = False):
    """Pivot pairs and long lists of one bucket; all members and the pivots of lists that have other parts elsewhere.

    ``n`` is four times the size, plus 2 if the list has other parts, plus 1 if the shingle lies in the index prefix.
    """
    order = np.lexsort((group, shingle))
    shingle, group, n = shingle[order], group[order], n[order]
    new = np.ones(len(shingle), dtype=bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (group[1:] != group[:-1])
    shingle, group, n = shingle[new], group[new], n[new]
    start = np.ones(len(shingle), dtype=bool)
    start[1:] = shingle[1:] != shingle[:-1]
    list_of = np.cumsum(start) - 1
    length = np.bincount(list_of)
    keep = (length[list_of] > 1) | ((n & 2) > 0)
    shingle, group, n, list_of = shingle[keep], group[keep], n[keep], list_of[keep]
    if len(group) == 0:
        return
    size, part, flag = (n >> 2).astype(np.int64), (n & 2) > 0, (n & 1).astype(np.int64)
    band = np.floor(np.log(size) / np.log(rule.den / rule.num)).astype(np.int64)
    order = np.lexsort((group, band, list_of))
    g, s, f, b, li = group[order], size[order], flag[order], band[order], list_of[order]
    head = np.ones(len(g), dtype=bool)
    head[1:] = (li[1:] != li[:-1]) | (b[1:] != b[:-1])
    pivot = np.flatnonzero(head)[np.cumsum(head) - 1]
    place = np.arange(len(g)) - pivot
    left = []
    for k in range(rule.pivots):
        other = np.flatnonzero(place > k)
        left.append((pivot[other] + k, other))
    heads = np.flatnonzero(head)
    near = np.flatnonzero((li[heads[1:]] == li[heads[:-1]]) & (b[heads[1:]] == b[heads[:-1]] + 1))
    left.append((heads[near], heads[near + 1]))
    x, y = (np.concatenate(c) for c in zip(*left, strict=True))
    ok = _fits(s[x], f[x], s[y], f[y], rule)
    pairs = np.unique(np.column_stack((np.minimum(g[x], g[y])[ok], np.maximum(g[x], g[y])[ok])), axis=0)
    zero = np.zeros(len(pairs), np.int64)
    yield 0, pairs[:, 0].copy(), pairs[:, 1].copy(), zero, zero
    if pairs_only:
        return
    if part.any():
        yield 2, shingle[part], group[part], size[part], flag[part]
        first = order[(place < rule.pivots) & part[order]]
        yield 3, shingle[first], group[first], size[first], flag[first]
    long_ = (length[list_of] > 2) & ~part
    if long_.any():
        group, size, flag, list_of = group[long_], size[long_], flag[long_], list_of[long_]
        first = np.flatnonzero(np.append(True, list_of[1:] != list_of[:-1]))
        name = tv.mix64(np.add.reduceat(tv.mix64(group * np.uint64(2) + flag.astype(np.uint64)), first))
        name = np.repeat(name, np.diff(np.append(first, len(group))))
        _, only = np.unique(np.column_stack((name, group)), axis=0, return_index=True)
        yield 1, name[only], group[only], size[only], flag[only]


def _part_pivots(found: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of groups ``a, b``: the pivots of all parts of a dealt list meet as one list does."""
    sent = found.filter("kind = 3").select("a", "b", "n", "indexed")
    sent = sent.repartition(_n_buckets(found) // 4, "a").sortWithinPartitions("a")

    def whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        held = None
        for batch in batches:
            new = tuple(batch.column(k).to_numpy() for k in range(4))
            held = new if held is None else tuple(np.concatenate(c) for c in zip(held, new, strict=True))
            if len(held[0]) >= 100_000:
                cut = int(np.searchsorted(held[0], held[0][-1]))
                if cut:
                    yield tuple(c[:cut] for c in held)
                    held = tuple(c[cut:] for c in held)
        if held is not None:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, n, indexed in whole_lists(batches):
            for _, x, y, _, _ in _meet(a.view(np.uint64), b.view(np.uint64), (4 * n + indexed).astype(np.uint32),
                                       rule, pairs_only=True):
                yield pa.RecordBatch.from_arrays([_signed(x), _signed(y)], names=["a", "b"])

    return sent.mapInArrow(run, "a long, b long")


def _dealt_lists(found: DataFrame) -> DataFrame:
    """Members ``a, b, n, indexed`` of the dealt lists of three groups or more; equal lists once, named by their members."""
    members = found.filter("kind = 2").select("a", "b", "n", "indexed")
    whole = (members.groupBy("a").agg(F.bit_xor(F.xxhash64("b", "indexed")).alias("name"), F.count("*").alias("groups"))
             .filter("groups > 2").groupBy("name", "groups").agg(F.min("a").alias("a")))
    return members.join(whole, "a").select(F.xxhash64("name", "groups").alias("a"), "b", "n", "indexed")


def _verify(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Those of the class pairs ``a, b`` whose whole sets link.  ``texts``: ``cls, z`` (compressed texts)."""
    joined = (pairs.join(texts.select(F.col("cls").alias("a"), F.col("z").alias("za")), "a")
              .join(texts.select(F.col("cls").alias("b"), F.col("z").alias("zb")), "b").select("a", "b", "za", "zb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
                blobs = {}
                for side, key in (("za", a), ("zb", b)):
                    for k, z in zip(key.tolist(), part.column(side), strict=True):
                        if k not in blobs:
                            blobs[k] = unzip.decompress(z.as_py())
                sets: dict[int, np.ndarray] = {}
                held: list[int] = []
                size = 0
                for k, text in [*blobs.items(), (None, b"")]:
                    if k is None or size > tv.SLICE_BYTES:
                        data = np.frombuffer(b"".join(blobs[x] for x in held), dtype=np.uint8)
                        cuts = np.concatenate(([0], np.cumsum([len(blobs[x]) for x in held]))).astype(np.int64)
                        sets.update(zip(held, tv.shingle_sets(data, cuts, rule.words), strict=True))
                        held, size = [], 0
                    if k is not None:
                        held.append(k)
                        size += len(text)
                same = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                                 for x, y in zip(a.tolist(), b.tolist(), strict=True)], dtype=np.int64)
                total = np.array([len(sets[x]) + len(sets[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                linked = rule.den * same >= rule.num * (total - same)
                yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked])], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def _texts(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Compressed text of one document of each wanted class."""
    reps = classes.join(wanted.select("cls").distinct(), "cls").select("cls", "rep.id", "rep.text_hash")
    reps = written(reps, "shingle-reps")
    n = reps.count()
    found = rows.select("id", "text_hash", "_text").join(
        maybe_broadcast(reps.select(F.col("id").alias("rid"), F.col("text_hash").alias("rhash"), "cls"), n, 48),
        F.col("id").eqNullSafe(F.col("rid")) & (F.col("text_hash") == F.col("rhash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zipper = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                z = pa.array([zipper.compress(t.as_buffer()) for t in part.column("_text")], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("cls"), z], names=["cls", "z"])

    packed = found.select("cls", "_text").mapInArrow(run, "cls long, z binary")
    return written(packed, "shingle-texts").dropDuplicates(["cls"])


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _bitmaps_fit(rule: Rule) -> F.Column:
    """Whether classes ``x`` and ``y`` can link by their sizes ``n`` and bitmaps ``bits``.

    The intersection has at most n less the bits that the other lacks, and must have
    num / (num + den) of both sizes together.
    """
    def lacks(p: str, q: str) -> F.Column:
        one = F.zip_with(p, q, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))))
        return F.aggregate(one, F.lit(0), lambda total, c: total + c)

    least = rule.num * (F.col("x.n") + F.col("y.n"))
    both = rule.num + rule.den
    return (both * (F.col("x.n") - lacks("x.bits", "y.bits")) >= least) & (both * (F.col("y.n") - lacks("y.bits", "x.bits")) >= least)


def _open(lists: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Lists whose members are in different components, with each member's component and bitmap."""
    placed = (lists.join(nodes, lists.cls == nodes.node, "left")
              .select("name", "cls", "indexed", F.coalesce("component", "cls").alias("component")))
    open_ = (placed.groupBy("name").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter("lo != hi").select("name"))
    return placed.join(open_, "name").join(classes.select("cls", "n", "bits"), "cls")


def _across(open_: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of classes that share a list, are in different components and can link."""
    x, y = open_.alias("x"), open_.alias("y")
    low, high = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    flagged = (F.when(F.col("x.n") < F.col("y.n"), F.col("x.indexed")).when(F.col("y.n") < F.col("x.n"), F.col("y.indexed"))
               .otherwise(F.least("x.indexed", "y.indexed")))
    return (x.join(y, (F.col("x.name") == F.col("y.name")) & (F.col("x.cls") < F.col("y.cls"))
                   & (F.col("x.component") != F.col("y.component")) & (rule.den * low >= rule.num * high) & (flagged == 1)
                   & _bitmaps_fit(rule))
            .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())


def similar(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shingle-set size and component of every document.

    Returns ``doc_id, text_hash, n_shingles, component_id`` and ``component``, a
    number of the component (null without shingles).

    A document of fewer than ``rule.words`` words has its whole sequence as one
    shingle.  Null texts, empty texts and texts without words have the empty set,
    link with nothing and are their own component.  Repeated rows are copies;
    a null id never names a component that has another id; an empty table gives
    an empty result; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("_text"))
    frequent = frequent_shingles(rows, rule)
    sets = written(set_table(rows, frequent, rule), "shingle-sets")
    classes = sets.filter("n > 0").groupBy("cls").agg(
        F.min(F.struct("id", "text_hash")).alias("rep"), F.min("n").alias("n"), F.min("grp").alias("grp"), F.first("bits").alias("bits"))
    classes = written(classes, "shingle-classes")
    found = written(_candidates(rows, frequent, rule), "shingle-candidates")
    members = classes.select("cls", "grp")
    pairs = found.filter("kind = 0").select("a", "b").unionByName(_part_pivots(found, rule)).distinct()
    expanded = (pairs.join(members.select(F.col("grp").alias("a"), F.col("cls").alias("x")), "a")
                .join(members.select(F.col("grp").alias("b"), F.col("cls").alias("y")), "b").select("x", "y"))
    heads = members.groupBy("grp").agg(F.min("cls").alias("x"))
    inside = members.join(heads, "grp").filter("cls != x").select("x", F.col("cls").alias("y"))
    sized = classes.select("cls", "n", "bits")
    first = expanded.unionByName(inside).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    first = (first.join(sized.alias("x"), F.col("a") == F.col("x.cls")).join(sized.alias("y"), F.col("b") == F.col("y.cls"))
             .filter(_bitmaps_fit(rule)).select("a", "b"))
    first = written(first, "shingle-pairs")
    ends = first.select(F.col("a").alias("cls")).unionByName(first.select(F.col("b").alias("cls")))
    lists = (found.filter("kind = 1").select("a", "b", "n", "indexed").distinct().unionByName(_dealt_lists(found))
             .join(members.select(F.col("grp").alias("b"), "cls"), "b").select(F.col("a").alias("name"), "cls", "n", "indexed"))
    in_group = (members.join(members.groupBy("grp").count().filter("count > 2"), "grp")
                .join(classes.select("cls", "n"), "cls").select(F.col("grp").alias("name"), "cls", "n", F.lit(1).alias("indexed")))
    lists = written(lists.unionByName(in_group), "shingle-lists")
    texts = _texts(rows, classes, ends.unionByName(lists.select("cls")))
    links = written(_verify(first, texts, rule), "shingle-links")
    nodes = connected(_edges(links))
    open_ = written(_open(lists, nodes, classes), "shingle-open")
    across = written(_across(open_, rule).join(first, ["a", "b"], "left_anti"), "shingle-across")
    more = written(_verify(across, texts, rule), "shingle-links")
    if not more.isEmpty():
        nodes = connected(_edges(links.unionByName(more)))
    named = (sets.filter("n > 0").join(nodes, sets.cls == nodes.node, "left")
             .select("id", "text_hash", "n", F.coalesce("component", "cls").alias("component")))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    linked = named.join(least, "component").select("id", "text_hash", "n", "component_id", "component")
    alone = sets.filter("n = 0").select("id", "text_hash", "n", F.col("id").alias("component_id"),
                                        F.lit(None).cast("long").alias("component"))
    return linked.unionByName(alone).select(F.col("id").alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"),
                                            "component_id", "component")


def representatives(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the least id and, of its texts, the least hash.

    A null id stays only where no row of the component has one.
    Rows without shingles stay.  Rows that agree in id and text count once.
    """
    found = written(similar(docs, rule, id_col, text_col).select("doc_id", "text_hash", "component"), "near-found")
    stays = found.filter("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("one"))
    goes = found.join(stays, "component").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("text_hash") == F.col("one.text_hash"))))
    goes = written(goes.select(F.col("doc_id").alias("__near_id"), F.col("text_hash").alias("__near_hash")).distinct(), "near-goes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = docs.withColumn("__near_own", F.xxhash64(text)).join(
        maybe_broadcast(goes, goes.count(), 32), F.col(id_col).eqNullSafe(F.col("__near_id")) & (F.col("__near_own") == F.col("__near_hash")), "left_anti")
    repeated = found.filter("component is not null").groupBy("doc_id", "text_hash").count().filter("count > 1")
    return kept.drop("__near_own") if repeated.isEmpty() else kept.dropDuplicates([id_col, text_col]).drop("__near_own")
