"""Operator 7: shards by a minimax contiguous partition.

Documents with equal texts form a group.  Groups stand in order of the md5 of their
text and are the atoms of the partition: a binary search finds the smallest capacity
at which a greedy pass over the ordered groups needs no more shards than asked for.

The driver sees no list of groups.  It holds the sizes of *cells*, the groups whose
md5 begins with the same digits, at first 65,536 at most.  A cell in which a cut may
fall is measured again with two more digits, in one pass for all of them, until
the cells around every cut are single groups.  Two greedy passes bound the
capacity meanwhile: cells that may be cut anywhere give a lower bound, whole cells an
upper one.  When both agree the capacity is that over the groups.

At this capacity many partitions are possible, and the plain greedy one would leave
its last shards empty where one group is very large.  The cuts are therefore put
where each shard comes nearest to the mean of what is left over the shards that are
left (groups larger than that mean count as a shard of their own), never above the
capacity and never so that the rest would not fit.

Row numbers inside a shard come from counts per (shard, input partition), so no
task ever holds a whole shard or a whole group of equal texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .corpus_io import written

#: Hexadecimal digits of the md5 that name a cell at first, and digits more when it is measured again.
FIRST_DIGITS, MORE_DIGITS = 4, 2
ROW_OVERHEAD = 8

#: Measures cells of so many digits (those within the given ones): digits, bytes, whether it is one group.
Measure = Callable[[int, list[str] | None], list[tuple[str, int, bool]]]


class Cells:
    """Cells in md5 order."""

    def __init__(self, rows: list[tuple[str, int, bool]]):
        rows = sorted(rows)
        self.names = [r[0] for r in rows]
        self.bytes = np.array([r[1] for r in rows], dtype=np.int64)
        self.single = np.array([r[2] for r in rows], dtype=bool)
        self.ends = np.concatenate(([0], np.cumsum(self.bytes)))

    def border(self, place: int) -> int:
        """Index of the last border that is not after ``place`` bytes."""
        return int(np.searchsorted(self.ends, place, side="right")) - 1

    def shards(self, at: int, capacity: int, most: int, whole: bool) -> list[int] | None:
        """Ends (in bytes) of the greedy shards from byte ``at`` on; ``whole``: no cell is cut.  None: more than ``most``."""
        out = []
        for _ in range(most):
            if at == self.ends[-1]:
                break
            i = self.border(at + capacity)
            last = i == len(self.ends) - 1
            to = int(self.ends[i]) if last or whole or self.single[i] else at + capacity
            if to <= at:
                return None
            at = to
            out.append(at)
        return out if at == self.ends[-1] else None

    def capacity(self, shards: int, whole: bool) -> int:
        """The smallest capacity at which ``shards`` suffice."""
        low, high = -(-int(self.ends[-1]) // shards), int(self.ends[-1])
        while low < high:
            middle = (low + high) // 2
            if self.shards(0, middle, shards, whole) is None:
                low = middle + 1
            else:
                high = middle
        return low

    def mean(self, at: int, shards: int) -> float:
        """Mean of what is left from border ``at`` on; single groups above it count as shards of their own."""
        rest, left = int(self.ends[-1] - self.ends[at]), shards
        large = np.sort(self.bytes[at:][self.single[at:]])[::-1]
        for size in large.tolist():
            if left <= 1 or size * left <= rest:
                break
            rest, left = rest - size, left - 1
        return rest / left

    def cuts(self, shards: int, capacity: int) -> tuple[list[int], list[int]]:
        """The end (as a border) of each shard, and the borders before cells that the wish to cut falls into."""
        out, wished, at, n = [], [], 0, len(self.bytes)
        for left in range(shards, 0, -1):
            if at == n or left == 1:
                out.append(n)
                at = n
                continue
            wish = self.ends[at] + self.mean(at, left)
            low = self.border(int(wish))
            if low < n and self.ends[low] < wish:
                wished.append(low)
            options = [i for i in (low, low + 1) if at < i <= n and self.ends[i] - self.ends[at] <= capacity]
            options = [i for i in options if self.shards(int(self.ends[i]), capacity, left - 1, whole=True) is not None]
            # where neither side of the wish will do, as much as the capacity allows
            at = min(options, key=lambda i: (abs(self.ends[i] - wish), i), default=self.border(int(self.ends[at]) + capacity))
            out.append(at)
        return out, wished


def minimax_cuts(measure: Measure, shards: int) -> tuple[int, list[str | None]]:
    """The smallest capacity over the groups, and the first digits of shards 1, 2, ... (None: nothing is left for it)."""
    cells = Cells(measure(FIRST_DIGITS, None))
    if not cells.names:
        return 0, [None] * (shards - 1)
    while True:
        low, high = cells.capacity(shards, whole=False), cells.capacity(shards, whole=True)
        near = set()
        if low < high:
            # where greedy shards of any capacity between the two may end
            small, large = cells.shards(0, low, shards, False), cells.shards(0, high, shards, False)
            small += [int(cells.ends[-1])] * (shards - len(small))
            large += [int(cells.ends[-1])] * (shards - len(large))
            for a, b in zip(small, large, strict=True):
                near |= set(range(cells.border(min(a, b)), min(cells.border(max(a, b)) + 1, len(cells.names))))
            # and the largest: the capacity is not below a group
            near |= set(np.flatnonzero(cells.bytes > low).tolist())
        cuts, wished = cells.cuts(shards, high)
        near = [i for i in sorted(near | set(wished)) if not cells.single[i]]
        if not near:
            return high, [cells.names[c] if c < len(cells.names) else None for c in cuts[:-1]]
        finer = []
        by_length: dict[int, list[str]] = {}
        for i in near:
            by_length.setdefault(len(cells.names[i]), []).append(cells.names[i])
        for length, names in by_length.items():
            finer += measure(length + MORE_DIGITS, names)
        gone = set(near)
        cells = Cells([(cells.names[i], int(cells.bytes[i]), bool(cells.single[i])) for i in range(len(cells.names)) if i not in gone] + finer)


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row to a shard; equal texts stay together.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.  A null
    text counts as the empty text.  Repeated rows and null ids are kept, each with
    a slot of its own.  An empty table gives an empty result; with fewer groups
    than shards some shards are empty.  Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t")).select(
        "doc_id",
        (F.octet_length("_t") + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32("_t").alias("text_crc32"),
        F.md5("_t").alias("group"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"))
    rows = written(rows, "shard-rows")

    def measure(digits: int, within: list[str] | None) -> list[tuple[str, int, bool]]:
        some = rows if within is None else rows.filter(F.substring("group", 1, digits - MORE_DIGITS).isin(within))
        found = some.groupBy(F.substring("group", 1, digits).alias("cell")).agg(
            F.sum("size").alias("bytes"), (F.min("group") == F.max("group")).alias("single")).collect()
        return [(r.cell, r.bytes, r.single) for r in found]  # 65,536 cells at most, then 256 for each cell near a cut

    _, firsts = minimax_cuts(measure, shards)
    number = sum(((F.col("group") >= F.lit(f)).cast("int") for f in firsts if f is not None), F.lit(0))
    placed = rows.withColumn("shard", number).drop("group")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("at"))
    return (placed.withColumn("nth", nth).join(offsets, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                    (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
