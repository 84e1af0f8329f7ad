"""Operator 2: vector bin packing of tokenised examples into training sequences.

Each sequence has three limits at once: tokens, segments (pieces) and
loss-bearing tokens.  A task reads its documents as a stream, keeps a bounded pool
of open examples and fills one sequence at a time: of the examples that fit
whole, the one whose demand vector has the largest dot product with what the
sequence has left; when none fits, the best one is cut to fill it.  Nothing is
shuffled: a sequence never crosses input partitions, and its number is the
partition's number and a count.

What a task has left at the end goes into sequences whose lengths are powers of
two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .bpe import slice_encoder

#: Examples that a task keeps open to choose from.
POOL = 256
#: Bits of a sequence's number that count within an input partition.
SEQUENCE_BITS = 36


@dataclass(frozen=True)
class Limits:
    """The limits of one sequence."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("every limit of a sequence is 1 at least")


class Packer:
    """Fills sequences from a pool of examples with the dot-product heuristic.

    An example is (key, ids, plain) where the first ``plain`` ids bear no loss.
    """

    def __init__(self, limits: Limits):
        self.limits = limits
        self.scale = 1.0 / np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64) ** 2
        self.open: list[tuple] = []  # (key, ids, plain)
        self.start = np.zeros(2 * POOL, np.int64)
        self.rest = np.zeros(2 * POOL, np.int64)  # ids from the start on, and those of them that bear no loss
        self.free = np.zeros(2 * POOL, np.int64)
        self.sequence = 0
        self.pieces: list[tuple] = []  # (key, start, doc_tokens, ids, loss, sequence, offset)

    def add(self, key, ids: np.ndarray, plain: int) -> None:
        """Take an example; whole sequences of its own are cut off at once."""
        start, size, limits = 0, len(ids), self.limits
        while size - start >= limits.tokens:
            loss = limits.tokens - max(0, min(plain - start, limits.tokens))
            if loss > limits.loss_tokens:
                break
            self.pieces.append((key, start, size, ids[start:start + limits.tokens], loss, self.sequence, 0))
            self.sequence += 1
            start += limits.tokens
        if start < size:
            n = len(self.open)
            self.open.append((key, ids, plain))
            self.start[n], self.rest[n], self.free[n] = start, size - start, max(0, plain - start)
        while len(self.open) > POOL:
            self._fill(limits.tokens)

    def finish(self) -> None:
        """Place all that is left, in sequences of full length or a power of two."""
        while self.open:
            left = int(self.rest[:len(self.open)].sum())
            self._fill(min(self.limits.tokens, 1 << (left.bit_length() - 1)))

    def _fill(self, tokens: int) -> None:
        """Fill one sequence of ``tokens`` ids at most from the pool."""
        n = len(self.open)
        rest, free = self.rest[:n], self.free[:n]
        demand = np.empty((3, n))
        demand[0], demand[1], demand[2] = rest, 1, rest - free
        room, segments, loss_room = tokens, self.limits.segments, self.limits.loss_tokens
        alive = np.ones(n, dtype=bool)
        offset = 0
        while room and segments and alive.any():
            score = (self.scale * (room, segments, loss_room)) @ demand
            fits = alive & (demand[0] <= room) & (demand[2] <= loss_room)
            i = int(np.argmax(np.where(fits if fits.any() else alive, score, -1.0)))
            length = int(min(room, rest[i], free[i] + loss_room))
            alive[i] = False
            if length < 1:  # its next id bears loss and no loss is left: it waits for the next sequence
                continue
            key, ids, _ = self.open[i]
            start = int(self.start[i])
            loss = length - int(min(free[i], length))
            self.pieces.append((key, start, len(ids), ids[start:start + length], loss, self.sequence, offset))
            offset, room, segments, loss_room = offset + length, room - length, segments - 1, loss_room - loss
            self.start[i] += length
            rest[i] -= length
            free[i] = max(0, free[i] - length)
        self.sequence += 1
        kept = np.flatnonzero(rest)
        if len(kept) < n:
            self.open = [self.open[i] for i in kept]
            for x in (self.start, self.rest, self.free):
                x[:len(kept)] = x[kept]


PIECES = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("loss_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("ids", T.BinaryType())])


def pack(docs: DataFrame, tokenizer_path: str, limits: Limits = Limits(), id_col: str = "doc_id",
         text_col: str = "text", prompt_col: str | None = None, end_id: int = 1) -> DataFrame:
    """Tokenise every document and pack all its ids into sequences.

    Returns one row for each piece: the id column, ``start`` (ids of the document
    before it), ``length``, ``doc_tokens`` (with ``end_id``), ``loss_tokens``,
    ``sequence_id``, ``offset`` (in the sequence, gapless from 0) and ``ids``
    (little-endian uint32).  ``prompt_col`` names a column with the prompt's text,
    which goes before the text and bears no loss.

    A null text is the empty one, and gives the single ``end_id``.  Repeated rows
    are examples of their own, null ids are kept, very long texts are cut, an
    empty table gives an empty result, and other columns are not looked at.
    """
    prompt = F.coalesce(F.col(prompt_col), F.lit("")) if prompt_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                       prompt.cast("binary").alias("prompt"))
    schema = T.StructType([T.StructField(id_col, rows.schema["key"].dataType), *PIECES.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, packer = slice_encoder(tokenizer_path), Packer(limits)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        end = np.array([end_id], dtype=np.uint32)
        key_type = None

        def out() -> pa.RecordBatch:
            p, packer.pieces = packer.pieces, []
            longs = [pa.array([x[k] for x in p], pa.int64()) for k in (1, 2, 4)]
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in p], key_type), longs[0], pa.array([len(x[3]) for x in p], pa.int64()),
                 longs[1], longs[2], pa.array([base + x[5] for x in p], pa.int64()),
                 pa.array([x[6] for x in p], pa.int64()),
                 pa.array([x[3].astype("<u4").tobytes() for x in p], pa.binary())], names=schema.names)

        for batch in batches:
            key_type = batch.schema.field("key").type
            for part in tv.text_slices(batch, "text"):
                ids, sizes = encoder.encode(*tv.binary_view(part.column("text")))
                heads, head_sizes = encoder.encode(*tv.binary_view(part.column("prompt")))
                a = b = 0
                for key, n, m in zip(part.column("key").to_pylist(), sizes.tolist(), head_sizes.tolist(), strict=True):
                    packer.add(key, np.concatenate((heads[b:b + m], ids[a:a + n], end)), m)
                    a, b = a + n, b + m
                if packer.pieces:
                    yield out()
        packer.finish()
        if packer.pieces:
            yield out()

    return rows.mapInArrow(run, schema)
