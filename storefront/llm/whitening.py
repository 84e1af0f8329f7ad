"""Operator 13: whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The vectors become integers, are packed once into blocks of rows on the shared folder
and are centred in every pass from the exact sums, as (n*x - S) / n.  Step j of the
bidiagonalisation takes one pass over the blocks: every task forms its rows of
u = X y and returns X'u, the products of u with all earlier left vectors and its
length.  A left vector is never stored, as it has one entry for each row: it is the
image X y of a vector y with one entry for each dimension, so a task that needs the
earlier ones multiplies its rows by their y.  Left vectors are reorthogonalised
fully, once on the driver before the pass (X'u of the earlier ones is known there)
and once with the products that the pass returns; right vectors twice on the driver.

The driver holds vectors of the dimension's length, never anything for each row.  A
lost executor costs the tasks that it had.

When the residual bounds of the wanted triplets are below ``Plan.tolerance``, the
process goes on from a random vector orthogonal to all right vectors until they hold
again with the same values, so a second component of an equal deviation is found
too.  A space that is used up (a zero off-diagonal) goes on in the same way.  The
small bidiagonal matrix's SVD gives components and deviations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .corpus_io import small_batches, written

#: Entries of one block of vectors.
BLOCK_ENTRIES = 1 << 17
#: Scaled entries are held between these bounds, so that they and 1,000,000 more are exact doubles.
MOST = 1 << 52
OFFSET = 1_000_000
SCALE = 64.0


@dataclass(frozen=True)
class Plan:
    """How many components, and when the bidiagonalisation ends."""

    components: int = 32
    #: Residual of a wanted triplet against the largest singular value.
    tolerance: float = 1e-14
    #: A direction whose deviation is less than this share of the largest has none.
    rank_tolerance: float = 1e-9
    seed: int = 13


@dataclass(frozen=True)
class Fit:
    """The fitted list: row count, exact sums, components as columns, deviations and the covariance's trace."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    deviations: np.ndarray
    trace: float


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (doubles) of the rows whose vector is not null and has only finite entries."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vec").isNotNull() & ~odd)


def pack(rows: DataFrame, dims: int) -> DataFrame:
    """Blocks ``ids, wide, q``: floor(64 c) of several vectors, row after row, as 32-bit (``wide``: 64-bit) integers."""
    most = max(1, BLOCK_ENTRIES // max(dims, 1))
    id_type = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                vec = part.column("vec")
                size = np.diff(vec.offsets.to_numpy())
                flat = vec.flatten().to_numpy(zero_copy_only=False)
                c = np.zeros((len(size), dims))
                c[np.arange(dims) < size[:, None]] = flat
                q = np.floor(np.clip(c * SCALE, -MOST, MOST)).astype(np.int64)
                wide = bool(len(q) and dims) and int(np.abs(q).max()) >= 1 << 31
                ids = part.column("id")
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([wide]),
                     pa.array([q.astype("<i8" if wide else "<i4").tobytes()], pa.binary())], names=["ids", "wide", "q"])

    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("wide", T.BooleanType()),
                           T.StructField("q", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and x = floor(64 c) + 1,000,000 of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            kind = "<i8" if batch.column("wide")[i].as_py() else "<i4"
            ids = batch.column("ids")[i].values
            q = np.frombuffer(batch.column("q")[i].as_buffer(), dtype=kind)
            yield ids, q.reshape(len(ids), dims).astype(np.int64) + OFFSET


def numerators(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n*x - S exactly: 64-bit integers where they hold them, else Python's."""
    most = max((abs(s) for s in sums), default=0) + n * (int(np.abs(x).max()) if x.size else 0)
    if most < 1 << 62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return (numerators(x, n, sums) / n).astype(np.float64)


def squared(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n*x - S)**2, exactly; None where it is beyond a 64-bit integer."""
    v = numerators(x, n, sums)
    most = max(abs(int(v.max())), abs(int(v.min()))) if v.size else 0
    if v.dtype == object or most * most * v.shape[1] >= 1 << 63:
        v = v.astype(object)
        return [s if s < 1 << 63 else None for s in ((v * v).sum(axis=1) if v.size else [0] * len(v))]
    return (v * v).sum(axis=1).tolist()


def exact_sums(blocks: DataFrame, dims: int) -> tuple[int, ...]:
    """S of each dimension; the entries' high and low bits are added apart, so no sum overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for _, x in _blocks(batches, dims):
            high += (x >> 26).sum(axis=0)
            low += (x & ((1 << 26) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(high), pa.array(low)],
                                         names=["i", "high", "low"])

    total = blocks.mapInArrow(run, "i int, high long, low long").groupBy("i").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # one row for each dimension
    out = [0] * dims
    for r in total:
        out[r.i] = (r.high << 26) + r.low
    return tuple(out)


def _summed(blocks: DataFrame, size: int, dims: int, add) -> np.ndarray:
    """Sum over all blocks of ``add(x)``, a vector of ``size`` doubles; one vector for each task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size), False
        for _, x in _blocks(batches, dims):
            total += add(x)
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["i", "s"])

    out = np.zeros(size)
    for r in blocks.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        out[r.i] = r.s
    return out


def fit(blocks: DataFrame, n: int, dims: int, plan: Plan = Plan()) -> Fit:
    """Bidiagonalise the centred rows of ``blocks``; every step is one pass."""
    sums = exact_sums(blocks, dims)
    rng = np.random.default_rng(plan.seed)
    right = np.zeros((dims, 0))                                  # v_1 ... v_j
    image, back = np.zeros((dims, 0)), np.zeros((dims, 0))       # y_j with u_j = X y_j, and X'u_j
    alpha: list[float] = []
    beta: list[float] = []
    trace, scale = 0.0, 0.0
    held: np.ndarray | None = None

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v

    def fresh() -> np.ndarray:
        v = orthogonal(rng.standard_normal(dims))
        return v / np.linalg.norm(v)

    def bidiagonal() -> np.ndarray:
        return np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1)

    v = fresh() if dims else np.zeros(0)
    for j in range(dims):
        y = v - image @ (back.T @ v)
        vectors = np.column_stack((image, y))

        def add(x: np.ndarray, vectors=vectors) -> np.ndarray:
            rows = centred(x, n, sums)
            left = rows @ vectors
            return np.concatenate((left.T @ left[:, -1], rows.T @ left[:, -1], [(rows * rows).sum()]))

        got = _summed(blocks, j + 2 + dims, dims, add)
        rest, length, z, trace = got[:j], got[j], got[j + 1:-1], got[-1] / n
        y, z, length = y - image @ rest, z - back @ rest, max(0.0, length - rest @ rest)
        scale = max(scale, np.sqrt(length))
        a = float(np.sqrt(length))
        if a > 0 and a > plan.rank_tolerance * scale:
            y, z = y / a, z / a
        else:
            a, y, z = 0.0, np.zeros(dims), np.zeros(dims)
        right, image, back = (np.column_stack(p) for p in ((right, v), (image, y), (back, z)))
        alpha.append(a)
        r = orthogonal(z - a * v)
        b = float(np.linalg.norm(r))
        if j + 1 == dims:
            break
        last, s, _ = np.linalg.svd(bidiagonal())
        k = min(plan.components, len(s))
        if b <= plan.tolerance * scale or len(s) >= plan.components and (b * np.abs(last[-1, :k])).max() <= plan.tolerance * s[0]:
            # wanted triplets have converged, or the space is used up: go on elsewhere until nothing new comes
            if len(s) >= plan.components and held is not None and np.allclose(held, s[:k], rtol=1e-12, atol=1e-12 * s[0]):
                break
            held = s[:k]
            beta.append(0.0)
            v = fresh()
        else:
            beta.append(b)
            v = r / b
    if not dims or n == 0:
        return Fit(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0)
    _, s, q = np.linalg.svd(bidiagonal())
    k = int((s[:plan.components] > plan.rank_tolerance * s[0]).sum()) if s[0] > 0 else 0
    return Fit(n, sums, right @ q[:k].T, s[:k] / np.sqrt(n), trace)


def identity_error(blocks: DataFrame, dims: int, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.deviations)
    n, sums, turn = model.n, model.sums, model.components / model.deviations

    def add(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ turn
        return np.concatenate(((w.T @ w).ravel(), w.sum(axis=0)))

    got = _summed(blocks, k * k + k, dims, add) / n
    return float(np.abs(got[:k * k].reshape(k, k) - np.outer(got[k * k:], got[k * k:]) - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", plan: Plan = Plan()) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``.

    One row for each usable vector and component, numbered from 1 by falling
    deviation.  Rows whose vector is null or holds a null, NaN or infinite entry are
    left out.  A shorter vector counts as padded with zeros; entries beyond 2**52 / 64
    are taken as that.  Null and repeated ids are kept, each vector with rows of its
    own; equal vectors have equal rows.  Directions without deviation are no
    components, so equal vectors, a single one or none give an empty result.
    ``deviation`` is null where it is beyond a 64-bit integer.  Other columns of
    ``df`` are not looked at.
    """
    small_batches(df.sparkSession)
    rows = usable(df, id_col, vec_col)
    n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    blocks = written(pack(rows, dims), "whitening-blocks")
    model = fit(blocks, n, dims, plan)
    k = len(model.deviations)
    error = identity_error(blocks, dims, model) if k else 0.0
    sums = model.sums
    turn = model.components / model.deviations
    share = model.deviations ** 2 / model.trace if k else model.deviations
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if k == 0:
            return
        for ids, x in _blocks(batches, dims):
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            w = centred(x, n, sums) @ turn
            yield pa.RecordBatch.from_arrays(
                [ids.take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n)),
                 pa.array(squared(x, n, sums), pa.int64()).take(each), pa.array(w.ravel()),
                 pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))], names=names)

    return blocks.mapInArrow(run, schema)
