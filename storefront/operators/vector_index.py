"""Nearest neighbours of embedding vectors, by an index of inverted cells or exactly.

``build_index`` fits a coarse quantiser (k-means on a bounded sample), puts every row
into the cell of its nearest centre and packs cells into blocks of vectors.  A cell
with more rows than ``PART_ROWS`` is dealt into parts by id, so no part holds a popular
vector's copies alone, however many there are.  ``search`` sends each query to the
parts of its ``probes`` nearest cells: a shuffle join of blocks of queries and blocks
of rows on (cell, part), scored with one matrix product for each pair of blocks.
Candidates are ranked by their exact similarity.

``probes`` is the least number of cells that holds the wanted share of the true
neighbours of a bounded sample of rows, measured in one pass over all rows.

``exact_neighbours`` compares a stated query set with all rows, block by block.

Neither vectors of rows nor those of queries come to the driver; it holds the cells'
centres and sizes and the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storefront.session import ship_package

TOP_N = 5
#: Vectors of a block of rows and of a block of queries.
BLOCK_ROWS, BLOCK_QUERIES = 2_048, 1_024
#: Rows of a part of a cell.
PART_ROWS = 16_384
#: Rows of the sample for each centre, and rows whose neighbours are searched to set ``probes``.
FIT_ROWS, TUNE_ROWS = 64, 256
#: Centres lie on the driver and travel with tasks: beyond the square of this many rows cells grow instead.
MOST_CELLS = 1 << 14
FIT_ROUNDS = 8
#: Entries of a matrix of rows and centres, and rows of an answer to one batch: both bound a worker's memory, whatever
#: the number of cells and of visited ones.
MOST_ENTRIES, MOST_VISITS = 1 << 20, 1 << 14


@dataclass(frozen=True)
class VectorIndex:
    """Cells' centres, parts of each cell, how many cells a query visits, and the packed rows."""

    centres: np.ndarray
    parts: np.ndarray
    probes: int
    blocks: DataFrame  # cell, part, ids, vectors

    @property
    def dims(self) -> int:
        return self.centres.shape[1]


def unit_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, v``: vectors scaled to length 1; a null, zero or non-finite vector is the zero vector.

    Rows with a null id are left out: an answer names rows by id.
    """
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    squared = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    usable = (squared > 0) & (squared < float("inf"))
    scaled = F.when(usable, F.transform(v, lambda x: x / F.sqrt(squared))).otherwise(F.array().cast("array<double>"))
    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))


def _matrix(column, dims: int) -> np.ndarray:
    """A list column as one matrix; shorter vectors are filled with zeros, longer ones meet zeros beyond ``dims``."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(size), dims))
    out[np.arange(dims) < size[:, None]] = flat[place < dims]
    return out


def _nearest_cells(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, nearest first; few rows meet all centres at once."""
    out = np.empty((len(x), k), np.int64)
    size, most = (centres * centres).sum(axis=1), max(1, MOST_ENTRIES // len(centres))
    for at in range(0, len(x), most):
        far = size - 2.0 * (x[at:at + most] @ centres.T)
        out[at:at + most] = far.argmin(axis=1)[:, None] if k == 1 else np.argsort(far, axis=1, kind="stable")[:, :k]
    return out


def _packed(rows: DataFrame, keys: list[str], dims: int, most: int) -> DataFrame:
    """Blocks ``*keys, ids, vectors`` of consecutive rows with equal keys; ``vectors`` are doubles, row after row."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = [batch.column(k).to_numpy() for k in keys]
            change = np.zeros(batch.num_rows, bool)
            for k in key:
                change[1:] |= k[1:] != k[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for at in range(a, b, most):
                    part = batch.slice(at, min(most, b - at))
                    ids = part.column("id")
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(k[at:at + 1]) for k in key), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                         pa.array([_matrix(part.column("v"), dims).tobytes()], pa.binary())], names=[*keys, "ids", "vectors"])

    fields = "".join(f"{k} int, " for k in keys)
    return rows.select(*keys, "id", "v").mapInArrow(run, fields + "ids array<long>, vectors binary")


def _best(sim: np.ndarray, row_ids: np.ndarray, top_n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the top_n largest similarities of each row (ties: lesser id) and whether they count."""
    if sim.shape[1] > 4 * top_n:  # only those not below the top_n-th largest are sorted
        least = -np.partition(-sim, top_n - 1, axis=1)[:, top_n - 1:top_n]
        order = np.argsort(row_ids, kind="stable")
        wanted = (sim >= least)[:, order]
        width = int(wanted.sum(axis=1).max())
        few = order[np.argsort(~wanted, axis=1, kind="stable")[:, :width]]
        close = np.take_along_axis(sim, few, 1)
        close[~np.take_along_axis(wanted, np.argsort(~wanted, axis=1, kind="stable")[:, :width], 1)] = -np.inf
    else:
        few = np.broadcast_to(np.argsort(row_ids, kind="stable"), sim.shape)
        close = np.take_along_axis(sim, few, 1)
    top = np.argsort(-close, axis=1, kind="stable")[:, :top_n]
    return np.take_along_axis(few, top, 1), np.isfinite(np.take_along_axis(close, top, 1))


def _scored(pairs: DataFrame, dims: int, top_n: int) -> DataFrame:
    """The top_n rows of each query within each pair of blocks (``ids, vectors, q_ids, q_vectors``), then among all."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values.to_numpy()
                q_ids = batch.column("q_ids")[i].values.to_numpy()
                x = np.frombuffer(batch.column("vectors")[i].as_buffer()).reshape(len(ids), dims)
                q = np.frombuffer(batch.column("q_vectors")[i].as_buffer()).reshape(len(q_ids), dims)
                sim = np.round(q @ x.T, 12)
                sim[q_ids[:, None] == ids[None, :]] = -np.inf
                place, there = _best(sim, ids, top_n)
                rows = np.repeat(np.arange(len(q_ids)), there.sum(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[rows]), pa.array(ids[place[there]]), pa.array(sim[rows, place[there]])],
                                                 names=["query_id", "id", "similarity"])

    found = pairs.select("ids", "vectors", "q_ids", "q_vectors").mapInArrow(run, "query_id long, id long, similarity double")
    w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def _dims(rows: DataFrame) -> tuple[int, int]:
    """Number of rows and length of the longest vector (1 at least)."""
    ship_package(rows.sparkSession)
    n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    return n, max(dims, 1)


def exact_neighbours(df: DataFrame, id_col: str, vec_col: str, queries: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """The top_n rows most similar (cosine) to each row of ``queries``, itself excluded.

    ``queries`` has the same two columns.  Each block of queries meets each block of
    rows, and only top_n rows for each query leave a pair.  Returns ``query_id, rank,
    <id_col>, similarity`` (to 12 decimals); ties go to the lesser id.  Null ids are
    left out, a null, zero or non-finite vector has similarity 0, copies are all
    compared, and an empty side gives an empty result.
    """
    rows, asked = unit_rows(df, id_col, vec_col), unit_rows(queries, id_col, vec_col)
    _, dims = _dims(rows.unionByName(asked))
    blocks = _packed(rows, [], dims, BLOCK_ROWS)
    wanted = _packed(asked, [], dims, BLOCK_QUERIES).select(F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    return _scored(blocks.crossJoin(wanted), dims, top_n).select("query_id", "rank", F.col("id").alias(id_col), "similarity")


def _centres(rows: DataFrame, n: int, dims: int, cells: int, seed: int) -> np.ndarray:
    """Centres of k-means on a sample of about ``FIT_ROWS`` rows for each cell."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    share = min(1.0, FIT_ROWS * cells / n)
    full = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("v")))
    sample = rows.where(F.size("v") > 0).sample(False, share, seed).select(array_to_vector(full).alias("features"))
    model = KMeans(k=cells, initMode="random", maxIter=FIT_ROUNDS, seed=seed).fit(sample)
    return np.array(model.clusterCenters())


def _probes(rows: DataFrame, centres: np.ndarray, recall: float, top_n: int) -> int:
    """Cells that hold the share ``recall`` of the true neighbours of ``TUNE_ROWS`` rows."""
    import pyarrow as pa

    dims = centres.shape[1]
    asked = rows.where(F.size("v") > 0).orderBy(F.xxhash64("id"), "id").limit(TUNE_ROWS).collect()
    ids = np.array([r.id for r in asked], np.int64)
    q = np.array([r.v + [0.0] * (dims - len(r.v)) for r in asked]).reshape(len(ids), dims)

    def run(batches):
        for batch in batches:
            x, own = _matrix(batch.column("v"), dims), batch.column("id").to_numpy()
            sim = q @ x.T
            sim[ids[:, None] == own[None, :]] = -np.inf
            place, there = _best(sim, own, top_n)
            rows_ = np.repeat(np.arange(len(ids)), there.sum(axis=1))
            cell = _nearest_cells(x, centres, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(rows_), pa.array(own[place[there]]), pa.array(sim[rows_, place[there]]),
                                              pa.array(cell[place[there]])], names=["q", "id", "s", "cell"])

    w = Window.partitionBy("q").orderBy(F.col("s").desc(), "id")
    found = (rows.mapInArrow(run, "q long, id long, s double, cell long").withColumn("r", F.row_number().over(w))
             .where(F.col("r") <= top_n).select("q", "cell").collect())  # TUNE_ROWS * top_n rows
    if not found:
        return 1
    order = np.argsort(_nearest_cells(q, centres, len(centres)), axis=1)  # the place of each cell in a query's order
    seen = np.sort(order[[r.q for r in found], [r.cell for r in found]])
    return int(seen[min(len(seen) - 1, int(np.ceil(recall * len(seen))) - 1)]) + 1


def build_index(df: DataFrame, id_col: str, vec_col: str, cells: int | None = None, probes: int | None = None,
                recall: float = 0.95, top_n: int = TOP_N, seed: int = 42) -> VectorIndex:
    """Index every row of ``df`` (needs a checkpoint folder).

    ``cells`` defaults to the square root of the number of rows, ``probes`` to what
    reaches ``recall`` for ``top_n`` neighbours on a sample.
    """
    rows = unit_rows(df, id_col, vec_col)
    n, dims = _dims(rows)
    cells = max(1, min(cells or round(n ** 0.5), MOST_CELLS, n))
    some = rows.where(F.size("v") > 0).limit(1).count()
    centres = _centres(rows, n, dims, cells, seed) if some and cells > 1 else np.zeros((1, dims))

    def cell_of(batches: Iterator):
        import pyarrow as pa
        for batch in batches:
            cell = _nearest_cells(_matrix(batch.column("v"), dims), centres, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), batch.column("id"), batch.column("v")], names=["cell", "id", "v"])

    placed = rows.mapInArrow(cell_of, "cell int, id long, v array<double>").checkpoint()
    parts = np.ones(len(centres), np.int64)
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # one row for each cell
        parts[r.cell] = -(-r.n // PART_ROWS)
    part = F.pmod(F.xxhash64("id"), F.element_at(F.lit(parts.tolist()), F.col("cell") + 1)).cast("int")
    dealt = placed.withColumn("part", part).repartition("cell", "part").sortWithinPartitions("cell", "part")
    blocks = _packed(dealt, ["cell", "part"], dims, BLOCK_ROWS).checkpoint()
    if probes is None:
        probes = _probes(placed.select("id", "v"), centres, recall, top_n)
    return VectorIndex(centres, parts, min(probes, len(centres)), blocks)


def search(index: VectorIndex, queries: DataFrame, id_col: str, vec_col: str, top_n: int = TOP_N,
           probes: int | None = None) -> DataFrame:
    """The most similar rows of an index, as ``exact_neighbours`` gives them, among those of the visited cells."""
    import pyarrow as pa

    centres, dims, parts = index.centres, index.dims, index.parts
    visited = min(probes or index.probes, len(centres))

    def visits(batches):
        some = max(1, MOST_VISITS // visited)
        for batch in (b.slice(at, some) for b in batches for at in range(0, b.num_rows, some)):
            near = _nearest_cells(_matrix(batch.column("v"), dims), centres, visited)
            times = parts[near]
            row = np.repeat(np.arange(batch.num_rows), times.sum(axis=1))
            cell = np.repeat(near.ravel(), times.ravel())
            begin = np.cumsum(times.ravel()) - times.ravel()
            part = np.arange(len(cell)) - np.repeat(begin, times.ravel())
            for at in range(0, len(row), MOST_VISITS):  # a cell may have many parts
                to = slice(at, at + MOST_VISITS)
                take = pa.array(row[to])
                yield pa.RecordBatch.from_arrays([pa.array(cell[to], pa.int32()), pa.array(part[to], pa.int32()),
                                                  batch.column("id").take(take), batch.column("v").take(take)],
                                                 names=["cell", "part", "id", "v"])

    asked = unit_rows(queries, id_col, vec_col).mapInArrow(visits, "cell int, part int, id long, v array<double>").checkpoint()
    # queries that visit one cell are dealt into blocks' worth of shares
    many = asked.groupBy("cell", "part").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_QUERIES)).alias("shares"))
    dealt = asked.join(many, ["cell", "part"]).withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int"))
    dealt = dealt.repartition("cell", "part", "share").sortWithinPartitions("cell", "part", "share")
    wanted = _packed(dealt, ["cell", "part", "share"], dims, BLOCK_QUERIES).select(
        "cell", "part", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    return _scored(index.blocks.join(wanted, ["cell", "part"]), dims, top_n).select(
        "query_id", "rank", F.col("id").alias(id_col), "similarity")


def recall_of(found: DataFrame, exact: DataFrame, id_col: str) -> DataFrame:
    """``queries, neighbours, recall``: the share of exact neighbours that ``found`` holds, by similarity.

    A found row that is as similar as the last exact neighbour counts, whichever of
    equally similar rows was taken.
    """
    last = exact.groupBy("query_id").agg(F.min("similarity").alias("least"), F.count(F.lit(1)).alias("wanted"))
    good = found.join(last, "query_id").where(F.col("similarity") >= F.col("least") - 1e-9).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("good"))
    return last.join(good, "query_id", "left").agg(
        F.count(F.lit(1)).alias("queries"), F.sum("wanted").alias("neighbours"),
        F.try_divide(F.sum(F.least("wanted", F.coalesce("good", F.lit(0)))), F.sum("wanted")).alias("recall"))
