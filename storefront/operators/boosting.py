"""Boosted regression trees over rows that are packed into small codes (M4, M6).

Spark ML's ``GBTRegressor`` passes over rows that are objects, about seven jobs for each tree.
``BoostedTrees`` is the same estimator with the same parameters and the same rules (squared error, bins by
quantiles, a subsample for each tree, end at the best validation error) and gives the same kind of model.
Its rows are blocks of numpy arrays: a code for each group of features, and the residuals.  A job for each
level adds up rows and residuals by node and bin; the splits are found from these sums on the driver.

* One job ends a tree (new residuals, validation error) and begins the next one (its root's sums).
* Only the smaller child of a split is counted: the other one has what its parent has without it.
* Features with few bins share a code, so that one count serves several features.
* The way of a row is looked up by code: a bit for each node that tells whether it goes right there.
* A task holds a block at a time.  Blocks are persisted as Spark ML's rows are: in memory, or else on disk.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.accumulators import Accumulator, AccumulatorParam
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.session import ensure_checkpoint_dir, ship_package

#: Rows that are worked on at a time.
BLOCK_ROWS = 131_072
#: Most cells of one code: the sums of a level's nodes stay in a core's cache.
CODE_CELLS = 1024
#: Distinct values of a feature that a summary has at most; one of more values has a quarter of them, evenly by rank.
SUMMARY = 16_384
#: A gain below this share of what it is the difference of is rounding.
ROUNDING = 1e-12
#: Parameters that ``BoostedTrees`` leaves to Spark ML unless they have these values.
PLAIN = {"lossType": "squared", "impurity": "variance", "featureSubsetStrategy": "all", "minWeightFractionPerNode": 0.0,
         "leafCol": ""}


class BoostedTrees(GBTRegressor):
    """``GBTRegressor`` for many rows.  ``inputs`` names the columns that the features were assembled from (else the vectors
    are read); ``undealt`` has the same rows where they are cheaper to read, for the bins."""

    inputs: list[str] | None = None
    undealt: DataFrame | None = None

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        value = self.getOrDefault
        if self.isDefined("weightCol") or any(value(k) != v for k, v in PLAIN.items()) or value("maxDepth") > 6:
            return super()._fit(dataset)
        spark = dataset.sparkSession
        ship_package(spark)
        ensure_checkpoint_dir(spark)
        validate = self.isDefined("validationIndicatorCol")
        is_val = F.col(value("validationIndicatorCol")) if validate else F.lit(False)

        x = (F.array(*[F.col(c).cast("double") for c in self.inputs]) if self.inputs
             else vector_to_array(F.col(value("featuresCol"))))

        def rows(df: DataFrame) -> DataFrame:
            return df.where(is_val.isNotNull()).select(x.alias("x"), F.col(value("labelCol")).cast("double").alias("y"),
                                                       is_val.alias("val"))

        cuts = find_cuts(rows(self.undealt if self.undealt is not None else dataset), value("maxBins"))
        layout = Layout(cuts, value("maxDepth"))
        trees = boost(packed(rows(dataset), layout), layout, validate, *(value(p) for p in (
            "maxIter", "stepSize", "subsamplingRate", "validationTol", "minInstancesPerNode", "minInfoGain", "seed",
            "checkpointInterval")))
        weights = [1.0] + [value("stepSize")] * (len(trees) - 1)
        return self._copyValues(GBTRegressionModel(_spark_model(spark, self.uid, trees, weights, layout.width)))


# -------------------------------------------------------------------- bins ---
def merged(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the distinct values; above ``most`` of them each entry stands for the values up to its own."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    values, counts = values[first], np.add.reduceat(counts, first) if len(first) else counts
    if len(values) <= most:
        return values, counts
    below = np.cumsum(counts)
    marks = np.arange(1, most // 4 + 1) * (below[-1] / (most // 4))
    at = np.unique(np.searchsorted(below, marks).clip(max=len(below) - 1))
    return values[at], np.diff(below[at], prepend=0)


def thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Spark ML's choice: between all values if they are few, or else between values near every ``1 / bins`` of the rows."""
    between = (values[:-1] + values[1:]) / 2
    if len(values) <= bins:
        return between
    below, out, step = np.cumsum(counts), [], counts.sum() / bins
    target = step
    for i in range(1, len(values)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            out.append(between[i - 1])
            target += step
    return np.array(out)


def grouped(sizes: list[int], most: int) -> list[list[int]]:
    """Features that share a code: the product of their bins is at most ``most``; those of one bin are in none."""
    groups: list[list[int]] = []
    for f in sorted((f for f, n in enumerate(sizes) if n > 1), key=lambda f: -sizes[f]):
        fits = [g for g in groups if math.prod(sizes[i] for i in g) * sizes[f] <= most]
        fits[0].append(f) if fits else groups.append([f])
    return groups


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features by row, labels, which are for validation) of each batch."""
    for batch in batches:
        if batch.num_rows:
            x, y, val = (batch.column(i) for i in range(3))
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = y.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all() or not np.isfinite(y).all():
                raise ValueError("labels and features must be numbers: not NULL, NaN or infinite")
            yield x, y, val.to_numpy(zero_copy_only=False).astype(bool)


def _blocks(arrays: Iterator[tuple]) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """(for validation, features by column, labels) of about ``BLOCK_ROWS`` rows each."""
    waiting: dict[bool, list] = {False: [], True: []}

    def flush(kind):
        x, y = (np.concatenate(c) for c in zip(*waiting[kind]))
        waiting[kind] = []
        return kind, np.ascontiguousarray(x.T), y

    for x, y, val in arrays:
        for kind in (False, True):
            chosen = np.flatnonzero(val == kind)
            if len(chosen):
                waiting[kind].append((x[chosen], y[chosen]))
                if sum(len(w[1]) for w in waiting[kind]) >= BLOCK_ROWS:
                    yield flush(kind)
    for kind in (False, True):
        if waiting[kind]:
            yield flush(kind)


def find_cuts(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Thresholds of each feature, from summaries of all training rows."""
    def run(batches):
        summaries: list[list] = []
        for val, x, _ in _blocks(_arrays(batches)):
            if not val:
                summaries = summaries or [[] for _ in x]
                for parts, column in zip(summaries, x):
                    parts.append(merged(*np.unique(column, return_counts=True), SUMMARY))
                    if sum(len(v) for v, _ in parts) > 8 * SUMMARY:
                        parts[:] = [merged(*map(np.concatenate, zip(*parts)), 4 * SUMMARY)]
        for f, parts in enumerate(summaries):
            v, c = merged(*map(np.concatenate, zip(*parts)), SUMMARY)
            yield pa.record_batch({"f": pa.array([f], pa.int32()), "v": pa.array([v], pa.list_(pa.float64())),
                                   "c": pa.array([c], pa.list_(pa.int64()))})

    told = rows.mapInArrow(run, "f int, v array<double>, c array<bigint>").collect()
    if not told:
        raise ValueError("no rows to fit")
    out = []
    for f in range(max(t.f for t in told) + 1):
        v, c = (np.concatenate([np.asarray(t[i]) for t in told if t.f == f]) for i in (1, 2))
        out.append(thresholds(*merged(v, c, len(v)), bins))
    return out


# --------------------------------------------------------------------- fit ---
class Layout:
    """How rows are packed, and the passes over packed rows.

    Nodes have the numbers of a heap (root 1, children 2i and 2i + 1); rows outside a tree's subsample
    carry ``out`` on top, as they are not counted but go the same way.
    """

    def __init__(self, cuts: list[np.ndarray], depth: int):
        self.cuts, self.depth, self.width = cuts, depth, len(cuts)
        self.sizes = [len(c) + 1 for c in cuts]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.groups = grouped(self.sizes, CODE_CELLS) or [[0]]
        self.cells = [math.prod(self.sizes[f] for f in g) for g in self.groups]
        self.out = 2 << depth
        self.bits = np.uint32 if depth <= 5 else np.uint64       # one for each node that can be split

    def pack(self, x: np.ndarray) -> np.ndarray:
        """A code of each row for each group of features."""
        codes = np.zeros((len(self.groups), x.shape[1]), np.uint16)
        for code, group in zip(codes, self.groups):
            for f in group:
                code *= self.sizes[f]
                code += np.searchsorted(self.cuts[f], x[f]).astype(np.uint16)
        return codes

    def outside(self, rate: float, seed: tuple, n: int) -> np.ndarray:
        """Which rows a tree doesn't sample."""
        if rate >= 1.0:
            return np.zeros(n, bool)
        return np.random.default_rng(seed).integers(0, 2**32, n, np.uint32) >= np.uint32(rate * 2.0**32)

    def empty(self, nodes: int) -> list[np.ndarray]:
        return [np.zeros((2, nodes * c)) for c in self.cells]

    def count(self, sums: list[np.ndarray], codes: np.ndarray, residuals: np.ndarray, nodes: np.ndarray, place: dict) -> None:
        """Adds rows and residuals by code for the nodes of ``place``."""
        at = np.full(2 * self.out, len(place))
        for node, i in place.items():
            at[node] = i
        where = at.take(nodes)
        rows = np.flatnonzero(where < len(place))
        few = 3 * len(rows) < len(nodes)          # else the other rows are counted, too, behind the nodes
        if few:
            where, residuals = where.take(rows), residuals.take(rows)
        for total, code, cells in zip(sums, codes, self.cells):
            cell = where * cells
            cell += code.take(rows) if few else code
            n = total.shape[1]
            total[0] += np.bincount(cell, minlength=n)[:n]
            total[1] += np.bincount(cell, residuals, n)[:n]

    def by_bin(self, sums: list[np.ndarray]) -> np.ndarray:
        """(2, nodes, all bins of all features): rows and residuals."""
        n = sums[0].shape[1] // self.cells[0]
        out = np.zeros((2, n, self.starts[-1]))
        for total, group in zip(sums, self.groups):
            cube = total.reshape(2, n, *[self.sizes[f] for f in group])
            for i, f in enumerate(group):
                others = tuple(2 + j for j in range(len(group)) if j != i)
                out[:, :, self.starts[f]:self.starts[f + 1]] = cube.sum(axis=others)
        for f in range(self.width):
            if self.sizes[f] == 1:
                out[:, :, self.starts[f]] = sums[0].reshape(2, n, -1).sum(axis=2)
        return out

    def turns(self, splits: dict[int, tuple[int, int]]) -> list[tuple[int, np.ndarray]]:
        """For each group of features that nodes are split by: a bit for each node, by code, that is 1 if it goes right."""
        out = []
        for g, group in enumerate(self.groups):
            bits = np.zeros(self.cells[g], self.bits)
            for node, (feature, last) in splits.items():
                if feature in group:
                    after = math.prod(self.sizes[f] for f in group[group.index(feature) + 1:])
                    right = np.arange(self.cells[g]) // after % self.sizes[feature] > last
                    bits |= right.astype(self.bits) << self.bits(node - 1)
            if bits.any():
                out.append((g, bits))
        return out

    def nodes(self, turns: list[tuple[int, np.ndarray]], levels: int, codes: np.ndarray, outside: np.ndarray | None) -> np.ndarray:
        """The node of each row after so many levels; a node that isn't split goes on as its left child."""
        bits = np.zeros(codes.shape[1], self.bits)
        for g, by_code in turns:
            bits |= by_code.take(codes[g])
        node, one = np.ones(codes.shape[1], self.bits), self.bits(1)
        for _ in range(levels):
            right = bits >> (node - one)
            right &= one
            node += node
            node += right
        if outside is not None:
            node += outside * self.bits(self.out)
        return node


class _Parts(AccumulatorParam):
    """{part: what it found}: floating point numbers are then added in the same order each time."""

    def zero(self, value):
        return {}

    def addInPlace(self, value1, value2):
        value1.update(value2)
        return value1


def packed(rows: DataFrame, layout: Layout) -> RDD:
    """Blocks (for validation, codes, residuals, rows outside the subsample); the last one is not drawn yet."""
    def run(batches):
        for val, x, y in _blocks(_arrays(batches)):
            yield pa.record_batch({"val": pa.array([val]), "codes": pa.array([layout.pack(x).tobytes()], pa.binary()),
                                   "y": pa.array([y.tobytes()], pa.binary())})

    def block(row):
        y = np.frombuffer(row.y, np.float64)
        return row.val, np.frombuffer(row.codes, np.uint16).reshape(-1, len(y)), y, None

    return rows.mapInArrow(run, "val boolean, codes binary, y binary").rdd.map(block)


def boost(blocks: RDD, layout: Layout, validate: bool, max_iter: int, step: float, rate: float, tol: float, least: int,
          min_gain: float, seed: int, checkpoint_trees: int) -> list[dict]:
    """The trees (``_plain``), by Spark ML's rules."""
    trees: list[dict] = []
    best_error, best = math.nan, 1
    written: list[str] = []
    state = None
    for m in range(max_iter + 1):
        before, last = state if m else blocks, trees[-1] if trees else None
        found = blocks.ctx.accumulator({}, _Parts())
        state = before.mapPartitionsWithIndex(_between(layout, last, rate, (seed % 2**32, m), found), True) \
                      .persist(StorageLevel.MEMORY_AND_DISK_DESER)
        if m and checkpoint_trees > 0 and m % checkpoint_trees == 0:
            state.checkpoint()
        state._jrdd.count()          # the blocks stay in the JVM: what is asked for comes by the accumulator
        if m:
            before.unpersist()
        if state.isCheckpointed():
            written.append(state.getCheckpointFile())
            _removed(state, written[:-1])
        root, squares, error, held_out = (_added([found.value[p][i] for p in sorted(found.value)]) for i in range(4))
        if last is not None:
            last["squares"] = squares * last["scale"] ** 2
            if validate:
                error = error / held_out if held_out else math.nan
                if m == 1:
                    best_error = error
                elif best_error - error < tol * max(error, 0.01):
                    break
                elif error < best_error:
                    best_error, best = error, m
        if m < max_iter:
            trees.append(_tree(state, layout, m, root, 1.0 if m == 0 else step, least, min_gain))
    state.unpersist()
    _removed(state, written)
    return [_plain(t, layout.depth) for t in (trees[:best] if validate else trees)]


def _removed(rdd: RDD, folders: list[str]) -> None:
    for folder in folders:
        path = rdd.ctx._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(rdd.ctx._jsc.hadoopConfiguration()).delete(path, True)


def _between(layout: Layout, last: dict | None, rate: float, seed: tuple, found: Accumulator) -> Callable:
    """Ends the last tree and begins the next: blocks with new residuals and a new subsample; and, in ``found``, each part's
    (sums of the root's bins, the ended tree's squares by node, squared error of validation rows, their number)."""
    levels, steps = (last["levels"], last["steps"]) if last else ([], None)

    def run(part, blocks):
        turns = layout.turns({n: s for level in levels for n, s in level.items()})
        root, squares, error, held_out = layout.empty(1), np.zeros(layout.out), 0.0, 0
        for b, (val, codes, residuals, outside) in enumerate(blocks):
            if steps is not None:
                nodes = layout.nodes(turns, layout.depth, codes, outside)
                if not val:
                    squares += np.bincount(nodes.astype(np.int64), residuals * residuals, 2 * layout.out)[:layout.out]
                residuals = residuals - steps.take(nodes)
            if val:
                error, held_out, outside = error + float(residuals @ residuals), held_out + len(residuals), None
            else:
                outside = layout.outside(rate, (*seed, part, b), len(residuals))
                layout.count(root, codes, residuals, layout.nodes([], 0, codes, outside), {1: 0})
            yield val, codes, residuals, outside
        found.add({part: (layout.by_bin(root), squares, error, held_out)})
    return run


def _level(layout: Layout, levels: list[dict], place: dict) -> Callable:
    """Sums of the nodes of ``place`` in a part."""
    def run(blocks):
        turns, sums = layout.turns({n: s for level in levels for n, s in level.items()}), layout.empty(len(place))
        for val, codes, residuals, outside in blocks:
            if not val:
                layout.count(sums, codes, residuals, layout.nodes(turns, len(levels), codes, outside), place)
        yield layout.by_bin(sums)
    return run


def _tree(state: RDD, layout: Layout, m: int, root: np.ndarray, weight: float, least: int, min_gain: float) -> dict:
    """One tree on the residuals, level by level."""
    scale = 1.0 if m == 0 else 2.0           # Spark ML boosts on the gradient, which is twice the residual
    first = root[:, 0, layout.starts[0]:layout.starts[1]].sum(axis=1)
    tree: dict = {"scale": scale, "splits": {}, "levels": [], "stats": {1: (float(first[0]), float(first[1]))}}
    bins = {1: root[:, 0]}
    for level in range(layout.depth):
        found = {node: s for node, b in bins.items()
                 if (s := _split(layout, b, tree["stats"][node], scale, least, min_gain)) is not None}
        if not found:
            break
        smaller = []
        for node, s in found.items():
            tree["splits"][node] = s
            tree["stats"][2 * node], tree["stats"][2 * node + 1] = s["left"], s["right"]
            smaller.append(2 * node + (s["right"][0] < s["left"][0]))
        tree["levels"].append({node: (s["feature"], s["bin"]) for node, s in found.items()})
        if level + 1 < layout.depth:
            place = {node: i for i, node in enumerate(smaller)}
            told = _added(state.mapPartitions(_level(layout, tree["levels"], place)).collect())
            parents, bins = bins, {}
            for i, node in enumerate(smaller):
                bins[node], bins[node ^ 1] = told[:, i], parents[node // 2] - told[:, i]
    tree["steps"] = np.zeros(2 * layout.out)
    for node, (n, s) in tree["stats"].items():
        if node not in tree["splits"]:
            end = _lowest(node, layout.depth)
            tree["steps"][[end, end + layout.out]] = weight * scale * s / n if n else 0.0
    return tree


def _lowest(node: int, depth: int) -> int:
    """Where the rows of a leaf are after all levels: as far left below it as possible."""
    return node << depth + 1 - node.bit_length()


def _split(layout: Layout, bins: np.ndarray, stats: tuple[float, float], scale: float, least: int, min_gain: float) -> dict | None:
    """The best split of a node, or None."""
    n, s = stats
    best = None
    for f in range(layout.width):
        if layout.sizes[f] == 1:
            continue
        left_n, left_s = np.cumsum(bins[:, layout.starts[f]:layout.starts[f + 1]], axis=1)[:, :-1]
        right_n, right_s = n - left_n, s - left_s
        allowed = (left_n >= max(1, least)) & (right_n >= max(1, least))
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = np.where(allowed, left_s * left_s / left_n + right_s * right_s / right_n, -np.inf)
        i = int(np.argmax(parts))
        gain = float(parts[i]) - s * s / n if allowed[i] else 0.0
        if gain <= ROUNDING * float(parts[i]) or gain * scale**2 / n < min_gain or best is not None and gain <= best["raw"]:
            continue
        best = {"raw": gain, "gain": gain * scale**2 / n, "feature": f, "bin": i, "cut": float(layout.cuts[f][i]),
                "left": (float(left_n[i]), float(left_s[i])), "right": (float(right_n[i]), float(right_s[i]))}
    return best


def _added(parts: list):
    """The sum in order of the parts."""
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def _plain(tree: dict, depth: int) -> dict:
    """{node: (rows, sum, sum of squares, (feature, threshold, gain) or None)} of a finished tree."""
    squares, scale = {node: float(tree["squares"][_lowest(node, depth)]) for node in tree["stats"]}, tree["scale"]
    for node in sorted(tree["splits"], reverse=True):
        squares[node] = squares[2 * node] + squares[2 * node + 1]
    return {node: (n, s * scale, squares[node], (w["feature"], w["cut"], w["gain"]) if (w := tree["splits"].get(node)) else None)
            for node, (n, s) in tree["stats"].items()}


def _spark_model(spark: SparkSession, uid: str, trees: list[dict], weights: list[float], width: int):
    """Spark ML's model of the trees."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    leaf, internal, threshold = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    fitted = ml.regression.DecisionTreeRegressionModel
    known, part_of = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.java.util.Arrays.copyOfRange
    # the statistics of all nodes go over in one array, as each call takes its time
    numbers = np.array([v for tree in trees for node in sorted(tree) for v in tree[node][:3]], ">f8")
    statistics = gateway.new_array(jvm.double, len(numbers))
    jvm.java.nio.ByteBuffer.wrap(bytearray(numbers.tobytes())).asDoubleBuffer().get(statistics)
    splits: dict = {}
    made = gateway.new_array(fitted, len(trees))
    at = len(numbers)
    for t in reversed(range(len(trees))):
        nodes: dict = {}
        for node in sorted(trees[t], reverse=True):
            n, s, squares, split = trees[t][node]
            at -= 3
            told = known(part_of(statistics, at, at + 3), int(n))
            mean, variance = (s / n, max(0.0, squares / n - (s / n) ** 2)) if n else (0.0, 0.0)
            if split is None:
                nodes[node] = leaf(mean, variance, told)
                continue
            feature, cut, gain = split
            if (feature, cut) not in splits:
                splits[feature, cut] = threshold(feature, cut)
            nodes[node] = internal(mean, variance, gain, nodes.pop(2 * node), nodes.pop(2 * node + 1), splits[feature, cut], told)
        made[t] = fitted(nodes[1], width)
    each = gateway.new_array(jvm.double, len(weights))
    for i, w in enumerate(weights):
        each[i] = float(w)
    return ml.regression.GBTRegressionModel(uid, made, each, width)
