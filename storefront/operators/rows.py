"""Row order helpers: first-per-key in input order and dense row numbers.

pandas relies on file order (``drop_duplicates`` keeps the first row,
``groupby().first()`` takes the first non-null value).  Spark has no row order
after a shuffle, so the caller names an ordering column (e.g. the file's row
identity) and these helpers make "first" explicit and deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def first_non_null(value: str | Column, order: str | Column) -> Column:
    """Value of the first row (by ``order``) whose value is not NULL."""
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    return F.min_by(v, F.when(v.isNotNull(), o))


def first_row(df: DataFrame, key: str, order: str, cols: Sequence[str]) -> DataFrame:
    """One row per key: the columns of the key's first row in ``order`` (drop_duplicates)."""
    return (df.groupBy(key)
            .agg(F.min_by(F.struct(*cols), F.col(order)).alias("_first"))
            .select(key, *[F.col(f"_first.{c}").alias(c) for c in cols]))


def dense_row_index(df: DataFrame, order_cols: Sequence[str], out: str = "row_index",
                    buckets: int | None = None, seed: int = 42) -> DataFrame:
    """0-based dense row number in ``order_cols`` order (see ``prefix_sum``)."""
    return prefix_sum(df, order_cols, None, out, buckets, seed)


def prefix_sum(df: DataFrame, order_cols: Sequence[str], value_col: str | None, out: str,
               buckets: int | None = None, seed: int = 42) -> DataFrame:
    """Sum of ``value_col`` over the rows before each row in ``order_cols`` order
    (``value_col`` None counts rows: a dense 0-based row number), without one task.

    1. deal the rows to ranges of the order (``range_bucket``); a row's bucket is a pure
       function of the row, so every branch of the plan agrees on it (physical
       partition ids do not: adaptive execution may coalesce partitions differently
       per branch);
    2. number rows inside each bucket (a window whose group is one range);
    3. count rows per bucket, turn the counts into start offsets and broadcast
       that table (its size is the bucket count);
    4. index = offset of the bucket + number inside it.
    """
    spark = df.sparkSession
    n_b = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    leaves = _leaves(df, order_cols)
    keyed = df.withColumn("_pid", range_bucket(df, order_cols, n_b, seed))
    val = F.lit(1) if value_col is None else F.col(value_col)
    inner = Window.partitionBy("_pid").orderBy(*leaves).rowsBetween(Window.unboundedPreceding, -1)
    numbered = keyed.withColumn("_v", val).withColumn("_rn", F.coalesce(F.sum("_v").over(inner), F.lit(0)))
    # bucket sizes from the numbered rows: same shuffle (reused), input computed once
    counts = numbered.groupBy("_pid").agg(F.sum("_v").alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_rn"))
            .drop("_pid", "_rn", "_off", "_v"))


#: Sampled rows for each bucket when boundaries are taken from a sample.
SAMPLE_PER_BUCKET = 100


def range_bucket(df: DataFrame, order_cols: Sequence[str], buckets: int, seed: int = 42) -> Column:
    """Number of each row's range in the order of ``order_cols`` (NULLs first), 0 to ``buckets`` - 1.

    Boundaries are values of the first order column where these are spread evenly (one
    ``percentile_approx`` pass).  If a value or NULL spans more than half a range, and for
    other types, they are whole order tuples, weighted as a sample of rows has them: so
    a hot value or NULL is cut by the columns after it.  Only rows that tie on the whole
    tuple must share a range.  A row finds its range by binary search.
    """
    from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType
    if buckets <= 1:
        return F.lit(0)
    leaves = _leaves(df, order_cols)
    first = leaves[0]
    ftype = df.select(first.alias("k")).schema["k"].dataType
    total = None
    if isinstance(ftype, (NumericType, DateType, TimestampType, TimestampNTZType)):
        # twice as many places as bounds: a value that is met twice in a row spans half a range
        ps = [i / (2 * buckets) for i in range(1, 2 * buckets)]
        row = df.select(F.count(F.lit(1)).alias("n"), F.count_if(first.isNull()).alias("nulls"),
                        F.percentile_approx(first, F.array(*[F.lit(p) for p in ps]), F.lit(10_000)).alias("q")).first()
        total, found = row.n, row.q or []
        if len(set(found)) == len(found) and row.nulls * 2 * buckets <= total or len(leaves) == 1:
            return bucket_of(first, sorted({v for v in found[1::2] if v is not None}), ftype)
    total = df.count() if total is None else total
    if total == 0:
        return F.lit(0)
    share = min(1.0, SAMPLE_PER_BUCKET * buckets / total)
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(leaves)])
    ktype = df.select(key.alias("k")).schema["k"].dataType
    sample = df.select(key.alias("k")).sample(False, share, seed).orderBy("k").collect()
    step = len(sample) / buckets
    picks = [sample[int(step * i)].k for i in range(1, buckets) if int(step * i) < len(sample)]
    return bucket_of(key, list(dict.fromkeys(picks)), ktype)


def bucket_of(key: Column, bounds: Sequence, dtype) -> Column:
    """Number of the ascending ``bounds`` that are not above ``key``, by binary search; NULL keys: 0."""
    if not bounds:
        return F.lit(0)

    def lit(v):
        return F.struct(*[F.lit(x).alias(f"k{i}") for i, x in enumerate(v)]) if isinstance(v, tuple) else F.lit(v)

    array = F.array(*[lit(v) for v in bounds]).cast(ArrayType(dtype))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(array, at + step - 1) <= key, at + step).otherwise(at))


def _leaves(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Order columns with struct columns expanded into their fields (same ordering)."""
    from pyspark.sql.types import StructType
    out: list[Column] = []

    def walk(expr: Column, dtype) -> None:
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                walk(expr.getField(f.name), f.dataType)
        else:
            out.append(expr)
    for c in cols:
        walk(F.col(f"`{c}`"), df.schema[c].dataType)
    return out
