"""Exact quantiles without gathering a column into one task.

pandas ``quantile(q)`` (linear interpolation) is exact.  Spark's ``percentile`` is
exact too, but it buffers every value of the group in one task, which does not
survive a 100 TB column.  ``quantile_columns`` answers several columns and several
quantiles in two passes in all, by the same steps at every size:

1. one pass takes, for each column, n and a mergeable sketch (``percentile_approx``)
   of the places on both sides of each q.  A sketch's rank error is at most
   n / accuracy, so each pair brackets the ranks k = floor((n - 1) q) and k + 1, or
   these are the values next to the bracket;
2. one exact pass counts the values inside the brackets one by one (pre-aggregated,
   so a hot value is one row) and those of each gap between brackets as one row with
   its least and largest value.  Running counts over these rows locate the ranks.

``group_median`` is the per-group variant used for per-product medians.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 100_000


def quantile_scalar(df: DataFrame, col: str, q: float, accuracy: int = DEFAULT_ACCURACY) -> Column:
    """The q-quantile of a column's values that are neither NULL nor NaN, NULL without any."""
    return quantile_columns(df, {col: [q]}, accuracy)[col, q]


def quantile_scalars(df: DataFrame, cols: list[str], q: float, accuracy: int = DEFAULT_ACCURACY) -> dict[str, Column]:
    """The q-quantile of several columns, in two passes in all."""
    got = quantile_columns(df, {c: [q] for c in cols}, accuracy)
    return {c: got[c, q] for c in cols}


def _brackets(ends: Sequence[float]) -> list[tuple[float, float]]:
    """Pairs of ends in order, with overlapping ones as one."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(zip(ends[::2], ends[1::2], strict=True)):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def quantile_columns(df: DataFrame, ranks: Mapping[str, Sequence[float]],
                     accuracy: int = DEFAULT_ACCURACY) -> dict[tuple[str, float], Column]:
    """Every wanted quantile of every column: ``(column, q) -> Column``.

    The first pass returns one row when this is called; the second is one lazy scalar
    subquery that all the columns share.
    """
    cols = list(ranks)
    raw = [F.col(c).cast("double") for c in cols]
    vals = df.select(*[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(raw)])
    slack = 3.0 / accuracy
    places = [[p for q in ranks[c] for p in (max(0.0, q - slack), min(1.0, q + slack))] for c in cols]
    first = vals.agg(*[x for i, p in enumerate(places) for x in (
        F.count(f"v{i}").alias(f"n{i}"),
        F.percentile_approx(f"v{i}", F.array(*[F.lit(x) for x in p]), F.lit(accuracy)).alias(f"b{i}"))]).first()
    out = {(c, q): F.lit(None).cast("double") for c in cols for q in ranks[c]}
    known = [i for i in range(len(cols)) if first[f"n{i}"]]
    if not known:
        return out
    parts = []
    for i in known:
        v = F.col(f"v{i}")
        brackets = _brackets(first[f"b{i}"])
        begun = sum(((v >= lo).cast("int") for lo, _ in brackets), F.lit(0))
        over = sum(((v > hi).cast("int") for _, hi in brackets), F.lit(0))
        inside = begun > over
        # zones in value order: gap 0, bracket 1, gap 2, ...
        parts.append(F.struct(F.lit(i).alias("i"), (begun + over).alias("zone"), F.when(inside, v).alias("own"), v.alias("v")))
    one = vals.select(parts[0].alias("p")) if len(parts) == 1 else vals.select(F.explode(F.array(*parts)).alias("p"))
    counted = one.where("p.v is not null").groupBy("p.i", "p.zone", "p.own").agg(
        F.count(F.lit(1)).alias("c"), F.min("p.v").alias("least"), F.max("p.v").alias("most"))
    # O(n / accuracy) rows for each bracket
    w = Window.partitionBy("i").orderBy("zone", "own").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("to", F.sum("c").over(w)).withColumn("from", F.col("to") - F.col("c"))
    answers, names = [], {}
    for i in known:
        for q in ranks[cols[i]]:
            n = first[f"n{i}"]
            place = (n - 1) * q
            k = math.floor(place)

            def at(r: int, i: int = i) -> Column:
                # of a gap only the values next to a bracket can be asked for
                value = F.when(F.col("from") == r, F.col("least")).when(F.col("to") == r + 1, F.col("most")).otherwise(F.col("own"))
                return F.max(F.when((F.col("i") == i) & (F.col("from") <= r) & (r < F.col("to")), value))

            a, b = at(k), at(min(k + 1, n - 1))
            names[cols[i], q] = f"q{len(answers)}"
            answers.append((a + (b - a) * F.lit(place - k)).alias(names[cols[i], q]))
    row = placed.agg(F.struct(*answers).alias("s")).select("s").scalar()
    out.update({key: row.getField(name) for key, name in names.items()})
    return out


def group_median(df: DataFrame, key: str, col: str, out: str = "median",
                 accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Exact per-key median (linear interpolation), one row per key.

    A per-key ``percentile_approx`` (partially aggregated, so a hot key is spread over
    all tasks) brackets the two middle ranks, exactly where a key has few values; only
    the values inside the bracket, O(n / accuracy) of them, are collapsed to (key,
    value, count) and ranked, offset by the count of values below the bracket.  No
    key's values meet in one task, and every key takes the same steps.
    """
    vals = df.where(F.col(col).isNotNull()).select(key, F.col(col).cast("double").alias("v"))
    delta = 3.0 / accuracy
    stats = vals.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("v", F.array(F.lit(0.5 - delta), F.lit(0.5 + delta)), F.lit(accuracy)).alias("_b"))
    bounds = stats.select(key, "n", F.element_at("_b", 1).alias("lo"), F.element_at("_b", 2).alias("hi"))
    # one look at the values: those below the bracket are one row of each key, those inside one for each value
    joined = vals.join(bounds, key).where(F.col("v") <= F.col("hi"))
    below = F.col("v") < F.col("lo")
    counts = joined.groupBy(key, "n", F.when(~below, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(key).orderBy("v")
    ranked = counts.withColumn("cum", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # 0-based ranks lo = floor((n-1)/2), hi = ceil((n-1)/2); value at rank r is the
    # first distinct value whose running count exceeds r
    lo_r = F.floor((F.col("n") - 1) / 2)
    hi_r = F.ceil((F.col("n") - 1) / 2)
    picked = ranked.groupBy(key).agg(
        F.min(F.when(F.col("cum") > lo_r, F.col("v"))).alias("_lo"),
        F.min(F.when(F.col("cum") > hi_r, F.col("v"))).alias("_hi"),
    )
    return picked.select(key, ((F.col("_lo") + F.col("_hi")) / F.lit(2.0)).alias(out))
