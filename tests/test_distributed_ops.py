"""Distributed building blocks: exact quantiles, dense row numbers, prefix sums,
repartition invariance and the file readers/writers."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storefront.operators import reports
from storefront.operators.rows import dense_row_index, prefix_sum
from storefront.operators.stats import group_median, quantile_columns, quantile_scalar
from storefront.session import ensure_checkpoint_dir


@pytest.mark.parametrize("q", [0.0, 0.5, 0.85, 0.9, 1.0])
def test_quantile_bracket_path_is_exact(spark, q):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25)])   # a hot value
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = df.select(quantile_scalar(df, "x", q, accuracy=200).alias("q")).limit(1).collect()[0].q
    assert got == pytest.approx(float(np.quantile(vals, q)), rel=1e-12, abs=1e-12)


def test_group_median_matches_numpy(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", 2.0), ("a", 10.0), ("b", 5.0), ("b", 5.0), ("b", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in group_median(df, "k", "v").collect()}
    assert got == {"a": 2.5, "b": 5.0}


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_dense_row_index(spark, buckets):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2003).alias("k"), F.col("id"))
    got = dense_row_index(df.repartition(5), ["k", "id"], buckets=buckets).toPandas()
    got = got.sort_values(["k", "id"]).reset_index(drop=True)
    assert list(got.row_index) == list(range(2000))


def test_prefix_sum(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "k int, v int")
    got = prefix_sum(df, ["k"], "v", "before", buckets=4).orderBy("k").toPandas()
    want = np.concatenate([[0], np.cumsum([i % 3 for i in range(100)])[:-1]])
    assert list(got.before) == list(want)


def test_report_unchanged_under_repartition(spark):
    rows = [(f"c{i % 7}", float(i) * 1.1 + 0.01) for i in range(500)]
    df = spark.createDataFrame(rows, "category string, order_value double")
    a = reports.revenue_by_category(df).collect()
    b = reports.revenue_by_category(df.repartition(13)).collect()
    c = reports.revenue_by_category(df.coalesce(1)).collect()
    assert a == b == c          # exact (decimal) sums do not depend on partitioning


def test_rank_sources_and_roundtrip(spark):
    from storefront.sources import readers, sinks
    base = tempfile.mkdtemp(prefix="sf-src-", dir="/tmp")
    a = os.path.join(base, "notes.csv")
    b = os.path.join(base, "shop_orders.csv")
    with open(a, "w") as fh:
        fh.write("title,body\nx,y\n")
    with open(b, "w") as fh:
        fh.write("order_id,order_date,customer_id,Quantity\n1,2024-01-01,c,2\n")
    ranked = readers.rank_sources(spark, [a, b]).collect()
    assert ranked[0].path.endswith("shop_orders.csv") and ranked[0].score == 2 * 4 + 1
    df = readers.load_table(spark, b, {"order_id": ["Order ID"], "quantity": ["Qty", "Quantity"]},
                            ["order_date"])
    assert "quantity" in df.columns
    assert set(["order_id", "order_date"]) <= set(df.columns)
    sinks.write_table(df, os.path.join(base, "out"), "csv")
    back = readers.read_if_present(spark, os.path.join(base, "out"), "csv")
    assert back is not None and back.count() == 1
    assert readers.read_if_present(spark, os.path.join(base, "missing.csv")) is None


def test_group_median_hot_key_bracket_path(spark):
    rng = np.random.default_rng(11)
    hot = rng.normal(size=5000)
    rows = [("hot", float(v)) for v in hot] + [("hot", 0.125)] * 2000 + \
           [("small", 1.0), ("small", 4.0), ("small", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in group_median(df, "k", "v", accuracy=500).collect()}
    assert got["small"] == 2.0
    assert got["hot"] == pytest.approx(float(np.median(np.concatenate([hot, np.full(2000, 0.125)]))),
                                       rel=0, abs=1e-12)


def test_dense_row_index_hot_first_column(spark):
    # a third of the rows share the first order value: they must still be spread
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                     F.col("id"))
    got = dense_row_index(df, ["k", "id"], buckets=8).toPandas().sort_values(["k", "id"]).reset_index(drop=True)
    assert list(got.row_index) == list(range(3000))


@pytest.mark.parametrize("kind", ["nulls", "hot", "struct", "text", "ties"])
def test_no_range_is_above_twice_the_mean(spark, kind):
    """A first key with 90 % NULL, one value at half of all rows, struct and text keys: ranges stay even and in order."""
    from storefront.operators.rows import range_bucket
    ensure_checkpoint_dir(spark)
    n = 20_000
    base = spark.range(n).repartition(7).withColumn("u", F.xxhash64("id"))
    k = {"nulls": F.when(F.col("id") % 10 == 0, F.col("id")), "hot": F.when(F.col("id") % 2 == 0, F.lit(77)).otherwise(F.col("id")),
         "struct": F.struct(F.when(F.col("id") % 10 == 0, F.lit(1)).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b")),
         "text": F.concat(F.lit("k"), F.pmod(F.col("u"), F.lit(5)).cast("string")), "ties": F.lit(3)}[kind]
    df = base.select(k.alias("k"), "u", "id")
    placed = df.withColumn("b", range_bucket(df, ["k", "u"], 16)).checkpoint()
    sizes = [r["count"] for r in placed.groupBy("b").count().collect()]
    assert max(sizes) <= 2 * n / 16
    got = dense_row_index(df, ["k", "u"], buckets=16)
    rank = got.select("row_index", F.row_number().over(Window.orderBy("k", "u")).alias("want"))
    assert rank.where("row_index != want - 1").count() == 0


def test_many_ranks_of_many_columns(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=4000).round(2), np.concatenate([rng.integers(0, 9, 3500).astype(float), np.full(500, np.nan)])
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b, strict=True)], "a double, b double, c double")
    qs = [0.0, 0.01, 0.25, 0.5, 0.5001, 0.999, 1.0]
    for accuracy in (50, 1000, 100_000):
        got = quantile_columns(df, {"a": qs, "b": qs[::2], "c": [0.5]}, accuracy)
        row = spark.range(1).select(*[v.alias(f"{c}_{i}") for i, ((c, _), v) in enumerate(got.items())]).first()
        for value, (c, q) in zip(row, got, strict=True):
            want = None if c == "c" else float(np.quantile(a if c == "a" else b[:3500], q))
            assert value == (want if want is None else pytest.approx(want, abs=1e-12))
    few = spark.createDataFrame([(3.0,), (1.0,), (None,)], "a double")
    assert [r[0] for r in spark.range(1).select(*quantile_columns(few, {"a": [0.75]}).values()).collect()] == [2.5]
