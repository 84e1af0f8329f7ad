"""The split tables read their export once."""

from __future__ import annotations

import pytest

from storefront.operators import split


def _counted(spark, rows, schema):
    """A table whose rows are counted whenever they are worked out."""
    seen = spark.sparkContext.accumulator(0)

    def count(r):
        seen.add(1)
        return r

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(count), schema), seen


SCHEMA = "rid long, `Product ID` string, `Customer ID` string, Category string, City string, Sales double"
FULL = [(1, "a", "x", "c1", "k1", 2.0), (2, "a", "x", "c2", "k2", 4.0), (3, "b", "y", "c3", "k3", 8.0), (4, None, None, "c4", "k4", 16.0)]


@pytest.mark.parametrize("table", ["products", "customers"])
def test_split_reads_the_export_once(spark, table):
    df, seen = _counted(spark, FULL, SCHEMA)
    if table == "products":
        out = split.split_products(df, "rid").select("product_id", "category", "base_price")
        want = [("a", "c1", 2.0), ("b", "c3", 8.0)]
    else:
        out = split.split_customers(df, "rid").select("customer_id", "city", "lifetime_value")
        want = [("x", "k1", 6.0), ("y", "k3", 8.0)]
    assert sorted(map(tuple, out.collect())) == want
    assert seen.value == len(FULL)


def test_split_takes_later_values_where_the_first_row_has_none(spark):
    rows = [(1, "a", "x", None, None, 2.0), (2, "a", "x", "c2", "k2", None), (3, "a", "x", "c3", "k3", 1.0), (4, "b", "y", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = split.split_products(df, "rid").select("product_id", "category", "base_price").collect()
    assert sorted(map(tuple, got)) == [("a", "c2", 2.0), ("b", None, None)]
    got = split.split_customers(df, "rid").select("customer_id", "city", "lifetime_value").collect()
    assert sorted(map(tuple, got)) == [("x", "k2", 3.0), ("y", None, None)]


def test_split_wide_works_its_export_out_once(spark):
    df, seen = _counted(spark, FULL, SCHEMA)
    orders, products, customers = split.split_wide(df.drop("Product ID", "Customer ID"), "rid")
    both = orders.join(products, "product_id").join(customers, "customer_id")
    got = both.select("order_id", "order_value", "category", "city", "lifetime_value").collect()
    assert sorted(map(tuple, got)) == [(f"O{i}", v, f"c{i}", f"k{i}", v) for i, v in enumerate((2.0, 4.0, 8.0, 16.0), 1)]
    assert seen.value == len(FULL)
