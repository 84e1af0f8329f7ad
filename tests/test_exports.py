"""The wide and the review export deal the order lines no oftener than needed."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storefront.sources import testdata as td


@pytest.mark.parametrize("export", [td.wide_export, td.review_export])
def test_exports_deal_order_lines_twice(spark, export):
    """By order and by part, the latter last: customers meet the orders, not the lines."""
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = export(spark, "/root/testdata/sf0.001").groupBy().agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "p_partkey" in joins[0] and "o_orderkey" in joins[1]
