"""Every registered query against its SQL oracle (DuckDB) on the smallest tables.

Same comparison as the driver's gate: row count, column names and values with
rows sorted and columns sorted by name.
"""

import math
import os

import duckdb
import pandas as pd
import pytest

from storefront.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return ("~",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", float(v))
    if hasattr(v, "item") and not isinstance(v, str):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return ("t", v.to_pydatetime().isoformat())
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    return ("s", str(v))


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in df[cols].iterrows()), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _keys():
    return sorted(registry.oracle_sql())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    got = registry.queries()[key](spark, SF).toPandas()
    want = duck.sql(registry.oracle_sql()[key]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["category", "revenue", "label"]


def test_every_query_has_oracle_or_is_a_model():
    rows_only = set(registry.queries()) - set(registry.oracle_sql())
    assert rows_only <= {"sales_model", "feature_importance", "feature_importance_churn", "top_features", "churn_model",
                         "score_customers", "insights", "insight_cards", "report_sections", "kpi_json", "knn_index"}


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_insight_document_agrees_with_operators(spark):
    from pyspark.sql import functions as F

    from storefront.operators import insights
    from storefront.plans.model_plans import _features, _recency_score
    from storefront.sources import testdata as td
    o, p, c = td.orders(spark, SF), td.products(spark, SF), td.customers(spark, SF)
    doc = {(r.section, r.metric): r for r in insights.insights(
        o, p, _recency_score(_features(spark, SF)), c, td.REF_DATE).collect()}
    top = insights.top_products(o, p, td.REF_DATE).first()
    assert doc[("product_insights", "Top 5 Products (Revenue)")].value == top.top_products
    worst = insights.worst_products(o, p, td.REF_DATE).first()
    assert doc[("product_insights", "Underperforming Products")].value == worst.worst_products
    cat = insights.top_category(o, td.REF_DATE).first()
    assert doc[("revenue_insights", "Top Revenue Category")].value.startswith(cat.category + ": ")
    disc = insights.optimal_discount(o, td.REF_DATE).first()
    assert doc[("revenue_insights", "Optimal Discount Strategy")].value.startswith(str(disc.discount_pct))
    failed = insights.payment_failures(o).first()
    assert doc[("operational_insights", "Payment Failures")].value.startswith(f"{failed.failed_orders} orders")
    worst_cat = (insights.return_by_category(o).orderBy(F.col("return_rate").desc(), F.col("category"))
                 .first().category)
    assert f"'{worst_cat}'" in doc[("operational_insights", "Overall Return Rate")].hint
