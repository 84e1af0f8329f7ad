"""Steps that several passes read are run once (findings on time and shuffles)."""

from __future__ import annotations

from storefront.operators import churn, insights, models, reports, rollup
from storefront.sources import testdata as td


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_imputed_medians_are_numbers_in_the_plan(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, None, 6.0), (3, 4.0, 7.0), (4, float("nan"), None), (5, 10.0, None)],
                               "id int, a double, b double").withColumn("c", models.F.lit(None).cast("double"))
    out = churn.impute_features(df, ["a", "b", "c"])
    assert "subquery" not in _plan(out).lower()
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        (1, 1.0, 5.0, 0.0), (2, 4.0, 6.0, 0.0), (3, 4.0, 7.0, 0.0), (4, 4.0, 6.0, 0.0), (5, 10.0, 6.0, 0.0)]


def test_models_read_stored_rows(spark):
    rows = spark.range(400).selectExpr("id AS order_id", "id % 7 * 1.5D AS order_value", "id % 5 * 1.0D AS x", "id AS more")
    _, test = models.fit_sales_model(rows.repartition(3), ["x"], params=dict(maxIter=2, maxDepth=2))
    assert test.inputFiles() and "more" in test.columns and "Repartition" not in _plan(test)
    people = spark.range(200).selectExpr("id AS customer_id", "CAST(id % 2 AS INT) AS churned", "id % 5 * 1.0D AS x")
    _, test, _ = models.fit_churn_model(people, ["x"], params=dict(numTrees=2, maxDepth=2))
    assert test.inputFiles() and test.count() == 40


def test_rows_of_a_fit_are_dealt_evenly(spark, monkeypatch):
    """Stored rows of a small file come back as one part: each pass of a fit would run in one task."""
    parts = []

    class Seen(models.Pipeline):
        def fit(self, df, params=None):
            parts.append(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
            return super().fit(df)

    monkeypatch.setattr(models, "Pipeline", Seen)
    monkeypatch.setattr(models, "BOOSTED_ROWS", 100, raising=False)
    monkeypatch.setattr(models, "FOREST_ROWS", 100, raising=False)
    rows = spark.range(2000).selectExpr("id AS order_id", "id % 7 * 1.5D AS order_value", "id % 5 * 1.0D AS x").coalesce(1)
    model, test = models.fit_sales_model(rows, ["x"], params=dict(maxIter=2, maxDepth=2))
    models.cross_val_r2(rows, ["x"], folds=2, params=dict(maxIter=2, maxDepth=2))
    people = rows.selectExpr("order_id AS customer_id", "CAST(order_id % 2 AS INT) AS churned", "x")
    models.fit_churn_model(people, ["x"], params=dict(numTrees=2, maxDepth=2))
    assert len(parts) == 4
    for p in parts:      # the session has four cores
        assert len(p) == 4 and max(p) < 1.2 * min(p)
    assert sum(parts[0]) + test.count() == 2000
    few = rows.limit(150)
    assert models.spread(few, 100) is few


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in cols)) for r in df.collect()), key=repr)


def test_rollup_of_days_alone(spark):
    """Reports by day, category, discount or delay need no cells by product, which are wider than the lines."""
    o = td.orders(spark, "/root/testdata/sf0.001")
    r = rollup.build(o, tables=("days",))
    assert r.cells is None and "product_id" not in r.days.columns
    assert _rows(rollup.daily_revenue(r)) == _rows(reports.daily_revenue(o))
    assert _rows(rollup.insight_facts(r, td.REF_DATE, o)) == _rows(insights.insight_facts(o, td.REF_DATE))
