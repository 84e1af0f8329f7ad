"""Model persistence (S10), cross-validation (M6), mapping config (S6) and output writers."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from storefront.operators import kpis, mapping, models
from storefront.sources import readers, sinks

SMALL_GBT = dict(maxIter=5, stepSize=0.3, maxDepth=3, subsamplingRate=0.9, validationTol=1e-4)


def _orders(spark, n=400):
    rows = [(f"o{i}", float(1 + i % 4), float(i % 3) * 5.0, float(100 + (i * 37) % 900), 4.0, i % 3, 10, i % 7,
             1 + i % 12, 20.0) for i in range(n)]
    df = spark.createDataFrame(rows, "order_id string, quantity double, discount_pct double, base_price double, "
                                     "rating double, delivery_delay int, hour_of_day int, day_of_week int, "
                                     "month int, profit_margin double")
    return df.withColumn("order_value", F.col("base_price") * F.col("quantity")
                         * (F.lit(1.0) - F.col("discount_pct") / 100))


def test_sales_model_save_load_and_importance(spark):
    model, test = models.fit_sales_model(_orders(spark), params=SMALL_GBT)
    path = os.path.join(tempfile.mkdtemp(prefix="sf-model-", dir="/tmp"), "sales")
    models.save_model(model, path)
    again = models.load_model(path)
    a = [r.prediction for r in model.transform(test).orderBy("order_id").collect()]
    b = [r.prediction for r in again.transform(test).orderBy("order_id").collect()]
    assert a == b and len(a) == test.count() > 0
    imp = models.feature_importance(model, models.SALES_FEATURES).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)
    m = models.regression_metrics(model.transform(test), "order_value", "prediction").first()
    assert m.r2 > 0.5 and m.status in ("Excellent", "Good", "Fair")


def test_cross_validation_folds(spark):
    cv = models.cross_val_r2(_orders(spark), params=SMALL_GBT, folds=3).collect()
    assert sorted(r.fold for r in cv) == [0, 1, 2]
    assert all(r.mean_r2 == pytest.approx(sum(x.r2 for x in cv) / 3) for r in cv)


def test_churn_probabilities_in_unit_interval(spark):
    rows = [(f"c{i}", i % 2, float(i % 2) * 100 + i % 7, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id string, churned int, recency double, lifetime_value double")
    model, test, const = models.fit_churn_model(df, ["recency", "lifetime_value"],
                                                params=dict(numTrees=5, maxDepth=3))
    assert const is None
    scored = models.score(model, test)
    probs = [r.churn_probability for r in scored.collect()]
    assert probs and all(0.0 <= p <= 1.0 for p in probs)
    auc = models.roc_auc(scored, "churned", "churn_probability").first().roc_auc
    assert auc > 0.9


def test_mapping_from_json_config(spark):
    cfg = {"order_id": ["Bestell-Nr"], "order_value": ["Umsatz"]}
    path = os.path.join(tempfile.mkdtemp(prefix="sf-map-", dir="/tmp"), "supplier.json")
    with open(path, "w") as fh:
        json.dump(cfg, fh)
    df = spark.createDataFrame([("A1", 10.0)], "`Bestell-Nr` string, Umsatz double")
    out = mapping.map_columns(df, mapping.load_mapping(path))
    assert out.columns == ["order_id", "order_value"]


def test_outputs_and_documents_roundtrip(spark):
    base = tempfile.mkdtemp(prefix="sf-out-", dir="/tmp")
    orders = spark.createDataFrame([("o1", 10.0, 1, 3), ("o2", 20.0, 0, 2)],
                                   "order_id string, order_value double, is_returned int, delivery_time_days int")
    labeled = spark.createDataFrame([("c1", 1), ("c2", 0)], "customer_id string, churned int")
    k = kpis.business_kpis(orders, labeled)
    doc = kpis.kpi_document(k)
    sinks.write_document(doc, os.path.join(base, "kpis"))
    back = readers.read_if_present(spark, os.path.join(base, "kpis"), "json").first()
    assert back.business_kpis.total_orders == 2 and back.business_kpis.total_revenue == 30.0
    empty = orders.where(F.lit(False))
    written = sinks.write_outputs(base, {"orders": orders, "high_risk_customers": empty}, fmt="csv")
    assert written == ["orders"]
    assert readers.read_if_present(spark, os.path.join(base, "high_risk_customers"), "csv") is None
