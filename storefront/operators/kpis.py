"""KPI document (K1-K4): business KPIs, model block, top features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.functions.numeric import exact_avg, exact_sum

# Grade thresholds of the model block.
EXCELLENT_ABOVE = 0.85
GOOD_ABOVE = 0.70
TOP_FEATURES = 5


def model_status(score: Column) -> Column:
    """> 0.85 Excellent, > 0.70 Good, else (also NULL/NaN) Fair."""
    return (F.when(score > EXCELLENT_ABOVE, F.lit("Excellent"))
            .when(score > GOOD_ABOVE, F.lit("Good")).otherwise(F.lit("Fair")))


def business_kpis(orders: DataFrame, labeled_customers: DataFrame) -> DataFrame:
    """K1: one row of order and customer KPIs (two one-pass aggregates)."""
    o = orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(exact_sum("order_value"), F.lit(0.0)).alias("total_revenue"),
        exact_avg("order_value").alias("average_order_value"),
        F.try_divide(F.sum("is_returned").cast("double"), F.count("is_returned")).alias("return_rate"),
        F.try_divide(F.sum("delivery_time_days").cast("double"), F.count("delivery_time_days"))
        .alias("average_delivery_time"),
    )
    c = labeled_customers.agg(F.count(F.lit(1)).alias("total_customers"),
                              F.try_divide(F.sum("churned").cast("double"), F.count("churned")).alias("customer_churn_rate"))
    cs = c.select(F.struct("total_customers", "customer_churn_rate")).scalar()
    return o.select("*", cs.getField("total_customers").alias("total_customers"),
                    cs.getField("customer_churn_rate").alias("customer_churn_rate"))


def top_features(importance: DataFrame, n: int = TOP_FEATURES) -> Column:
    """K3: the n most important features as an array of (feature, importance)."""
    top = importance.orderBy(F.col("importance").desc(), F.col("feature").asc()).limit(n)
    arr = top.agg(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("k"), F.col("feature"),
                                             F.col("importance")))),
        lambda s: F.struct(s["feature"].alias("feature"), s["importance"].alias("importance"))).alias("a"))
    return arr.select("a").scalar()


def kpi_document(kpis: DataFrame, reg_metrics: DataFrame | None = None, clf_metrics: DataFrame | None = None,
                 reg_importance: DataFrame | None = None, clf_importance: DataFrame | None = None,
                 with_timestamp: bool = True) -> DataFrame:
    """K2-K4: the KPI document as one nested row (write it with ``write.json``)."""
    cols = [F.struct(*[F.col(c) for c in kpis.columns]).alias("business_kpis")]
    blocks = []
    if reg_metrics is not None:
        r = reg_metrics.select(F.struct("mae", "rmse", "r2")).scalar()
        blocks.append(F.struct(
            r.getField("mae").alias("mae"), r.getField("rmse").alias("rmse"), r.getField("r2").alias("r2_score"),
            model_status(r.getField("r2")).alias("status")).alias("sales_prediction"))
    if clf_metrics is not None:
        names = ("accuracy", "roc_auc", "precision", "recall", "f1_score")
        m = clf_metrics.select(F.struct(*names)).scalar()
        blocks.append(F.struct(
            *[m.getField(c).alias(c) for c in names],
            model_status(m.getField("roc_auc")).alias("status")).alias("churn_prediction"))
    if blocks:
        cols.append(F.struct(*blocks).alias("model_performance"))
    if reg_importance is not None:
        cols.append(top_features(reg_importance).alias("top_features_sales"))
    if clf_importance is not None:
        cols.append(top_features(clf_importance).alias("top_features_churn"))
    if with_timestamp:
        cols.insert(0, F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    return kpis.select(*cols)
