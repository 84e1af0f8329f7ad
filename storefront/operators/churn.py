"""Churn labels and customer features (F1-F8).

The per-customer order statistics are one hash aggregate (partial aggregation
before the shuffle, so a customer holding a third of all lines costs one row per
map task), joined to customers on customer_id.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.functions.dates import floor_days
from storefront.functions.numeric import exact_avg, exact_sum, nan_to_null
from storefront.operators.stats import quantile_scalars

# Fixed values of the churn rule.
CHURN_AFTER_DAYS = 180          # churned when days since last order > 180 (strict)
NO_ORDER_RECENCY = 9999         # days since last order for customers without orders

STAT_COLUMNS = ("total_orders", "avg_order_value", "total_spent", "avg_rating_given",
                "return_rate", "avg_discount")
CHURN_FEATURES = ("lifetime_value", "total_orders", "avg_order_value", "recency",
                  "total_spent", "avg_rating_given", "return_rate", "customer_age_days")


def last_order(orders: DataFrame) -> DataFrame:
    """last order timestamp per customer (NULL customer ids are not a group)."""
    return (orders.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id").agg(F.max("order_date").alias("last_order_date")))


def churn_labels(customers: DataFrame, orders: DataFrame, ref_date: str,
                 days: int = CHURN_AFTER_DAYS) -> DataFrame:
    """days_since_last_order (9999 without orders) and churned = days > 180."""
    return _labelled(customers.join(last_order(orders), "customer_id", "left"), ref_date, days)


def _labelled(df: DataFrame, ref_date: str, days: int) -> DataFrame:
    rec = F.coalesce(floor_days(ref_date, "last_order_date"), F.lit(NO_ORDER_RECENCY)).cast("int")
    return (df.withColumn("days_since_last_order", rec)
            .withColumn("churned", F.when(F.col("days_since_last_order") > days, 1).otherwise(0)))


def churn_rate(labeled: DataFrame) -> DataFrame:
    """share of churned customers."""
    return labeled.agg(F.count(F.lit(1)).alias("customers"),
                       F.sum("churned").cast("bigint").alias("churned"),
                       F.try_divide(F.sum("churned").cast("double"), F.count("churned")).alias("churn_rate"))


def order_stats(orders: DataFrame) -> DataFrame:
    """per-customer count, mean/sum value, mean rating, return rate, mean discount."""
    return (orders.where(F.col("customer_id").isNotNull())
            .groupBy("customer_id").agg(*_stats()))


def _stats() -> list[Column]:
    return [F.count("order_id").alias("total_orders"),
            exact_avg("order_value").alias("avg_order_value"),
            exact_sum("order_value").alias("total_spent"),
            F.try_divide(F.sum("customer_rating").cast("double"), F.count("customer_rating")).alias("avg_rating_given"),
            F.try_divide(F.sum("is_returned").cast("double"), F.count("is_returned")).alias("return_rate"),
            exact_avg("discount_pct").alias("avg_discount")]


def customer_features(labeled: DataFrame, orders: DataFrame, ref_date: str,
                      stats: DataFrame | None = None) -> DataFrame:
    """customers + order stats (no orders -> 0), recency, customer_age_days."""
    stats = order_stats(orders) if stats is None else stats
    return _features(labeled.join(stats, "customer_id", "left"), ref_date)


def _features(joined: DataFrame, ref_date: str) -> DataFrame:
    filled = joined.na.fill({"total_orders": 0, "avg_order_value": 0.0, "total_spent": 0.0,
                             "avg_rating_given": 0.0, "return_rate": 0.0, "avg_discount": 0.0})
    return (filled.withColumn("recency", F.col("days_since_last_order"))
            .withColumn("customer_age_days", floor_days(ref_date, "signup_date")))


def labelled_features(customers: DataFrame, orders: DataFrame, ref_date: str, days: int = CHURN_AFTER_DAYS) -> DataFrame:
    """F2-F6 in one pass over the orders: last order and statistics are one aggregate."""
    per = (orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
           .agg(F.max("order_date").alias("last_order_date"), *_stats()))
    return _features(_labelled(customers.join(per, "customer_id", "left"), ref_date, days), ref_date)


def impute_features(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """inf/NaN -> NULL, NULL -> exact column median, still NULL -> 0.

    ``df`` is read once for the counts of missing values and twice more for the medians of
    the columns that have some; the medians are numbers in the plan, so whoever reads the
    result any number of times does not have them worked out again.
    """
    cols = list(cols)
    clean = df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in cols})
    missing = clean.agg(*[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    holes = [c for i, c in enumerate(cols) if missing[i]]
    if not holes:
        return clean
    med = quantile_scalars(clean, holes, 0.5)
    known = df.sparkSession.range(1).select(*[F.coalesce(med[c], F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(holes)]).first()
    return clean.withColumns({c: F.coalesce(F.col(c), F.lit(float(known[i]))) for i, c in enumerate(holes)})
