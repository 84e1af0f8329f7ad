"""Dashboard queries (D1-D11): the data behind each chart and tile.

Filters are written as column-vs-literal predicates so they reach the parquet
scan; the category filter is a left-semi join (no duplication of orders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storefront.functions.dates import to_ts, weekday_mon0
from storefront.functions.numeric import exact_sum
from storefront.functions.text import truncate_label, weekday_name

# Chart sizes and per-section card counts of the dashboard/report.
TOP_CATEGORIES = 10
DEFAULT_CATEGORY_PICK = 3
CARD_LIMITS = {"customer_insights": 3, "operational_insights": 2, "growth_opportunities": 3,
               "risk_alerts": None}
REPORT_LIMITS = {"revenue_insights": 3, "customer_insights": 3, "product_insights": 2,
                 "operational_insights": 3, "growth_opportunities": 3}


def filter_dates(orders: DataFrame, start: str | None = None, end: str | None = None,
                 col: str = "order_date") -> DataFrame:
    """date(order_date) between start and end, inclusive.

    Written as ``col >= start AND col < end + 1 day`` so parquet can skip row
    groups; ``None`` leaves that side open (the dashboard default is min..max).
    """
    dt = orders.schema[col].dataType
    out = orders
    if start is not None:
        out = out.where(F.col(col) >= F.lit(start).cast("date").cast("timestamp").cast(dt))
    if end is not None:
        nxt = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp").cast(dt)
        out = out.where(F.col(col) < nxt)
    return out


def first_categories(products: DataFrame, n: int = DEFAULT_CATEGORY_PICK,
                     order_col: str = "product_id") -> DataFrame:
    """The first n categories in catalog order (the dashboard's default pick)."""
    return (products.where(F.col("category").isNotNull())
            .groupBy("category").agg(F.min(order_col).alias("_first"))
            .orderBy("_first").limit(n).select("category"))


def filter_categories(orders: DataFrame, products: DataFrame, categories=None) -> DataFrame:
    """Orders whose product belongs to the selected categories (semi join).

    ``categories`` is a list of names or a one-column DataFrame; by default the
    first three categories of the catalog.
    """
    if categories is None:
        cats = first_categories(products)
    elif isinstance(categories, DataFrame):
        cats = categories
    else:
        cats = None
    if cats is None:
        picked = products.where(F.col("category").isin(list(categories))).select("product_id")
    else:
        picked = products.join(cats, "category", "left_semi").select("product_id")
    return orders.join(picked, "product_id", "left_semi")


def revenue_by_category(orders: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    """D3: top categories by revenue with a chart label."""
    return (orders.where(F.col("category").isNotNull())
            .groupBy("category").agg(exact_sum("order_value").alias("revenue"))
            .orderBy(F.col("revenue").desc(), F.col("category").asc()).limit(top)
            .withColumn("label", truncate_label("category")))


def truncate_labels(df: DataFrame, col: str, max_len: int = 40, out: str = "label") -> DataFrame:
    """Chart label of at most max_len characters."""
    return df.withColumn(out, truncate_label(col, max_len))


def orders_by_weekday(orders: DataFrame, col: str = "order_date") -> DataFrame:
    """Order lines per weekday (Monday = 0) with the day's name."""
    day = weekday_mon0(to_ts(col)) if "day_of_week" not in orders.columns else F.col("day_of_week")
    return (orders.where(F.col(col).isNotNull()).groupBy(day.alias("day_of_week"))
            .agg(F.count(F.lit(1)).alias("orders"))
            .withColumn("day_name", weekday_name("day_of_week")))


def daily_revenue(orders: DataFrame, col: str = "order_date") -> DataFrame:
    """Revenue per calendar day."""
    return (orders.where(F.col(col).isNotNull())
            .groupBy(F.to_date(col).alias("date"))
            .agg(exact_sum("order_value").alias("revenue")))


def insight_cards(insights: DataFrame, limits: dict | None = None) -> DataFrame:
    """The first n insights of each section (None = all)."""
    limits = CARD_LIMITS if limits is None else limits
    cond = None
    for section, n in limits.items():
        c = (F.col("section") == section)
        if n is not None:
            c = c & (F.col("ordinal") <= n)
        cond = c if cond is None else (cond | c)
    return insights.where(cond)


def kpi_tiles(kpis: DataFrame) -> DataFrame:
    """Formatted KPI tile texts; missing values show as 0."""
    def z(c):
        return F.coalesce(F.col(c), F.lit(0))
    return kpis.select(
        F.concat(F.lit("₹"), F.format_number(z("total_revenue").cast("double"), 0)).alias("revenue_tile"),
        F.format_number(z("total_orders").cast("double"), 0).alias("orders_tile"),
        F.format_number(z("total_customers").cast("double"), 0).alias("customers_tile"),
        F.concat(F.format_number(z("customer_churn_rate").cast("double") * 100, 1), F.lit("%")).alias("churn_tile"),
        F.concat(F.lit("₹"), F.format_number(z("average_order_value").cast("double"), 2)).alias("aov_tile"),
        F.concat(F.format_number(z("return_rate").cast("double") * 100, 2), F.lit("%")).alias("return_tile"),
        F.concat(F.format_number(z("average_delivery_time").cast("double"), 1), F.lit(" days")).alias("delivery_tile"),
    )
