"""One additive rollup for the reports, insights and KPIs.

``build`` reads the order lines once and writes two tables, partitioned by month:

``cells``  one row for each (day, category, discount, product, delay), sums and counts only;
``days``   the same without the product: at most days x categories x discounts x delays rows.

A product that is sold less than once a day and discount has about a cell for each line, and
a cell is wider than a line: ``build(orders, tables=("days",))`` aggregates the lines straight
into ``days``, and the figures by product then come from the lines (``insights``).

Every figure of a report is a sum over cells, so it is the same as over the lines.
Reports of whole tables read ``days``, those by product ``cells``; a window of recent
days prunes the months before it and skips row groups by ``day``.  A month can be
written again alone (``refresh``): only its partitions are replaced.

Sums of money are kept as the two parts of ``exact_sum`` (an exact DECIMAL and the rest
in DOUBLE).  A window begins at a day; a reference with a time of day is refused.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.functions.numeric import EXACT_SCALE, nan_to_null
from storefront.functions.text import truncate_label, weekday_name
from storefront.operators import insights, reports
from storefront.session import ensure_checkpoint_dir

DIMENSIONS = ["day", "category", "discount_pct", "product_id", "delivery_delay"]
DAY_DIMENSIONS = [d for d in DIMENSIONS if d != "product_id"]
#: The tables of a whole rollup.
TABLES = ("cells", "days")
#: Measures that are summed exactly: name -> column.
MONEY = {"value": "order_value", "rating": "rating", "quantity": "quantity"}
#: Whole numbers: name -> column.
WHOLE = {"returned": "is_returned", "delivery": "delivery_time_days", "customer_rating": "customer_rating"}


@dataclass(frozen=True)
class Rollup:
    """The two tables (``cells`` is None where only ``days`` was built); ``path`` is the folder that holds them."""

    cells: DataFrame | None
    days: DataFrame
    path: str


def _measures() -> list[str]:
    names = ["lines", "failed", *(f"{m}_n" for m in (*MONEY, *WHOLE)), *WHOLE]
    for m in (*MONEY, "failed_value"):
        names += [f"{m}_high", f"{m}_rest"]
    return names


def _month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def _cells(orders: DataFrame, dimensions: list[str] = DIMENSIONS) -> DataFrame:
    failed = F.col("failed_payment_attempts") > 0
    aggs = [F.count(F.lit(1)).alias("lines"), F.count_if(failed).alias("failed")]
    for name, col in {**MONEY, "failed_value": "order_value"}.items():
        x = nan_to_null(F.col(col).cast("double"))
        x = F.when(failed, x) if name == "failed_value" else x
        high = x.cast(f"decimal(38,{EXACT_SCALE})")
        aggs += [F.sum(high).alias(f"{name}_high"), F.sum(x - high.cast("double")).alias(f"{name}_rest")]
        if name in MONEY:
            # counts of the values that are not NULL, as ``count`` gives them for whole reports
            aggs.append(F.count(x).alias(f"{name}_n"))
    for name, col in WHOLE.items():
        aggs += [F.sum(F.col(col).cast("long")).alias(name), F.count(col).alias(f"{name}_n")]
    keyed = orders.withColumn("day", F.to_date("order_date"))
    return keyed.groupBy(*dimensions).agg(*aggs).withColumn("month", _month(F.col("day")))


def _fewer(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with fewer dimensions."""
    return cells.groupBy(*keys).agg(*[F.sum(m).cast(cells.schema[m].dataType).alias(m) for m in _measures()])


def _write(table: DataFrame, path: str) -> None:
    table.sparkSession.createDataFrame([(table.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(f"{path}-schema")
    # adaptive execution makes one file of a small month and several of a large one
    (table.hint("rebalance", F.col("month")).sortWithinPartitions("month", "day")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))


def open_rollup(spark: SparkSession, path: str, tables: tuple[str, ...] = TABLES) -> Rollup:
    """A rollup that was written; an empty one has no files to take a schema from, so it is stored beside."""
    found = {}
    for name in tables:
        schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/{name}-schema").first()[0]))
        found[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
    return Rollup(found.get("cells"), found["days"], path)


def build(orders: DataFrame, path: str | None = None, tables: tuple[str, ...] = TABLES) -> Rollup:
    """Write the rollup of ``orders`` into ``path`` (a new folder in the checkpoint folder by default); ``tables`` may be ``days`` alone."""
    spark = orders.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/rollup/{uuid.uuid4().hex}"
    refresh(orders, path, tables)
    return open_rollup(spark, path, tables)


def refresh(orders: DataFrame, path: str, tables: tuple[str, ...] = TABLES) -> None:
    """Write the months of ``orders`` again; other months stay as they are.

    ``orders`` must hold all lines of the months that it touches, ``tables`` are those that were built.  The partitions of a
    table are replaced when its job commits, so an interrupted refresh leaves a table's
    old ones; ``days`` is derived from the ``cells`` that were just written.
    """
    spark = orders.sparkSession
    if "cells" not in tables:
        _write(_cells(orders, DAY_DIMENSIONS), f"{path}/days")
        return
    before = f"{path}/incoming-{uuid.uuid4().hex}"
    _cells(orders).write.parquet(before)  # the one pass over the lines
    fresh = spark.read.parquet(before)
    _write(fresh, f"{path}/cells")
    _write(_fewer(fresh, ["month", *DAY_DIMENSIONS]), f"{path}/days")
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(before)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


# --- figures --------------------------------------------------------------------------------------

def recent(table: DataFrame, ref_date: str, days: int) -> DataFrame:
    """Cells of the days from ``ref_date - days`` on; months before are pruned."""
    first = _dt.datetime.fromisoformat(ref_date) - _dt.timedelta(days=days)
    if first.time() != _dt.time(0):
        raise ValueError("a window of the rollup begins at a day")
    return table.where((F.col("month") >= first.year * 100 + first.month) & (F.col("day") >= F.lit(first.date())))


def _when(cond: Column | None, x: Column) -> Column:
    return x if cond is None else F.when(cond, x)


def total(name: str, cond: Column | None = None) -> Column:
    """The exact sum of a money measure; NULL without values."""
    return (F.sum(_when(cond, F.col(f"{name}_high"))).cast("double") + F.sum(_when(cond, F.col(f"{name}_rest"))))


def count(name: str, cond: Column | None = None) -> Column:
    return F.coalesce(F.sum(_when(cond, F.col(name))), F.lit(0)).cast("long")


def mean(name: str, cond: Column | None = None) -> Column:
    """Mean of a measure over the lines that have it."""
    above = total(name, cond) if name in MONEY else F.sum(_when(cond, F.col(name))).cast("double")
    return F.try_divide(above, F.sum(_when(cond, F.col(f"{name}_n"))))


def revenue_90_30(r: Rollup, ref_date: str) -> DataFrame:
    """I1/I2."""
    window = recent(r.days, ref_date, insights.RECENT_DAYS)
    short = F.col("day") >= F.lit(insights.cutoff(ref_date, insights.SHORT_DAYS)[:10]).cast("date")
    return window.agg(count("lines").alias("orders_90"), F.coalesce(total("value"), F.lit(0.0)).alias("revenue_90"),
                      count("lines", short).alias("orders_30"), F.coalesce(total("value", short), F.lit(0.0)).alias("revenue_30"))


def top_category(r: Rollup, ref_date: str) -> DataFrame:
    """I3."""
    by = recent(r.days, ref_date, insights.RECENT_DAYS).groupBy("category").agg(total("value").alias("revenue"))
    whole = recent(r.days, ref_date, insights.RECENT_DAYS).select(total("value")).scalar()
    return (by.where(F.col("category").isNotNull()).orderBy(F.col("revenue").desc(), F.col("category").asc()).limit(1)
            .select("category", "revenue", (F.try_divide(F.col("revenue"), whole) * F.lit(100.0)).alias("share_pct")))


def discount_impact(r: Rollup, ref_date: str) -> DataFrame:
    """I4."""
    return (recent(r.days, ref_date, insights.RECENT_DAYS).where(F.col("discount_pct").isNotNull()).groupBy("discount_pct")
            .agg(mean("value").alias("avg_order_value"), total("value").alias("total_revenue"), count("value_n").alias("order_count")))


def optimal_discount(r: Rollup, ref_date: str) -> DataFrame:
    """I5."""
    return (discount_impact(r, ref_date).orderBy(F.col("total_revenue").desc(), F.col("discount_pct").asc()).limit(1)
            .select("discount_pct", "total_revenue"))


def product_sales(r: Rollup, products: DataFrame, ref_date: str) -> DataFrame:
    """I8."""
    per = (recent(r.cells, ref_date, insights.RECENT_DAYS).where(F.col("product_id").isNotNull()).groupBy("product_id")
           .agg(total("quantity").alias("units_sold"), total("value").alias("revenue"), mean("rating").alias("avg_rating")))
    return per.join(products.select("product_id", "base_price", "category"), "product_id")


def top_products(r: Rollup, products: DataFrame, ref_date: str, n: int = insights.TOP_PRODUCTS) -> DataFrame:
    """I9."""
    sold = product_sales(r, products, ref_date)
    return insights._id_list(sold, [F.col("revenue").desc(), F.col("product_id").asc()], n, "top_products")


def worst_products(r: Rollup, products: DataFrame, ref_date: str, n: int = insights.TOP_PRODUCTS) -> DataFrame:
    """I10."""
    sold = product_sales(r, products, ref_date).where(F.col("revenue") > 0)
    last = sold.orderBy(F.col("revenue").asc(), F.col("product_id").desc()).limit(n)
    return insights._id_list(last, [F.col("revenue").desc(), F.col("product_id").asc()], n, "worst_products")


def delivery_insight(r: Rollup) -> DataFrame:
    """I11."""
    late = F.col("delivery_delay") > insights.DELAY_ALERT_DAYS
    return r.days.agg(
        mean("delivery").alias("avg_delivery_days"), count("lines", late).alias("delayed_orders"),
        F.try_divide(F.sum(F.when(late, F.col("delivery_delay") * F.col("lines"))).cast("double"), F.sum(F.when(late, F.col("lines"))))
        .alias("avg_delay_days"), mean("returned", late).alias("delayed_return_rate"))


def delay_impact(r: Rollup) -> DataFrame:
    """I12."""
    return (r.days.where(F.col("delivery_delay").isNotNull()).groupBy("delivery_delay")
            .agg(mean("returned").alias("return_rate"), mean("customer_rating").alias("avg_rating"), count("lines").alias("orders")))


def payment_failures(r: Rollup) -> DataFrame:
    """I13."""
    return r.days.agg(
        count("failed").alias("failed_orders"),
        (F.try_divide(F.sum("failed").cast("double"), F.sum("lines")) * F.lit(100.0)).alias("failed_pct"),
        F.coalesce(total("failed_value"), F.lit(0.0)).alias("value_at_stake"))


def return_rate(r: Rollup) -> DataFrame:
    """I14."""
    return r.days.agg(mean("returned").alias("return_rate"), count("lines").alias("orders"))


def return_by_category(r: Rollup) -> DataFrame:
    """I14."""
    return (r.days.where(F.col("category").isNotNull()).groupBy("category")
            .agg(mean("returned").alias("return_rate"), count("lines").alias("orders")))


def revenue_by_category(r: Rollup, top: int = reports.TOP_CATEGORIES) -> DataFrame:
    """D3."""
    return (r.days.where(F.col("category").isNotNull()).groupBy("category").agg(total("value").alias("revenue"))
            .orderBy(F.col("revenue").desc(), F.col("category").asc()).limit(top).withColumn("label", truncate_label("category")))


def orders_by_weekday(r: Rollup) -> DataFrame:
    """D5."""
    return (r.days.where(F.col("day").isNotNull()).groupBy(F.weekday("day").alias("day_of_week")).agg(count("lines").alias("orders"))
            .withColumn("day_name", weekday_name("day_of_week")))


def daily_revenue(r: Rollup) -> DataFrame:
    """D6."""
    return r.days.where(F.col("day").isNotNull()).groupBy(F.col("day").alias("date")).agg(total("value").alias("revenue"))


def business_kpis(r: Rollup, labeled_customers: DataFrame) -> DataFrame:
    """K1."""
    o = r.days.agg(count("lines").alias("total_orders"), F.coalesce(total("value"), F.lit(0.0)).alias("total_revenue"),
                   mean("value").alias("average_order_value"), mean("returned").alias("return_rate"),
                   mean("delivery").alias("average_delivery_time"))
    c = labeled_customers.agg(F.count(F.lit(1)).alias("total_customers"),
                              F.try_divide(F.sum("churned").cast("double"), F.count("churned")).alias("customer_churn_rate"))
    cs = c.select(F.struct("total_customers", "customer_churn_rate")).scalar()
    return o.select("*", cs.getField("total_customers").alias("total_customers"),
                    cs.getField("customer_churn_rate").alias("customer_churn_rate"))


def insight_facts(r: Rollup, ref_date: str, lines: DataFrame | None = None) -> DataFrame:
    """The order-level numbers of the insight document, as ``insights.insight_facts`` gives them.

    Four small aggregates over cells: no line is expanded.  Without ``cells`` the products'
    figures are one aggregate of the order ``lines``.
    """
    if r.cells is None and lines is None:
        raise ValueError("a rollup of days alone needs the order lines for the figures by product")
    late = F.col("delivery_delay") > insights.DELAY_ALERT_DAYS
    c90, c30 = (F.col("day") >= F.lit(insights.cutoff(ref_date, d)[:10]).cast("date")
                for d in (insights.RECENT_DAYS, insights.SHORT_DAYS))
    figures = [
        count("lines", c90).alias("orders_90"), F.coalesce(total("value", c90), F.lit(0.0)).alias("revenue_90"),
        count("lines", c30).alias("orders_30"), F.coalesce(total("value", c30), F.lit(0.0)).alias("revenue_30"),
        F.coalesce(total("quantity", c90), F.lit(0.0)).alias("units_90"),
        F.coalesce(total("rating", c90), F.lit(0.0)).alias("_rating_sum_90"), count("rating_n", c90).alias("_rating_n_90"),
        count("lines").alias("orders"), count("returned").alias("_ret_sum"), count("returned_n").alias("_ret_n"),
        count("delivery").alias("_del_sum"), count("delivery_n").alias("_del_n"), count("lines", late).alias("delayed_orders"),
        F.coalesce(F.sum(F.when(late, F.col("delivery_delay") * F.col("lines"))), F.lit(0)).cast("long").alias("_late_delay_sum"),
        count("lines", late).alias("_late_delay_n"), count("returned", late).alias("_late_ret_sum"),
        count("returned_n", late).alias("_late_ret_n"), count("failed").alias("failed_orders"),
        F.coalesce(total("failed_value"), F.lit(0.0)).alias("value_at_stake")]
    types = {c: (lines if r.cells is None else r.cells).schema[c].dataType for c in ("category", "discount_pct", "product_id")}
    out = None
    for level in (*types, "all"):
        if level == "product_id" and r.cells is None:
            out = out.unionByName(insights.insight_facts(lines, ref_date, [["product_id"]]))
            continue
        source = r.cells if level == "product_id" else r.days
        # without lines there is no row at all, as a grouping set has none
        grouped = source.agg(*figures).where("orders > 0") if level == "all" else source.groupBy(level).agg(*figures)
        part = grouped.select(*[(F.col(c) if c == level else F.lit(None).cast(t)).alias(c) for c, t in types.items()],
                              *[c for c in grouped.columns if c != level], F.lit(level).alias("level"))
        out = part if out is None else out.unionByName(part)
    return out
