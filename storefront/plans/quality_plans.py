"""Registered queries for the data-quality checks (V1-V9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from storefront.operators import quality
from storefront.plans.catalog import XAVG, XSUM, register
from storefront.plans.views import with_views
from storefront.session import apply_conf, ensure_checkpoint_dir
from storefront.sources import testdata as td


def _o(spark, d):
    return td.orders(spark, d)


def _p(spark, d):
    return td.products(spark, d)


def _c(spark, d):
    return td.customers(spark, d)


def _nulls_sql(view: str, table: str, gone: tuple[str, ...] = ()) -> str:
    parts = []
    for col in quality.REQUIRED[table]:
        if col in gone:
            continue
        parts.append(
            f"SELECT '{table}' AS table_name, '{col}' AS column_name, COUNT(*) AS rows, "
            f"COUNT(*) FILTER (WHERE {col} IS NULL) AS nulls, "
            f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS DOUBLE) / COUNT(*) * 100e0 AS null_pct, "
            f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS DOUBLE) / COUNT(*) > 0.1 AS high_nulls FROM {view}")
    return " UNION ALL ".join(parts)


@register("dq_nulls", with_views(" UNION ALL ".join(
    [_nulls_sql("orders_c", "orders"), _nulls_sql("products_c", "products"),
     _nulls_sql("customers_c", "customers")])))
def _dq_nulls(spark, d):
    return (quality.dq_nulls(_o(spark, d), "orders")
            .unionByName(quality.dq_nulls(_p(spark, d), "products"))
            .unionByName(quality.dq_nulls(_c(spark, d), "customers")))


register("dq_orders", with_views(
    "SELECT COUNT(*) AS rows, MIN(order_date) AS first_order, MAX(order_date) AS last_order, "
    "COUNT(*) FILTER (WHERE quantity < 1) AS quantity_below_1, "
    "COUNT(*) FILTER (WHERE order_value < 0) AS negative_value, "
    f"COALESCE({XSUM('order_value')}, 0e0) AS total_revenue FROM orders_c"))(
    lambda spark, d: quality.dq_orders(_o(spark, d)))

register("dq_products", with_views(
    "SELECT COUNT(*) AS rows, MIN(base_price) AS min_price, MAX(base_price) AS max_price, "
    "COUNT(*) FILTER (WHERE rating < 1 OR rating > 5) AS rating_out_of_range FROM products_c"))(
    lambda spark, d: quality.dq_products(_p(spark, d)))

register("dq_customers", with_views(
    "SELECT COUNT(*) AS rows, MIN(lifetime_value) AS min_ltv, MAX(lifetime_value) AS max_ltv, "
    f"{XAVG('lifetime_value')} AS avg_ltv FROM customers_c"))(
    lambda spark, d: quality.dq_customers(_c(spark, d)))


def _orphan_sql(left: str, right: str, key: str) -> str:
    return (f"SELECT COUNT(*) AS orphans, CASE WHEN COUNT(*) <= 10 THEN "
            f"COALESCE(string_agg(CAST({key} AS VARCHAR), ', ' ORDER BY CAST({key} AS VARCHAR)), '') END "
            f"AS orphan_ids FROM (SELECT DISTINCT {key} FROM {left} l WHERE NOT EXISTS "
            f"(SELECT 1 FROM {right} r WHERE r.{key} = l.{key})) t")


register("dq_orphan_customers", with_views(_orphan_sql("orders_c", "customers_c", "customer_id")))(
    lambda spark, d: quality.orphan_summary(_o(spark, d), _c(spark, d), "customer_id"))

register("dq_orphan_products", with_views(_orphan_sql("orders_c", "products_c", "product_id")))(
    lambda spark, d: quality.orphan_summary(_o(spark, d), _p(spark, d), "product_id"))


_MONEY = "COALESCE(format('{{:,.2f}}', CAST({} AS DOUBLE)), 'none')"
_DAY = "COALESCE(strftime({}, '%Y-%m-%d'), 'none')"


def _report_sql(orders: str = "orders_c", n_orders: int = 19, gone: tuple[str, ...] = ()) -> str:
    """The report over the views; ``gone`` are columns that the orders view lacks."""
    def row(table, check, severity, ok, detail, src):
        return (f"SELECT '{table}' AS table_name, '{check}' AS \"check\", '{severity}' AS severity, {ok} AS ok, "
                f"{detail} AS detail FROM {src}")
    rows = []
    views = {"orders": orders, "products": "products_c", "customers": "customers_c"}
    for t in views:
        miss = [c for c in quality.REQUIRED[t] if t == "orders" and c in gone]
        rows.append(row(t, "required_columns", "error", str(not miss).upper(), "'" + ", ".join(miss) + "'", "(SELECT 1) o"))
    nulls = " UNION ALL ".join(_nulls_sql(v, t, gone if t == "orders" else ()) for t, v in views.items())
    rows.append("SELECT table_name, 'nulls:' || column_name AS \"check\", 'warning' AS severity, NOT high_nulls AS ok, "
                f"CAST(nulls AS VARCHAR) || ' nulls (' || format('{{:,.1f}}', null_pct) || '%)' AS detail FROM ({nulls}) n")
    for t, k in (("orders", n_orders), ("products", 7), ("customers", 5)):
        rows.append(row(t, "size", "info", "TRUE", f"CAST(COUNT(*) AS VARCHAR) || ' rows, {k} columns'", views[t]))
    if "order_date" not in gone:
        rows.append(row("orders", "date_range", "info", "TRUE",
                        _DAY.format("MIN(order_date)") + " || ' to ' || " + _DAY.format("MAX(order_date)"), orders))
    for col, check, bad in (("quantity", "quantity_below_1", "quantity < 1"), ("order_value", "negative_value", "order_value < 0")):
        if col not in gone:
            n = f"COUNT(*) FILTER (WHERE {bad})"
            rows.append(row("orders", check, "warning", f"{n} = 0", f"CAST({n} AS VARCHAR)", orders))
    if "order_value" not in gone:
        rows.append(row("orders", "total_revenue", "info", "TRUE", _MONEY.format(f"COALESCE({XSUM('order_value')}, 0e0)"), orders))
    for t, col, check in (("products", "base_price", "price_range"), ("customers", "lifetime_value", "lifetime_value")):
        rows.append(row(t, check, "info", "TRUE", _MONEY.format(f"MIN({col})") + " || ' to ' || " + _MONEY.format(f"MAX({col})")
                        + " || ', mean ' || " + _MONEY.format(XAVG(col)), views[t]))
    n = "COUNT(*) FILTER (WHERE rating < 1 OR rating > 5)"
    rows.append(row("products", "rating_out_of_range", "warning", f"{n} = 0", f"CAST({n} AS VARCHAR)", "products_c"))
    for name, right, key in (("orphan_customers", "customers_c", "customer_id"), ("orphan_products", "products_c", "product_id")):
        rows.append(row("orders", name, "warning", "orphans = 0", "COALESCE(orphan_ids, CAST(orphans AS VARCHAR))",
                        f"({_orphan_sql(orders, right, key)}) t"))
    return " UNION ALL ".join(rows)


register("dq_report", with_views(_report_sql()))(
    lambda spark, d: quality.dq_report(_o(spark, d), _p(spark, d), _c(spark, d)))

register("dq_verdict", with_views(
    f"SELECT COALESCE(bool_and(CASE WHEN severity = 'error' THEN ok END), TRUE) AS valid FROM ({_report_sql()}) r"))(
    lambda spark, d: quality.dq_verdict(quality.dq_report(_o(spark, d), _p(spark, d), _c(spark, d))))

# V1: no customers table, and the checks of products taken from the pass that writes it
_ABSENT = (f"SELECT * FROM ({_report_sql()}) r WHERE table_name <> 'customers' AND \"check\" <> 'orphan_customers' "
           "UNION ALL SELECT 'customers', 'present', 'error', FALSE, 'input missing'")


@register("dq_report_absent", with_views(_ABSENT))
def _dq_report_absent(spark, d):
    products = _p(spark, d)
    passing, seen = quality.observe_checks(_p(apply_conf(spark.newSession()), d), "products")
    passing.write.mode("overwrite").parquet(f"{ensure_checkpoint_dir(spark)}/ingest/{uuid.uuid4().hex}")
    return quality.dq_report(_o(spark, d), products, None, {"products": seen})


# orders with a missing column, orphan and NULL keys, and missing values
_DIRTY = ("dirty AS (SELECT order_id, CASE WHEN customer_id % 50 = 0 THEN NULL WHEN customer_id % 50 = 1 "
          "THEN customer_id + 100000000 ELSE customer_id END AS customer_id, CASE WHEN product_id = 7 THEN -7 "
          "ELSE product_id END AS product_id, order_date, CASE WHEN order_id % 3 = 0 THEN NULL "
          "ELSE order_value END AS order_value FROM orders_c)")


@register("dq_report_dirty", with_views(_report_sql("dirty", 5, ("quantity",)), _DIRTY))
def _dq_report_dirty(spark, d):
    o = _o(spark, d)
    c = F.col("customer_id")
    value = F.when(F.col("order_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("order_value"))
    dirty = o.select("order_id", F.when(c % 50 == 0, None).when(c % 50 == 1, c + 100000000).otherwise(c).alias("customer_id"),
                     F.when(F.col("product_id") == 7, -7).otherwise(F.col("product_id")).alias("product_id"),
                     "order_date", value.alias("order_value"))
    return quality.dq_report(dirty, _p(spark, d), _c(spark, d))
