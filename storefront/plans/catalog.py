"""Registered queries: each key maps to a Spark plan over the test tables and,
where SQL can express it, the equivalent DuckDB SQL used as the oracle.

Every query reads the whole tables (no id subsets, no row caps); limits appear
only where the operator itself is a top-k.  Column names and types are aligned
between the two sides; sums of money are exact (decimal accumulators) on both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.functions.dates import floor_days, weekday_mon0
from storefront.functions.numeric import exact_avg, exact_sum
from storefront.operators import churn, clean, insights, reports, rollup
from storefront.operators.clean import np_round
from storefront.operators.stats import quantile_columns
from storefront.plans.derived import kept
from storefront.plans.views import with_views
from storefront.sources import testdata as td

REF = td.REF_DATE
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# SQL fragments shared by the oracle queries: plain sums and means (``fsum`` only
# adds up more carefully); results are rounded, inputs never.
def XSUM(x: str) -> str:
    return f"fsum({x})"


def XAVG(x: str) -> str:
    return f"(fsum({x}) / COUNT({x}))"


def IAVG(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / COUNT({x}))"


def NPROUND(x: str, d: int) -> str:
    s = f"{float(10 ** d)!r}e0".replace(".0e0", "e0")
    return f"(round_even(({x}) * {s}, 0) / {s})"


# Decimals to which the results of sums and means are rounded on both sides (two
# engines add doubles up in different orders).  Money totals, whose terms have 4
# decimals, are rounded to 5.
ROUNDED: dict[str, dict[str, int]] = {
    "revenue_by_category": {"revenue": 5},
    "daily_revenue": {"revenue": 5},
    "revenue_90_30": {"revenue_90": 5, "revenue_30": 5},
    "top_category": {"revenue": 5, "share_pct": 9},
    "discount_impact": {"avg_order_value": 6, "total_revenue": 5},
    "optimal_discount": {"total_revenue": 5},
    "product_sales": {"revenue": 5, "avg_rating": 9},
    "payment_failures": {"value_at_stake": 5},
    "acquisition": {"avg_ltv": 6},
    "order_stats": {"avg_order_value": 6, "total_spent": 5, "avg_discount": 9},
    "customer_features": {"avg_order_value": 6, "total_spent": 5, "avg_discount": 9},
    "business_kpis": {"total_revenue": 5, "average_order_value": 6},
    "dq_orders": {"total_revenue": 5},
    "dq_customers": {"avg_ltv": 6},
    "split_customers": {"lifetime_value": 5},
    "high_risk": {"total_spent": 5},
    "high_risk_summary": {"at_risk_value": 5, "estimated_save": 5},
    "insight_facts": {"revenue_90": 5, "revenue_30": 5, "_rating_sum_90": 6, "value_at_stake": 5},
}


def _off(places: int) -> float:
    """A small part of the last place: means such as 1/16 of a cent would lie just between two results."""
    return 0.0123 / 10 ** places


def register(name: str, sql: str | None = None):
    places = ROUNDED.get(name, {})

    def deco(fn):
        if places:
            def run(spark, d):
                return fn(spark, d).withColumns({c: np_round(F.col(c) + _off(n), n) for c, n in places.items()})
        else:
            run = fn
        QUERIES[name] = run
        if sql is not None:
            cut = ", ".join(f"{NPROUND(f'{c} + {_off(n)!r}', n)} AS {c}" for c, n in places.items())
            ORACLE[name] = f"SELECT * REPLACE ({cut}) FROM ({sql}) t_" if cut else sql
        return fn
    return deco


def _o(spark, d):
    return td.orders(spark, d)


def _p(spark, d):
    return td.products(spark, d)


def _c(spark, d):
    return td.customers(spark, d)


def _r(spark, d) -> rollup.Rollup:
    """The rollup of the order lines by day, written once for the given files; figures by product come from the lines."""
    return kept("rollup", spark, d, ("lineitem", "orders", "part"), lambda: rollup.build(_o(spark, d), tables=("days",)), lambda r: r.path)


CUT90 = "TIMESTAMP '2001-05-04 00:00:00'"
CUT30 = "TIMESTAMP '2001-07-03 00:00:00'"
REF_TS = "TIMESTAMP '2001-08-02 00:00:00'"

# ------------------------------------------------------------------ scans ----
register("scan_orders", with_views(
    "SELECT order_id, line_no, supplier_id, customer_id, product_id, order_date, quantity, discount_pct, "
    "base_price, price_after_discount, order_value, delivery_time_days, delivery_delay, payment_method, "
    "failed_payment_attempts, is_returned, customer_rating, category, rating FROM orders_c"))(
    lambda spark, d: _o(spark, d))

# ---------------------------------------------------------------- reports ----
register("revenue_by_category", with_views(
    f"SELECT category, {XSUM('order_value')} AS revenue, "
    "CASE WHEN length(category) <= 40 THEN category ELSE substr(category, 1, 37) || '...' END AS label "
    "FROM orders_c WHERE category IS NOT NULL GROUP BY category ORDER BY revenue DESC, category LIMIT 10"))(
    lambda spark, d: rollup.revenue_by_category(_r(spark, d)))

register("daily_revenue", with_views(
    f"SELECT CAST(CAST(order_date AS DATE) AS TIMESTAMP) AS date, {XSUM('order_value')} AS revenue "
    "FROM orders_c WHERE order_date IS NOT NULL GROUP BY 1"))(
    lambda spark, d: rollup.daily_revenue(_r(spark, d)).withColumn("date", F.col("date").cast("timestamp")))

register("orders_by_weekday", with_views(
    "SELECT CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week, COUNT(*) AS orders, "
    "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][isodow(order_date)] AS day_name "
    "FROM orders_c WHERE order_date IS NOT NULL GROUP BY 1, 3"))(
    lambda spark, d: rollup.orders_by_weekday(_r(spark, d)))


@register("filter_dates", with_views(
    f"SELECT order_id, line_no, product_id, order_date, order_value FROM orders_c "
    "WHERE order_date >= TIMESTAMP '2000-01-01' AND order_date < TIMESTAMP '2000-07-01'"))
def _filter_dates(spark, d):
    return reports.filter_dates(_o(spark, d), "2000-01-01", "2000-06-30").select(
        "order_id", "line_no", "product_id", "order_date", "order_value")


@register("filter_categories", with_views(
    "SELECT o.order_id, o.line_no, o.product_id, o.category, o.order_value FROM orders_c o "
    "WHERE o.product_id IN (SELECT product_id FROM products_c WHERE category IN ("
    "  SELECT category FROM products_c GROUP BY category ORDER BY MIN(product_id) LIMIT 3))"))
def _filter_categories(spark, d):
    return reports.filter_categories(_o(spark, d), _p(spark, d)).select(
        "order_id", "line_no", "product_id", "category", "order_value")


register("truncate_labels", with_views(
    "SELECT product_id, product_name, "
    "CASE WHEN length(product_name) <= 20 THEN product_name ELSE substr(product_name, 1, 17) || '...' END "
    "AS label FROM products_c"))(
    lambda spark, d: reports.truncate_labels(_p(spark, d).select("product_id", "product_name"),
                                             "product_name", 20))

register("date_range", with_views(
    "SELECT MIN(order_date) AS first_order, MAX(order_date) AS last_order FROM orders_c"))(
    lambda spark, d: clean.date_range(_o(spark, d)))

# --------------------------------------------------------------- insights ----
register("revenue_90_30", with_views(
    f"SELECT COUNT(*) AS orders_90, COALESCE({XSUM('order_value')}, 0e0) AS revenue_90, "
    f"COUNT(*) FILTER (WHERE order_date >= {CUT30}) AS orders_30, "
    f"COALESCE({XSUM(f'CASE WHEN order_date >= {CUT30} THEN order_value END')}, 0e0) AS revenue_30 "
    f"FROM orders_c WHERE order_date >= {CUT90}"))(
    lambda spark, d: rollup.revenue_90_30(_r(spark, d), REF))

register("top_category", with_views(
    f"SELECT category, {XSUM('order_value')} AS revenue, "
    f"{XSUM('order_value')} / (SELECT {XSUM('order_value')} FROM orders_c WHERE order_date >= {CUT90}) * 100e0 "
    f"AS share_pct FROM orders_c WHERE order_date >= {CUT90} AND category IS NOT NULL "
    "GROUP BY category ORDER BY revenue DESC, category LIMIT 1"))(
    lambda spark, d: rollup.top_category(_r(spark, d), REF))

register("discount_impact", with_views(
    f"SELECT discount_pct, {XAVG('order_value')} AS avg_order_value, {XSUM('order_value')} AS total_revenue, "
    f"COUNT(order_value) AS order_count FROM orders_c WHERE order_date >= {CUT90} "
    "AND discount_pct IS NOT NULL GROUP BY discount_pct"))(
    lambda spark, d: rollup.discount_impact(_r(spark, d), REF))

register("optimal_discount", with_views(
    f"SELECT discount_pct, {XSUM('order_value')} AS total_revenue FROM orders_c "
    f"WHERE order_date >= {CUT90} AND discount_pct IS NOT NULL GROUP BY discount_pct "
    "ORDER BY total_revenue DESC, discount_pct LIMIT 1"))(
    lambda spark, d: rollup.optimal_discount(_r(spark, d), REF))

_PS = (f"ps AS (SELECT s.product_id, s.units_sold, s.revenue, s.avg_rating, p.base_price, p.category FROM "
       f"(SELECT product_id, SUM(quantity) AS units_sold, {XSUM('order_value')} AS revenue, "
       f"{XAVG('rating')} AS avg_rating FROM orders_c WHERE order_date >= {CUT90} AND product_id IS NOT NULL "
       f"GROUP BY product_id) s JOIN products_c p ON s.product_id = p.product_id)")

register("product_sales", with_views("SELECT * FROM ps", _PS))(
    lambda spark, d: insights.product_sales(_o(spark, d), _p(spark, d), REF))

register("top_products", with_views(
    "SELECT string_agg(CAST(product_id AS VARCHAR), ', ' ORDER BY revenue DESC, product_id) AS top_products, "
    "COUNT(*) AS n FROM (SELECT * FROM ps ORDER BY revenue DESC, product_id LIMIT 5) t", _PS))(
    lambda spark, d: insights.top_products(_o(spark, d), _p(spark, d), REF))

register("worst_products", with_views(
    "SELECT string_agg(CAST(product_id AS VARCHAR), ', ' ORDER BY revenue DESC, product_id) AS worst_products, "
    "COUNT(*) AS n FROM (SELECT * FROM ps WHERE revenue > 0 ORDER BY revenue ASC, product_id DESC LIMIT 5) t",
    _PS))(
    lambda spark, d: insights.worst_products(_o(spark, d), _p(spark, d), REF))

register("delivery_insight", with_views(
    f"SELECT {IAVG('delivery_time_days')} AS avg_delivery_days, "
    "COUNT(*) FILTER (WHERE delivery_delay > 2) AS delayed_orders, "
    "(CAST(SUM(delivery_delay) FILTER (WHERE delivery_delay > 2) AS DOUBLE) / "
    " COUNT(delivery_delay) FILTER (WHERE delivery_delay > 2)) AS avg_delay_days, "
    "(CAST(SUM(is_returned) FILTER (WHERE delivery_delay > 2) AS DOUBLE) / "
    " COUNT(is_returned) FILTER (WHERE delivery_delay > 2)) AS delayed_return_rate FROM orders_c"))(
    lambda spark, d: rollup.delivery_insight(_r(spark, d)))

register("delay_impact", with_views(
    f"SELECT delivery_delay, {IAVG('is_returned')} AS return_rate, {IAVG('customer_rating')} AS avg_rating, "
    "COUNT(*) AS orders FROM orders_c WHERE delivery_delay IS NOT NULL GROUP BY delivery_delay"))(
    lambda spark, d: rollup.delay_impact(_r(spark, d)))

register("payment_failures", with_views(
    "SELECT COUNT(*) FILTER (WHERE failed_payment_attempts > 0) AS failed_orders, "
    "CAST(COUNT(*) FILTER (WHERE failed_payment_attempts > 0) AS DOUBLE) / COUNT(*) * 100e0 AS failed_pct, "
    f"COALESCE({XSUM('CASE WHEN failed_payment_attempts > 0 THEN order_value END')}, 0e0) AS value_at_stake "
    "FROM orders_c"))(
    lambda spark, d: rollup.payment_failures(_r(spark, d)))

register("return_rate", with_views(
    f"SELECT {IAVG('is_returned')} AS return_rate, COUNT(*) AS orders FROM orders_c"))(
    lambda spark, d: rollup.return_rate(_r(spark, d)))

register("return_by_category", with_views(
    f"SELECT category, {IAVG('is_returned')} AS return_rate, COUNT(*) AS orders FROM orders_c "
    "WHERE category IS NOT NULL GROUP BY category"))(
    lambda spark, d: rollup.return_by_category(_r(spark, d)))

register("acquisition", with_views(
    f"SELECT {XAVG('lifetime_value')} AS avg_ltv, "
    "(SELECT city FROM customers_c WHERE city IS NOT NULL GROUP BY city ORDER BY COUNT(*) DESC, city LIMIT 1) "
    "AS top_city, (SELECT COUNT(*) FROM customers_c WHERE city IS NOT NULL GROUP BY city "
    "ORDER BY COUNT(*) DESC, city LIMIT 1) AS top_city_customers FROM customers_c"))(
    lambda spark, d: insights.acquisition(_c(spark, d)))

register("low_stock", with_views(
    "SELECT COUNT(*) AS low_stock_products, (SELECT string_agg(CAST(product_id AS VARCHAR), ', ' "
    "ORDER BY product_id) FROM (SELECT product_id FROM products_c WHERE stock_quantity < 20 "
    "ORDER BY product_id LIMIT 5) t) AS reorder_first FROM products_c WHERE stock_quantity < 20"))(
    lambda spark, d: insights.low_stock(_p(spark, d)))


@register("high_value_customers", with_views(
    "SELECT COUNT(*) FILTER (WHERE lifetime_value > q) AS high_value_customers, "
    f"{NPROUND('ANY_VALUE(q)', 6)} AS threshold FROM customers_c, "
    "(SELECT quantile_cont(lifetime_value, 0.9) AS q FROM customers_c) t"))
def _high_value_customers(spark, d):
    return insights.high_value_customers(_c(spark, d)).select(
        "high_value_customers", np_round(F.col("threshold"), 6).alias("threshold"))


register("high_value_flag", with_views(
    "SELECT customer_id, lifetime_value, CASE WHEN lifetime_value > "
    "(SELECT quantile_cont(lifetime_value, 0.85) FROM customers_c) THEN 1 ELSE 0 END AS is_high_value "
    "FROM customers_c"))(
    lambda spark, d: clean.high_value_flag(_c(spark, d).select("customer_id", "lifetime_value")))

# ------------------------------------------------------------------ churn ----
register("last_order", with_views(
    "SELECT customer_id, MAX(order_date) AS last_order_date FROM orders_c "
    "WHERE customer_id IS NOT NULL GROUP BY customer_id"))(
    lambda spark, d: churn.last_order(_o(spark, d)))

_LABELS = ("labels AS (SELECT c.*, l.last_order_date, "
           f"CAST(COALESCE(floor((epoch({REF_TS}) - epoch(l.last_order_date)) / 86400e0), 9999) AS INTEGER) "
           "AS days_since_last_order FROM customers_c c LEFT JOIN (SELECT customer_id, MAX(order_date) "
           "AS last_order_date FROM orders_c WHERE customer_id IS NOT NULL GROUP BY customer_id) l "
           "ON c.customer_id = l.customer_id), "
           "labeled AS (SELECT *, CASE WHEN days_since_last_order > 180 THEN 1 ELSE 0 END AS churned FROM labels)")

register("churn_labels", with_views(
    "SELECT customer_id, city, signup_date, lifetime_value, age_group, last_order_date, "
    "days_since_last_order, churned FROM labeled", _LABELS))(
    lambda spark, d: churn.churn_labels(_c(spark, d), _o(spark, d), REF))

register("churn_rate", with_views(
    "SELECT COUNT(*) AS customers, CAST(SUM(churned) AS BIGINT) AS churned, "
    f"{IAVG('churned')} AS churn_rate FROM labeled", _LABELS))(
    lambda spark, d: churn.churn_rate(churn.churn_labels(_c(spark, d), _o(spark, d), REF)))

_STATS = ("stats AS (SELECT customer_id, COUNT(order_id) AS total_orders, "
          f"{XAVG('order_value')} AS avg_order_value, {XSUM('order_value')} AS total_spent, "
          f"{IAVG('customer_rating')} AS avg_rating_given, {IAVG('is_returned')} AS return_rate, "
          f"{XAVG('discount_pct')} AS avg_discount FROM orders_c WHERE customer_id IS NOT NULL "
          "GROUP BY customer_id)")

register("order_stats", with_views("SELECT * FROM stats", _STATS))(
    lambda spark, d: churn.order_stats(_o(spark, d)))

_FEATURES = (_LABELS + ", " + _STATS + ", features AS (SELECT l.customer_id, l.lifetime_value, l.churned, "
             "COALESCE(s.total_orders, 0) AS total_orders, COALESCE(s.avg_order_value, 0e0) AS avg_order_value, "
             "COALESCE(s.total_spent, 0e0) AS total_spent, COALESCE(s.avg_rating_given, 0e0) AS avg_rating_given, "
             "COALESCE(s.return_rate, 0e0) AS return_rate, COALESCE(s.avg_discount, 0e0) AS avg_discount, "
             "l.days_since_last_order AS recency, "
             f"CAST(floor((epoch({REF_TS}) - epoch(l.signup_date)) / 86400e0) AS BIGINT) AS customer_age_days "
             "FROM labeled l LEFT JOIN stats s ON l.customer_id = s.customer_id)")


def _features(spark, d):
    return churn.labelled_features(_c(spark, d), _o(spark, d), REF).select(
        "customer_id", "lifetime_value", "churned", "total_orders", "avg_order_value", "total_spent",
        "avg_rating_given", "return_rate", "avg_discount", "recency", "customer_age_days")


register("customer_features", with_views("SELECT * FROM features", _FEATURES))(_features)

# ---------------------------------------------------------------- KPIs -------
_KPIS = (_LABELS + ", kpis AS (SELECT COUNT(*) AS total_orders, "
         f"COALESCE({XSUM('order_value')}, 0e0) AS total_revenue, {XAVG('order_value')} AS average_order_value, "
         f"{IAVG('is_returned')} AS return_rate, {IAVG('delivery_time_days')} AS average_delivery_time, "
         "(SELECT COUNT(*) FROM labeled) AS total_customers, "
         f"(SELECT {IAVG('churned')} FROM labeled) AS customer_churn_rate FROM orders_c)")


def _kpis(spark, d):
    labeled = churn.churn_labels(_c(spark, d), _o(spark, d), REF)
    return rollup.business_kpis(_r(spark, d), labeled)


register("business_kpis", with_views("SELECT * FROM kpis", _KPIS))(_kpis)

register("kpi_tiles", with_views(
    "SELECT '₹' || format('{:,.0f}', total_revenue) AS revenue_tile, "
    "format('{:,.0f}', CAST(total_orders AS DOUBLE)) AS orders_tile, "
    "format('{:,.0f}', CAST(total_customers AS DOUBLE)) AS customers_tile, "
    "format('{:,.1f}', customer_churn_rate * 100) || '%' AS churn_tile, "
    "'₹' || format('{:,.2f}', average_order_value) AS aov_tile, "
    "format('{:,.2f}', return_rate * 100) || '%' AS return_tile, "
    "format('{:,.1f}', average_delivery_time) || ' days' AS delivery_tile FROM kpis", _KPIS))(
    lambda spark, d: reports.kpi_tiles(_kpis(spark, d)))

# ------------------------------------------------------- cleaning/derived ----
register("date_parts", "SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CAST(hour(ts) AS INTEGER) AS hour_of_day, "
         "CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month FROM events")(
    lambda spark, d: clean.date_parts(
        td.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), "ts"))

register("profit_margin", with_views(
    "SELECT o.order_id, o.line_no, o.product_id, o.price_after_discount, "
    f"{NPROUND('(o.price_after_discount - p.manufacturing_cost) / NULLIF(o.price_after_discount, 0) * 100e0', 2)}"
    " AS profit_margin FROM orders_c o LEFT JOIN products_c p ON o.product_id = p.product_id"))(
    lambda spark, d: clean.profit_margin(
        _o(spark, d).select("order_id", "line_no", "product_id", "price_after_discount"), _p(spark, d)))

register("profit_margin_est", with_views(
    "SELECT order_id, line_no, product_id, price_after_discount, base_price, "
    f"{NPROUND('(price_after_discount - base_price * 0.6e0) / NULLIF(price_after_discount, 0) * 100e0', 2)}"
    " AS profit_margin FROM orders_c"))(
    lambda spark, d: clean.profit_margin(
        _o(spark, d).select("order_id", "line_no", "product_id", "price_after_discount", "base_price")))


@register("order_measures", with_views(
    "SELECT o.order_id, o.line_no, o.product_id, o.quantity, o.discount_pct, p.base_price, "
    "p.base_price * (1e0 - o.discount_pct / 100e0) AS price_after_discount, "
    "p.base_price * (1e0 - o.discount_pct / 100e0) * o.quantity AS order_value "
    "FROM orders_c o LEFT JOIN products_c p ON o.product_id = p.product_id"))
def _order_measures(spark, d):
    bare = _o(spark, d).select("order_id", "line_no", "product_id", "quantity", "discount_pct")
    enriched = clean.enrich_orders(bare, _p(spark, d), ("base_price",))
    return clean.order_measures(enriched).select(
        "order_id", "line_no", "product_id", "quantity", "discount_pct", "base_price",
        "price_after_discount", "order_value")


@register("enrich_orders", with_views(
    "SELECT o.order_id, o.line_no, o.product_id, p.base_price, p.category, p.rating "
    "FROM orders_c o LEFT JOIN products_c p ON o.product_id = p.product_id"))
def _enrich_orders(spark, d):
    bare = _o(spark, d).select("order_id", "line_no", "product_id")
    return clean.enrich_orders(bare, _p(spark, d))


@register("add_defaults", with_views(
    "SELECT product_id, category, base_price, 100 AS stock_quantity, 4.0e0 AS rating, "
    "base_price * 0.5e0 AS manufacturing_cost FROM products_c"))
def _add_defaults(spark, d):
    bare = _p(spark, d).select("product_id", "category", "base_price")
    return clean.add_defaults(bare, "products").select(
        "product_id", "category", "base_price", F.col("stock_quantity"), "rating", "manufacturing_cost")


# sums of fractions below 0.0001, means with NaN, a quantile over all order lines: plain SQL on the other side
@register("plain_aggregates", with_views(
    f"SELECT category, {NPROUND('sum(order_value * 1e-9)', 12)} AS tiny_sum, "
    f"{NPROUND('avg(CASE WHEN order_id % 3 <> 0 THEN order_value END)', 6)} AS mean_without_nan FROM orders_c GROUP BY category"))
def _plain_aggregates(spark, d):
    value = F.when(F.col("order_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("order_value"))
    out = _o(spark, d).groupBy("category").agg(exact_sum(F.col("order_value") * 1e-9).alias("tiny_sum"),
                                               exact_avg(value).alias("mean_without_nan"))
    return out.select("category", np_round(F.col("tiny_sum"), 12).alias("tiny_sum"),
                      np_round(F.col("mean_without_nan"), 6).alias("mean_without_nan"))


@register("line_quantiles", with_views(
    "SELECT " + ", ".join(f"{NPROUND(f'quantile_cont(order_value, {q})', 6)} AS q{int(q * 1000)}"
                          for q in (0.0, 0.25, 0.5, 0.85, 0.9, 0.999, 1.0)) + " FROM orders_c"))
def _line_quantiles(spark, d):
    o = _o(spark, d)
    got = quantile_columns(o, {"order_value": [0.0, 0.25, 0.5, 0.85, 0.9, 0.999, 1.0]})
    return spark.range(1).select(*[np_round(v, 6).alias(f"q{int(q * 1000)}") for (_, q), v in got.items()])
