"""Business insights.

Each insight is a small DataFrame (usually one row) computed by one aggregate
over the orders/customers/products tables; filters on order_date reach the
parquet scan.  ``insights`` unions the rows into one long table
(section, ordinal, metric, value, hint, severity) that the report and dashboard
views slice.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.functions.numeric import exact_avg, exact_sum, nan_to_null
from storefront.functions.text import money_text, pct_text
from storefront.operators.stats import quantile_scalar
from storefront.session import ensure_checkpoint_dir

# Windows, thresholds and list sizes of the reference's insights.
RECENT_DAYS = 90
SHORT_DAYS = 30
HIGH_RISK_PROBABILITY = 0.7
HIGH_RISK_TOP = 10
RETENTION_SAVE_SHARE = 0.3
HIGH_VALUE_QUANTILE = 0.9
TOP_PRODUCTS = 5
DELAY_ALERT_DAYS = 2
LOW_STOCK_BELOW = 20
LOW_STOCK_LIST = 5
CHURN_ALERT_ABOVE = 0.3

SECTIONS = ["revenue_insights", "customer_insights", "product_insights",
            "operational_insights", "growth_opportunities", "risk_alerts"]


def cutoff(ref_date: str, days: int) -> str:
    d = _dt.datetime.fromisoformat(ref_date) - _dt.timedelta(days=days)
    return d.strftime("%Y-%m-%d %H:%M:%S")


def since(df: DataFrame, ref_date: str, days: int, col: str = "order_date") -> DataFrame:
    """Rows with col >= ref - days (no upper bound, as in the reference).

    The literal is cast to the column's own type so the comparison stays a plain
    column-vs-literal predicate that parquet can push down.
    """
    return df.where(F.col(col) >= F.lit(cutoff(ref_date, days)).cast(df.schema[col].dataType))


# ---------------------------------------------------------------- revenue ----
def revenue_90_30(orders: DataFrame, ref_date: str) -> DataFrame:
    """Revenue and line counts over the last 90 and 30 days, one pass."""
    c30 = F.col("order_date") >= F.lit(cutoff(ref_date, SHORT_DAYS)).cast(orders.schema["order_date"].dataType)
    recent = since(orders, ref_date, RECENT_DAYS)
    return recent.agg(
        F.count(F.lit(1)).alias("orders_90"),
        F.coalesce(exact_sum("order_value"), F.lit(0.0)).alias("revenue_90"),
        F.count_if(c30).alias("orders_30"),
        F.coalesce(exact_sum(F.when(c30, F.col("order_value"))), F.lit(0.0)).alias("revenue_30"),
    )


def category_revenue(orders: DataFrame) -> DataFrame:
    return (orders.where(F.col("category").isNotNull())
            .groupBy("category").agg(exact_sum("order_value").alias("revenue")))


def top_category(orders: DataFrame, ref_date: str) -> DataFrame:
    """Best category by recent revenue and its share of recent revenue (%)."""
    recent = since(orders, ref_date, RECENT_DAYS)
    total = recent.select(exact_sum("order_value")).scalar()
    return (category_revenue(recent)
            .orderBy(F.col("revenue").desc(), F.col("category").asc()).limit(1)
            .select("category", "revenue", (F.try_divide(F.col("revenue"), total) * F.lit(100.0)).alias("share_pct")))


def discount_impact(orders: DataFrame, ref_date: str) -> DataFrame:
    """I4: recent revenue by discount level: mean, total, count."""
    recent = since(orders, ref_date, RECENT_DAYS)
    return (recent.where(F.col("discount_pct").isNotNull())
            .groupBy("discount_pct")
            .agg(exact_avg("order_value").alias("avg_order_value"),
                 exact_sum("order_value").alias("total_revenue"),
                 F.count(nan_to_null("order_value")).alias("order_count")))


def optimal_discount(orders: DataFrame, ref_date: str) -> DataFrame:
    """Discount level with the highest recent revenue; ties -> lowest discount."""
    return (discount_impact(orders, ref_date)
            .orderBy(F.col("total_revenue").desc(), F.col("discount_pct").asc()).limit(1)
            .select("discount_pct", "total_revenue"))


# --------------------------------------------------------------- customers ---
def high_risk(scored: DataFrame, top: int = HIGH_RISK_TOP) -> DataFrame:
    """Customers with churn_probability > 0.7 and orders, top 10 by total_spent."""
    return (scored.where((F.col("churn_probability") > HIGH_RISK_PROBABILITY) & (F.col("total_orders") > 0))
            .orderBy(F.col("total_spent").desc(), F.col("customer_id").asc())
            .limit(top))


def high_risk_summary(scored: DataFrame) -> DataFrame:
    """Count and value of the high-risk list and the 30 % save estimate."""
    hr = high_risk(scored)
    return hr.agg(F.count(F.lit(1)).alias("at_risk_customers"),
                  F.coalesce(exact_sum("total_spent"), F.lit(0.0)).alias("at_risk_value")) \
             .withColumn("estimated_save", F.col("at_risk_value") * F.lit(RETENTION_SAVE_SHARE))


def high_value_customers(customers: DataFrame, q: float = HIGH_VALUE_QUANTILE) -> DataFrame:
    """Customers whose lifetime_value is above its 0.9 quantile."""
    thr = quantile_scalar(customers, "lifetime_value", q)
    return customers.agg(F.count_if(F.col("lifetime_value") > thr).alias("high_value_customers"),
                         F.first(thr).alias("threshold"))


# ---------------------------------------------------------------- products ---
def product_sales(orders: DataFrame, products: DataFrame, ref_date: str) -> DataFrame:
    """I8: recent units, revenue and mean rating per product, inner join products."""
    recent = since(orders, ref_date, RECENT_DAYS)
    per = (recent.where(F.col("product_id").isNotNull())
           .groupBy("product_id")
           .agg(F.sum("quantity").alias("units_sold"),
                exact_sum("order_value").alias("revenue"),
                exact_avg("rating").alias("avg_rating")))
    return per.join(products.select("product_id", "base_price", "category"), "product_id")


def _id_list(df: DataFrame, order: list[Column], n: int, name: str) -> DataFrame:
    """Top-n rows by ``order`` as one comma list (bounded: n ids)."""
    top = df.orderBy(*order).limit(n)
    w = Window.orderBy(*order)
    return (top.withColumn("_r", F.row_number().over(w))
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "product_id"))),
                                          lambda s: s["product_id"].cast("string")), ", ").alias(name),
                 F.count(F.lit(1)).alias("n")))


def top_products(orders: DataFrame, products: DataFrame, ref_date: str, n: int = TOP_PRODUCTS) -> DataFrame:
    """The n best products by recent revenue (ties -> smaller id)."""
    ps = product_sales(orders, products, ref_date)
    return _id_list(ps, [F.col("revenue").desc(), F.col("product_id").asc()], n, "top_products")


def worst_products(orders: DataFrame, products: DataFrame, ref_date: str, n: int = TOP_PRODUCTS) -> DataFrame:
    """The last n products with revenue > 0, listed in descending revenue order."""
    ps = product_sales(orders, products, ref_date).where(F.col("revenue") > 0)
    bottom = ps.orderBy(F.col("revenue").asc(), F.col("product_id").desc()).limit(n)
    return _id_list(bottom, [F.col("revenue").desc(), F.col("product_id").asc()], n, "worst_products")


# ------------------------------------------------------------- operations ----
def delivery_insight(orders: DataFrame) -> DataFrame:
    """Mean delivery days; over delayed lines (delay > 2): mean delay and return rate."""
    late = F.col("delivery_delay") > DELAY_ALERT_DAYS
    return orders.agg(
        F.try_divide(F.sum("delivery_time_days").cast("double"), F.count("delivery_time_days")).alias("avg_delivery_days"),
        F.count_if(late).alias("delayed_orders"),
        exact_avg(F.when(late, F.col("delivery_delay"))).alias("avg_delay_days"),
        exact_avg(F.when(late, F.col("is_returned"))).alias("delayed_return_rate"),
    )


def delay_impact(orders: DataFrame) -> DataFrame:
    """Return rate and mean customer rating per delivery_delay."""
    return (orders.where(F.col("delivery_delay").isNotNull())
            .groupBy("delivery_delay")
            .agg(F.try_divide(F.sum("is_returned").cast("double"), F.count("is_returned")).alias("return_rate"),
                 F.try_divide(F.sum("customer_rating").cast("double"), F.count("customer_rating")).alias("avg_rating"),
                 F.count(F.lit(1)).alias("orders")))


def payment_failures(orders: DataFrame) -> DataFrame:
    """Lines with failed payment attempts, their share (%) and value at stake."""
    failed = F.col("failed_payment_attempts") > 0
    return orders.agg(
        F.count_if(failed).alias("failed_orders"),
        (F.try_divide(F.count_if(failed).cast("double"), F.count(F.lit(1))) * F.lit(100.0)).alias("failed_pct"),
        F.coalesce(exact_sum(F.when(failed, F.col("order_value"))), F.lit(0.0)).alias("value_at_stake"),
    )


def return_rate(orders: DataFrame) -> DataFrame:
    """Overall return rate."""
    return orders.agg(F.try_divide(F.sum("is_returned").cast("double"), F.count("is_returned")).alias("return_rate"),
                      F.count(F.lit(1)).alias("orders"))


def return_by_category(orders: DataFrame) -> DataFrame:
    """Return rate per category (worst first)."""
    return (orders.where(F.col("category").isNotNull())
            .groupBy("category")
            .agg(F.try_divide(F.sum("is_returned").cast("double"), F.count("is_returned")).alias("return_rate"),
                 F.count(F.lit(1)).alias("orders")))


# ----------------------------------------------------------------- growth ----
def acquisition(customers: DataFrame) -> DataFrame:
    """I16: mean lifetime value and the modal city (ties -> smallest name)."""
    mean_ltv = customers.agg(exact_avg("lifetime_value").alias("avg_ltv"))
    modal = (customers.where(F.col("city").isNotNull()).groupBy("city").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), F.col("city").asc()).limit(1)
             .select(F.col("city").alias("top_city"), F.col("n").alias("top_city_customers")))
    top = modal.select(F.struct("top_city", "top_city_customers")).scalar()
    return mean_ltv.select("avg_ltv", top.getField("top_city").alias("top_city"),
                           top.getField("top_city_customers").alias("top_city_customers"))


# ------------------------------------------------------------------ risks ----
def low_stock(products: DataFrame, below: int = LOW_STOCK_BELOW, n: int = LOW_STOCK_LIST) -> DataFrame:
    """Products with stock < 20: count and the first five ids."""
    low = products.where(F.col("stock_quantity") < below)
    first = low.orderBy("product_id").limit(n)
    ids = first.agg(F.array_join(F.transform(F.sort_array(F.collect_list("product_id")),
                                             lambda x: x.cast("string")), ", ").alias("ids"))
    return low.agg(F.count(F.lit(1)).alias("low_stock_products")).select(
        "low_stock_products", ids.select("ids").scalar().alias("reorder_first"))


def churn_alert(scored: DataFrame) -> DataFrame:
    """One High alert row when mean churn probability > 0.3, else no row."""
    return (scored.agg(F.avg("churn_probability").alias("avg_churn_probability"))
            .where(F.col("avg_churn_probability") > CHURN_ALERT_ABOVE)
            .withColumn("severity", F.lit("High")))


# --------------------------------------------------------------- document ----
def _row(spark, section: str, ordinal: int, metric: str, value: Column, hint: Column,
         severity: str | None, src: DataFrame) -> DataFrame:
    return src.select(F.lit(section).alias("section"), F.lit(ordinal).alias("ordinal"),
                      F.lit(metric).alias("metric"), value.cast("string").alias("value"),
                      hint.cast("string").alias("hint"), F.lit(severity).cast("string").alias("severity"))


#: The sets of rows that the insight document reads; each set's rows expand the lines once.
FACT_LEVELS = [["category"], ["discount_pct"], ["product_id"], []]


def insight_facts(orders: DataFrame, ref_date: str, levels: list[list[str]] = FACT_LEVELS) -> DataFrame:
    """The order-level numbers of the insight document in one aggregate pass.

    ``GROUPING SETS ((category), (discount_pct), (product_id), ())`` over the
    orders: one scan and one shuffle (partial aggregation per set before it)
    instead of one scan of the fact table per insight.  ``level`` names the set
    of each row; recent-window figures are conditional aggregates.
    """
    dt = orders.schema["order_date"].dataType
    recent = F.col("order_date") >= F.lit(cutoff(ref_date, RECENT_DAYS)).cast(dt)
    short = F.col("order_date") >= F.lit(cutoff(ref_date, SHORT_DAYS)).cast(dt)
    late = F.col("delivery_delay") > DELAY_ALERT_DAYS
    failed = F.col("failed_payment_attempts") > 0
    g = orders.groupingSets(levels, "category", "discount_pct", "product_id")
    facts = g.agg(
        F.grouping_id().alias("_gid"),
        F.count_if(recent).alias("orders_90"),
        F.coalesce(exact_sum(F.when(recent, F.col("order_value"))), F.lit(0.0)).alias("revenue_90"),
        F.count_if(short).alias("orders_30"),
        F.coalesce(exact_sum(F.when(short, F.col("order_value"))), F.lit(0.0)).alias("revenue_30"),
        F.coalesce(F.sum(F.when(recent, F.col("quantity"))), F.lit(0.0)).alias("units_90"),
        F.coalesce(exact_sum(F.when(recent, F.col("rating"))), F.lit(0.0)).alias("_rating_sum_90"),
        F.count(F.when(recent, F.col("rating"))).alias("_rating_n_90"),
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum("is_returned"), F.lit(0)).cast("bigint").alias("_ret_sum"),
        F.count("is_returned").alias("_ret_n"),
        F.coalesce(F.sum("delivery_time_days"), F.lit(0)).cast("bigint").alias("_del_sum"),
        F.count("delivery_time_days").alias("_del_n"),
        F.count_if(late).alias("delayed_orders"),
        F.coalesce(F.sum(F.when(late, F.col("delivery_delay"))), F.lit(0)).cast("bigint").alias("_late_delay_sum"),
        F.count(F.when(late, F.col("delivery_delay"))).alias("_late_delay_n"),
        F.coalesce(F.sum(F.when(late, F.col("is_returned"))), F.lit(0)).cast("bigint").alias("_late_ret_sum"),
        F.count(F.when(late, F.col("is_returned"))).alias("_late_ret_n"),
        F.count_if(failed).alias("failed_orders"),
        F.coalesce(exact_sum(F.when(failed, F.col("order_value"))), F.lit(0.0)).alias("value_at_stake"),
    )
    # grouping_id bits follow the column order (category, discount_pct, product_id)
    level = (F.when(F.col("_gid") == 3, "category").when(F.col("_gid") == 5, "discount_pct")
             .when(F.col("_gid") == 6, "product_id").otherwise("all"))
    return facts.withColumn("level", level).drop("_gid")


def insights(orders: DataFrame, products: DataFrame, scored: DataFrame, customers: DataFrame,
             ref_date: str, top_sales_features: DataFrame | None = None, facts: DataFrame | None = None) -> DataFrame:
    """The insight document as rows (section, ordinal, metric, value, hint, severity).

    Insights whose data is empty are absent, as in the reference (e.g. no recent
    orders -> no revenue or product insights; no failures -> no payment row).
    All order-level numbers come from ``facts``: one grouping-sets pass (``insight_facts``)
    by default, or the rollup's (``rollup.insight_facts``).  The small table is
    checkpointed for the dozen reads below.
    """
    spark = orders.sparkSession
    ensure_checkpoint_dir(spark)
    facts = (insight_facts(orders, ref_date) if facts is None else facts).checkpoint()
    # the scored customers feed two insights; keep the four columns they read
    scored = scored.select("customer_id", "churn_probability", "total_orders", "total_spent").checkpoint()
    glob = facts.where(F.col("level") == "all")
    cats = facts.where((F.col("level") == "category") & F.col("category").isNotNull())
    discs = facts.where((F.col("level") == "discount_pct") & F.col("discount_pct").isNotNull()
                        & (F.col("orders_90") > 0))
    prods = (facts.where((F.col("level") == "product_id") & F.col("product_id").isNotNull()
                         & (F.col("orders_90") > 0))
             .select("product_id", F.col("revenue_90").alias("revenue"))
             .join(products.select("product_id"), "product_id"))
    parts: list[DataFrame] = []
    rev = glob.where(F.col("orders_90") > 0)
    parts.append(_row(spark, "revenue_insights", 1, "Total Revenue (90 days)",
                      money_text(F.col("revenue_90")),
                      F.lit("Focus on maintaining this revenue momentum."), None, rev))
    total90 = glob.select("revenue_90").scalar()
    tc = (cats.where(F.col("orders_90") > 0)
          .orderBy(F.col("revenue_90").desc(), F.col("category").asc()).limit(1)
          .select("category", F.col("revenue_90").alias("revenue"),
                  (F.try_divide(F.col("revenue_90"), total90) * F.lit(100.0)).alias("share_pct")))
    parts.append(_row(spark, "revenue_insights", 2, "Top Revenue Category",
                      F.concat(F.col("category"), F.lit(": "), money_text(F.col("revenue")), F.lit(" ("),
                               F.format_number(F.col("share_pct"), 1), F.lit("%)")),
                      F.concat(F.lit("Increase inventory and marketing for '"), F.col("category"), F.lit("'.")),
                      None, tc))
    od = (discs.orderBy(F.col("revenue_90").desc(), F.col("discount_pct").asc()).limit(1)
          .select("discount_pct"))
    parts.append(_row(spark, "revenue_insights", 3, "Optimal Discount Strategy",
                      F.concat(F.col("discount_pct").cast("string"), F.lit("% discount drives highest revenue")),
                      F.concat(F.lit("Test "), F.col("discount_pct").cast("string"),
                               F.lit("% discount campaigns for underperforming products.")), None, od))
    hrs = high_risk_summary(scored).where(F.col("at_risk_customers") > 0)
    parts.append(_row(spark, "customer_insights", 1, "High-Value At-Risk Customers",
                      F.concat(F.col("at_risk_customers").cast("string"), F.lit(" customers (Total Value: "),
                               money_text(F.col("at_risk_value")), F.lit(")")),
                      F.concat(F.lit("Launch retention campaign. Estimated save: "),
                               money_text(F.col("estimated_save"))), None, hrs))
    hv = high_value_customers(customers)
    parts.append(_row(spark, "customer_insights", 2, "High-Value Customers",
                      F.concat(F.col("high_value_customers").cast("string"), F.lit(" customers (Top 10%)")),
                      F.lit("Create VIP program."), None, hv))
    tp = _id_list(prods, [F.col("revenue").desc(), F.col("product_id").asc()], TOP_PRODUCTS,
                  "top_products").where(F.col("n") > 0)
    parts.append(_row(spark, "product_insights", 1, "Top 5 Products (Revenue)", F.col("top_products"),
                      F.lit("Ensure adequate stock. Create product bundles."), None, tp))
    bottom = (prods.where(F.col("revenue") > 0)
              .orderBy(F.col("revenue").asc(), F.col("product_id").desc()).limit(TOP_PRODUCTS))
    wp = _id_list(bottom, [F.col("revenue").desc(), F.col("product_id").asc()], TOP_PRODUCTS,
                  "worst_products").where(F.col("n") > 0)
    parts.append(_row(spark, "product_insights", 2, "Underperforming Products", F.col("worst_products"),
                      F.lit("Review pricing strategy."), None, wp))
    di = glob.select(F.try_divide(F.col("_del_sum").cast("double"), F.col("_del_n")).alias("avg_delivery_days"),
                     F.try_divide(F.col("_late_delay_sum").cast("double"), F.col("_late_delay_n")).alias("avg_delay_days"),
                     F.try_divide(F.col("_late_ret_sum").cast("double"), F.col("_late_ret_n")).alias("delayed_return_rate"))
    parts.append(_row(spark, "operational_insights", 1, "Average Delivery Time",
                      F.concat(F.format_number(F.col("avg_delivery_days"), 1), F.lit(" days")),
                      F.concat(F.lit("Target <3 days. Delays of "), F.format_number(F.col("avg_delay_days"), 1),
                               F.lit(" days correlate with "), pct_text(F.col("delayed_return_rate")),
                               F.lit(" return rate.")), None, di))
    pf = glob.where(F.col("failed_orders") > 0).select(
        "failed_orders", (F.try_divide(F.col("failed_orders").cast("double"), F.col("orders")) * F.lit(100.0)).alias("failed_pct"),
        "value_at_stake")
    parts.append(_row(spark, "operational_insights", 2, "Payment Failures",
                      F.concat(F.col("failed_orders").cast("string"), F.lit(" orders ("),
                               F.format_number(F.col("failed_pct"), 1), F.lit("%)")),
                      F.concat(F.lit("Potential lost revenue: "), money_text(F.col("value_at_stake"))), None, pf))
    rr = glob.select(F.try_divide(F.col("_ret_sum").cast("double"), F.col("_ret_n")).alias("return_rate"))
    worst = (cats.select("category", F.try_divide(F.col("_ret_sum").cast("double"), F.col("_ret_n")).alias("return_rate"))
             .orderBy(F.col("return_rate").desc(), F.col("category").asc()).limit(1))
    parts.append(_row(spark, "operational_insights", 3, "Overall Return Rate",
                      pct_text(F.col("return_rate"), 2),
                      F.concat(F.lit("Target <5%. Highest returns in '"),
                               worst.select("category").scalar(), F.lit("'.")), None, rr))
    if top_sales_features is not None:
        feats = (top_sales_features.orderBy(F.col("importance").desc(), F.col("feature").asc()).limit(3)
                 .agg(F.array_join(F.transform(
                     F.sort_array(F.collect_list(F.struct((-F.col("importance")).alias("k"), "feature"))),
                     lambda s: s["feature"]), ", ").alias("f")))
        parts.append(_row(spark, "growth_opportunities", 1, "Dynamic Pricing",
                          F.concat(F.lit("Top features affecting sales: "), F.col("f")),
                          F.lit("Implement dynamic pricing."), None, feats))
    acq = acquisition(customers)
    parts.append(_row(spark, "growth_opportunities", 2, "Customer Acquisition",
                      F.concat(F.lit("Average Customer Lifetime Value: "), money_text(F.col("avg_ltv"))),
                      F.concat(F.lit("Focus on '"), F.col("top_city"), F.lit("' market for expansion.")),
                      None, acq))
    parts.append(_row(spark, "growth_opportunities", 3, "Cross-Selling & Upselling",
                      F.lit("Average order value can be increased through recommendations"),
                      F.lit("Implement 'Customers who bought X also bought Y' recommendations."), None,
                      acq))
    ls = low_stock(products).where(F.col("low_stock_products") > 0)
    parts.append(_row(spark, "risk_alerts", 1, "Low Stock Alert",
                      F.concat(F.col("low_stock_products").cast("string"), F.lit(" products running low on stock")),
                      F.concat(F.lit("Reorder immediately: "), F.col("reorder_first")), "Medium", ls))
    ca = churn_alert(scored)
    parts.append(_row(spark, "risk_alerts", 2, "High Churn Risk",
                      F.concat(F.lit("Average churn probability: "), pct_text(F.col("avg_churn_probability"))),
                      F.lit("Launch customer retention program."), "High", ca))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # re-number within each section so absent insights leave no gaps
    w = Window.partitionBy("section").orderBy("ordinal")
    return out.withColumn("ordinal", F.row_number().over(w))
