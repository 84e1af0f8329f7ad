"""Binding of the provided TPC-H-style parquet tables to the retail model.

Every view below is a lazy projection/join over the parquet scans, so Catalyst
prunes unused columns and pushes filters into the scans of whatever query uses
it.  No rows are dropped, capped or sampled.

orders     : one row per order line (lineitem x orders x part)
products   : part
customers  : customer x nation, signup = first order date
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.functions.dates import to_ts
from storefront.functions.text import money_text

# Fixed values of the binding.
REF_DATE = "2001-08-02"          # orders end 2001-08-01
URGENT_PRIORITY = "1-URGENT"


# Line identity used as "file order" of the exports: every lineitem column, so that
# rows tying on all of them are identical rows.
LINE_ORDER = [("o", "l_orderkey"), ("l", "l_linenumber"), ("p", "l_partkey"), ("s", "l_suppkey"),
              ("q", "l_quantity"), ("e", "l_extendedprice"), ("d", "l_discount"), ("t", "l_tax"),
              ("rf", "l_returnflag"), ("ls", "l_linestatus"), ("sd", "l_shipdate")]


def line_order():
    return F.struct(*[F.col(c).alias(a) for a, c in LINE_ORDER])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard orders table (one row per order line)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    delivery = (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .select(
                  F.col("l_orderkey").alias("order_id"),
                  F.col("l_linenumber").alias("line_no"),
                  F.col("l_suppkey").alias("supplier_id"),
                  F.col("o_custkey").alias("customer_id"),
                  F.col("l_partkey").alias("product_id"),
                  to_ts("o_orderdate").alias("order_date"),
                  F.col("l_quantity").alias("quantity"),
                  (F.col("l_discount") * F.lit(100.0)).alias("discount_pct"),
                  (F.col("l_extendedprice") / F.col("l_quantity")).alias("base_price"),
                  ((F.col("l_extendedprice") / F.col("l_quantity"))
                   * (F.lit(1.0) - F.col("l_discount"))).alias("price_after_discount"),
                  (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("order_value"),
                  delivery.alias("delivery_time_days"),
                  F.greatest(delivery - 2, F.lit(0)).alias("delivery_delay"),
                  F.lit("card").alias("payment_method"),
                  F.when((F.col("o_orderpriority") == URGENT_PRIORITY) & (F.col("o_orderstatus") == "F"), 1)
                   .otherwise(0).alias("failed_payment_attempts"),
                  F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_returned"),
                  (F.lit(1) + (F.col("l_partkey") + F.col("l_suppkey")) % 5).alias("customer_rating"),
                  F.col("p_type").alias("category"),
                  (F.lit(2.5) + F.col("p_size") / F.lit(20.0)).alias("rating"),
              ))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("base_price"),
        (F.lit(2.5) + F.col("p_size") / F.lit(20.0)).alias("rating"),
        F.col("p_size").alias("stock_quantity"),
        (F.col("p_retailprice") * F.lit(0.5)).alias("manufacturing_cost"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    first = (table(spark, sf_dir, "orders")
             .groupBy(F.col("o_custkey").alias("customer_id"))
             .agg(F.min(to_ts("o_orderdate")).alias("signup_date")))
    base = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("n_name").alias("city"),
        F.col("c_acctbal").alias("lifetime_value"),
        F.col("c_mktsegment").alias("age_group"),
    )
    return base.join(first, "customer_id", "left").select(
        "customer_id", "city", "signup_date", "lifetime_value", "age_group")


def wide_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same order lines as one wide sheet with vendor-style headers.

    Discount is a fraction (0..0.10) as in a superstore export; 'Row ID' is the
    line identity (order, line, part, supplier) that orders the sheet.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    delivery = (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    od = to_ts("o_orderdate")
    places = n.join(r, n.n_regionkey == r.r_regionkey)
    buyers = c.join(places, c.c_nationkey == n.n_nationkey)
    bought = o.join(buyers, o.o_custkey == c.c_custkey)     # lines are dealt twice: by order and by part
    return (li.join(bought, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .select(
                  line_order().alias("Row ID"),
                  F.col("l_orderkey").cast("string").alias("Order ID"),
                  od.alias("Order Date"),
                  (od + F.make_interval(days=delivery.cast("int"))).alias("Ship Date"),
                  F.col("o_orderpriority").alias("Ship Mode"),
                  F.col("c_custkey").cast("string").alias("Customer ID"),
                  F.col("c_mktsegment").alias("Segment"),
                  F.col("n_name").alias("City"),
                  F.col("n_name").alias("State"),
                  F.col("r_name").alias("Country"),
                  F.col("r_name").alias("Region"),
                  F.col("l_partkey").cast("string").alias("Product ID"),
                  F.col("p_type").alias("Category"),
                  F.col("p_name").alias("Product Name"),
                  (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("Sales"),
                  F.col("l_quantity").alias("Quantity"),
                  F.col("l_discount").alias("Discount"),
                  (F.col("l_extendedprice") * (F.lit(0.5) - F.col("l_discount"))).alias("Profit"),
              ))


def review_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-review style export: one review per order line, prices as currency text."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    c = table(spark, sf_dir, "customer")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    bought = o.join(c, o.o_custkey == c.c_custkey)     # lines are dealt twice: by order and by part
    return (li.join(bought, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .select(
                  F.col("l_partkey").cast("string").alias("product_id"),
                  F.col("p_name").alias("product_name"),
                  F.col("p_type").alias("category"),
                  money_text(unit * (F.lit(1.0) - F.col("l_discount")), 4).alias("discounted_price"),
                  money_text(unit).alias("actual_price"),
                  F.concat((F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
                   .alias("discount_percentage"),
                  (F.lit(2.5) + F.col("p_size") / F.lit(20.0)).cast("string").alias("rating"),
                  F.col("l_quantity").cast("bigint").alias("rating_count"),
                  F.col("c_custkey").cast("string").alias("user_id"),
                  F.col("c_name").alias("user_name"),
                  F.concat_ws("-", *[F.col(c).cast("string") for c in
                                     ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("review_id"),
                  line_order().alias("row_ord"),
              ))
