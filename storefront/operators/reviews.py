"""Product-review export -> orders / products / customers.

Each review row becomes one order of quantity 1.  Where the reference draws
seeded random dates, a hash of the row's key gives a per-key day offset: the
same for a key whatever the partitioning, and recomputable by any engine.
Dense order numbers (``AMZ_O<100000 + i>``) use a distributed row index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.functions.dates import hash_days_before
from storefront.functions.numeric import clean_money
from storefront.operators.clean import enrich_orders
from storefront.operators.rows import dense_row_index, first_row

# Fixed values of the review conversion.
REVIEW_MARKERS = ["user_id", "review_id", "product_name", "actual_price", "discounted_price"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "actual_price", "discounted_price", "rating",
                   "rating_count"]
ORDER_KEEP = ["order_id", "customer_id", "product_id", "order_date", "quantity", "discount_pct",
              "price_after_discount", "base_price", "delivery_time_days", "delivery_delay", "payment_method",
              "failed_payment_attempts", "is_returned", "customer_rating"]
ORDER_NUMBER_BASE = 100000
ORDER_PREFIX = "AMZ_O"
CUSTOMER_PREFIX = "C_AMZ_"
PRODUCT_PREFIX = "P_AMZ_"
SIGNUP_DAYS = (30, 900)          # signup = ref - [30, 900) days
ORDER_DAYS = (0, 730)            # order date = ref - [0, 730) days


def is_review_export(columns) -> bool:
    """A1: no order_date or order_id, but review/user/product columns present."""
    cols = set(columns)
    return ("order_date" not in cols or "order_id" not in cols) and any(c in cols for c in REVIEW_MARKERS)


def reviews_products(df: DataFrame, order_col: str) -> DataFrame:
    """A2: product rows of the export, first row per product_id."""
    cols = [c for c in PRODUCT_COLUMNS if c in df.columns]
    src = df
    if "product_id" not in df.columns:
        src = _with_product_id(dense_row_index(df, [order_col]))
        cols = ["product_id", *cols]
    return first_row(src, "product_id", order_col, [c for c in cols if c != "product_id"])


def reviews_customers(df: DataFrame, order_col: str, ref_date: str) -> DataFrame:
    """A3/A4: one customer per user_id (first row), hashed signup date, LTV 0."""
    if "user_id" in df.columns:
        extra = ["user_name"] if "user_name" in df.columns else []
        cust = (first_row(df.withColumnRenamed("user_id", "customer_id"), "customer_id", order_col, extra)
                if extra else df.select(F.col("user_id").alias("customer_id")).distinct())
    else:
        idx = dense_row_index(df.select(order_col), [order_col])
        cust = idx.select(F.concat(F.lit(CUSTOMER_PREFIX), F.col("row_index").cast("string")).alias("customer_id"))
    return (cust.withColumn("signup_date", hash_days_before(ref_date, F.col("customer_id"), *SIGNUP_DAYS))
                .withColumn("lifetime_value", F.lit(0.0)))


def _with_product_id(indexed: DataFrame) -> DataFrame:
    """A2: without product ids every row is a product of its own, named by its row number."""
    return indexed.withColumn("product_id", F.concat(F.lit(PRODUCT_PREFIX), F.col("row_index").cast("string")))


def reviews_to_orders(df: DataFrame, order_col: str, ref_date: str) -> DataFrame:
    """A5-A10: one order per review row in the standard order schema."""
    indexed = dense_row_index(df, [order_col])
    i = F.col("row_index")
    out = indexed.withColumn("order_id", F.concat(F.lit(ORDER_PREFIX), (i + ORDER_NUMBER_BASE).cast("string")))
    out = (out.withColumnRenamed("user_id", "customer_id") if "user_id" in df.columns
           else out.withColumn("customer_id", F.concat(F.lit(CUSTOMER_PREFIX), i.cast("string"))))
    if "product_id" not in df.columns:
        out = _with_product_id(out)
    if "discounted_price" in df.columns:
        pad = clean_money("discounted_price")
    elif "actual_price" in df.columns:
        pad = clean_money("actual_price")
    else:
        pad = F.lit(0.0)
    out = out.withColumn("price_after_discount", pad)
    base = (clean_money("actual_price") if "actual_price" in df.columns
            else F.coalesce(F.col("price_after_discount"), F.lit(0.0)))
    out = out.withColumn("base_price", base)
    b, p = F.col("base_price"), F.col("price_after_discount")
    out = out.withColumn("discount_pct", F.coalesce(
        F.when(b.isNotNull() & (b != 0) & p.isNotNull(), (b - p) / b * F.lit(100.0)), F.lit(0.0)))
    out = out.withColumns({
        "quantity": F.lit(1),
        "order_date": hash_days_before(ref_date, F.col("order_id"), *ORDER_DAYS),
        "delivery_time_days": F.lit(3),
        "delivery_delay": F.lit(0),
        "payment_method": F.lit("card"),
        "failed_payment_attempts": F.lit(0),
        "is_returned": F.lit(0),
        "customer_rating": (F.coalesce(F.col("rating").try_cast("double"), F.lit(4.0))
                            if "rating" in df.columns else F.lit(4)),
    })
    return out.select(*[c for c in ORDER_KEEP if c in out.columns])


def enrich_review_orders(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Bring rating (default 4.0), category and base_price onto the orders that lack them.

    Products are reduced to one row per id first, so an order stays one row.
    """
    wanted = tuple(c for c in ("rating", "category", "base_price") if c not in orders.columns and c in products.columns)
    out = enrich_orders(orders, products, wanted)
    if "rating" not in orders.columns:
        rating = F.col("rating").try_cast("double") if "rating" in wanted else F.lit(None).cast("double")
        out = out.withColumn("rating", F.coalesce(rating, F.lit(4.0)))
    return out
