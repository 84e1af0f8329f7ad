"""Cleaning and derived order columns.

All functions take and return DataFrames in the standard schema and only add or
replace columns; none drops rows.  Scalars such as a median are computed as
scalar subqueries (``DataFrame.scalar()``), so the plan stays lazy and no
1-row side is cross-joined.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.functions.dates import days_between, floor_days, to_ts, weekday_mon0
from storefront.functions.numeric import clean_money, nan_to_null, safe_div
from storefront.operators.stats import quantile_scalar

# Defaults the reference fills in for absent columns.
ORDER_DEFAULTS = {
    "delivery_time_days": 3,
    "payment_method": "card",
    "failed_payment_attempts": 0,
    "is_returned": 0,
    "customer_rating": 4,
}
PRODUCT_DEFAULTS = {"stock_quantity": 100, "rating": 4.0}
CUSTOMER_DEFAULTS = {"city": "Unknown", "age_group": "Unknown"}
MANUFACTURING_COST_SHARE = 0.5     # cost estimate when unknown, products
ESTIMATED_COST_SHARE = 0.6         # cost estimate for margin when products lack cost
DELAY_GRACE_DAYS = 2               # delay = max(days - 2, 0)
DEFAULT_DELIVERY_DAYS = 3


def np_round(c, decimals: int = 2) -> Column:
    """numpy/pandas ``round``: half-to-even on the binary value (rint(x*10^d)/10^d)."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** decimals)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def parse_dates(df: DataFrame, cols: Iterable[str],
                formats: tuple[str, ...] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy",
                                            "dd-MM-yyyy")) -> DataFrame:
    """Parse text date columns with the first matching format; bad -> NULL."""
    out = df
    for c in cols:
        if c not in df.columns:
            continue
        s = F.trim(F.col(c).cast("string"))
        # a format is only tried on text of its shape: no parse attempt (and no
        # parser exception) for the formats that cannot match
        out = out.withColumn(c, F.coalesce(*[
            F.when(s.rlike(_format_shape(f)), F.try_to_timestamp(s, F.lit(f))) for f in formats]))
    return out


def _format_shape(fmt: str) -> str:
    """A permissive regex for text that a datetime pattern could parse."""
    import re
    shape = re.escape(fmt)
    for token, rx in (("yyyy", r"\d{4}"), ("MM", r"\d{1,2}"), ("dd", r"\d{1,2}"),
                      ("HH", r"\d{1,2}"), ("mm", r"\d{1,2}"), ("ss", r"\d{1,2}")):
        shape = shape.replace(token, rx)
    return "^" + shape + "$"


def clean_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Currency or text numbers -> DOUBLE (NaN/inf -> NULL)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: clean_money(F.col(c)) for c in present})


def fill_order_nulls(df: DataFrame) -> DataFrame:
    """Quantity -> 1, discount_pct -> 0 where NULL."""
    fills = {c: v for c, v in {"quantity": 1.0, "discount_pct": 0.0}.items() if c in df.columns}
    return df.na.fill(fills) if fills else df


def add_defaults(df: DataFrame, table: str) -> DataFrame:
    """Add the reference's default columns when they are absent."""
    cols = set(df.columns)
    if table == "orders":
        new = {}
        for c, v in ORDER_DEFAULTS.items():
            if c not in cols:
                new[c] = F.lit(v)
        out = df.withColumns(new) if new else df
        if "delivery_delay" not in cols:
            out = out.withColumn("delivery_delay",
                                 F.greatest(F.col("delivery_time_days") - DELAY_GRACE_DAYS, F.lit(0)))
        return out
    if table == "products":
        new = {c: F.lit(v) for c, v in PRODUCT_DEFAULTS.items() if c not in cols}
        out = df.withColumns(new) if new else df
        if "manufacturing_cost" not in cols:
            out = impute_price(out) if "base_price" in cols else out.withColumn("base_price", F.lit(0.0))
            out = out.withColumn("manufacturing_cost", F.col("base_price") * F.lit(MANUFACTURING_COST_SHARE))
        return out
    if table == "customers":
        new = {c: F.lit(v) for c, v in CUSTOMER_DEFAULTS.items() if c not in cols}
        return df.withColumns(new) if new else df
    raise ValueError(f"unknown table {table!r}")


def impute_price(products: DataFrame, col: str = "base_price") -> DataFrame:
    """Clean the price text, fill NULL with the exact column median, else 0."""
    cleaned = products.withColumn(col, clean_money(F.col(col)))
    med = quantile_scalar(cleaned, col, 0.5)
    return cleaned.withColumn(col, F.coalesce(F.col(col), med, F.lit(0.0)))


def enrich_orders(orders: DataFrame, products: DataFrame,
                  cols: tuple[str, ...] = ("base_price", "category", "rating")) -> DataFrame:
    """Left join product attributes that the orders table lacks.

    The product side is reduced to one row per product_id first (deterministic:
    the smallest attribute tuple), so the join never fans out.  Columns the
    orders already have win over the product's (no ``_x/_y`` suffixes).
    """
    wanted = [c for c in cols if c in products.columns]
    if not wanted:
        return orders
    right = (products.select("product_id", *wanted)
             .groupBy("product_id")
             .agg(F.min(F.struct(*wanted)).alias("_p"))
             .select("product_id", *[F.col(f"_p.{c}").alias(f"_p_{c}") for c in wanted]))
    joined = orders.join(right, "product_id", "left")
    out = {}
    for c in wanted:
        out[c] = F.coalesce(F.col(c), F.col(f"_p_{c}")) if c in orders.columns else F.col(f"_p_{c}")
    return joined.withColumns(out).drop(*[f"_p_{c}" for c in wanted])


def order_measures(orders: DataFrame) -> DataFrame:
    """price_after_discount and order_value when absent."""
    out = orders
    if "discount_pct" not in out.columns:
        out = out.withColumn("discount_pct", F.lit(0.0))
    if "price_after_discount" not in out.columns:
        out = out.withColumn("price_after_discount",
                             F.col("base_price") * (F.lit(1.0) - F.col("discount_pct") / F.lit(100.0)))
    if "order_value" not in out.columns:
        out = out.withColumn("order_value", F.col("price_after_discount") * F.col("quantity"))
    return out


def delivery_time(orders: DataFrame, ship_col: str = "ship_date", order_col: str = "order_date") -> DataFrame:
    """Delivery days = floor days(ship - order), NULL -> 3; delay = max(days-2, 0)."""
    if ship_col in orders.columns and order_col in orders.columns:
        days = F.coalesce(days_between(ship_col, order_col), F.lit(DEFAULT_DELIVERY_DAYS)).cast("int")
    elif "delivery_time_days" in orders.columns:
        days = F.col("delivery_time_days")
    else:
        days = F.lit(DEFAULT_DELIVERY_DAYS)
    return (orders.withColumn("delivery_time_days", days)
                  .withColumn("delivery_delay",
                              F.greatest(F.col("delivery_time_days") - DELAY_GRACE_DAYS, F.lit(0))))


def date_parts(df: DataFrame, ts_col: str = "order_date") -> DataFrame:
    """hour_of_day, day_of_week (Monday = 0), month."""
    ts = to_ts(ts_col)
    return df.withColumns({
        "hour_of_day": F.hour(ts),
        "day_of_week": weekday_mon0(ts),
        "month": F.month(ts),
    })


def profit_margin(orders: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Margin % = round((price - cost) / price * 100, 2).

    With a products table holding manufacturing_cost the cost is looked up by
    product_id (a key join; the reference aligns by row position); otherwise the
    cost is estimated as 0.6 x base_price.  A zero price gives NULL, not inf.
    """
    if products is not None and "manufacturing_cost" in products.columns:
        cost = (products.groupBy("product_id")
                .agg(F.min("manufacturing_cost").alias("_cost")))
        joined = orders.join(cost, "product_id", "left")
        cost_c = F.col("_cost")
    else:
        joined = orders
        cost_c = F.col("base_price") * F.lit(ESTIMATED_COST_SHARE)
    pad = F.col("price_after_discount")
    margin = np_round(safe_div(pad - cost_c, pad) * F.lit(100.0), 2)
    out = joined.withColumn("profit_margin", margin)
    return out.drop("_cost") if "_cost" in out.columns else out


def date_range(orders: DataFrame, ts_col: str = "order_date") -> DataFrame:
    """First and last order timestamp."""
    return orders.agg(F.min(ts_col).alias("first_order"), F.max(ts_col).alias("last_order"))


def high_value_flag(customers: DataFrame, q: float = 0.85) -> DataFrame:
    """C14: is_high_value = lifetime_value above its q-quantile (exact, interpolated)."""
    thr = quantile_scalar(customers, "lifetime_value", q)
    return customers.withColumn(
        "is_high_value", F.when(F.col("lifetime_value") > thr, F.lit(1)).otherwise(F.lit(0)))


def discount_from_prices(df: DataFrame, base: str = "base_price",
                         paid: str = "price_after_discount") -> DataFrame:
    """Discount % = (base - paid) / base * 100 when base != 0 and both known, else 0."""
    b, p = F.col(base), F.col(paid)
    pct = F.when(b.isNotNull() & (b != 0) & p.isNotNull(), (b - p) / b * F.lit(100.0))
    return df.withColumn("discount_pct", F.coalesce(pct, F.lit(0.0)))


def discount_rescale(df: DataFrame, col: str = "discount") -> DataFrame:
    """Fraction -> percent when the column's max is < 1 (strict), else as is."""
    if col not in df.columns:
        return df.withColumn("discount_pct", F.lit(0.0))
    mx = df.select(F.max(col)).scalar()
    return df.withColumn("discount_pct",
                         F.when(mx < 1, F.col(col) * F.lit(100.0)).otherwise(F.col(col).cast("double")))


def recency_days(ref_date: str, ts_col: str) -> Column:
    return floor_days(ref_date, ts_col)
