"""Wide export -> orders / products / customers.

Per-key attributes are the first non-null value in input order (one
``groupBy`` with ``min_by`` per table, not one group-by per attribute).  The
"column entirely null" checks and the discount unit detection need a few
column-level facts; they come from one profiling aggregate (one pass, one row
back to the driver) instead of one pass per check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.functions.dates import days_between
from storefront.functions.numeric import exact_avg, exact_sum, exact_value
from storefront.operators.mapping import (SPLIT_CUSTOMER_ALIASES, SPLIT_ORDER_ALIASES,
                                          SPLIT_PRODUCT_ALIASES, resolve_columns)
from storefront.operators.rows import dense_row_index, first_non_null
from storefront.session import stored

# Defaults of the splitter.
DEFAULT_DELIVERY_DAYS = 3
DEFAULT_BASE_PRICE = 1000.0
DEFAULT_RATING = 4.0
DEFAULT_STOCK = 100
DEFAULT_LTV = 5000.0
DEFAULT_SIGNUP = "2020-01-01"
ROW_ID_COLUMN = "Row.ID"
ROW_NUMBER = "_row_number"
#: A profile under which no key is made and no discount is told apart: for tables that show neither.
_AS_GIVEN: dict = {"count": None, "keyed": None, "max_discount": None}
SUBCATEGORY_COLUMN = "Sub. CategYear"
PAYMENT_COLUMN = "Payment Method"


def _q(c: str):
    return F.col(f"`{c}`")


def profile(df: DataFrame) -> dict:
    """Non-null counts of the mapped columns (overall, and where the product or customer
    key is known) and the largest discount: one aggregate pass that serves all three tables."""
    hits = resolve_columns(df.columns, SPLIT_ORDER_ALIASES, "contains")
    attributes = {"product": resolve_columns(df.columns, SPLIT_PRODUCT_ALIASES, "contains"),
                  "customer": resolve_columns(df.columns, SPLIT_CUSTOMER_ALIASES, "contains")}
    mapped = sorted({*hits.values(), *attributes["product"].values(), *attributes["customer"].values()})
    aggs = {f"n{i}": (("count", c), F.count(_q(c))) for i, c in enumerate(mapped)}
    for name, found in attributes.items():
        key = hits.get(f"{name}_id")
        for src in sorted(set(found.values())) if key is not None else []:
            aggs[f"k{len(aggs)}"] = (("keyed", (name, src)), F.count(F.when(_q(key).isNotNull(), _q(src))))
    if "discount" in hits:
        aggs["maxdisc"] = (("max_discount", None), F.max(_q(hits["discount"])))
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(k) for k, (_, c) in aggs.items()]).first()
    out: dict = {"count": {}, "keyed": {}, "max_discount": None}
    for k, ((kind, what), _) in aggs.items():
        if kind == "max_discount":
            out[kind] = row[k]
        else:
            out[kind][what] = row[k]
    return out


def _surrogates(df: DataFrame, prof: dict) -> list[str]:
    """The keys that are absent or entirely null."""
    if prof is _AS_GIVEN:
        return []
    hits = resolve_columns(df.columns, SPLIT_ORDER_ALIASES, "contains")
    return [k for k in ("order_id", "customer_id", "product_id") if k not in hits or prof["count"][hits[k]] == 0]


def number_rows(df: DataFrame, order_col: str | None, prof: dict) -> DataFrame:
    """Add the dense row number 1..n (``ROW_NUMBER``) if a key has to be made from it."""
    if ROW_NUMBER in df.columns or not _surrogates(df, prof):
        return df
    if order_col is None:
        raise ValueError("a key is missing: name the column that orders the rows, so that they can be numbered")
    return dense_row_index(df, [order_col], ROW_NUMBER).withColumn(ROW_NUMBER, F.col(ROW_NUMBER) + 1)


def split_wide(df: DataFrame, order_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, products and customers of one export, with the same keys in all three.

    The export is stored once, as what leads to it would be worked out again for the
    profile, the ranges and the numbers, and profiled once; made-up keys are numbered once
    and written to the checkpoint folder, so the three tables agree on them.
    """
    df = stored(df, "split-export")
    prof = profile(df)
    numbered = number_rows(df, order_col, prof)
    if numbered is not df:
        numbered = stored(numbered, "split-numbered")
    return (split_orders(numbered, order_col, prof=prof).drop("_ord"), split_products(numbered, order_col, prof),
            split_customers(numbered, order_col, prof))


def _ts(c):
    return F.coalesce(c.try_cast("timestamp"), F.try_to_timestamp(c.cast("string")))


def split_orders(df: DataFrame, order_col: str | None = None, carry: dict | None = None,
                 prof: dict | None = None) -> DataFrame:
    """The orders table of a wide export (mapped columns + derived ones).

    ``carry`` ({name: source column}) adds source columns to the same projection,
    so the product and customer tables are built from one pass over the export.
    """
    hits = resolve_columns(df.columns, SPLIT_ORDER_ALIASES, "contains")
    prof = profile(df) if prof is None else prof
    made = _surrogates(df, prof)
    df = number_rows(df, order_col, prof)
    cols = {std: _q(src) for std, src in hits.items()}
    if "order_value" not in cols and "sales" in cols:
        cols["order_value"] = cols["sales"]
    for key, prefix in (("order_id", "O"), ("customer_id", "C"), ("product_id", "P")):
        if key in made:
            number = ROW_ID_COLUMN if key == "order_id" and ROW_ID_COLUMN in df.columns else ROW_NUMBER
            cols[key] = F.concat(F.lit(prefix), _q(number).cast("string"))
    for dc in ("order_date", "ship_date"):
        if dc in cols:
            cols[dc] = _ts(cols[dc])
    if "quantity" not in cols:
        cols["quantity"] = F.lit(1)
    # W5 fraction -> percent when max < 1 (strict)
    if "discount" in cols:
        mx = prof["max_discount"]
        cols["discount_pct"] = (cols["discount"] * F.lit(100.0) if mx is not None and mx < 1
                                else cols["discount"].cast("double"))
    else:
        cols["discount_pct"] = F.lit(0.0)
    # W6/W7 delivery time and delay
    if "ship_date" in cols and "order_date" in cols:
        days = F.coalesce(days_between(cols["ship_date"], cols["order_date"]),
                          F.lit(DEFAULT_DELIVERY_DAYS)).cast("int")
    else:
        days = F.lit(DEFAULT_DELIVERY_DAYS)
    cols["delivery_time_days"] = days
    cols["delivery_delay"] = F.greatest(days - 2, F.lit(0))
    cols["payment_method"] = (_q(PAYMENT_COLUMN) if PAYMENT_COLUMN in df.columns else F.lit("card"))
    cols["failed_payment_attempts"] = F.lit(0)
    cols["is_returned"] = F.lit(0)
    cols["customer_rating"] = F.lit(4)
    sel = [v.alias(k) for k, v in cols.items()]
    if order_col is not None:
        sel.append(_q(order_col).alias("_ord"))
    for name, src in (carry or {}).items():
        sel.append(_q(src).alias(name))
    return df.select(*sel)


def _of_each(df: DataFrame, order_col: str, prof: dict | None, key: str, table: str, aliases: dict, totals: dict,
             more: dict | None = None) -> tuple[DataFrame, Callable[[str], bool]]:
    """One row per ``key``: the first non-null attribute values and ``totals`` (aggregates by name); and
    a function that tells whether an attribute is absent or entirely null.

    The export is read once: its rows are grouped once, the groups are stored, and what
    the profile tells is added up from them.  A group's first row has the first values of
    all attributes that are not null there; only where one is null and a later row has it
    are the rows read again.  A key that is made from row numbers is one row's own, so
    nothing is grouped.
    """
    hits = resolve_columns(df.columns, aliases, "contains")
    okeys = resolve_columns(df.columns, SPLIT_ORDER_ALIASES, "contains")
    carried = {**{f"_a_{std}": src for std, src in hits.items()}, **(more or {})}
    attributes = [f"_a_{std}" for std in hits] + list(more or {})

    def out(c):
        return c.removeprefix("_a_")

    if key in okeys and (prof is None or prof["count"][okeys[key]] > 0):
        joined = split_orders(df, order_col, carried, _AS_GIVEN)
        value = [F.count(c).alias(f"_n{i}") for i, c in enumerate(attributes)]
        ordered = [F.count(F.when(F.col("_ord").isNotNull(), F.col(c))).alias(f"_o{i}") for i, c in enumerate(attributes)]
        first = [F.min_by(F.struct(*attributes), "_ord").alias("_first")] if attributes else []
        joined = joined.where(F.col(key).isNotNull())
        per = stored(joined.groupBy(key).agg(*first, *value, *ordered, *[t(joined).alias(n) for n, t in totals.items()]),
                     f"split-{table}")
        got = per.agg(F.count(key).alias("keys"), *[F.sum(f"_n{i}").alias(f"k{i}") for i in range(len(attributes))],
                      *[F.count_if(F.col(f"_first.{c}").isNull() & (F.col(f"_o{i}") > 0)).alias(f"l{i}")
                        for i, c in enumerate(attributes)]).first()
        if got["keys"]:
            later = [c for i, c in enumerate(attributes) if got[f"l{i}"]]
            rows = per.select(key, *[F.col(f"_first.{c}").alias(c) for c in attributes], *totals)
            if later:
                again = joined.groupBy(key).agg(*[first_non_null(F.col(c), "_ord").alias(c) for c in later])
                rows = rows.drop(*later).join(again, key, "left")
            known = {c: got[f"k{i}"] or 0 for i, c in enumerate(attributes)}
            return (rows.select(key, *[F.col(c).alias(out(c)) for c in attributes], *totals),
                    lambda std: not known.get(f"_a_{std}"))
    prof = profile(df) if prof is None else prof
    joined = split_orders(number_rows(df, order_col, prof), order_col, carried, prof)
    rows = joined.select(key, *[F.when(F.col("_ord").isNotNull(), F.col(c)).alias(out(c)) for c in attributes],
                         *[t(joined, True).alias(n) for n, t in totals.items()])
    return rows, lambda std: std not in hits or prof["count"][hits[std]] == 0


def split_products(df: DataFrame, order_col: str, prof: dict | None = None) -> DataFrame:
    """One row per product with first non-null attributes and defaults."""
    okeys = resolve_columns(df.columns, SPLIT_ORDER_ALIASES, "contains")
    totals = {"_mean_sales": _mean_sales} if "sales" in okeys else {}
    more = {"_subcat": SUBCATEGORY_COLUMN} if SUBCATEGORY_COLUMN in df.columns else {}
    prods, empty = _of_each(df, order_col, prof, "product_id", "products", SPLIT_PRODUCT_ALIASES, totals, more)
    if empty("category"):
        prods = prods.withColumn("category", F.col("_subcat") if more else F.lit("General"))
    if empty("base_price"):
        prods = prods.withColumn("base_price", F.col("_mean_sales") if "_mean_sales" in prods.columns
                                 else F.lit(DEFAULT_BASE_PRICE))
    prods = prods.withColumn("base_price", F.col("base_price").cast("double"))
    prods = prods.withColumn("rating", F.lit(DEFAULT_RATING) if empty("rating")
                             else F.col("rating").cast("double"))
    prods = prods.withColumn("stock_quantity", F.lit(DEFAULT_STOCK)) \
                 .withColumn("manufacturing_cost", F.col("base_price") * F.lit(0.5))
    keep = ["product_id", "category", "base_price", "rating"] + \
           (["product_name"] if "product_name" in prods.columns else []) + ["stock_quantity", "manufacturing_cost"]
    return prods.select(*keep)


def split_customers(df: DataFrame, order_col: str, prof: dict | None = None) -> DataFrame:
    """One row per customer: first location attributes, LTV, signup date."""
    totals = {"lifetime_value": _lifetime_value, "signup_date": _signup_date}
    cust, empty = _of_each(df, order_col, prof, "customer_id", "customers", SPLIT_CUSTOMER_ALIASES, totals)
    if empty("city"):
        cust = cust.withColumn("city", F.lit("Unknown"))
    cust = cust.withColumn("lifetime_value", F.col("lifetime_value").cast("double"))
    cust = cust.withColumn("age_group", F.lit("Unknown"))
    keep = ["customer_id"] + [c for c in ("city", "region", "country", "state", "segment") if c in cust.columns] \
        + ["lifetime_value", "signup_date", "age_group"]
    return cust.select(*keep)


def _mean_sales(joined: DataFrame, single: bool = False):
    """Mean of a group's sales, or of one row's own."""
    return exact_value("sales") if single else exact_avg("sales")


def _lifetime_value(joined: DataFrame, single: bool = False):
    if "sales" not in joined.columns:
        return F.lit(DEFAULT_LTV)
    return exact_value("sales") if single else exact_sum("sales")


def _signup_date(joined: DataFrame, single: bool = False):
    if "order_date" not in joined.columns:
        return F.lit(DEFAULT_SIGNUP).cast("timestamp")
    return F.col("order_date") if single else F.min("order_date")
