"""Data-quality checks (V1-V9) as DataFrames.

Per table, the row count, the null counts of the required columns and the
range checks fold into one aggregate pass (``table_checks``), or into a pass that is
made anyway (``observe_checks``); orphan keys are left-anti joins.
``dq_report`` returns one row per check (table, check, severity, ok, detail);
the verdict is ``bool_and(ok)`` over the error-level rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from storefront.functions.numeric import exact_avg, exact_sum

# Required columns per table and the null-share warning level.
REQUIRED = {
    "orders": ["order_id", "customer_id", "product_id", "order_date", "quantity", "order_value"],
    "products": ["product_id", "category", "base_price", "rating"],
    "customers": ["customer_id", "signup_date", "lifetime_value"],
}
NULL_WARN_SHARE = 0.1
RATING_RANGE = (1, 5)
ORPHAN_LIST = 10
#: Columns whose range is reported: table, column.
RANGED = (("products", "base_price"), ("customers", "lifetime_value"))


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """V2: required columns absent from the table (metadata only)."""
    return [c for c in REQUIRED[table] if c not in df.columns]


def _missing(df: DataFrame, col: str):
    """NULL, and NaN of a floating column, count as missing."""
    c = F.col(col)
    return c.isNull() | F.isnan(c) if df.schema[col].dataType.typeName() in ("double", "float") else c.isNull()


def dq_nulls(df: DataFrame, table: str) -> DataFrame:
    """V3/V4: rows, and null count / share / warning per required column that is present, one pass."""
    cols = [c for c in REQUIRED[table] if c in df.columns]
    if not cols:
        return df.limit(0).select(*[F.lit(None).cast(t).alias(n) for n, t in (
            ("table_name", "string"), ("column_name", "string"), ("rows", "long"), ("nulls", "long"),
            ("null_pct", "double"), ("high_nulls", "boolean"))])
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_missing(df, c)).alias(f"n_{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', n_{i}" for i, c in enumerate(cols))
    long = agg.selectExpr("_rows", f"stack({len(cols)}, {stack}) AS (column_name, nulls)")
    share = F.coalesce(F.try_divide(F.col("nulls").cast("double"), F.col("_rows")), F.lit(0.0))
    return long.select(F.lit(table).alias("table_name"), "column_name", F.col("_rows").alias("rows"), "nulls",
                       (share * F.lit(100.0)).alias("null_pct"), (share > NULL_WARN_SHARE).alias("high_nulls"))


def dq_orders(orders: DataFrame) -> DataFrame:
    """V5: date range, quantity < 1 present, negative value present, total revenue."""
    return orders.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"),
        F.count_if(F.col("quantity") < 1).alias("quantity_below_1"),
        F.count_if(F.col("order_value") < 0).alias("negative_value"),
        F.coalesce(exact_sum("order_value"), F.lit(0.0)).alias("total_revenue"),
    )


def dq_products(products: DataFrame) -> DataFrame:
    """V6: price range and ratings outside 1-5."""
    lo, hi = RATING_RANGE
    return products.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("base_price").alias("min_price"), F.max("base_price").alias("max_price"),
        F.count_if((F.col("rating") < lo) | (F.col("rating") > hi)).alias("rating_out_of_range"),
    )


def dq_customers(customers: DataFrame) -> DataFrame:
    """V6: lifetime value min / max / mean."""
    return customers.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("lifetime_value").alias("min_ltv"), F.max("lifetime_value").alias("max_ltv"),
        exact_avg("lifetime_value").alias("avg_ltv"),
    )


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """V7/V8: distinct keys of ``left`` missing from ``right`` (a NULL key counts as missing)."""
    return left.select(key).join(right.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti") \
               .distinct()


def orphan_summary(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Count of orphan keys and, when there are at most 10, their list (a bounded top-k of the ids)."""
    o = orphans(left, right, key).select(F.col(key).cast("string").alias("id"))
    few = o.where(F.col("id").isNotNull()).orderBy("id").limit(ORPHAN_LIST)
    ids = few.agg(F.array_join(F.sort_array(F.collect_list("id")), ", ").alias("ids")).scalar()
    return o.agg(F.count(F.lit(1)).alias("orphans")).select(
        "orphans", F.when(F.col("orphans") <= ORPHAN_LIST, ids).alias("orphan_ids"))


def _metrics(df: DataFrame, table: str) -> dict[str, Column]:
    """V3-V6: every number that the checks of one table need, as aggregates of one pass."""
    has = set(df.columns)
    out = {"n": F.count(F.lit(1))}
    out |= {f"nulls_{c}": F.count_if(_missing(df, c)) for c in REQUIRED[table] if c in has}
    if table == "orders":
        if "order_date" in has:
            out |= {"first_day": F.min("order_date"), "last_day": F.max("order_date")}
        if "quantity" in has:
            out["quantity_below_1"] = F.count_if(F.col("quantity") < 1)
        if "order_value" in has:
            out |= {"negative_value": F.count_if(F.col("order_value") < 0),
                    "total_revenue": F.coalesce(exact_sum("order_value"), F.lit(0.0))}
    for name, col in RANGED:
        if table == name and col in has:
            out |= {"least": F.min(col), "most": F.max(col), "mean": exact_avg(col)}
    if table == "products" and "rating" in has:
        lo, hi = RATING_RANGE
        out["rating_out_of_range"] = F.count_if((F.col("rating") < lo) | (F.col("rating") > hi))
    return out


def _checks(table: str, names: set[str], n_columns: int) -> list[Column]:
    """The check rows of one table, as structs over its row of metrics."""
    yes = F.lit(True)

    def row(check: str, severity: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check"), F.lit(severity).alias("severity"),
                        ok.alias("ok"), detail.cast("string").alias("detail"))

    def money(c: str) -> Column:
        return F.coalesce(F.format_number(F.col(c).cast("double"), 2), F.lit("none"))

    def day(c: str) -> Column:
        return F.coalesce(F.date_format(F.col(c), "yyyy-MM-dd"), F.lit("none"))

    out = []
    for c in (c for c in REQUIRED[table] if f"nulls_{c}" in names):
        share = F.coalesce(F.try_divide(F.col(f"nulls_{c}").cast("double"), F.col("n")), F.lit(0.0))
        out.append(row(f"nulls:{c}", "warning", share <= NULL_WARN_SHARE,
                       F.concat(F.col(f"nulls_{c}").cast("string"), F.lit(" nulls ("), F.format_number(share * F.lit(100.0), 1), F.lit("%)"))))
    out.append(row("size", "info", yes, F.concat(F.col("n").cast("string"), F.lit(f" rows, {n_columns} columns"))))
    if "first_day" in names:
        out.append(row("date_range", "info", yes, F.concat(day("first_day"), F.lit(" to "), day("last_day"))))
    for c in ("quantity_below_1", "negative_value", "rating_out_of_range"):
        if c in names:
            out.append(row(c, "warning", F.col(c) == 0, F.col(c)))
    if "total_revenue" in names:
        out.append(row("total_revenue", "info", yes, money("total_revenue")))
    if "least" in names:
        check = "price_range" if table == "products" else "lifetime_value"
        out.append(row(check, "info", yes, F.concat(money("least"), F.lit(" to "), money("most"), F.lit(", mean "), money("mean"))))
    return out


def _rows_of(metrics: DataFrame, table: str, names: set[str], n_columns: int) -> DataFrame:
    return metrics.select(F.inline(F.array(*_checks(table, names, n_columns))))


def table_checks(df: DataFrame, table: str) -> DataFrame:
    """V3-V6: the checks of one table, from one aggregate over it."""
    m = _metrics(df, table)
    return _rows_of(df.agg(*[c.alias(n) for n, c in m.items()]), table, set(m), len(df.columns))


def observe_checks(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """V3-V6 within another pass: the same rows, and an observation that holds the metrics once they have been written.

    Write the returned frame (an ingest job, say), then call ``observed_checks``.  A session
    that has observed something can no longer be serialised, and fitted forests carry
    theirs in their training summary: observe in a session of its own
    (``spark.newSession()``) where models are scored beside it.
    """
    seen = Observation(f"checks-{table}-{uuid.uuid4().hex}")
    return df.observe(seen, *[c.alias(n) for n, c in _metrics(df, table).items()]), seen


def observed_checks(df: DataFrame, table: str, seen: Observation) -> DataFrame:
    """The rows of ``table_checks`` from what was observed; waits for the pass to end.  ``df`` is the table as it was given."""
    spark = df.sparkSession
    m = _metrics(df, table)
    empty = df.limit(0).agg(*[c.alias(n) for n, c in m.items()])  # for its types
    got = seen.get
    return _rows_of(spark.createDataFrame([tuple(got[n] for n in m)], empty.schema), table, set(m), len(df.columns))


def dq_report(orders: DataFrame | None, products: DataFrame | None, customers: DataFrame | None,
              observed: Mapping[str, Observation] | None = None) -> DataFrame:
    """V1-V9: one row per check; severity 'error' rows decide the verdict.

    Each table is aggregated once, or not at all where ``observed`` has what its ingest
    pass saw; the orphan checks are one anti join each.  A missing table or column gives
    an error row; the checks of the columns that are present run all the same.
    """
    spark = next(d for d in (orders, products, customers) if d is not None).sparkSession
    observed = observed or {}
    rows = []
    tables = {"orders": orders, "products": products, "customers": customers}
    parts: list[DataFrame] = []
    for name, df in tables.items():
        if df is None:
            rows.append((name, "present", "error", False, "input missing"))
            continue
        miss = missing_columns(df, name)
        rows.append((name, "required_columns", "error", not miss, ", ".join(miss)))
        parts.append(observed_checks(df, name, observed[name]) if name in observed else table_checks(df, name))
    for check, other, key in (("orphan_customers", customers, "customer_id"), ("orphan_products", products, "product_id")):
        if orders is not None and other is not None and key in orders.columns and key in other.columns:
            s = orphan_summary(orders, other, key)
            parts.append(s.select(F.lit("orders").alias("table_name"), F.lit(check).alias("check"), F.lit("warning").alias("severity"),
                                  (F.col("orphans") == 0).alias("ok"),
                                  F.coalesce(F.col("orphan_ids"), F.col("orphans").cast("string")).alias("detail")))
    out = spark.createDataFrame(rows, "table_name string, check string, severity string, ok boolean, detail string")
    for p in parts:
        out = out.unionByName(p)
    return out


def dq_verdict(report: DataFrame) -> DataFrame:
    """V9: valid when every error-level check passed (warnings do not fail it)."""
    return report.agg(F.coalesce(F.bool_and(F.when(F.col("severity") == "error", F.col("ok"))), F.lit(True))
                      .alias("valid"))
