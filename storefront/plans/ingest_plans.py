"""Registered queries for mapping, the wide-export split and the review export."""

from __future__ import annotations

from pyspark.sql import functions as F

from storefront.functions.numeric import clean_money
from storefront.operators import clean, mapping, reviews, split
from storefront.operators.clean import np_round
from storefront.plans.catalog import NPROUND, REF, register
from storefront.plans.views import with_views
from storefront.sources import readers
from storefront.sources import testdata as td

ORD = "Row ID"
from storefront.plans.views import ROW_ORDER  # noqa: E402


def _first(col: str) -> str:
    return f'first("{col}" ORDER BY {ROW_ORDER}) FILTER (WHERE "{col}" IS NOT NULL)'


@register("map_columns", with_views(
    'SELECT "Order ID" AS order_id, "Order Date" AS order_date, "Customer ID" AS customer_id, '
    '"Product ID" AS product_id, "Quantity" AS quantity, "Sales" AS order_value, "Discount" AS discount_pct, '
    '"Ship Date" AS ship_date FROM wide_c'))
def _map_columns(spark, d):
    return mapping.map_columns(td.wide_export(spark, d), mapping.ORDERS_ALIASES, keep_unmapped=False)


_SPLIT_ORDERS = (
    'SELECT "Order ID" AS order_id, "Order Date" AS order_date, "Customer ID" AS customer_id, '
    '"Product ID" AS product_id, "Quantity" AS quantity, "Sales" AS sales, "Discount" AS discount, '
    '"Profit" AS profit, "Ship Date" AS ship_date, "Ship Mode" AS ship_mode, "Sales" AS order_value, '
    'CASE WHEN (SELECT MAX("Discount") FROM wide_c) < 1 THEN "Discount" * 100e0 ELSE "Discount" END '
    'AS discount_pct, '
    'CAST(COALESCE(floor((epoch("Ship Date") - epoch("Order Date")) / 86400e0), 3) AS INTEGER) '
    'AS delivery_time_days, '
    'GREATEST(CAST(COALESCE(floor((epoch("Ship Date") - epoch("Order Date")) / 86400e0), 3) AS INTEGER) - 2, 0) '
    'AS delivery_delay, \'card\' AS payment_method, 0 AS failed_payment_attempts, 0 AS is_returned, '
    '4 AS customer_rating FROM wide_c')


@register("split_orders", with_views(_SPLIT_ORDERS))
def _split_orders(spark, d):
    return split.split_orders(td.wide_export(spark, d))


@register("discount_rescale", with_views(
    'SELECT "Order ID" AS order_id, "Discount" AS discount, '
    'CASE WHEN (SELECT MAX("Discount") FROM wide_c) < 1 THEN "Discount" * 100e0 ELSE "Discount" END '
    'AS discount_pct, ro AS line_order, rl AS line_no, rp AS product_key, rs AS supplier_key FROM wide_c'))
def _discount_rescale(spark, d):
    w = td.wide_export(spark, d).select(
        F.col("Order ID").alias("order_id"), F.col("Discount").alias("discount"),
        F.col("`Row ID`.o").alias("line_order"), F.col("`Row ID`.l").alias("line_no"),
        F.col("`Row ID`.p").alias("product_key"), F.col("`Row ID`.s").alias("supplier_key"))
    return clean.discount_rescale(w, "discount")


@register("delivery_time", with_views(
    'SELECT ro AS order_id, rl AS line_no, rp AS product_id, rs AS supplier_id, '
    'CAST(COALESCE(floor((epoch("Ship Date") - epoch("Order Date")) / 86400e0), 3) AS INTEGER) '
    'AS delivery_time_days, '
    'GREATEST(CAST(COALESCE(floor((epoch("Ship Date") - epoch("Order Date")) / 86400e0), 3) AS INTEGER) - 2, 0) '
    'AS delivery_delay FROM wide_c'))
def _delivery_time(spark, d):
    w = td.wide_export(spark, d).select(
        F.col("`Row ID`.o").alias("order_id"), F.col("`Row ID`.l").alias("line_no"),
        F.col("`Row ID`.p").alias("product_id"), F.col("`Row ID`.s").alias("supplier_id"),
        F.col("Ship Date").alias("ship_date"), F.col("Order Date").alias("order_date"))
    return clean.delivery_time(w).drop("ship_date", "order_date")


@register("split_products", with_views(
    f'SELECT "Product ID" AS product_id, {_first("Category")} AS category, '
    f'CAST({_first("Sales")} AS DOUBLE) AS base_price, 4.0e0 AS rating, '
    f'{_first("Product Name")} AS product_name, 100 AS stock_quantity, '
    f'CAST({_first("Sales")} AS DOUBLE) * 0.5e0 AS manufacturing_cost '
    'FROM wide_c WHERE "Product ID" IS NOT NULL GROUP BY "Product ID"'))
def _split_products(spark, d):
    return split.split_products(td.wide_export(spark, d), ORD)


@register("split_customers", with_views(
    f'SELECT "Customer ID" AS customer_id, {_first("City")} AS city, {_first("Region")} AS region, '
    f'{_first("Country")} AS country, {_first("State")} AS state, {_first("Segment")} AS segment, '
    'fsum("Sales") AS lifetime_value, MIN("Order Date") AS signup_date, '
    "'Unknown' AS age_group FROM wide_c WHERE \"Customer ID\" IS NOT NULL GROUP BY \"Customer ID\""))
def _split_customers(spark, d):
    return split.split_customers(td.wide_export(spark, d), ORD)


# a table whose price text is missing or unreadable in places
_PRICED = ("priced AS (SELECT product_id, CASE WHEN product_id % 5 = 0 THEN NULL WHEN product_id % 7 = 0 THEN 'n/a' "
           "ELSE '₹' || format('{:,.2f}', base_price) END AS base_price FROM products_c), "
           "cleaned AS (SELECT product_id, " + "TRY_CAST(nullif(regexp_replace(base_price, '[^0-9.\\-]', '', 'g'), '') AS DOUBLE)"
           " AS v FROM priced)")


@register("impute_price", with_views(
    f"SELECT product_id, {NPROUND('COALESCE(v, (SELECT quantile_cont(v, 0.5) FROM cleaned), 0e0)', 6)} AS base_price "
    "FROM cleaned", _PRICED))
def _impute_price(spark, d):
    p, i = td.products(spark, d), F.col("product_id")
    text = F.when(i % 5 == 0, None).when(i % 7 == 0, "n/a").otherwise(F.concat(F.lit("₹"), F.format_number("base_price", 2)))
    out = clean.impute_price(p.select("product_id", text.alias("base_price")))
    return out.withColumn("base_price", np_round(F.col("base_price"), 6))


_FILES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _rank_sql() -> str:
    def has(k, points):
        return f"bool_or(contains(lower(column_name), '{k}'))::INTEGER * {points}"
    terms = [has(k, readers.ORDER_KEYWORD_POINTS) for k in readers.ORDER_KEYWORDS]
    terms += [has(k, readers.REVIEW_KEYWORD_POINTS) for k in readers.REVIEW_KEYWORDS]
    hint = " OR ".join(f"contains(table_name, '{h}')" for h in readers.NAME_HINTS)
    names = ", ".join(f"'{f}'" for f in _FILES)
    return (f"SELECT table_name AS name, CAST({' + '.join(terms)} + CASE WHEN {hint} THEN {readers.NAME_HINT_POINTS} ELSE 0 END "
            f"AS INTEGER) AS score FROM information_schema.columns WHERE table_name IN ({names}) GROUP BY table_name")


@register("rank_sources", _rank_sql())
def _rank_sources(spark, d):
    ranked = readers.rank_sources(spark, [f"{d}/{f}.parquet" for f in _FILES])
    name = F.regexp_extract("path", r"([^/]+)\.parquet$", 1)
    return ranked.select(name.alias("name"), F.col("score").cast("int").alias("score"))


_NUMBERED = ("numbered AS (SELECT *, row_number() OVER (ORDER BY " + ROW_ORDER + ") AS rn FROM wide_c)")


@register("split_wide", with_views(
    "SELECT 'O' || rn AS order_id, 'C' || rn AS customer_id, 'P' || rn AS product_id, \"Sales\" AS order_value, "
    "\"Category\" AS category, \"Sales\" AS base_price, \"City\" AS city, \"Sales\" AS lifetime_value FROM numbered", _NUMBERED))
def _split_wide(spark, d):
    wide = td.wide_export(spark, d).drop("Order ID", "Customer ID", "Product ID")
    orders, products, customers = split.split_wide(wide, ORD)
    return (orders.select("order_id", "customer_id", "product_id", "order_value")
            .join(products.select("product_id", "category", "base_price"), "product_id", "left")
            .join(customers.select("customer_id", "city", "lifetime_value"), "customer_id", "left"))


_PARSE_FORMATS = "['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%m/%d/%Y', '%d-%m-%Y']"


@register("parse_dates",
          "SELECT o_orderkey AS order_id, "
          f"try_strptime(strftime(o_orderdate, '%Y-%m-%d'), {_PARSE_FORMATS}) AS order_date, "
          f"try_strptime(strftime(o_orderdate, '%m/%d/%Y'), {_PARSE_FORMATS}) AS ship_date, "
          f"try_strptime(o_orderpriority, {_PARSE_FORMATS}) AS priority_date FROM orders")
def _parse_dates(spark, d):
    o = td.table(spark, d, "orders")
    text = o.select(F.col("o_orderkey").alias("order_id"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
                    F.date_format("o_orderdate", "MM/dd/yyyy").alias("ship_date"),
                    F.col("o_orderpriority").alias("priority_date"))
    return clean.parse_dates(text, ["order_date", "ship_date", "priority_date"])


_MONEY = "(CASE WHEN regexp_replace({c}, '[^0-9.\\-]', '', 'g') = '' THEN NULL ELSE " \
         "TRY_CAST(regexp_replace({c}, '[^0-9.\\-]', '', 'g') AS DOUBLE) END)"


def money_sql(c: str) -> str:
    return _MONEY.format(c=c)


@register("clean_money", with_views(
    f"SELECT review_id, discounted_price AS discounted_text, {money_sql('discounted_price')} AS discounted_price, "
    f"actual_price AS actual_text, {money_sql('actual_price')} AS actual_price, "
    f"{money_sql('user_name')} AS user_name FROM reviews_c"))
def _clean_money(spark, d):
    r = td.review_export(spark, d).select(
        "review_id", F.col("discounted_price").alias("discounted_text"), "discounted_price",
        F.col("actual_price").alias("actual_text"), "actual_price", "user_name")
    return clean.clean_numeric(r, ["discounted_price", "actual_price", "user_name"])


@register("discount_from_prices", with_views(
    f"SELECT review_id, b AS base_price, p AS price_after_discount, "
    "COALESCE(CASE WHEN b IS NOT NULL AND b <> 0 AND p IS NOT NULL THEN (b - p) / b * 100e0 END, 0e0) "
    f"AS discount_pct FROM (SELECT review_id, {money_sql('actual_price')} AS b, "
    f"{money_sql('discounted_price')} AS p FROM reviews_c) t"))
def _discount_from_prices(spark, d):
    r = td.review_export(spark, d)
    r = r.select("review_id", clean_money("actual_price").alias("base_price"),
                 clean_money("discounted_price").alias("price_after_discount"))
    return clean.discount_from_prices(r)


_HASH = "(('0x' || substr(md5({k}), 1, 8))::BIGINT % {m})"

_REVIEW_ORDERS = (
    f"ro AS (SELECT *, row_number() OVER (ORDER BY {ROW_ORDER}) - 1 AS i FROM reviews_c), "
    "ro2 AS (SELECT *, 'AMZ_O' || CAST(i + 100000 AS VARCHAR) AS order_id FROM ro)")


@register("reviews_to_orders", with_views(
    "SELECT order_id, user_id AS customer_id, product_id, "
    f"CAST(DATE '{REF}' - CAST({_HASH.format(k='order_id', m=730)} AS INTEGER) AS TIMESTAMP) AS order_date, "
    "1 AS quantity, "
    "COALESCE(CASE WHEN b IS NOT NULL AND b <> 0 AND p IS NOT NULL THEN (b - p) / b * 100e0 END, 0e0) "
    "AS discount_pct, p AS price_after_discount, b AS base_price, 3 AS delivery_time_days, 0 AS delivery_delay, "
    "'card' AS payment_method, 0 AS failed_payment_attempts, 0 AS is_returned, "
    "COALESCE(TRY_CAST(rating AS DOUBLE), 4.0e0) AS customer_rating FROM "
    f"(SELECT *, {money_sql('actual_price')} AS b, {money_sql('discounted_price')} AS p FROM ro2) t",
    _REVIEW_ORDERS))
def _reviews_to_orders(spark, d):
    return reviews.reviews_to_orders(td.review_export(spark, d), "row_ord", REF)


def _first_row(col: str) -> str:
    return f"first({col} ORDER BY {ROW_ORDER})"


@register("reviews_products", with_views(
    f"SELECT product_id, {_first_row('product_name')} AS product_name, {_first_row('category')} AS category, "
    f"{_first_row('actual_price')} AS actual_price, {_first_row('discounted_price')} AS discounted_price, "
    f"{_first_row('rating')} AS rating, {_first_row('rating_count')} AS rating_count "
    "FROM reviews_c GROUP BY product_id"))
def _reviews_products(spark, d):
    return reviews.reviews_products(td.review_export(spark, d), "row_ord")


@register("reviews_customers", with_views(
    f"SELECT user_id AS customer_id, {_first_row('user_name')} AS user_name, "
    f"CAST(DATE '{REF}' - CAST(30 + {_HASH.format(k='user_id', m=870)} AS INTEGER) AS TIMESTAMP) AS signup_date, "
    "0e0 AS lifetime_value FROM reviews_c GROUP BY user_id"))
def _reviews_customers(spark, d):
    return reviews.reviews_customers(td.review_export(spark, d), "row_ord", REF)


# an export without categories, with an empty price column and a sub-category: the fallbacks of W11 and W12
@register("split_products_fallbacks", with_views(
    f'SELECT "Product ID" AS product_id, {_first("Category")} AS category, {NPROUND("fsum(Sales) / COUNT(Sales)", 9)} AS base_price, '
    '4.0e0 AS rating, "Product ID" AS product_name, 100 AS stock_quantity FROM wide_c WHERE "Product ID" IS NOT NULL GROUP BY "Product ID"'))
def _split_products_fallbacks(spark, d):
    w = td.wide_export(spark, d)
    poor = w.select("Row ID", "Order ID", "Order Date", "Product ID", F.lit(None).cast("double").alias("Price"), "Sales", "Quantity",
                    F.col("Category").alias(split.SUBCATEGORY_COLUMN))
    out = split.split_products(poor, ORD)
    return out.select("product_id", "category", np_round(F.col("base_price"), 9).alias("base_price"), "rating", "product_name", "stock_quantity")


# orders and customers that lack every column with a default
@register("add_defaults_orders", with_views(
    "SELECT order_id, line_no, product_id, 3 AS delivery_time_days, 'card' AS payment_method, 0 AS failed_payment_attempts, "
    "0 AS is_returned, 4 AS customer_rating, 1 AS delivery_delay FROM orders_c"))
def _add_defaults_orders(spark, d):
    return clean.add_defaults(td.orders(spark, d).select("order_id", "line_no", "product_id"), "orders")


@register("add_defaults_customers", with_views(
    "SELECT customer_id, lifetime_value, 'Unknown' AS city, 'Unknown' AS age_group FROM customers_c"))
def _add_defaults_customers(spark, d):
    return clean.add_defaults(td.customers(spark, d).select("customer_id", "lifetime_value"), "customers")
