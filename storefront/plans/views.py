"""The test-data binding of ``sources/testdata.py`` written as SQL CTEs.

The driver's oracle (DuckDB) sees only the raw tables; each oracle query starts
with these CTEs so both engines compute from the same definitions.
Constants are written as ``2.5e0`` so both engines stay in DOUBLE.
"""

from __future__ import annotations

LINE_ORDER_SQL = ("l.l_orderkey AS ro, l.l_linenumber AS rl, l.l_partkey AS rp, l.l_suppkey AS rs, "
                  "l.l_quantity AS rq, l.l_extendedprice AS re, l.l_discount AS rd, l.l_tax AS rt, "
                  "l.l_returnflag AS rrf, l.l_linestatus AS rls, l.l_shipdate AS rsd")
ROW_ORDER = "ro, rl, rp, rs, rq, re, rd, rt, rrf, rls, rsd"

ORDERS_C = """orders_c AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_suppkey AS supplier_id,
         o.o_custkey AS customer_id, l.l_partkey AS product_id,
         CAST(o.o_orderdate AS TIMESTAMP) AS order_date,
         l.l_quantity AS quantity,
         l.l_discount * 100e0 AS discount_pct,
         l.l_extendedprice / l.l_quantity AS base_price,
         (l.l_extendedprice / l.l_quantity) * (1e0 - l.l_discount) AS price_after_discount,
         l.l_extendedprice * (1e0 - l.l_discount) AS order_value,
         (l.l_orderkey + l.l_linenumber) % 8 AS delivery_time_days,
         GREATEST((l.l_orderkey + l.l_linenumber) % 8 - 2, 0) AS delivery_delay,
         'card' AS payment_method,
         CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F' THEN 1 ELSE 0 END
           AS failed_payment_attempts,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned,
         1 + (l.l_partkey + l.l_suppkey) % 5 AS customer_rating,
         p.p_type AS category,
         2.5e0 + p.p_size / 20e0 AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey)"""

PRODUCTS_C = """products_c AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_retailprice AS base_price, 2.5e0 + p_size / 20e0 AS rating,
         p_size AS stock_quantity, p_retailprice * 0.5e0 AS manufacturing_cost
  FROM part)"""

CUSTOMERS_C = """customers_c AS (
  SELECT c.c_custkey AS customer_id, n.n_name AS city, f.signup_date,
         c.c_acctbal AS lifetime_value, c.c_mktsegment AS age_group
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS TIMESTAMP)) AS signup_date
             FROM orders GROUP BY o_custkey) f ON f.o_custkey = c.c_custkey)"""

WIDE_C = """wide_c AS (
  SELECT """ + LINE_ORDER_SQL + """,
         CAST(l.l_orderkey AS VARCHAR) AS "Order ID",
         CAST(o.o_orderdate AS TIMESTAMP) AS "Order Date",
         CAST(o.o_orderdate AS TIMESTAMP) + to_days(CAST((l.l_orderkey + l.l_linenumber) % 8 AS INTEGER))
           AS "Ship Date",
         o.o_orderpriority AS "Ship Mode",
         CAST(c.c_custkey AS VARCHAR) AS "Customer ID",
         c.c_mktsegment AS "Segment", n.n_name AS "City", n.n_name AS "State",
         r.r_name AS "Country", r.r_name AS "Region",
         CAST(l.l_partkey AS VARCHAR) AS "Product ID",
         p.p_type AS "Category", p.p_name AS "Product Name",
         l.l_extendedprice * (1e0 - l.l_discount) AS "Sales",
         l.l_quantity AS "Quantity", l.l_discount AS "Discount",
         l.l_extendedprice * (0.5e0 - l.l_discount) AS "Profit"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey
                  JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

REVIEWS_C = """reviews_c AS (
  SELECT CAST(l.l_partkey AS VARCHAR) AS product_id, p.p_name AS product_name, p.p_type AS category,
         '₹' || format('{:,.4f}', (l.l_extendedprice / l.l_quantity) * (1e0 - l.l_discount)) AS discounted_price,
         '₹' || format('{:,.2f}', l.l_extendedprice / l.l_quantity) AS actual_price,
         CAST(2.5e0 + p.p_size / 20e0 AS VARCHAR) AS rating,
         CAST(l.l_quantity AS BIGINT) AS rating_count,
         CAST(c.c_custkey AS VARCHAR) AS user_id, c.c_name AS user_name,
         concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS review_id,
         """ + LINE_ORDER_SQL + """
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey
                  JOIN customer c ON o.o_custkey = c.c_custkey)"""

ALL_VIEWS = [ORDERS_C, PRODUCTS_C, CUSTOMERS_C, WIDE_C, REVIEWS_C]


def with_views(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the binding CTEs (DuckDB inlines unused ones)."""
    ctes = ",\n".join(ALL_VIEWS)
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body}"
