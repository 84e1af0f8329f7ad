"""Registered queries for ingest and sinks (S1, S4, S6-S9, S11): each writes files from the given tables and reads them back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from storefront.plans.catalog import _KPIS, CUT30, NPROUND, _kpis, _o, _r, register
from storefront.operators import kpis, rollup
from storefront.operators.clean import np_round
from storefront.plans.views import with_views
from storefront.session import ensure_checkpoint_dir
from storefront.sources import ingest, sinks
from storefront.sources import testdata as td


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/io/{uuid.uuid4().hex}"


# every 97th order has a broken quantity, the next one a comma too many
_QTY = "CASE WHEN l_orderkey % 97 = 5 THEN 'n/a' ELSE CAST(l_quantity AS {text}) END"
_MODE = "CASE WHEN l_orderkey % 97 = 6 THEN concat(l_returnflag, ',', l_linestatus) ELSE l_returnflag END"
_BROKEN = "l_orderkey % 97 IN (5, 6)"


@register("csv_quarantine",
          "SELECT 'good' AS part, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_no, l_quantity AS quantity, l_returnflag AS flag, "
          f"CAST(NULL AS VARCHAR) AS line FROM lineitem WHERE NOT ({_BROKEN}) UNION ALL SELECT 'bad', NULL, NULL, NULL, NULL, "
          f"concat_ws(',', l_orderkey, l_linenumber, {_QTY.format(text='VARCHAR')}, {_MODE}) FROM lineitem WHERE {_BROKEN}")
def _csv_quarantine(spark, d):
    """Lineitem as CSV with broken rows, read back in two parts."""
    base = _folder(spark)
    li = td.table(spark, d, "lineitem").selectExpr(f"concat_ws(',', l_orderkey, l_linenumber, {_QTY.format(text='STRING')}, {_MODE}) AS line")
    li.write.text(f"{base}/lines.csv")
    got = ingest.ingest_csv(spark, f"{base}/lines.csv", f"{base}/staging", header=False, names=["order_id", "line_no", "quantity", "flag"])
    good = got.rows.select(F.lit("good").alias("part"), F.col("order_id").cast("string"), F.col("line_no").cast("string"), "quantity", "flag",
                           F.lit(None).cast("string").alias("line"))
    return good.unionByName(got.quarantine.select(F.lit("bad").alias("part"), "line"), allowMissingColumns=True)


_SUPPLIERS = {"acme": {"order_id": ["txn_id"], "order_date": ["txn_date"], "customer_id": ["buyer"], "quantity": ["units"], "order_value": ["total"]},
              "borealis": {"order_id": ["Bestellnummer"], "quantity": ["Menge"], "order_value": ["Betrag"], "product_id": ["sku"]}}


@register("supplier_mappings", with_views(
    "SELECT CASE WHEN supplier_id % 2 = 0 THEN 'acme' ELSE 'borealis' END AS supplier, order_id, "
    "CASE WHEN supplier_id % 2 = 0 THEN order_date END AS order_date, CASE WHEN supplier_id % 2 = 0 THEN CAST(customer_id AS VARCHAR) END AS customer_id, "
    "CASE WHEN supplier_id % 2 = 1 THEN CAST(product_id AS VARCHAR) END AS product_id, quantity, order_value FROM orders_c"))
def _supplier_mappings(spark, d):
    """Two suppliers' files under different headers, with mappings read from JSON files."""
    base = _folder(spark)
    o = _o(spark, d)
    own = {"acme": ["order_id", "order_date", "customer_id", "quantity", "order_value"],
           "borealis": ["order_id", "product_id", "quantity", "order_value"]}
    for i, (name, columns) in enumerate(own.items()):
        mapping = _SUPPLIERS[name]
        part = o.where(F.col("supplier_id") % 2 == i).select(*[F.col(c).alias(mapping[c][0]) for c in columns])
        part.write.option("header", True).csv(f"{base}/{name}.csv")
        spark.createDataFrame([(json.dumps(mapping),)], "value string").coalesce(1).write.text(f"{base}/mappings/{name}.json")
    mappings = ingest.read_mappings(spark, f"{base}/mappings")
    out = ingest.load_suppliers(spark, {n: f"{base}/{n}.csv" for n in own}, mappings)
    return out.select("supplier", F.col("order_id").cast("long"), "order_date", F.col("customer_id").cast("string"),
                      F.col("product_id").cast("string"), F.col("quantity").cast("double"), "order_value")


@register("days_roundtrip", with_views(
    f"SELECT order_id, line_no, order_date, order_value, CASE WHEN order_date >= {CUT30} THEN 'new' ELSE 'old' END AS version FROM orders_c "
    "WHERE order_date IS NOT NULL"))
def _days_roundtrip(spark, d):
    """A table written by month; the last months are written again and replace only themselves."""
    path = f"{_folder(spark)}/orders"
    o = _o(spark, d).select("order_id", "line_no", "order_date", "order_value")
    sinks.write_days(o.withColumn("version", F.lit("old")), path)
    first = F.lit("2001-07-03 00:00:00").cast("timestamp")
    months = F.date_format("order_date", "yyyyMM") >= "200107"
    sinks.write_days(o.where(months).withColumn("version", F.when(F.col("order_date") >= first, "new").otherwise("old")), path)
    return spark.read.parquet(path).drop("month")


@register("document_roundtrip", with_views(
    f"SELECT total_orders, {NPROUND('total_revenue', 5)} AS total_revenue, total_customers, {NPROUND('customer_churn_rate', 9)} AS churn_rate, "
    "(SELECT category FROM orders_c WHERE category IS NOT NULL GROUP BY category ORDER BY fsum(order_value) DESC, category LIMIT 1) AS best, "
    "CAST(NULL AS VARCHAR) AS remark FROM kpis", _KPIS))
def _document_roundtrip(spark, d):
    """The KPI document as nested JSON, read back under its stored schema."""
    path = f"{_folder(spark)}/kpis"
    best = rollup.revenue_by_category(_r(spark, d), 1).select("category").scalar()
    doc = kpis.kpi_document(_kpis(spark, d), with_timestamp=False).select("*", F.struct(best.alias("best"), F.lit(None).cast("string").alias("remark")).alias("notes"))
    sinks.write_document(doc, path)
    back = sinks.read_document(spark, path)
    return back.select("business_kpis.total_orders", np_round(F.col("business_kpis.total_revenue"), 5).alias("total_revenue"),
                       "business_kpis.total_customers", np_round(F.col("business_kpis.customer_churn_rate"), 9).alias("churn_rate"),
                       "notes.best", "notes.remark")
