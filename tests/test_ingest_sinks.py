"""Tolerant CSV, mappings per supplier, and sinks that are read back."""

import os

import pytest
from pyspark.sql import functions as F

from storefront.sources import ingest, sinks


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_types_come_from_most_values_of_the_sample(spark, tmp_path):
    rows = "".join(f"{i},{i / 4},00{i},2001-01-{i % 28 + 1:02d} 10:00:00,true,name {i},\n" for i in range(1, 60))
    put(f"{tmp_path}/a.csv", "n,x,code,at,flag,name,none\n" + rows + "bad,bad,z,never,maybe,,\n")
    got = ingest.sampled_schema(spark, f"{tmp_path}/a.csv")
    assert [f.dataType.simpleString() for f in got] == ["bigint", "double", "string", "timestamp", "boolean", "string", "string"]
    assert [f.name for f in got] == ["n", "x", "code", "at", "flag", "name", "none"]


def test_bad_rows_go_to_the_quarantine_whatever_is_selected(spark, tmp_path):
    put(f"{tmp_path}/in/a.csv", "id,qty,city\n1,2.5,Rome\n2,many,Oslo\n3,4\n4,1,Bonn,extra\n5,,Lima\n")
    put(f"{tmp_path}/in/b.csv", 'id,qty,city\n6,7,"Paris, France"\nx,1,Kyiv\n')
    got = ingest.ingest_csv(spark, f"{tmp_path}/in", f"{tmp_path}/staging", schema="id bigint, qty double, city string")
    assert sorted(tuple(r) for r in got.rows.collect()) == [(1, 2.5, "Rome"), (5, None, "Lima"), (6, 7.0, "Paris, France")]
    assert sorted(r.city for r in got.rows.select("city").collect()) == ["Lima", "Paris, France", "Rome"]  # the same rows
    bad = sorted((r.line, r.file.rsplit("/", 1)[1]) for r in got.quarantine.collect())
    assert bad == [("2,many,Oslo", "a.csv"), ("3,4", "a.csv"), ("4,1,Bonn,extra", "a.csv"), ("x,1,Kyiv", "b.csv")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ingest.ingest_csv(spark, f"{tmp_path}/nowhere", f"{tmp_path}/s2")


def test_each_supplier_has_its_mapping(spark, tmp_path):
    put(f"{tmp_path}/acme.csv", "txn,units,when,extra\n1,2,2001-02-03,z\n2,3,bad,z\n")
    put(f"{tmp_path}/other.csv", "order_id,quantity\nA7,1.5\n")
    put(f"{tmp_path}/maps/acme.json", '{"order_id": ["txn"], "quantity": ["units"], "order_date": ["when"]}')
    maps = ingest.read_mappings(spark, f"{tmp_path}/maps")
    assert maps == {"acme": {"order_id": ["txn"], "quantity": ["units"], "order_date": ["when"]}}
    sources = {"acme": f"{tmp_path}/acme.csv", "other": f"{tmp_path}/other.csv"}
    default = {"order_id": ["order_id"], "quantity": ["quantity"]}
    got = ingest.load_suppliers(spark, sources, maps, default)
    rows = sorted((r.supplier, r.order_id, r.quantity, str(r.order_date)) for r in got.collect())
    assert rows == [("acme", "1", 2.0, "2001-02-03 00:00:00"), ("acme", "2", 3.0, "None"), ("other", "A7", 1.5, "None")]
    with pytest.raises(KeyError, match="other"):
        ingest.load_suppliers(spark, sources, maps)


def test_a_failed_overwrite_leaves_the_old_months(spark, tmp_path):
    path = f"{tmp_path}/t"
    day = F.to_timestamp(F.lit("2001-01-15"))
    old = spark.range(100).select("id", F.when(F.col("id") < 50, day).when(F.col("id") < 90, F.add_months(day, 1).cast("timestamp")).alias("order_date"),
                                  F.lit("old").alias("v"))
    sinks.write_days(old, path)
    broken = old.where("id < 50").select("id", "order_date", F.when(F.col("id") == 49, F.raise_error(F.lit("stop"))).otherwise(F.lit("new")).cast("string").alias("v"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_days(broken, path)
    assert {(r.v, r["count"]) for r in spark.read.parquet(path).groupBy("v").count().collect()} == {("old", 100)}
    sinks.write_days(old.where("id < 50").withColumn("v", F.lit("new")), path)
    assert {(r.v, r["count"]) for r in spark.read.parquet(path).groupBy("v").count().collect()} == {("old", 50), ("new", 50)}
    assert spark.read.parquet(path).where("month is null").count() == 10


def test_documents_keep_their_shape(spark, tmp_path):
    doc = spark.createDataFrame([((1, None), [("f", 0.5)])], "kpis struct<orders: long, note: string>, top array<struct<name: string, w: double>>")
    sinks.write_document(doc, f"{tmp_path}/d")
    back = sinks.read_document(spark, f"{tmp_path}/d")
    assert back.schema == doc.schema and back.collect() == doc.collect()
    sinks.write_document(doc.limit(0), f"{tmp_path}/e")
    assert sinks.read_document(spark, f"{tmp_path}/e").schema == doc.schema
