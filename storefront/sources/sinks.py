"""Output writers.

Every writer is a plain ``DataFrameWriter`` call: distributed, one file per
partition, overwrite semantics.  Documents (insights, KPIs) are written as
JSON rows of nested structs, with their schema beside them, and read back under it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table; CSV gets a header row."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def write_days(df: DataFrame, path: str, day: str = "order_date", fmt: str = "parquet") -> None:
    """Write a table by month of ``day``; only the months that ``df`` holds are replaced.

    The partitions change when the job commits, so a job that is interrupted leaves the
    old ones.  Rows without a day have a partition of their own.
    """
    month = F.date_format(day, "yyyyMM").cast("int")
    (df.withColumn("month", month).hint("rebalance", F.col("month"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
     .partitionBy("month").format(fmt).save(path))


def write_document(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write nested document rows as JSON lines (nulls kept), and their schema to ``<path>-schema``."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    df.sparkSession.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(f"{path}-schema")


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A document as it was written; its schema is not guessed from the rows, so an empty one has it too."""
    stored = spark.read.text(f"{path}-schema").first()[0]
    return spark.read.schema(T.StructType.fromJson(json.loads(stored))).json(path)


def write_outputs(base: str, tables: Mapping[str, DataFrame], fmt: str = "parquet",
                  skip_empty: tuple[str, ...] = ("high_risk_customers",)) -> list[str]:
    """Write the pipeline outputs under ``base``; tables listed in
    ``skip_empty`` are written only when they hold a row (checked with a
    one-row probe, not a count)."""
    written = []
    for name, df in tables.items():
        if name in skip_empty and not df.take(1):
            continue
        write_table(df, f"{base.rstrip('/')}/{name}", fmt)
        written.append(name)
    return written
