"""Input readers.

* ``read_table`` reads CSV (header row) or parquet/JSON; a missing path raises.
* ``load_table`` = read + column mapping + date parsing in one lazy plan.
* ``rank_sources`` picks the most order-like file among candidates: the file
  listing and headers are metadata (one row per file); the scoring and the
  choice are DataFrame expressions.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from storefront.functions.numeric import nan_to_null
from storefront.operators.clean import parse_dates
from storefront.operators.mapping import map_columns

# Header keywords and file-name hints of the source auto-detection.
ORDER_KEYWORDS = ["order_id", "order_date", "customer_id", "product_id", "quantity", "order_value"]
REVIEW_KEYWORDS = ["product_name", "actual_price", "discounted_price", "review_id", "user_id"]
NAME_HINTS = ["superstore", "orders", "amazon"]
ORDER_KEYWORD_POINTS = 2
REVIEW_KEYWORD_POINTS = 1
NAME_HINT_POINTS = 1


def _fmt(path: str) -> str:
    p = path.lower().rstrip("/")
    for ext, fmt in ((".csv", "csv"), (".json", "json"), (".parquet", "parquet"), (".orc", "orc")):
        if p.endswith(ext):
            return fmt
    return "parquet"


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: StructType | str | None = None) -> DataFrame:
    """Read one table; CSV has a header row; types are inferred unless a schema is given."""
    fmt = fmt or _fmt(path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None) \
                       .option("mode", "PERMISSIVE")
    return reader.format(fmt).load(path)


def load_table(spark: SparkSession, path: str, mapping: Mapping[str, Sequence[str]] | None = None,
               date_columns: Sequence[str] = (), fmt: str | None = None,
               schema: StructType | str | None = None) -> DataFrame:
    """S1+S4+S2: read, map vendor headers to standard names, parse dates (bad -> NULL), NaN -> NULL."""
    df = read_table(spark, path, fmt, schema)
    if mapping:
        df = map_columns(df, mapping)
    if date_columns:
        df = parse_dates(df, [c for c in date_columns if c in df.columns])
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df


def read_if_present(spark: SparkSession, path: str, fmt: str | None = None,
                    schema: StructType | str | None = None) -> DataFrame | None:
    """Read an output back if it exists, else None (the feature is skipped).

    Only an absent path counts as absent; a corrupt or unreadable input raises.
    """
    return read_table(spark, path, fmt, schema) if _length(spark, path) is not None else None


def _length(spark: SparkSession, path: str) -> int | None:
    """Bytes under a path on any file system, None if there is nothing: one metadata call."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(place).getLength()) if fs.exists(place) else None


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names: the header line of a CSV, the footer of a Parquet or ORC file; no type inference."""
    if _fmt(path) == "csv":
        return spark.read.option("header", True).csv(path).columns
    return read_table(spark, path).columns


def source_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per candidate file: path, size in bytes, header column names (metadata only)."""
    rows = [(p, _length(spark, p) or 0, _header(spark, p)) for p in paths]
    return spark.createDataFrame(rows, "path string, size long, header array<string>")


def score_sources(headers: DataFrame) -> DataFrame:
    """S3: +2 per order keyword and +1 per review keyword contained in any
    lower-cased header, +1 when the file name hints at orders."""
    low = F.transform(F.col("header"), lambda c: F.lower(c))

    def has(k):
        return F.exists(low, lambda c: c.contains(k)).cast("int")
    score = sum((has(k) * ORDER_KEYWORD_POINTS for k in ORDER_KEYWORDS), F.lit(0)) + \
        sum((has(k) * REVIEW_KEYWORD_POINTS for k in REVIEW_KEYWORDS), F.lit(0))
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    hint = F.when(F.lit(False) | _any_contains(name, NAME_HINTS), NAME_HINT_POINTS).otherwise(0)
    return headers.withColumn("score", score + hint)


def _any_contains(c, words):
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def rank_sources(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """S3: candidates ranked by (score desc, size desc); the first row is the pick."""
    keep = [p for p in paths if os.path.splitext(p.lower())[1] in (".csv", ".parquet", ".json")]
    scored = score_sources(source_headers(spark, keep))
    return scored.orderBy(F.col("score").desc(), F.col("size").desc(), F.col("path").asc())
