"""Ingest of delivered files (S1, S4, S6, S9): tolerant CSV, quarantine, and mappings per supplier.

``ingest_csv`` reads delimited files in one pass.  Column types come from a bounded
sample of rows; a row that does not fit them, or has another number of fields, goes to
the quarantine with its raw line instead of being nulled in silence.

``load_suppliers`` reads the files of several suppliers, renames each supplier's
columns by that supplier's mapping (JSON, ``{standard: [aliases]}``, read through Spark)
and unites them by name.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.functions.numeric import nan_to_null
from storefront.operators.clean import parse_dates
from storefront.operators.mapping import map_columns

#: Rows that the types are taken from, and the share of a column's values that must have the type.
SAMPLE_ROWS = 1_000
TYPE_SHARE = 0.9
BAD_LINE = "_bad_line"
#: Types in the order in which they are tried.
TYPES = ("bigint", "double", "boolean", "timestamp")


@dataclass(frozen=True)
class Ingested:
    """Rows that fit the schema, and ``line, file`` of those that do not."""

    rows: DataFrame
    quarantine: DataFrame


def sampled_schema(spark: SparkSession, path: str, header: bool = True, names: Sequence[str] | None = None,
                   sample_rows: int = SAMPLE_ROWS) -> T.StructType:
    """Column names from the header (or ``names``) and the types of the first ``sample_rows`` rows.

    A column has the first of ``TYPES`` that ``TYPE_SHARE`` of its sampled values can be
    cast to, so a few broken values leave a number column one; otherwise, or without
    values, it is text.  Numbers with a leading zero, such as codes, stay text.
    """
    raw = spark.read.option("header", header).csv(path)
    raw = raw.toDF(*names) if names is not None else raw
    few = raw.limit(sample_rows)
    aggs = []
    for i, c in enumerate(raw.columns):
        v = F.col(f"`{c}`")
        aggs.append(F.count(v).alias(f"n{i}"))
        for t in TYPES:
            fits = v.try_cast(t).isNotNull()
            if t in ("bigint", "double"):
                fits = fits & ~v.rlike(r"^\s*[+-]?0\d")
            aggs.append(F.count_if(fits).alias(f"{t}{i}"))
    got = few.agg(*aggs).first()
    fields = []
    for i, c in enumerate(raw.columns):
        kind = next((t for t in TYPES if got[f"n{i}"] and got[f"{t}{i}"] >= TYPE_SHARE * got[f"n{i}"]), "string")
        fields.append(T.StructField(c, T._parse_datatype_string(kind)))
    return T.StructType(fields)


def ingest_csv(spark: SparkSession, path: str, staging: str, schema: T.StructType | str | None = None, header: bool = True,
               names: Sequence[str] | None = None) -> Ingested:
    """Read delimited files once, write them to ``staging`` and return both parts from there.

    All columns of every line are parsed, whatever is asked of the result later, so a row
    is good or bad once and for all.  A missing path raises.
    """
    if schema is None:
        schema = sampled_schema(spark, path, header, names)
    elif isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    full = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    lines = (spark.read.schema(full).option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False)
             .option("enforceSchema", True).option("columnNameOfCorruptRecord", BAD_LINE).csv(path))
    bad = F.col(BAD_LINE).isNotNull()
    lines = lines.select("*", F.when(bad, F.col("_metadata.file_path")).alias("_file"), bad.alias("_bad"))
    # rows are written as they come: folders for good and bad ones would have each task sort all its rows first
    lines.write.mode("overwrite").parquet(staging)
    back = spark.read.schema(lines.schema).parquet(staging)
    floats = [f.name for f in schema.fields if f.dataType.typeName() in ("double", "float")]
    good = back.where(~F.col("_bad")).select(*[(nan_to_null(F.col(f"`{f.name}`")).alias(f.name) if f.name in floats else F.col(f"`{f.name}`"))
                                               for f in schema.fields])
    return Ingested(good, back.where("_bad").select(F.col(BAD_LINE).alias("line"), F.col("_file").alias("file")))


def read_mappings(spark: SparkSession, folder: str) -> dict[str, dict[str, list[str]]]:
    """``supplier -> {standard: [aliases]}`` of every ``<supplier>.json`` in a folder of any store; one row each."""
    found = spark.read.text(f"{folder.rstrip('/')}/*.json", wholetext=True).select("value", F.col("_metadata.file_path").alias("p")).collect()
    out = {}
    for r in found:
        parts = [p for p in r.p.split("/") if p.endswith(".json")]
        data = json.loads(r.value)
        out[parts[0][:-len(".json")]] = {str(k): [str(a) for a in v] for k, v in data.items()}
    return out


def load_suppliers(spark: SparkSession, sources: Mapping[str, str], mappings: Mapping[str, Mapping[str, Sequence[str]]],
                   default: Mapping[str, Sequence[str]] | None = None, date_columns: Sequence[str] = ("order_date",),
                   keep_unmapped: bool = False) -> DataFrame:
    """S6+S4+S2: the files of every supplier under standard names, with a column ``supplier``.

    ``sources`` are paths by supplier.  A supplier without a mapping takes ``default``; one
    without either raises.  A standard column that a supplier lacks is null there; numbers
    of different types meet in the wider one.
    """
    parts = []
    for supplier in sorted(sources):
        mapping = mappings.get(supplier, default)
        if mapping is None:
            raise KeyError(f"no mapping for supplier {supplier!r}")
        path = sources[supplier]
        raw = spark.read.schema(sampled_schema(spark, path)).option("header", True).csv(path)
        mapped = map_columns(raw, mapping, keep_unmapped)
        mapped = parse_dates(mapped, [c for c in date_columns if c in mapped.columns])
        parts.append(mapped.withColumn("supplier", F.lit(supplier)))
    return _united(parts)


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that is a number everywhere becomes double if it is one somewhere, others text."""
    kinds: dict[str, set[str]] = {}
    for p in parts:
        for f in p.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())

    def common(c: str) -> Column:
        own = kinds[c]
        to = None if len(own) == 1 else "double" if own <= {"bigint", "int", "double"} else "string"
        return F.col(f"`{c}`") if to is None else F.col(f"`{c}`").cast(to).alias(c)

    out = None
    for p in parts:
        p = p.select(*[common(c) for c in p.columns])
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out
