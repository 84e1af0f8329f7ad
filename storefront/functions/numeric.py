"""Numeric column helpers.

Sums are accumulated so that they hardly depend on the order in which partitions
are combined: the part of a value down to 4 decimals adds up exactly in DECIMAL,
the rest (below 0.0001) adds up in DOUBLE, and the two are added once at the end.
Nothing of a value is cut off.  NaN and infinity count as missing, as in pandas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Decimals of a value that are summed exactly; what lies below is summed in double.
EXACT_SCALE = 4


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c) -> Column:
    """Sum of all values that are neither NULL nor NaN; NULL without any."""
    x = nan_to_null(_col(c).cast("double"))
    high = x.cast(DecimalType(38, EXACT_SCALE))
    return F.sum(high).cast("double") + F.sum(x - high.cast("double"))


def exact_value(c) -> Column:
    """``exact_sum`` and ``exact_avg`` of a single value."""
    x = nan_to_null(_col(c).cast("double"))
    high = x.cast(DecimalType(38, EXACT_SCALE)).cast("double")
    return high + (x - high)


def exact_avg(c) -> Column:
    """Mean of the values that are neither NULL nor NaN, like pandas ``mean``."""
    return F.try_divide(exact_sum(c), F.count(nan_to_null(_col(c).cast("double"))))


def nan_to_null(c) -> Column:
    """pandas treats NaN and +-inf as missing; Spark does not. Turn them into NULL."""
    c = _col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def safe_div(num, den) -> Column:
    """Division that yields NULL on a zero or NULL divisor instead of failing."""
    return F.try_divide(_col(num), _col(den))


def ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def clean_money(c) -> Column:
    """Currency text -> number: keep only digits, '.', '-', then a lenient cast.

    '₹1,299.50' -> 1299.5; '1-2' -> NULL; '' -> NULL (an empty string does not
    cast).  The result is never NaN or infinite (letters are removed first).
    One regex and one cast, no repeated sub-expression: the generated code
    stays small enough for the JIT even when many columns are cleaned at once.
    """
    return F.regexp_replace(_col(c).cast("string"), r"[^0-9.\-]", "").try_cast("double")
