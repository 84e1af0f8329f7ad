"""String helpers for report labels and formatted KPI values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Monday first (pandas dayofweek order).
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate_label(c, max_len: int = 40) -> Column:
    """Labels longer than max_len become their first max_len-3 chars + '...'."""
    s = _col(c).cast("string")
    return F.when(F.length(s) <= max_len, s).otherwise(
        F.concat(F.substring(s, 1, max_len - 3), F.lit("...")))


def weekday_name(day_of_week) -> Column:
    """0..6 -> Monday..Sunday; other values -> 'Day <n>'."""
    d = _col(day_of_week)
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.when((d >= 0) & (d < len(DAY_NAMES)), F.element_at(names, (d + 1).cast("int"))) \
        .otherwise(F.concat(F.lit("Day "), d.cast("string")))


def money_text(c, decimals: int = 2) -> Column:
    """'₹1,234.56' style text."""
    return F.concat(F.lit("₹"), F.format_number(_col(c), decimals))


def pct_text(c, decimals: int = 1) -> Column:
    """fraction -> '12.3%' style text."""
    return F.concat(F.format_number(_col(c) * 100, decimals), F.lit("%"))
