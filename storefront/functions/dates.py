"""Date helpers with pandas semantics.

* ``floor_days(ref, ts)`` is pandas ``(ref - ts).dt.days``: the floor of elapsed
  days, not the count of midnights (``datediff``) nor a truncation toward zero.
* ``weekday_mon0`` is pandas ``dayofweek`` (Monday = 0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c) -> Column:
    """Any date/timestamp/timestamp_ntz column as TIMESTAMP (session zone UTC)."""
    return _col(c).cast("timestamp")


def ts_lit(value: str) -> Column:
    return F.lit(value).cast("timestamp")


def floor_days(ref, ts) -> Column:
    """floor((ref - ts) / 1 day) as BIGINT; NULL when ts is NULL."""
    ref_c = ts_lit(ref) if isinstance(ref, str) else _col(ref)
    secs = F.unix_timestamp(to_ts(ref_c)) - F.unix_timestamp(to_ts(ts))
    return F.floor(secs / F.lit(86400.0))


def days_between(later, earlier) -> Column:
    """floor((later - earlier) / 1 day) for two timestamp columns."""
    secs = F.unix_timestamp(to_ts(later)) - F.unix_timestamp(to_ts(earlier))
    return F.floor(secs / F.lit(86400.0))


def weekday_mon0(ts) -> Column:
    return F.weekday(_col(ts))


def hash_days_before(ref: str, key, lo: int, hi: int) -> Column:
    """Deterministic 'random' day offset in [lo, hi) per key, as ref - offset days.

    Replaces a seeded numpy draw: the value depends only on the key, so it is the
    same whatever the partitioning or the number of executors.  Uses md5 so the
    same number can be recomputed by any SQL engine.
    """
    return F.date_sub(F.lit(ref).cast("date"), hash_offset(key, lo, hi).cast("int")).cast("timestamp")


def hash_offset(key, lo: int, hi: int) -> Column:
    h = F.conv(F.substring(F.md5(_col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.lit(lo) + F.pmod(h, F.lit(hi - lo))
