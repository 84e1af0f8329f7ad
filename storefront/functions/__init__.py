"""Column-expression helpers (all JVM-side, codegen friendly; no Python UDFs)."""

from storefront.functions.numeric import (clean_money, exact_avg, exact_sum, nan_to_null,
                                          ratio, safe_div)
from storefront.functions.dates import (days_between, floor_days, hash_days_before,
                                        to_ts, weekday_mon0)
from storefront.functions.text import DAY_NAMES, truncate_label, weekday_name

__all__ = [
    "clean_money", "exact_avg", "exact_sum", "nan_to_null", "ratio", "safe_div",
    "days_between", "floor_days", "hash_days_before", "to_ts", "weekday_mon0",
    "DAY_NAMES", "truncate_label", "weekday_name",
]
