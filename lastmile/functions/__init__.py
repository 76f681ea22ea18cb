"""Column-level building blocks (built-in Spark expressions only)."""

from lastmile.functions.numeric import count_where, mean_rounded, money_limbs, money_of, money_sum, ratio_pct, round2, summable
from lastmile.functions.text import (
    canonical_city, canonical_contract, canonical_value, fix_decimal_comma, pad_zip, to_double,
)
from lastmile.functions.timecols import (
    elapsed_seconds, epoch_seconds, on_time_flag, parse_date, parse_mixed_timestamp,
    transit_hours, with_time_dimensions,
)

__all__ = [
    "canonical_city", "canonical_contract", "canonical_value", "count_where", "elapsed_seconds",
    "epoch_seconds", "fix_decimal_comma", "mean_rounded", "money_limbs", "money_of", "money_sum", "on_time_flag", "pad_zip",
    "parse_date", "parse_mixed_timestamp", "ratio_pct", "round2", "summable", "to_double", "transit_hours",
    "with_time_dimensions",
]
