"""Column-level helpers (rounding, exact money sums, NULL-safe clip, dates)."""

from priceloom.functions.dates import day_name, parse_iso_date, parse_mixed_date, year_month
from priceloom.functions.numerics import (
    clip,
    erfc_nonneg,
    exact_avg,
    exact_sum,
    guarded,
    is_true,
    money_sum,
    pct,
    pct_change,
    r,
    safe_div,
    title_case,
    two_sided_p,
)

__all__ = [
    "clip", "day_name", "erfc_nonneg", "exact_avg", "exact_sum", "guarded", "is_true", "money_sum",
    "parse_iso_date", "parse_mixed_date", "pct", "pct_change", "r", "safe_div",
    "title_case", "two_sided_p", "year_month",
]
