"""Column expressions, all built from Spark's own functions."""

from worksledger.functions.dates import duration_days, try_date
from worksledger.functions.flags import in_bbox, is_filled, is_positive
from worksledger.functions.numbers import (
    bucketize,
    coalesce_zero,
    cost_variance,
    exact_avg,
    exact_sum,
    merged_avg,
    merged_sum,
    percent,
    round_half,
    safe_ratio,
    scale_units,
    sum_parts,
    to_int,
)
from worksledger.functions.text import (
    clean_text,
    null_display,
    plain_number,
    strip_spaces,
    truncate_text,
)

__all__ = [
    "bucketize",
    "clean_text",
    "coalesce_zero",
    "cost_variance",
    "duration_days",
    "exact_avg",
    "exact_sum",
    "in_bbox",
    "is_filled",
    "is_positive",
    "merged_avg",
    "merged_sum",
    "null_display",
    "percent",
    "plain_number",
    "round_half",
    "safe_ratio",
    "scale_units",
    "strip_spaces",
    "sum_parts",
    "to_int",
    "truncate_text",
    "try_date",
]
