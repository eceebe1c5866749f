from tidemark.functions.casts import to_date_safe, to_double_safe, to_int_safe
from tidemark.functions.keys import event_key, fingerprint
from tidemark.functions.rates import (
    bin_label,
    days_between,
    depth_bucket,
    percent_text,
    risk_tier,
    safe_rate,
    sigmoid,
    year_quarter,
)
from tidemark.functions.text import blank_to_null, canonical_flag

__all__ = [
    "bin_label",
    "blank_to_null",
    "canonical_flag",
    "days_between",
    "depth_bucket",
    "event_key",
    "fingerprint",
    "percent_text",
    "risk_tier",
    "safe_rate",
    "sigmoid",
    "to_date_safe",
    "to_double_safe",
    "to_int_safe",
    "year_quarter",
]
