"""Column -> Column helpers (the reference's SQL macros, as Python functions)."""

from meterline.functions.exprs import (
    case_map,
    minutes_between,
    month_label,
    month_start,
    payment_description,
    row_fingerprint,
    safe_cast,
    surrogate_key,
    ts_text,
    vendor_name,
)

__all__ = [
    "case_map", "minutes_between", "month_label", "month_start", "payment_description",
    "row_fingerprint", "safe_cast", "surrogate_key", "ts_text", "vendor_name",
]
