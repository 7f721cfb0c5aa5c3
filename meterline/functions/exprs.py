"""Scalar expressions (ids X1-X10, P4).

Everything here returns a built-in Column expression, so it stays inside
whole-stage codegen; there are no Python UDFs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import PAYMENT_TYPES, PAYMENT_TYPES_DEFAULT, VENDORS

# Text form of a timestamp inside keys: fixed width, microseconds included,
# independent of the session time zone (inputs are TIMESTAMP_NTZ).
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
KEY_NULL = "__null__"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c, data_type) -> Column:
    """Cast that yields NULL instead of failing on malformed text."""
    return _col(c).try_cast(data_type)


def ts_text(c) -> Column:
    return F.date_format(_col(c), TS_TEXT_FORMAT)


def _text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return ts_text(name)
    return F.col(name).cast("string")


def row_fingerprint(df: DataFrame, names: list[str], sep: str = "") -> Column:
    """md5 over the concatenated text of ``names``; NULL counts as ''.

    The default has no separator, as loaded warehouses do it (so ('1','23')
    and ('12','3') collide); pass ``sep`` for a collision-safe key.
    """
    parts = [F.coalesce(_text(df, n), F.lit("")) for n in names]
    joined = F.concat_ws(sep, *parts) if sep else F.concat(*parts)
    return F.md5(joined)


def surrogate_key(df: DataFrame, names: list[str]) -> Column:
    """32-hex surrogate key over ``names``: md5 of '-'-joined text, NULL sentinel."""
    parts = [F.coalesce(_text(df, n), F.lit(KEY_NULL)) for n in names]
    return F.md5(F.concat_ws("-", *parts))


def case_map(c, mapping: Mapping, default=None) -> Column:
    """CASE c WHEN k THEN v ... [ELSE default] END, built from a dict."""
    c = _col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def payment_description(c) -> Column:
    return case_map(c, PAYMENT_TYPES, PAYMENT_TYPES_DEFAULT)


def vendor_name(c) -> Column:
    return case_map(c, VENDORS)


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (BIGINT, may be negative).

    10:00:59 -> 10:01:01 is 1, like a warehouse ``datediff(minute)``; elapsed-time
    functions would give 0.  Truncating both ends to the minute first turns the
    elapsed count into a boundary count; it is computed from calendar fields so
    it does not depend on the session time zone.
    """
    a, b = _col(start), _col(end)
    day_gap = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    minute_of_day = lambda c: F.hour(c) * 60 + F.minute(c)
    return (day_gap * 1440 + minute_of_day(b) - minute_of_day(a)).cast("bigint")


def month_start(ts) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(F.to_date(_col(ts)), "month")


def month_label(ts, sep: str = "-") -> Column:
    """X10: 'yyyy-MM' (or 'yyyy_MM') label of a timestamp."""
    return F.date_format(_col(ts), f"yyyy{sep}MM")
