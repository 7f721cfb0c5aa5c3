"""Lookup joins (J1, J2) with a size-checked broadcast.

A lookup side is broadcast only after a bounded count proves it small; a
larger side falls back to Spark's planner (sort-merge join, which AQE may
still turn into a broadcast or split when skewed).  The count reads at most
``max_rows + 1`` rows, so the check itself does not scale with the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKUP_MAX_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = LOOKUP_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most
    max_rows + 1).  Counted on every use: a lookup may have grown."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df``."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def lookup_join(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str,
                columns: Mapping[str, str], defaults: Mapping[str, object] | None = None,
                max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """Left-join ``lookup`` on ``left_key = right_key`` and add ``columns``
    (lookup name -> output name); unmatched rows get NULL or ``defaults``.

    The lookup is renamed before the join, so joining the same dimension
    in several roles never produces ambiguous columns.  The lookup key must
    be unique for the left join to preserve row counts (see the ``unique``
    check).
    """
    defaults = defaults or {}
    tag = f"_lk_{right_key}_{abs(hash(tuple(columns.values()))) % 10**8}"
    side = lookup.select(F.col(right_key).alias(tag),
                         *[F.col(src).alias(dst) for src, dst in columns.items()])
    side = bounded_broadcast(side, max_rows)
    out = df.join(side, df[left_key] == side[tag], "left").drop(tag)
    for dst, val in defaults.items():
        out = out.withColumn(dst, F.coalesce(F.col(dst), F.lit(val)))
    return out


def role_join(df: DataFrame, dim: DataFrame, key_by_role: Mapping[str, str],
              dim_key: str, columns: Mapping[str, str]) -> DataFrame:
    """Join one dimension in several roles, e.g. pickup and dropoff zone.

    ``key_by_role`` maps a role prefix to the fact's key column; each dim
    column ``c`` arrives as ``f"{role}_{columns[c]}"``.
    """
    small = is_small(dim)
    for role, key in key_by_role.items():
        tag = f"_{role}_{dim_key}"
        side = dim.select(F.col(dim_key).alias(tag),
                          *[F.col(c).alias(f"{role}_{n}") for c, n in columns.items()])
        side = F.broadcast(side) if small else side
        df = df.join(side, df[key] == side[tag], "left").drop(tag)
    return df
