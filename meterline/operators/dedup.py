"""Keep-first deduplication.

``row_number() = 1`` over the key.  Spark plans this as a *partial*
WindowGroupLimit before the shuffle, so every map task already reduces a key
to one row: a key holding a third of all rows ships one row per map task,
not a third of the table into one reducer.

Ties are broken by a total order (the caller's tie-breakers, else every
remaining column), so the survivor does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_col(c) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence,
                tie_breakers: Sequence[str] | None = None,
                drop: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per ``keys`` ordered by ``order`` then ``tie_breakers``.

    NULL key values form one group (window partitioning groups NULLs).
    ``tie_breakers=None`` uses all other columns, which makes the result
    deterministic for any input.  ``drop`` lists helper columns to remove
    from the output (e.g. tie-breakers carried only for this step).
    """
    if tie_breakers is None:
        named = set(keys) | {c for c in order if isinstance(c, str)}
        tie_breakers = [c for c in df.columns if c not in named]
    w = Window.partitionBy(*keys).orderBy(*[_order_col(c) for c in order],
                                          *[_order_col(c) for c in tie_breakers])
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return out.drop(*drop) if drop else out
