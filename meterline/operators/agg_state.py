"""Aggregates kept up by batches.

``sum`` and ``count`` can be added and subtracted, so a report of sums and
averages need not be rebuilt when some rows of its table change: the state
(sums and counts per group) of the rows that come minus that of the rows they
replace is added to the stored state of the groups' partitions, and only
those partitions are rewritten.  Sums are DECIMAL, so adding and taking away
leaves the same digits as a rebuild.

Distinct values of a bounded whole-number column (days, ids) are kept as
bitmaps that can be OR-ed, which is exact; a value can be added but not taken
away, so a partition whose rows were replaced is built anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import merge, sinks

WIDE = "decimal(38,9)"


def state_of(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], sign: int = 1,
             exact: str = WIDE) -> DataFrame:
    """(keys, n_rows, and per measure s_ (sum) and n_ (values)) of ``rows``;
    with ``sign`` -1 what taking them away adds."""
    one = F.lit(sign).cast("bigint")
    return rows.groupBy(*keys).agg(
        F.sum(one).alias("n_rows"),
        *[F.coalesce(F.sum(F.col(m).cast(exact) * F.lit(sign)), F.lit(0)).cast(exact).alias(f"s_{m}") for m in measures],
        *[F.sum(F.when(F.col(m).isNotNull(), one).otherwise(0)).cast("bigint").alias(f"n_{m}") for m in measures])


def added(state: DataFrame, delta: DataFrame, keys: Sequence[str], exact: str = WIDE) -> DataFrame:
    """Two states (or changes of one) added.  A change may hold no more rows
    than before and still change sums: it keeps its groups."""
    both = state.unionByName(delta)
    values = [c for c in state.columns if c not in keys]
    return both.groupBy(*keys).agg(*[
        F.sum(c).cast(exact if c.startswith("s_") else "bigint").alias(c) for c in values])


def merged(state: DataFrame, delta: DataFrame, keys: Sequence[str], exact: str = WIDE) -> DataFrame:
    """The state after a change; groups without a row left are gone."""
    return added(state, delta, keys, exact).filter("n_rows <> 0")


def total(measure: str) -> Column:
    """The sum, NULL where the group has no value."""
    return F.when(F.col(f"n_{measure}") > 0, F.col(f"s_{measure}"))


def average(measure: str) -> Column:
    return F.col(f"s_{measure}").cast("double") / F.nullif(F.col(f"n_{measure}"), F.lit(0))


def changes(target: DataFrame, batch: DataFrame, key, touched: Column | None = None) -> DataFrame:
    """Rows of ``target`` that an upsert of ``batch`` replaces.  ``touched``
    restricts the target to partitions that can hold them."""
    keys = [key] if isinstance(key, str) else list(key)
    old = target if touched is None else target.filter(touched)
    return old.join(batch.select(*keys).distinct(), keys, "left_semi")


def apply_batch(spark: SparkSession, name: str, path: str, part_col: str, keys: Sequence[str],
                measures: Sequence[str], new: DataFrame, replaced: DataFrame | None = None) -> None:
    """Bring the state table ``name`` (partitioned by ``part_col``, one of
    ``keys``) up to a batch: ``new`` rows come, ``replaced`` rows go.  Only
    partitions the batch touches are read and rewritten; those left empty are
    dropped.

    The state and its table are two writes: bring the state up first, then
    merge the batch.  After a run that broke off in between, :func:`rebuild`
    the batch's partitions from the table before running it again."""
    delta = state_of(new, keys, measures)
    if replaced is not None:
        delta = added(delta, state_of(replaced, keys, measures, -1), keys)
    with sinks.staged(delta, "state_delta") as own:
        created = sinks.create_table_if_absent(spark, own, name, path, partition_by=part_col)
        values = merge.partition_values(own, part_col)
        if not values:
            return
        if created:
            sinks.append_table_partitions(own, name, part_col)
            return
        stored = merge.rows_of_partitions(spark.table(name), part_col, values)
        with sinks.staged(merged(stored.select(*own.columns), own, keys), "state_next") as after:
            left = {str(v) for v in merge.partition_values(after, part_col)}
            if left:
                sinks.overwrite_table_partitions(after, name, part_col)
            had = sinks.listed_partitions(spark, name) & {str(v) for v in values}
            sinks.drop_table_partitions(spark, name, path, part_col, sorted(had - left))


def rebuild(spark: SparkSession, name: str, path: str, part_col: str, keys: Sequence[str],
            measures: Sequence[str], rows: DataFrame, values: Sequence) -> None:
    """Partitions ``values`` of the state anew from ``rows``, the table's."""
    own = state_of(merge.rows_of_partitions(rows, part_col, values), keys, measures)
    with sinks.staged(own, "state_rebuilt") as after:
        left = {str(v) for v in merge.partition_values(after, part_col)}
        if left:
            sinks.overwrite_table_partitions(after, name, part_col)
        had = sinks.listed_partitions(spark, name) & {str(v) for v in values}
        sinks.drop_table_partitions(spark, name, path, part_col, sorted(had - left))


# ----------------------------------------------------------- distinct values

def bitmaps(rows: DataFrame, value: Column, by: Mapping[str, Column] | None = None) -> DataFrame:
    """(by, bucket, bits): which whole numbers occur, 32,768 to a bitmap."""
    by = by or {}
    marked = rows.select(*[c.alias(n) for n, c in by.items()], value.cast("bigint").alias("v")).filter("v is not null")
    return marked.groupBy(*by, F.bitmap_bucket_number("v").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))


def or_bitmaps(maps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of the same group and bucket made one."""
    return maps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_distinct(maps: DataFrame, by: Sequence[str] = (), alias: str = "n") -> DataFrame:
    """How many different values the bitmaps hold, per group or in all."""
    one = or_bitmaps(maps, by)
    return one.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias(alias))
