"""Exploration queries.

Thin on purpose: each is the DataFrame a Spark user would write.  All
aggregates are partial/final hash aggregations, so a hot key is reduced on
the map side before any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def on_dates(df: DataFrame, ts: str, part_col: str | None, lo, hi, granularity: str = "day") -> DataFrame:
    """O1: ``DATE(ts) BETWEEN lo AND hi`` with partition pruning.

    A predicate on ``to_date(ts)`` alone is pushed as a row-group filter but
    prunes no partition folders; adding the same range on the derived
    partition column (its day, or the first day of its month) does.
    """
    cond = F.to_date(F.col(ts)).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    if part_col:
        first, last = (F.lit(x).cast("date") for x in (lo, hi))
        if granularity == "month":
            first, last = F.trunc(first, "month"), F.trunc(last, "month")
        cond = cond & F.col(part_col).between(first, last)
    return df.filter(cond)


def count_rows(df: DataFrame, alias: str = "trips") -> DataFrame:
    """A1: one-row COUNT(*)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def min_max(df: DataFrame, column, lo: str = "min_ts", hi: str = "max_ts") -> DataFrame:
    """A2."""
    c = F.col(column) if isinstance(column, str) else column
    return df.agg(F.min(c).alias(lo), F.max(c).alias(hi))


def date_span(df: DataFrame, ts: str) -> DataFrame:
    """Min and max day and the exact number of distinct days."""
    d = F.to_date(F.col(ts))
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                  F.countDistinct(d).alias("num_days"))


def trips_by(df: DataFrame, *keys, count_alias: str = "trips",
             order: str = "keys") -> DataFrame:
    """Group count by key columns or expressions.

    ``order='count'`` sorts by count descending (ties by key), else by keys.
    """
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_alias))
    names = [c for c in g.columns if c != count_alias]
    if order == "count":
        return g.orderBy(F.col(count_alias).desc(), *[F.col(n).asc_nulls_first() for n in names])
    return g.orderBy(*[F.col(n).asc_nulls_first() for n in names])


def top_k(df: DataFrame, key: str, k: int = 10, count_alias: str = "trips") -> DataFrame:
    """The k largest groups by count (ties by key); planned as TakeOrdered."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_alias))
    return g.orderBy(F.col(count_alias).desc(), F.col(key).asc_nulls_first()).limit(k)


def partition_counts(df: DataFrame, part_col: str) -> DataFrame:
    """Rows per partition, most rows first (reads the partition column only)."""
    return (df.groupBy(part_col).agg(F.count(F.lit(1)).alias("total_rows"))
              .orderBy(F.col("total_rows").desc(), F.col(part_col)))


def partition_counts_from_catalog(spark: SparkSession, name: str, part_col: str) -> DataFrame:
    """S12 from metadata: the counts that were kept when the table was written
    or last analysed; a partition without one is an error, not a guess."""
    from meterline.operators.sinks import partition_statistics
    kind = spark.table(name).schema[part_col].dataType.simpleString()
    rows = [(None if v == "__HIVE_DEFAULT_PARTITION__" else v, n) for v, n, _ in partition_statistics(spark, name, part_col)]
    if any(n is None for _, n in rows):
        raise ValueError(f"{name} has partitions without statistics")
    return (spark.createDataFrame(rows, "v string, total_rows bigint")
            .select(F.col("v").cast(kind).alias(part_col), "total_rows")
            .orderBy(F.col("total_rows").desc(), F.col(part_col)))


def year_of(ts) -> Column:
    """EXTRACT(YEAR) as BIGINT."""
    return F.year(F.col(ts) if isinstance(ts, str) else ts).cast("bigint")


def month_of(ts) -> Column:
    return F.month(F.col(ts) if isinstance(ts, str) else ts).cast("bigint")


def out_of_range_years(df: DataFrame, ts: str, lo: int, hi: int) -> DataFrame:
    """rows whose year is NOT BETWEEN lo AND hi."""
    # comparisons on the timestamp itself, so that row groups are skipped
    kind, c = df.schema[ts].dataType, F.col(ts)
    return df.filter((c < F.lit(f"{lo:04d}-01-01").cast(kind))
                     | (c >= F.lit(f"{hi + 1:04d}-01-01").cast(kind))).select(ts)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables in one UNION ALL job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def head(df: DataFrame, n: int, order=None) -> DataFrame:
    """First n rows (by ``order`` when given; otherwise any n)."""
    if order is not None:
        df = df.orderBy(*([order] if isinstance(order, (str, Column)) else order))
    return df.limit(n)
