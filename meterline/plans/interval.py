"""Interval pipeline: ingest -> staged trips -> daily report (U2, P5-P7, F2,
W2, J2, A8, A9, V1, V2, K12).

Each step is a pure DataFrame function over a half-open run interval
``[start, end)``; :func:`run_interval` chains them and replaces exactly that
interval of the persisted staging and report tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.dedup import dedup_first
from meterline.operators.joins import lookup_join
from meterline.operators.merge import in_interval
from meterline.plans.staging import concat_by_name
from meterline.schemas import INTERVAL_COLUMNS, INTERVAL_REQUIRED, LOOKUP_MISS, TS

# Service-specific and CamelCase names -> the pipeline's standard names.
RENAMES = {
    "VendorID": "vendor_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "lpep_pickup_datetime": "tpep_pickup_datetime",
    "lpep_dropoff_datetime": "tpep_dropoff_datetime",
}


def ingest(frames_by_service: Mapping[str, DataFrame], extracted_at=None,
           carry: Sequence[str] = ()) -> DataFrame:
    """Tag each taxi type's frame, concatenate by name, keep the declared columns.

    Fixes two defects of a literal port: the vendor id is renamed (otherwise
    the declared ``vendor_id`` silently disappears) and green ``lpep_*``
    times are mapped to the shared pickup/dropoff names (otherwise the
    interval filter later drops every green row).  A missing required column
    is an error.
    """
    if not frames_by_service:
        raise ValueError("no data fetched")
    stamp = (F.current_timestamp().cast(TS) if extracted_at is None
             else F.lit(extracted_at).cast(TS))
    tagged = []
    for service, df in frames_by_service.items():
        df = df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})
        tagged.append(df.withColumn("taxi_type", F.lit(service))
                        .withColumn("extracted_at", stamp))
    out = concat_by_name(tagged)
    missing = [c for c in INTERVAL_REQUIRED if c not in out.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    keep = [c for c in INTERVAL_COLUMNS if c in out.columns]
    return out.select(*keep, *carry)


def _check_bounds(start, end, granularity: str):
    s, e = (dt.datetime.fromisoformat(str(x)) for x in (start, end))
    if s >= e:
        raise ValueError("interval start must precede end")
    if granularity == "date" and any(x.time() != dt.time(0) for x in (s, e)):
        raise ValueError("a date-granular interval needs day-aligned bounds")
    return s, e


STAGING_KEY = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "pu_location_id",
               "do_location_id", "fare_amount", "taxi_type"]


def interval_staging(trips: DataFrame, lookup: DataFrame, start, end,
                     tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """staging.trips for ``[start, end)``: dedup on the 6-column trip key,
    payment name from the lookup ('unknown' when missing), fares >= 0.

    The fare filter is on a dedup key column, so applying it before the
    dedup is equivalent and shrinks the shuffle.  The kept row is chosen by
    a total order (pickup, then tie-breakers) so reruns agree.
    """
    s, e = _check_bounds(start, end, "timestamp")
    rows = trips.filter(in_interval("tpep_pickup_datetime", s, e)).filter(F.col("fare_amount") >= 0)
    extra = list(tie_breakers or [])
    kept = dedup_first(rows, STAGING_KEY, ["tpep_pickup_datetime"],
                       tie_breakers=tie_breakers, drop=extra)
    joined = lookup_join(kept, lookup, "payment_type", "payment_type_id",
                         {"payment_type_name": "payment_type_name"},
                         defaults={"payment_type_name": LOOKUP_MISS})
    return joined.select(
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        F.col("pu_location_id").alias("pickup_location_id"),
        F.col("do_location_id").alias("dropoff_location_id"),
        "taxi_type", "passenger_count", "trip_distance", "payment_type", "payment_type_name",
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "total_amount", "extracted_at")


MONEY_SCALE = "decimal(18,4)"


def exact_sum(c: str, scale: str = MONEY_SCALE):
    """Sum of a money/distance column, exact at the places of ``scale`` (four;
    the trip files have at most two).  Give a wider one for finer inputs:
    values are rounded to it before they are added.

    Floating-point sums depend on the order rows arrive in, which differs
    with partitioning; summing as DECIMAL makes the report reproducible on
    any cluster layout.  The result is returned as DOUBLE.
    """
    return F.sum(F.col(c).cast(scale)).cast("double")


def exact_avg(c: str, scale: str = MONEY_SCALE):
    """Average = exact sum / non-NULL count (NULL for no values)."""
    return exact_sum(c, scale) / F.nullif(F.count(c), F.lit(0))


def report_measures(scale: str = MONEY_SCALE) -> list:
    """What the daily reports say of a group of trips."""
    return [F.count(F.lit(1)).alias("total_trips"),
            exact_sum("fare_amount", scale).alias("total_fare_amount"),
            exact_avg("fare_amount", scale).alias("avg_fare_amount"),
            exact_sum("tip_amount", scale).alias("total_tip_amount"),
            exact_avg("tip_amount", scale).alias("avg_tip_amount"),
            exact_sum("trip_distance", scale).alias("total_trip_distance"),
            exact_avg("trip_distance", scale).alias("avg_trip_distance")]


def daily_report(staged: DataFrame, start, end, by_payment: bool = False,
                 ordered: bool = True, scale: str = MONEY_SCALE) -> DataFrame:
    """reports.trips_report: per day and taxi type (and payment type when
    ``by_payment``): trips, fare/tip/distance sums and averages, sorted
    (``ordered=False`` skips the global sort, e.g. when the report is
    written to a table)."""
    s, e = _check_bounds(start, end, "date")
    keys = [F.to_date("pickup_datetime").alias("pickup_date"), F.col("taxi_type")]
    if by_payment:
        keys.append(F.col("payment_type"))
    g = (staged.filter(in_interval("pickup_datetime", s, e))
               .groupBy(*keys)
               .agg(*report_measures(scale)))
    if not ordered:
        return g
    order = ["pickup_date", "taxi_type"] + (["payment_type"] if by_payment else [])
    return g.orderBy(*order)


def daily_reports(staged: DataFrame, start, end, scale: str = MONEY_SCALE) -> DataFrame:
    """A8 and A9 in one pass: rows of the report by day and taxi type
    (``report`` "taxi_type", payment type NULL) and of the one by payment type
    too ("payment_type"), by GROUPING SETS over one scan.  ``grouping`` tells
    a payment type that is NULL from one that was rolled up."""
    s, e = _check_bounds(start, end, "date")
    rows = staged.filter(in_interval("pickup_datetime", s, e)).withColumn("pickup_date", F.to_date("pickup_datetime"))
    keys = [F.col("pickup_date"), F.col("taxi_type"), F.col("payment_type")]
    return (rows.groupingSets([keys[:2], keys], *keys)
            .agg(F.when(F.grouping("payment_type") == 1, "taxi_type").otherwise("payment_type").alias("report"),
                 F.count(F.lit(1)).alias("total_trips"),
                 *[c for name in ("fare_amount", "tip_amount", "trip_distance")
                   for c in (exact_sum(name, scale).alias(f"total_{name}"), exact_avg(name, scale).alias(f"avg_{name}"))]))


# --- one run of the pipeline, persisted ---------------------------------------------------

MONTH_COL = "pickup_month"


def month_of(c: Column) -> Column:
    """Partition value of a pickup time or day: the first day of its month."""
    return F.trunc(F.to_date(c), "month")


@dataclass(frozen=True)
class IntervalTables:
    """Catalog names and folders (under the shared folder) of the persisted
    staging and report tables."""
    staging: str
    staging_path: str
    report: str
    report_path: str


def run_interval(spark: SparkSession, frames_by_service: Mapping[str, DataFrame],
                 lookup: DataFrame, start, end, tables: IntervalTables, extracted_at=None,
                 tie_breakers: Sequence[str] | None = None) -> None:
    """One scheduled run for ``[start, end)``: ingest -> staged trips ->
    daily report, where both persisted tables replace exactly the run's
    interval (the time-interval strategy, K12), so reruns and backfills
    are idempotent.

    Both tables are partitioned by pickup month: a run lists, reads and
    rewrites only the months its interval touches, however long the
    tables' history.  The report is built from the staging *table*, so a
    run that re-stages part of a month reports it from the full month's
    rows.  Bounds must be day-aligned (the report is date-granular).
    """
    from meterline.operators.merge import replace_interval_table
    s, e = _check_bounds(start, end, "date")
    carry = list(tie_breakers or [])
    staged = interval_staging(ingest(frames_by_service, extracted_at, carry=carry), lookup,
                              s, e, tie_breakers=tie_breakers)
    staged = staged.withColumn(MONTH_COL, month_of(F.col("pickup_datetime")))
    replace_interval_table(spark, staged, tables.staging, tables.staging_path,
                           "pickup_datetime", s, e, MONTH_COL, month_of)
    months = F.col(MONTH_COL).between(month_of(F.lit(s.date())), month_of(F.lit(e.date())))
    report = daily_report(spark.table(tables.staging).filter(months), s, e, ordered=False)
    report = report.withColumn(MONTH_COL, month_of(F.col("pickup_date")))
    replace_interval_table(spark, report, tables.report, tables.report_path,
                           "pickup_date", s.date(), e.date(), MONTH_COL, month_of)
