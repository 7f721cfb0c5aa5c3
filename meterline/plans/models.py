"""Star-schema models: trips, dimensions, fact, monthly revenue mart.

Plan shape (flagship): two scans (yellow, green) -> projections -> UNION ALL
-> one shuffle for the keep-first dedup (partial WindowGroupLimit before it)
-> two broadcast zone joins -> one partial/final aggregation for the mart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.exprs import (
    minutes_between,
    month_start,
    payment_description,
    surrogate_key,
    vendor_name,
)
from meterline.operators.dedup import dedup_first
from meterline.operators.joins import role_join
from meterline.schemas import FCT_TRIPS_CONTRACT, TS, UNKNOWN_ZONE

TRIP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]

TRIPS_COLUMNS = [
    "trip_id", "vendor_id", "service_type", "rate_code_id", "pickup_location_id",
    "dropoff_location_id", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type", "payment_type_description",
]


def build_trips(unioned: DataFrame, tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """int_trips: keep the earliest-dropoff row per natural trip key, then add
    the surrogate ``trip_id``, ``payment_type`` NULL -> 0 and its description.

    Key and description are computed after the dedup (they are functions of
    surviving columns), so the md5 runs only for kept rows.
    """
    extra = list(tie_breakers or [])
    kept = dedup_first(unioned, TRIP_KEY, ["dropoff_datetime"],
                       tie_breakers=tie_breakers, drop=extra)
    return kept.select(
        surrogate_key(kept, TRIP_KEY).alias("trip_id"),
        *[c for c in TRIPS_COLUMNS[1:-2]],
        F.coalesce(F.col("payment_type"), F.lit(0)).alias("payment_type"),
        payment_description("payment_type").alias("payment_type_description"),
    )


def dim_zones(lookup: DataFrame) -> DataFrame:
    """dim_zones: the zone lookup under standard names."""
    return lookup.select(F.col("locationid").cast("int").alias("location_id"),
                         "borough", "zone", "service_zone")


def fct_trips(trips: DataFrame, zones: DataFrame, since=None) -> DataFrame:
    """fct_trips: trips with pickup and dropoff zones (two LEFT joins to one
    dimension) and the trip duration in minutes, in contract column order.

    ``since`` is the incremental high-water mark: only trips with
    ``pickup_datetime > since`` are produced (see ``operators.merge``).
    """
    if since is not None:
        trips = trips.filter(F.col("pickup_datetime") > F.lit(since).cast(TS))
    joined = role_join(trips, zones,
                       {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"},
                       "location_id", {"borough": "borough", "zone": "zone"})
    joined = joined.withColumn("trip_duration_minutes",
                               minutes_between("pickup_datetime", "dropoff_datetime"))
    return joined.select(*[f.name for f in FCT_TRIPS_CONTRACT.fields])


def dim_vendors(fact: DataFrame) -> DataFrame:
    """dim_vendors: distinct vendors of the fact with their names (NULL if unknown).

    Distinct first, name after: the partial aggregate shrinks the fact to a
    handful of rows per task before anything is shuffled.
    """
    return (fact.select("vendor_id").distinct()
                .select("vendor_id", vendor_name("vendor_id").alias("vendor_name")))


MART_SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_ehail_fee": "ehail_fee",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
}


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """fct_monthly_zone_revenue: 8 sums, trip count and 2 averages per
    (pickup zone, month, service).

    The 'Unknown Zone' default is projected *before* grouping, so a NULL
    zone and a zone literally named 'Unknown Zone' form one group.  A hot
    group (e.g. all unknown zones) is absorbed by the partial aggregation.
    """
    keyed = fact.select(
        F.coalesce(F.col("pickup_zone"), F.lit(UNKNOWN_ZONE)).alias("pickup_zone"),
        month_start("pickup_datetime").alias("revenue_month"),
        "service_type", "trip_id", "passenger_count", "trip_distance", *MART_SUMS.values())
    return keyed.groupBy("pickup_zone", "revenue_month", "service_type").agg(
        *[F.sum(src).alias(dst) for dst, src in MART_SUMS.items()],
        F.count("trip_id").alias("total_monthly_trips"),
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        (F.sum("trip_distance").cast("double") / F.nullif(F.count("trip_distance"), F.lit(0)))
        .alias("avg_monthly_trip_distance"),
    )
