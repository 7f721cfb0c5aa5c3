"""Staging models and the yellow/green union.

All of this stays one lazy plan: renames and casts are projections, the
vendor filter is pushed to the scan, and the union adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.exprs import safe_cast
from meterline.schemas import NUMERIC, TS

AMOUNTS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount"]


def _strict(c: str, t) -> Column:
    return F.col(c).cast(t)


def dev_sample(df: DataFrame, sample_range: tuple | None,
               column: str = "pickup_datetime") -> DataFrame:
    """environment-conditional sample, a half-open range on ``column``."""
    if sample_range is None:
        return df
    lo, hi = sample_range
    return df.filter((F.col(column) >= F.lit(lo).cast(TS)) & (F.col(column) < F.lit(hi).cast(TS)))


def stage_yellow(raw: DataFrame, sample_range: tuple | None = None,
                 carry: Sequence[str] = ()) -> DataFrame:
    """stg_yellow: rename to the shared standard, strict casts, drop NULL vendors."""
    out = raw.filter(F.col("VendorID").isNotNull()).select(
        _strict("VendorID", "int").alias("vendor_id"),
        _strict("RatecodeID", "int").alias("rate_code_id"),
        _strict("PULocationID", "int").alias("pickup_location_id"),
        _strict("DOLocationID", "int").alias("dropoff_location_id"),
        _strict("tpep_pickup_datetime", TS).alias("pickup_datetime"),
        _strict("tpep_dropoff_datetime", TS).alias("dropoff_datetime"),
        _strict("store_and_fwd_flag", "string").alias("store_and_fwd_flag"),
        _strict("passenger_count", "int").alias("passenger_count"),
        _strict("trip_distance", NUMERIC).alias("trip_distance"),
        *[_strict(c, NUMERIC).alias(c) for c in AMOUNTS],
        _strict("improvement_surcharge", NUMERIC).alias("improvement_surcharge"),
        _strict("total_amount", NUMERIC).alias("total_amount"),
        _strict("payment_type", "int").alias("payment_type"),
        *carry,
    )
    return dev_sample(out, sample_range)


def stage_green(raw: DataFrame, sample_range: tuple | None = None,
                carry: Sequence[str] = ()) -> DataFrame:
    """stg_green: like yellow, but rate code, trip type and payment type are
    safe casts (malformed text becomes NULL instead of failing)."""
    out = raw.filter(F.col("VendorID").isNotNull()).select(
        _strict("VendorID", "int").alias("vendor_id"),
        safe_cast("RatecodeID", "int").alias("rate_code_id"),
        _strict("PULocationID", "int").alias("pickup_location_id"),
        _strict("DOLocationID", "int").alias("dropoff_location_id"),
        _strict("lpep_pickup_datetime", TS).alias("pickup_datetime"),
        _strict("lpep_dropoff_datetime", TS).alias("dropoff_datetime"),
        _strict("store_and_fwd_flag", "string").alias("store_and_fwd_flag"),
        _strict("passenger_count", "int").alias("passenger_count"),
        _strict("trip_distance", NUMERIC).alias("trip_distance"),
        safe_cast("trip_type", "int").alias("trip_type"),
        *[_strict(c, NUMERIC).alias(c) for c in AMOUNTS],
        _strict("ehail_fee", NUMERIC).alias("ehail_fee"),
        _strict("improvement_surcharge", NUMERIC).alias("improvement_surcharge"),
        _strict("total_amount", NUMERIC).alias("total_amount"),
        safe_cast("payment_type", "int").alias("payment_type"),
        *carry,
    )
    return dev_sample(out, sample_range)


UNION_COLUMNS = [
    "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount", "payment_type",
    "service_type",
]


def union_trips(green: DataFrame, yellow: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Align both services to one 20-column layout and UNION ALL.

    Yellow trips are street-hail only (trip_type 1) and have no e-hail fee (0).
    """
    filled = {
        "trip_type": F.lit(1).cast("int"),
        "ehail_fee": F.lit(0).cast(NUMERIC),
    }

    def shape(df: DataFrame, service: str) -> DataFrame:
        cols = []
        for c in UNION_COLUMNS:
            if c == "service_type":
                cols.append(F.lit(service).alias(c))
            elif c in df.columns:
                cols.append(F.col(c))
            else:
                cols.append(filled[c].alias(c))
        return df.select(*cols, *carry)

    return shape(green, "Green").unionByName(shape(yellow, "Yellow"))


def concat_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """By-name concatenation; a column missing from a frame becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
