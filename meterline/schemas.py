"""Explicit schemas, fixed lookup values and output contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# NUMERIC is always written with an explicit precision: a bare
# ``CAST(x AS NUMERIC)`` would be DECIMAL(10,0) in Spark and drop the cents.
NUMERIC = T.DecimalType(38, 9)

# Timestamps stay zone-free (TIMESTAMP_NTZ), like the parquet inputs, so no
# result depends on the session time zone.
TS = T.TimestampNTZType()

# --- fixed values (must equal the reference's for matching results) --------
# Payment type codes and names; anything else (incl. NULL) is 'Unknown'.
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_TYPES_DEFAULT = "Unknown"
# Vendor ids and names; other ids get NULL (no ELSE branch).
VENDORS = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}
SERVICE_TYPES = ("Green", "Yellow")
UNKNOWN_ZONE = "Unknown Zone"
LOOKUP_MISS = "unknown"
# -----------------------------------------------------------------------------


def _fields(*pairs):
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


S, L = T.StringType(), T.LongType()

# Raw yellow month file, CSV column order.
YELLOW_RAW = _fields(
    ("VendorID", S), ("tpep_pickup_datetime", TS), ("tpep_dropoff_datetime", TS),
    ("passenger_count", L), ("trip_distance", NUMERIC), ("RatecodeID", S),
    ("store_and_fwd_flag", S), ("PULocationID", S), ("DOLocationID", S),
    ("payment_type", L), ("fare_amount", NUMERIC), ("extra", NUMERIC),
    ("mta_tax", NUMERIC), ("tip_amount", NUMERIC), ("tolls_amount", NUMERIC),
    ("improvement_surcharge", NUMERIC), ("total_amount", NUMERIC),
    ("congestion_surcharge", NUMERIC),
)

# Raw green month file, CSV column order.
GREEN_RAW = _fields(
    ("VendorID", S), ("lpep_pickup_datetime", TS), ("lpep_dropoff_datetime", TS),
    ("store_and_fwd_flag", S), ("RatecodeID", S), ("PULocationID", S),
    ("DOLocationID", S), ("passenger_count", L), ("trip_distance", NUMERIC),
    ("fare_amount", NUMERIC), ("extra", NUMERIC), ("mta_tax", NUMERIC),
    ("tip_amount", NUMERIC), ("tolls_amount", NUMERIC), ("ehail_fee", NUMERIC),
    ("improvement_surcharge", NUMERIC), ("total_amount", NUMERIC),
    ("payment_type", L), ("trip_type", S), ("congestion_surcharge", NUMERIC),
)

RAW_SCHEMAS = {"yellow": YELLOW_RAW, "green": GREEN_RAW}
PICKUP_COLUMN = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}
DROPOFF_COLUMN = {"yellow": "tpep_dropoff_datetime", "green": "lpep_dropoff_datetime"}

# Columns of the row fingerprint (vendor, pickup, dropoff, PU, DO).
FINGERPRINT_COLUMNS = {
    svc: ["VendorID", PICKUP_COLUMN[svc], DROPOFF_COLUMN[svc], "PULocationID", "DOLocationID"]
    for svc in ("yellow", "green")
}

PAYMENT_LOOKUP = _fields(("payment_type_id", T.IntegerType()), ("payment_type_name", S))

ZONE_LOOKUP = _fields(("locationid", T.IntegerType()), ("borough", S), ("zone", S),
                      ("service_zone", S))

# Interval-pipeline ingest columns, in declared order (ids integer, amounts double).
INTERVAL_COLUMNS = [
    "vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "pu_location_id", "do_location_id", "payment_type", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "taxi_type", "extracted_at",
]
INTERVAL_REQUIRED = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "taxi_type"]

I = T.IntegerType()
# Output contract of the trip fact (names and types, in order).
FCT_TRIPS_CONTRACT = _fields(
    ("trip_id", S), ("vendor_id", I), ("service_type", S), ("rate_code_id", I),
    ("pickup_location_id", I), ("pickup_borough", S), ("pickup_zone", S),
    ("dropoff_location_id", I), ("dropoff_borough", S), ("dropoff_zone", S),
    ("pickup_datetime", TS), ("dropoff_datetime", TS), ("store_and_fwd_flag", S),
    ("passenger_count", I), ("trip_distance", NUMERIC), ("trip_type", I),
    ("trip_duration_minutes", L), ("fare_amount", NUMERIC), ("extra", NUMERIC),
    ("mta_tax", NUMERIC), ("tip_amount", NUMERIC), ("tolls_amount", NUMERIC),
    ("ehail_fee", NUMERIC), ("improvement_surcharge", NUMERIC), ("total_amount", NUMERIC),
    ("payment_type", I), ("payment_type_description", S),
)
