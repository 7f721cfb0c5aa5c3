"""DuckDB SQL used as the independent oracle for every registered query.

Written by hand from the semantics (not generated from the Spark plans), so
agreement between the two is a real check.  The trip adapter is a CTE chain
over the test tables; each query text prefixes the CTEs it needs.
"""

from __future__ import annotations

# --- trip adapter, raw frames ------------------------------------------------
_TA = """
ta_base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
    CAST(NULLIF(l.l_linenumber % 5, 0) AS VARCHAR) AS VendorID,
    o.o_orderdate AS pickup_ts, l.l_shipdate AS dropoff_ts,
    CASE WHEN l.l_linenumber % 2 = 0 AND o.o_orderkey % 11 = 0 THEN 'bad'
         ELSE CAST(l.l_partkey % 6 + 1 AS VARCHAR) END AS RatecodeID,
    CASE WHEN l.l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l.l_quantity AS BIGINT) % 7 AS passenger_count,
    CAST(CAST(CAST(l.l_quantity AS DECIMAL(18,2)) / 2 AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS trip_distance,
    CAST(CASE WHEN c.c_nationkey = 24 THEN 999 WHEN c.c_nationkey = 23 THEN NULL
              ELSE c.c_nationkey END AS VARCHAR) AS PULocationID,
    CAST(s.s_nationkey AS VARCHAR) AS DOLocationID,
    CAST(NULLIF(o.o_orderkey % 7, 0) AS BIGINT) AS payment_type,
    CASE WHEN o.o_orderkey % 53 = 0 THEN CAST(0 AS DECIMAL(18,2))
         WHEN o.o_orderkey % 50 = 0 THEN -CAST(l.l_extendedprice AS DECIMAL(18,2))
         ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS fare2,
    l.l_discount, l.l_tax,
    CASE WHEN l.l_linenumber = 2 THEN '1' ELSE '2' END AS trip_type
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
ta AS (
  SELECT *,
    CAST(fare2 * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS tip4,
    CAST(fare2 * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS tolls4
  FROM ta_base
),
ta_amounts AS (
  SELECT *,
    CAST(fare2 AS DECIMAL(38,9)) AS fare_amount,
    CAST(0.5 AS DECIMAL(38,9)) AS extra,
    CAST(0.5 AS DECIMAL(38,9)) AS mta_tax,
    CAST(tip4 AS DECIMAL(38,9)) AS tip_amount,
    CAST(tolls4 AS DECIMAL(38,9)) AS tolls_amount,
    CAST(0.3 AS DECIMAL(38,9)) AS improvement_surcharge,
    CAST(CAST(fare2 + 0.5 + 0.5 + tip4 + tolls4 + 0.3 + 2.5 AS DECIMAL(18,4)) AS DECIMAL(38,9)) AS total_amount,
    CAST(2.5 AS DECIMAL(38,9)) AS congestion_surcharge
  FROM ta
),
ta_yellow AS (
  SELECT VendorID, pickup_ts AS tpep_pickup_datetime, dropoff_ts AS tpep_dropoff_datetime,
    passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID,
    payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM ta_amounts WHERE l_linenumber % 2 = 1
),
ta_green AS (
  SELECT VendorID, pickup_ts AS lpep_pickup_datetime, dropoff_ts AS lpep_dropoff_datetime,
    store_and_fwd_flag, RatecodeID, PULocationID, DOLocationID, passenger_count, trip_distance,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, CAST(NULL AS DECIMAL(38,9)) AS ehail_fee,
    improvement_surcharge, total_amount, payment_type, trip_type, congestion_surcharge,
    l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM ta_amounts WHERE l_linenumber % 2 = 0
)"""

# --- staging, union, dedup, zones, fact ---------------------------------------
_STG = """
stg_yellow AS (
  SELECT CAST(VendorID AS INTEGER) AS vendor_id, CAST(RatecodeID AS INTEGER) AS rate_code_id,
    CAST(PULocationID AS INTEGER) AS pickup_location_id, CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
    tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
    store_and_fwd_flag, CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
    CAST(payment_type AS INTEGER) AS payment_type, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM ta_yellow WHERE VendorID IS NOT NULL
),
stg_green AS (
  SELECT CAST(VendorID AS INTEGER) AS vendor_id, TRY_CAST(RatecodeID AS INTEGER) AS rate_code_id,
    CAST(PULocationID AS INTEGER) AS pickup_location_id, CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
    lpep_pickup_datetime AS pickup_datetime, lpep_dropoff_datetime AS dropoff_datetime,
    store_and_fwd_flag, CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
    TRY_CAST(trip_type AS INTEGER) AS trip_type,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount,
    TRY_CAST(payment_type AS INTEGER) AS payment_type, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM ta_green WHERE VendorID IS NOT NULL
),
unioned AS (
  SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime,
    dropoff_datetime, store_and_fwd_flag, passenger_count, trip_distance, trip_type, fare_amount,
    extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount,
    payment_type, 'Green' AS service_type, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM stg_green
  UNION ALL
  SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime,
    dropoff_datetime, store_and_fwd_flag, passenger_count, trip_distance, CAST(1 AS INTEGER),
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, CAST(0 AS DECIMAL(38,9)),
    improvement_surcharge, total_amount, payment_type, 'Yellow', l_orderkey, l_linenumber,
    l_partkey, l_suppkey
  FROM stg_yellow
),
trips AS (
  SELECT md5(concat_ws('-',
      coalesce(CAST(vendor_id AS VARCHAR), '__null__'),
      coalesce(strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f'), '__null__'),
      coalesce(CAST(pickup_location_id AS VARCHAR), '__null__'),
      coalesce(service_type, '__null__'))) AS trip_id,
    vendor_id, service_type, rate_code_id, pickup_location_id, dropoff_location_id,
    pickup_datetime, dropoff_datetime, store_and_fwd_flag, passenger_count, trip_distance,
    trip_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee,
    improvement_surcharge, total_amount,
    coalesce(payment_type, 0) AS payment_type,
    -- fixed values: payment type codes and names
    CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
      WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
      ELSE 'Unknown' END AS payment_type_description
  FROM unioned
  QUALIFY row_number() OVER (
    PARTITION BY vendor_id, pickup_datetime, pickup_location_id, service_type
    ORDER BY dropoff_datetime, l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1
),
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
    'Zone ' || CAST(r_regionkey AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
fct AS (
  SELECT t.trip_id, t.vendor_id, t.service_type, t.rate_code_id,
    t.pickup_location_id, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
    t.dropoff_location_id, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
    t.pickup_datetime, t.dropoff_datetime, t.store_and_fwd_flag, t.passenger_count,
    t.trip_distance, t.trip_type,
    date_diff('minute', t.pickup_datetime, t.dropoff_datetime) AS trip_duration_minutes,
    t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount, t.ehail_fee,
    t.improvement_surcharge, t.total_amount, t.payment_type, t.payment_type_description
  FROM trips t
  LEFT JOIN zones pz ON t.pickup_location_id = pz.location_id
  LEFT JOIN zones dz ON t.dropoff_location_id = dz.location_id
)"""


def with_ctes(body: str, *blocks: str) -> str:
    return "WITH " + ",".join(b.strip("\n") for b in blocks) + "\n" + body


def money(expr: str) -> str:
    """Exact decimal -> DOUBLE, the same bits in both engines."""
    return f"CAST(CAST({expr} AS DECIMAL(18,4)) AS DOUBLE)"


def avg6(expr: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6)"


_MART_SUMS = [
    ("revenue_monthly_fare", "fare_amount"),
    ("revenue_monthly_extra", "extra"),
    ("revenue_monthly_mta_tax", "mta_tax"),
    ("revenue_monthly_tip_amount", "tip_amount"),
    ("revenue_monthly_tolls_amount", "tolls_amount"),
    ("revenue_monthly_ehail_fee", "ehail_fee"),
    ("revenue_monthly_improvement_surcharge", "improvement_surcharge"),
    ("revenue_monthly_total_amount", "total_amount"),
]

MONTHLY_ZONE_REVENUE = with_ctes(f"""
SELECT pickup_zone, revenue_month, service_type,
  {", ".join(money(f"SUM({src})") + f" AS {dst}" for dst, src in _MART_SUMS)},
  COUNT(trip_id) AS total_monthly_trips,
  AVG(passenger_count) AS avg_monthly_passenger_count,
  {money("SUM(trip_distance)")} / NULLIF(COUNT(trip_distance), 0) AS avg_monthly_trip_distance
FROM (
  SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
    CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month,
    service_type, trip_id, passenger_count, trip_distance,
    {", ".join(src for _, src in _MART_SUMS)}
  FROM fct) k
GROUP BY pickup_zone, revenue_month, service_type
""", _TA, _STG)

DECIMALS = {"trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "ehail_fee", "improvement_surcharge", "total_amount"}


def sel(cols, prefix: str = "") -> str:
    """Column list with exact decimal -> DOUBLE conversion for money columns."""
    return ", ".join(money(prefix + c) + f" AS {c}" if c in DECIMALS else prefix + c
                     for c in cols)


STG_YELLOW_COLS = ["vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
                   "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
                   "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
                   "tolls_amount", "improvement_surcharge", "total_amount", "payment_type"]
STG_GREEN_COLS = ["vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
                  "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
                  "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
                  "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
                  "payment_type"]
UNION_COLS = ["vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
              "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
              "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
              "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
              "payment_type", "service_type"]
TRIPS_COLS = ["trip_id", "vendor_id", "service_type", "rate_code_id", "pickup_location_id",
              "dropoff_location_id", "pickup_datetime", "dropoff_datetime",
              "store_and_fwd_flag", "passenger_count", "trip_distance", "trip_type",
              "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
              "improvement_surcharge", "total_amount", "payment_type",
              "payment_type_description"]
FCT_COLS = ["trip_id", "vendor_id", "service_type", "rate_code_id", "pickup_location_id",
            "pickup_borough", "pickup_zone", "dropoff_location_id", "dropoff_borough",
            "dropoff_zone", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
            "passenger_count", "trip_distance", "trip_type", "trip_duration_minutes",
            "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
            "improvement_surcharge", "total_amount", "payment_type", "payment_type_description"]

# --- fixed values (must equal the reference's for matching results) --------
# Payment type codes and names.
PAYMENT_VALUES = ("(VALUES (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'), "
                  "(5, 'Unknown'), (6, 'Voided trip')) AS p(payment_type_id, payment_type_name)")

TS_FMT = "'%Y-%m-%d %H:%M:%S.%f'"


def _fp(cols) -> str:
    parts = []
    for c in cols:
        if c.endswith("datetime"):
            parts.append(f"coalesce(strftime({c}, {TS_FMT}), '')")
        else:
            parts.append(f"coalesce(CAST({c} AS VARCHAR), '')")
    return "md5(" + " || ".join(parts) + ")"


FP_YELLOW = _fp(["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
                 "DOLocationID"])
FP_GREEN = _fp(["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID",
                "DOLocationID"])

# --- interval pipeline ----------------------------------------------------------------
_ING_AMOUNTS = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
                "tolls_amount", "improvement_surcharge", "total_amount"]


def _ing_side(src: str, pre: str, taxi: str) -> str:
    amounts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _ING_AMOUNTS)
    return f"""SELECT CAST(VendorID AS INTEGER) AS vendor_id,
    {pre}_pickup_datetime AS tpep_pickup_datetime, {pre}_dropoff_datetime AS tpep_dropoff_datetime,
    CAST(passenger_count AS INTEGER) AS passenger_count,
    CAST(PULocationID AS INTEGER) AS pu_location_id, CAST(DOLocationID AS INTEGER) AS do_location_id,
    CAST(payment_type AS INTEGER) AS payment_type, {amounts},
    '{taxi}' AS taxi_type, TIMESTAMP '2024-01-01 00:00:00' AS extracted_at,
    l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM {src}"""


_ING = f"""
ing AS (
  {_ing_side("ta_yellow", "tpep", "yellow")}
  UNION ALL BY NAME
  {_ing_side("ta_green", "lpep", "green")}
),
staged AS (
  SELECT d.tpep_pickup_datetime AS pickup_datetime, d.tpep_dropoff_datetime AS dropoff_datetime,
    d.pu_location_id AS pickup_location_id, d.do_location_id AS dropoff_location_id,
    d.taxi_type, d.passenger_count, d.trip_distance, d.payment_type,
    coalesce(p.payment_type_name, 'unknown') AS payment_type_name,
    d.fare_amount, d.extra, d.mta_tax, d.tip_amount, d.tolls_amount,
    d.improvement_surcharge, d.total_amount, d.extracted_at
  FROM (
    SELECT * FROM ing
    WHERE tpep_pickup_datetime >= TIMESTAMP '1990-01-01 00:00:00'
      AND tpep_pickup_datetime < TIMESTAMP '2030-01-01 00:00:00'
      AND fare_amount >= 0
    QUALIFY row_number() OVER (
      PARTITION BY tpep_pickup_datetime, tpep_dropoff_datetime, pu_location_id,
                   do_location_id, fare_amount, taxi_type
      ORDER BY tpep_pickup_datetime, l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1
  ) d
  LEFT JOIN {PAYMENT_VALUES} ON d.payment_type = p.payment_type_id
)"""

INTERVAL_COLS = ["vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                 "trip_distance", "pu_location_id", "do_location_id", "payment_type",
                 "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "improvement_surcharge", "total_amount", "taxi_type", "extracted_at"]


def _xsum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE)"


def _xavg(c: str) -> str:
    return f"{_xsum(c)} / NULLIF(COUNT({c}), 0)"


def _report(extra_key: str = "") -> str:
    k = f", {extra_key}" if extra_key else ""
    return with_ctes(f"""
SELECT CAST(pickup_datetime AS DATE) AS pickup_date, taxi_type{k},
  COUNT(*) AS total_trips,
  {_xsum("fare_amount")} AS total_fare_amount, {_xavg("fare_amount")} AS avg_fare_amount,
  {_xsum("tip_amount")} AS total_tip_amount, {_xavg("tip_amount")} AS avg_tip_amount,
  {_xsum("trip_distance")} AS total_trip_distance, {_xavg("trip_distance")} AS avg_trip_distance
FROM staged
WHERE pickup_datetime >= TIMESTAMP '1990-01-01 00:00:00'
  AND pickup_datetime < TIMESTAMP '2030-01-01 00:00:00'
GROUP BY CAST(pickup_datetime AS DATE), taxi_type{k}
ORDER BY pickup_date, taxi_type{k}""", _TA, _ING)


def _yellow(body: str) -> str:
    return with_ctes(body, _TA)


_DAY = "CAST(tpep_pickup_datetime AS DATE)"
_YR = "CAST(EXTRACT(YEAR FROM tpep_pickup_datetime) AS BIGINT)"
_MN = "CAST(EXTRACT(MONTH FROM tpep_pickup_datetime) AS BIGINT)"

_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

ORACLE: dict[str, str] = {
    "monthly_zone_revenue": MONTHLY_ZONE_REVENUE,
    "stg_yellow": with_ctes(f"SELECT {sel(STG_YELLOW_COLS)} FROM stg_yellow", _TA, _STG),
    "stg_green": with_ctes(f"SELECT {sel(STG_GREEN_COLS)} FROM stg_green", _TA, _STG),
    "trips_unioned": with_ctes(f"SELECT {sel(UNION_COLS)} FROM unioned", _TA, _STG),
    "trips_dedup": with_ctes(f"SELECT {sel(TRIPS_COLS)} FROM trips", _TA, _STG),
    "surrogate_key": with_ctes("""
SELECT vendor_id, pickup_datetime, pickup_location_id, service_type,
  md5(concat_ws('-',
    coalesce(CAST(vendor_id AS VARCHAR), '__null__'),
    coalesce(strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f'), '__null__'),
    coalesce(CAST(pickup_location_id AS VARCHAR), '__null__'),
    coalesce(service_type, '__null__'))) AS trip_id
FROM unioned""", _TA, _STG),
    "row_fingerprint": with_ctes(f"""
SELECT {FP_YELLOW} AS unique_row_id, 'yellow_tripdata.csv' AS filename, VendorID,
  tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
  PULocationID, DOLocationID, {money("fare_amount")} AS fare_amount
FROM ta_yellow
UNION ALL
SELECT {FP_GREEN}, 'green_tripdata.csv', VendorID, lpep_pickup_datetime, lpep_dropoff_datetime,
  PULocationID, DOLocationID, {money("fare_amount")}
FROM ta_green""", _TA),
    "fct_trips": with_ctes(f"SELECT {sel(FCT_COLS)} FROM fct", _TA, _STG),
    "dim_zones": with_ctes("SELECT * FROM zones", _TA, _STG),
    "dim_vendors": with_ctes("""
SELECT DISTINCT vendor_id,
  -- fixed values: vendor ids and names
  CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.'
    WHEN 4 THEN 'Unknown/Other' END AS vendor_name
FROM fct""", _TA, _STG),
    "payment_lookup_join": with_ctes(f"""
SELECT u.l_orderkey, u.l_linenumber, u.l_partkey, u.l_suppkey, u.service_type, u.payment_type,
  coalesce(p.payment_type_name, 'unknown') AS payment_type_name
FROM unioned u LEFT JOIN {PAYMENT_VALUES} ON u.payment_type = p.payment_type_id""", _TA, _STG),
    "concat_by_name": with_ctes(f"SELECT {', '.join(INTERVAL_COLS)} FROM ing", _TA, _ING),
    "interval_staging": with_ctes("SELECT * FROM staged", _TA, _ING),
    "interval_daily_report": _report(),
    "interval_daily_report_by_payment": _report("payment_type"),
    "top_payment_types": with_ctes("""
SELECT payment_type_name, COUNT(*) AS trips FROM staged GROUP BY payment_type_name
ORDER BY trips DESC, payment_type_name LIMIT 10""", _TA, _ING),
    "dev_sample": with_ctes(f"""
SELECT {sel(STG_YELLOW_COLS)} FROM stg_yellow
WHERE pickup_datetime >= TIMESTAMP '1998-01-01' AND pickup_datetime < TIMESTAMP '1998-02-01'""",
                            _TA, _STG),
    "count_day": _yellow(f"SELECT COUNT(*) AS trips FROM ta_yellow WHERE {_DAY} = DATE '1998-06-15'"),
    "distinct_vendors": _yellow(f"""
SELECT DISTINCT VendorID FROM ta_yellow
WHERE {_DAY} BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'"""),
    "count_range_vendor": _yellow(f"""
SELECT COUNT(*) AS trips FROM ta_yellow
WHERE {_DAY} BETWEEN DATE '1998-06-01' AND DATE '2000-12-31' AND VendorID = '1'"""),
    "minmax_ts": _yellow("""
SELECT MIN(tpep_pickup_datetime) AS min_ts, MAX(tpep_pickup_datetime) AS max_ts FROM ta_yellow"""),
    "minmax_vendor": _yellow("""
SELECT MIN(tpep_pickup_datetime) AS min_ts, MAX(tpep_pickup_datetime) AS max_ts
FROM ta_yellow WHERE VendorID = '1'"""),
    "distinct_days": _yellow(f"""
SELECT MIN({_DAY}) AS min_date, MAX({_DAY}) AS max_date, COUNT(DISTINCT {_DAY}) AS num_days
FROM ta_yellow"""),
    "out_of_range_years": _yellow(f"""
SELECT tpep_pickup_datetime FROM ta_yellow WHERE {_YR} NOT BETWEEN 1996 AND 2000"""),
    "by_vendor": _yellow("""
SELECT VendorID, COUNT(*) AS trips FROM ta_yellow GROUP BY VendorID ORDER BY trips DESC"""),
    "by_year": _yellow(f"""
SELECT {_YR} AS yr, COUNT(*) AS trips FROM ta_yellow WHERE VendorID = '1' GROUP BY yr ORDER BY yr"""),
    "by_year_month": _yellow(f"""
SELECT {_YR} AS yr, {_MN} AS mn, COUNT(*) AS trips FROM ta_yellow GROUP BY yr, mn ORDER BY yr, mn"""),
    "month_label_counts": """
SELECT strftime(o_orderdate, '%Y-%m') AS month_label, strftime(o_orderdate, '%Y_%m') AS table_suffix,
  COUNT(*) AS orders
FROM orders GROUP BY 1, 2""",
    "day_counts": """
SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS orders FROM orders GROUP BY 1 ORDER BY 1""",
    "head_ordered": "SELECT event_id, ts, event_type FROM events ORDER BY ts LIMIT 10",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in _TABLES),
    "dedup_composite": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
    l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
    l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) = 1""",
}


# --- written tables ------------------------------------------------------------------------
_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_ORDER_FP = ("md5(CAST(o_orderkey AS VARCHAR) || CAST(o_custkey AS VARCHAR) || "
             f"strftime(o_orderdate, {TS_FMT}) || o_orderstatus || o_orderpriority)")
_FP_ORDERS = f"SELECT {_ORDER_FP} AS unique_row_id, {_ORDER_COLS} FROM orders"
_IN_1997 = "o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'"
_BACKFILL = with_ctes(f"""
SELECT service, month_label, COUNT(*) AS trips, {money("SUM(fare_amount)")} AS fare_amount
FROM (
  SELECT 'yellow' AS service, strftime(tpep_pickup_datetime, '%Y-%m') AS month_label, fare_amount
  FROM ta_yellow
  UNION ALL
  SELECT 'green', strftime(lpep_pickup_datetime, '%Y-%m'), fare_amount FROM ta_green) m
GROUP BY service, month_label""", _TA)

ORACLE.update({
    "partition_counts": """
SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS total_rows FROM orders
GROUP BY 1 ORDER BY total_rows DESC, order_date""",
    "pruned_count": """
SELECT COUNT(*) AS orders FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'""",
    "clustered_count": """
SELECT COUNT(*) AS orders FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '2000-12-31'
  AND o_orderstatus = 'F'""",
    "ctas_roundtrip": f"SELECT {_ORDER_COLS} FROM orders",
    "append_two": f"SELECT {_ORDER_COLS} FROM orders UNION ALL SELECT {_ORDER_COLS} FROM orders",
    "replace_empty": f"SELECT {_ORDER_COLS} FROM orders WHERE false",
    "full_refresh": f"SELECT {_ORDER_COLS} FROM orders",
    "merge_empty_batch": _FP_ORDERS,
    "merge_insert_only": _FP_ORDERS,
    "merge_upsert": f"""
SELECT {_ORDER_COLS} FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""",
    "merge_upsert_new_column": f"""
SELECT {_ORDER_COLS}, CAST(NULL AS INTEGER) AS o_priority_rank
FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0, o_orderdate, o_orderpriority,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER)
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""",
    "replace_interval": f"""
SELECT {_ORDER_COLS} FROM orders WHERE NOT ({_IN_1997})
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority
FROM orders WHERE {_IN_1997} AND o_orderstatus <> 'P'""",
    "delete_insert": f"""
WITH batch AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate,
    o_orderpriority
  FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01')
SELECT {_ORDER_COLS} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL SELECT * FROM batch
UNION ALL SELECT * FROM batch""",
    "incremental_fact": with_ctes(f"""
SELECT trip_id, pickup_datetime, service_type, {money("total_amount")} AS total_amount FROM fct""",
                                  _TA, _STG),
    "csv_inferred_lookup": with_ctes("SELECT * FROM zones", _TA, _STG),
    "csv_wildcards": """
SELECT o_orderstatus, COUNT(*) AS orders,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total_price,
  MIN(o_orderkey) AS min_orderkey, MAX(o_orderkey) AS max_orderkey
FROM orders GROUP BY o_orderstatus""",
    "seed_lookup_csv": with_ctes(f"""
SELECT p.payment_type_id, p.payment_type_name, CAST(coalesce(c.trips, 0) AS BIGINT) AS trips
FROM {PAYMENT_VALUES}
LEFT JOIN (SELECT payment_type, COUNT(*) AS trips FROM ing GROUP BY payment_type) c
  ON p.payment_type_id = c.payment_type""", _TA, _ING),
    "month_backfill": _BACKFILL,
    "file_lineage": _BACKFILL,
    "stream_month_load": with_ctes(f"""
SELECT {FP_YELLOW} AS unique_row_id, VendorID, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, PULocationID, DOLocationID,
  {money("fare_amount")} AS fare_amount
FROM ta_yellow""", _TA),
})


# --- machine learning ---------------------------------------------------------------------
_ML = f"""
mlt AS (
  SELECT {FP_YELLOW} AS row_key,
    CAST(passenger_count AS DOUBLE) AS passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
    PULocationID, DOLocationID, CAST(payment_type AS VARCHAR) AS payment_type,
    CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
    CAST(tip_amount AS DOUBLE) AS tip_amount
  FROM ta_yellow WHERE fare_amount <> 0
),
mls AS (
  SELECT *, CASE WHEN ('0x' || substr(md5(row_key), 1, 4))::INTEGER % 100 < 20
                 THEN 'eval' ELSE 'train' END AS split
  FROM mlt
)"""


def _num_info(c: str) -> str:
    return (f"SELECT '{c}' AS input, MIN({c}) AS min, MAX({c}) AS max, "
            f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(COUNT({c}), 0) AS mean, "
            f"quantile_disc({c}, 0.5) AS median, ROUND(stddev_samp({c}), 6) AS stddev, "
            f"CAST(NULL AS BIGINT) AS category_count, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
            "FROM mlt")


def _cat_info(c: str) -> str:
    return (f"SELECT '{c}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
            f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), COUNT(DISTINCT {c}), "
            f"COUNT(*) FILTER (WHERE {c} IS NULL) FROM mlt")


def _sig6(x: str) -> str:
    x = f"({x})"
    k = f"CEIL(LOG10(ABS({x})))"
    return f"CASE WHEN {x} = 0 THEN 0.0 ELSE ROUND({x} / POW(10.0, {k}), 6) * POW(10.0, {k}) END"


_EVAL = f"""
SELECT {_sig6("AVG(ABS(e))")} AS mean_absolute_error,
  {_sig6("AVG(e * e)")} AS mean_squared_error,
  {_sig6("AVG(CASE WHEN p > -1 AND y > -1 THEN POW(LN(1 + p) - LN(1 + y), 2) END)")} AS mean_squared_log_error,
  COUNT(*) FILTER (WHERE NOT (p > -1 AND y > -1)) AS rows_without_log,
  {_sig6("quantile_disc(ABS(e), 0.5)")} AS median_absolute_error,
  {_sig6("1 - AVG(e * e) / VAR_POP(y)")} AS r2_score,
  {_sig6("1 - VAR_POP(e) / VAR_POP(y)")} AS explained_variance
FROM (
  SELECT t.tip_amount AS y, g.p AS p, g.p - t.tip_amount AS e
  FROM mls t JOIN (
    SELECT coalesce(payment_type, '__null__') AS pt, AVG(tip_amount) AS p
    FROM mls WHERE split = 'train' AND tip_amount IS NOT NULL GROUP BY 1) g
  ON coalesce(t.payment_type, '__null__') = g.pt
  WHERE t.split = 'eval' AND t.tip_amount IS NOT NULL) r"""

ORACLE.update({
    "ml_features": with_ctes("SELECT * EXCLUDE (row_key) FROM mlt", _TA, _ML),
    "ml_split": with_ctes("""
SELECT split, COUNT(*) AS rows, CAST(SUM(CAST(tip_amount AS DECIMAL(18,4))) AS DOUBLE) AS tip_amount
FROM mls GROUP BY split""", _TA, _ML),
    "ml_feature_info": with_ctes(" UNION ALL ".join(
        [_num_info(c) for c in ("passenger_count", "trip_distance", "fare_amount", "tolls_amount")]
        + [_cat_info(c) for c in ("PULocationID", "DOLocationID", "payment_type")]), _TA, _ML),
    "ml_predict_single_feature": with_ctes("""
SELECT COUNT(*) AS n, ROUND(regr_intercept(tip_amount, fare_amount), 6) AS intercept,
  ROUND(regr_slope(tip_amount, fare_amount), 6) AS slope,
  ROUND(CAST(SUM(CAST(tip_amount AS DECIMAL(18,4))) AS DOUBLE), 4) AS sum_predicted_tip_amount
FROM mlt WHERE tip_amount IS NOT NULL""", _TA, _ML),
    "ml_predict_categorical": with_ctes("""
SELECT payment_type, COUNT(*) AS n,
  ROUND(CAST(SUM(CAST(tip_amount AS DECIMAL(18,4))) AS DOUBLE), 2) AS sum_predicted_tip_amount
FROM mlt WHERE tip_amount IS NOT NULL GROUP BY payment_type""", _TA, _ML),
    "ml_evaluate": with_ctes(_EVAL, _TA, _ML),
})


# --- data-quality checks ------------------------------------------------------------------
_MODELS = """
mart AS (
  SELECT pickup_zone, revenue_month, service_type,
    SUM(total_amount) AS revenue_monthly_total_amount, COUNT(trip_id) AS total_monthly_trips
  FROM (SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
          CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month,
          service_type, trip_id, total_amount FROM fct) k
  GROUP BY pickup_zone, revenue_month, service_type
),
vendors AS (SELECT DISTINCT vendor_id FROM fct),
plk AS (SELECT * FROM """ + PAYMENT_VALUES + """),
report AS (
  SELECT CAST(pickup_datetime AS DATE) AS pickup_date, taxi_type, COUNT(*) AS total_trips,
    SUM(fare_amount) AS total_fare_amount, SUM(tip_amount) AS total_tip_amount
  FROM staged GROUP BY 1, 2
)"""

_TABLE = {"stg_yellow": "stg_yellow", "stg_green": "stg_green", "int_trips": "trips",
          "fct_trips": "fct", "dim_zones": "zones", "dim_vendors": "vendors",
          "fct_monthly_zone_revenue": "mart", "payment_lookup": "plk",
          "staging_trips": "staged", "trips_report": "report"}


def _row(model: str, check: str, column: str, failed: str) -> str:
    return (f"SELECT '{model}' AS model, '{check}' AS check_name, '{column}' AS column_name, "
            f"CAST(({failed}) AS BIGINT) AS failed_rows")


def _nn(model, c):
    return _row(model, "not_null", c, f"SELECT COUNT(*) FILTER (WHERE {c} IS NULL) FROM {_TABLE[model]}")


def _pred(model, check, c, cond):
    return _row(model, check, c, f"SELECT COUNT(*) FILTER (WHERE {cond}) FROM {_TABLE[model]}")


def _dups(model, check, cols, drop_nulls):
    cl = ", ".join(cols)
    where = (" WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)) if drop_nulls else ""
    return _row(model, check, ",".join(cols),
                f"SELECT COUNT(*) FROM (SELECT {cl} FROM {_TABLE[model]}{where} "
                f"GROUP BY {cl} HAVING COUNT(*) > 1) d")


def _rel(model, c):
    t = _TABLE[model]
    return _row(model, "relationships", c,
                f"SELECT COUNT(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM zones z WHERE z.location_id = x.{c})")


def _custom(model, name, value_sql):
    return _row(model, "custom:" + name, "",
                f"SELECT CASE WHEN ({value_sql}) = 1 THEN 0 ELSE 1 END FROM {_TABLE[model]}")


def _checks(*rows: str) -> str:
    body = "SELECT *, failed_rows = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(rows) + "\n) c"
    return with_ctes(body, _TA, _STG, _ING, _MODELS)


_CORE = ["trip_id", "vendor_id", "service_type", "pickup_datetime", "total_amount"]
_ACCEPT = "service_type IS NOT NULL AND service_type NOT IN ('Green', 'Yellow')"

ORACLE.update({
    "check_not_null": _checks(
        _nn("stg_yellow", "vendor_id"), _nn("stg_yellow", "pickup_datetime"),
        _nn("stg_green", "vendor_id"), _nn("stg_green", "pickup_datetime"),
        *[_nn("int_trips", c) for c in _CORE], *[_nn("fct_trips", c) for c in _CORE],
        *[_nn("fct_monthly_zone_revenue", c) for c in (
            "pickup_zone", "revenue_month", "service_type", "revenue_monthly_total_amount",
            "total_monthly_trips")],
        _nn("payment_lookup", "payment_type_id"), _nn("payment_lookup", "payment_type_name"),
        _nn("staging_trips", "pickup_datetime"), _nn("staging_trips", "dropoff_datetime"),
        _nn("trips_report", "pickup_date")),
    "check_unique": _checks(
        _dups("int_trips", "unique", ["trip_id"], True),
        _dups("fct_trips", "unique", ["trip_id"], True),
        _dups("dim_zones", "unique", ["location_id"], True),
        _dups("dim_vendors", "unique", ["vendor_id"], True),
        _dups("payment_lookup", "unique", ["payment_type_id"], True)),
    "check_accepted_values": _checks(
        *[_pred(m, "accepted_values", "service_type", _ACCEPT)
          for m in ("int_trips", "fct_trips", "fct_monthly_zone_revenue")]),
    "check_relationships": _checks(_rel("fct_trips", "pickup_location_id"),
                                   _rel("fct_trips", "dropoff_location_id")),
    "check_unique_combination": _checks(
        _dups("fct_monthly_zone_revenue", "unique_combination",
              ["pickup_zone", "revenue_month", "service_type"], False),
        _dups("trips_report", "unique_combination", ["pickup_date", "taxi_type"], False)),
    "check_non_negative": _checks(
        _pred("staging_trips", "non_negative", "fare_amount", "fare_amount < 0"),
        *[_pred("trips_report", "non_negative", c, f"{c} < 0")
          for c in ("total_trips", "total_fare_amount", "total_tip_amount")],
        _pred("fct_trips", "non_negative", "fare_amount", "fare_amount < 0")),
    "check_positive": _checks(
        _pred("fct_trips", "positive", "trip_distance", "trip_distance <= 0"),
        _pred("fct_trips", "positive", "fare_amount", "fare_amount <= 0"),
        _pred("fct_monthly_zone_revenue", "positive", "total_monthly_trips",
              "total_monthly_trips <= 0")),
    "check_custom": _checks(
        _custom("staging_trips", "row_count_greater_than_zero",
                "CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END"),
        _custom("trips_report", "total_trips_positive",
                "CASE WHEN MIN(total_trips) > 0 THEN 1 ELSE 0 END")),
    "check_primary_key": _checks(
        _nn("payment_lookup", "payment_type_id"),
        _dups("payment_lookup", "unique_combination", ["payment_type_id"], False),
        _nn("staging_trips", "pickup_datetime"),
        _dups("staging_trips", "unique_combination", ["pickup_datetime"], False),
        _nn("trips_report", "pickup_date"), _nn("trips_report", "taxi_type"),
        _dups("trips_report", "unique_combination", ["pickup_date", "taxi_type"], False)),
})


def _fresh(source: str, table: str, col: str) -> str:
    age = (f"(epoch_us(TIMESTAMP '2001-08-02 01:00:00') - epoch_us(MAX({col}))) / 3.6e9")
    return (f"SELECT '{source}' AS source, MAX({col}) AS max_loaded_at, ROUND({age}, 6) AS age_hours, "
            f"CASE WHEN MAX({col}) IS NULL THEN 'error' WHEN {age} > 48 THEN 'error' "
            f"WHEN {age} > 24 THEN 'warn' ELSE 'pass' END AS status FROM {table}")


ORACLE["check_freshness"] = with_ctes(
    _fresh("yellow_tripdata", "ta_yellow", "tpep_pickup_datetime") + "\nUNION ALL\n"
    + _fresh("green_tripdata", "ta_green", "lpep_pickup_datetime") + "\nUNION ALL\n"
    + "SELECT 'taxi_zone_lookup', CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), 'skipped'", _TA)

# Contract of the trip fact: column name and declared type, in order.
_CONTRACT = [
    ("trip_id", "string"), ("vendor_id", "int"), ("service_type", "string"),
    ("rate_code_id", "int"), ("pickup_location_id", "int"), ("pickup_borough", "string"),
    ("pickup_zone", "string"), ("dropoff_location_id", "int"), ("dropoff_borough", "string"),
    ("dropoff_zone", "string"), ("pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "timestamp_ntz"), ("store_and_fwd_flag", "string"),
    ("passenger_count", "int"), ("trip_distance", "decimal(38,9)"), ("trip_type", "int"),
    ("trip_duration_minutes", "bigint"), ("fare_amount", "decimal(38,9)"),
    ("extra", "decimal(38,9)"), ("mta_tax", "decimal(38,9)"), ("tip_amount", "decimal(38,9)"),
    ("tolls_amount", "decimal(38,9)"), ("ehail_fee", "decimal(38,9)"),
    ("improvement_surcharge", "decimal(38,9)"), ("total_amount", "decimal(38,9)"),
    ("payment_type", "int"), ("payment_type_description", "string"),
]
ORACLE["contract_report"] = (
    "SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{t}', '{t}', true)" for n, t in _CONTRACT)
    + ") AS c(column_name, expected_type, actual_type, matches)")

# The layout queries return what their unpartitioned counterparts return.
ORACLE["distinct_vendors_flat"] = ORACLE["distinct_vendors"]
ORACLE["distinct_vendors_by_day"] = ORACLE["distinct_vendors"]
ORACLE["count_range_vendor_by_day"] = ORACLE["count_range_vendor"]
ORACLE["count_range_vendor_clustered"] = ORACLE["count_range_vendor"]
ORACLE["incremental_lookback"] = ORACLE["incremental_fact"]
ORACLE["distinct_vendors_by_month"] = ORACLE["distinct_vendors"]
ORACLE["count_range_vendor_by_month"] = ORACLE["count_range_vendor"]
ORACLE["count_range_vendor_month_clustered"] = ORACLE["count_range_vendor"]

# Runs over adjacent intervals (and a rerun) report what one run over the whole range reports.
ORACLE["interval_pipeline_runs"] = ORACLE["interval_daily_report"]
