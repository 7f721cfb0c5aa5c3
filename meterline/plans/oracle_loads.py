"""DuckDB SQL of the queries in ``catalog_loads``, written from their meaning."""

from __future__ import annotations

from meterline.plans.oracle_sql import _ING, _MART_SUMS, _ML, _STG, _TA, ORACLE, _xavg, _xsum, money, with_ctes

_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_STAYS = f"SELECT {_COLS} FROM orders WHERE o_custkey % 10 <> 3"
_MOVED = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
  o_orderdate + INTERVAL 400 DAY AS o_orderdate, o_orderpriority FROM orders WHERE o_custkey % 10 = 3"""


def _report(name: str, key: str) -> str:
    extra = ", payment_type" if key else ""
    return f"""
SELECT CAST(pickup_datetime AS DATE) AS pickup_date, taxi_type, {key or "CAST(NULL AS BIGINT)"} AS payment_type,
  '{name}' AS report, COUNT(*) AS total_trips,
  {_xsum("fare_amount")} AS total_fare_amount, {_xavg("fare_amount")} AS avg_fare_amount,
  {_xsum("tip_amount")} AS total_tip_amount, {_xavg("tip_amount")} AS avg_tip_amount,
  {_xsum("trip_distance")} AS total_trip_distance, {_xavg("trip_distance")} AS avg_trip_distance
FROM staged
WHERE pickup_datetime >= TIMESTAMP '1990-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '2030-01-01 00:00:00'
GROUP BY CAST(pickup_datetime AS DATE), taxi_type{extra}"""


def _run(run: int, rows: str, lost: str, negative: str, twice: str, published: str) -> str:
    checks = [("not_null", "trip_id", f"SELECT COUNT(*) FROM {rows} WHERE {lost}"),
              ("not_null", "pickup_datetime", f"SELECT COUNT(*) FROM {rows} WHERE pickup_datetime IS NULL"),
              ("non_negative", "trip_distance", f"SELECT COUNT(*) FROM {rows} WHERE {negative}"),
              ("unique", "trip_id", f"SELECT COUNT(*) FROM (SELECT 1 FROM {rows} WHERE {twice} GROUP BY trip_id HAVING COUNT(*) > 1)")]
    return "\nUNION ALL\n".join(
        f"SELECT CAST({run} AS INTEGER) AS run, '{c}' AS check_name, '{on}' AS column_name, n AS failed_rows, "
        f"n = 0 AS passed, {published} AS published FROM ({sql}) t(n)" for c, on, sql in checks)


_YEARS = "(SELECT EXTRACT(YEAR FROM tpep_pickup_datetime) AS y FROM ta_yellow GROUP BY 1)"
_FIXED = "(pickup_datetime < TIMESTAMP '1996-01-01' AND passenger_count = 3)"

_ARRIVALS = """
arrivals AS (
  SELECT tpep_pickup_datetime AS pickup_datetime, taxi_type, passenger_count, fare_amount, tip_amount, trip_distance,
    date_trunc('day', tpep_pickup_datetime) + INTERVAL 1 DAY AS day_end,
    CASE WHEN tpep_pickup_datetime < TIMESTAMP '1995-01-01' THEN 1
         WHEN tpep_pickup_datetime < TIMESTAMP '1997-01-01' THEN 2 ELSE 3 END
      + CASE WHEN passenger_count = 2 THEN 1 ELSE 0 END AS arrival
  FROM ing
),
split AS (
  SELECT a.*, coalesce(day_end <= (SELECT MAX(b.pickup_datetime) FROM arrivals b WHERE b.arrival < a.arrival)
                                  - INTERVAL 400 DAY, false) AS is_late,
    day_end <= (SELECT MAX(pickup_datetime) FROM arrivals) - INTERVAL 400 DAY AS is_closed
  FROM arrivals a
)"""


def _by_day(rows: str) -> str:
    return with_ctes(f"""
SELECT CAST(pickup_datetime AS DATE) AS pickup_date, taxi_type, COUNT(*) AS total_trips,
  {_xsum("fare_amount")} AS total_fare_amount, {_xavg("fare_amount")} AS avg_fare_amount,
  {_xsum("tip_amount")} AS total_tip_amount, {_xavg("tip_amount")} AS avg_tip_amount,
  {_xsum("trip_distance")} AS total_trip_distance, {_xavg("trip_distance")} AS avg_trip_distance
FROM split WHERE {rows} GROUP BY CAST(pickup_datetime AS DATE), taxi_type""", _TA, _ING, _ARRIVALS)


ORACLE.update({
    "months_type_drift": with_ctes(f"""
SELECT CAST(EXTRACT(YEAR FROM tpep_pickup_datetime) AS INTEGER) AS year, COUNT(*) AS trips,
  CAST(SUM(passenger_count) AS DOUBLE) AS passengers,
  COUNT(CASE WHEN EXTRACT(YEAR FROM tpep_pickup_datetime) <= 1998 THEN congestion_surcharge END) AS surcharged,
  {money("SUM(tolls_amount)")} AS tolls
FROM ta_yellow GROUP BY 1""", _TA),
    "months_drift_report": with_ctes(f"""
SELECT 'passenger_count' AS column_name, 'double' AS common_type, 'bigint, double, int' AS file_types,
  COUNT(*) AS files, CAST(0 AS BIGINT) AS missing FROM {_YEARS}
UNION ALL
SELECT 'congestion_surcharge', 'decimal(38,9)', 'decimal(38,9)', COUNT(*) FILTER (y <= 1998), COUNT(*) FILTER (y > 1998)
FROM {_YEARS}""", _TA),
    "audited_publish": with_ctes(f"""
SELECT trip_id, pickup_datetime, service_type, {money("total_amount")} AS total_amount FROM fct""", _TA, _STG),
    "audited_publish_report": with_ctes(
        _run(1, "(SELECT * FROM fct WHERE pickup_datetime < TIMESTAMP '1997-01-01')", "trip_id IS NULL", "trip_distance < 0",
             "trip_id IS NOT NULL", "true") + "\nUNION ALL\n"
        + _run(2, "fct", "passenger_count IS NOT DISTINCT FROM 2 OR passenger_count IS NULL",
               "passenger_count = 3 AND trip_distance > 0 OR passenger_count IS DISTINCT FROM 3 AND trip_distance < 0",
               "passenger_count <> 2", "false") + "\nUNION ALL\n"
        + _run(3, "fct", "trip_id IS NULL", "trip_distance < 0", "trip_id IS NOT NULL", "true"), _TA, _STG),
    "mart_incremental": with_ctes(f"""
SELECT pickup_zone, revenue_month, service_type,
  {", ".join(money(f"SUM({src})") + f" AS {dst}" for dst, src in _MART_SUMS)},
  COUNT(*) AS total_monthly_trips, AVG(passenger_count) AS avg_monthly_passenger_count,
  {money("SUM(trip_distance)")} / NULLIF(COUNT(trip_distance), 0) AS avg_monthly_trip_distance
FROM (SELECT * REPLACE (coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
        tip_amount + CASE WHEN {_FIXED} THEN 1 ELSE 0 END AS tip_amount,
        total_amount + CASE WHEN {_FIXED} THEN 1 ELSE 0 END AS total_amount),
        CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month FROM fct) k
GROUP BY pickup_zone, revenue_month, service_type""", _TA, _STG),
    "distinct_days_bitmaps": with_ctes("""
SELECT CAST(EXTRACT(YEAR FROM tpep_pickup_datetime) AS INTEGER) AS year,
  COUNT(DISTINCT CAST(tpep_pickup_datetime AS DATE)) AS num_days
FROM ta_yellow GROUP BY 1""", _TA),
    "interval_reports_one_pass": with_ctes(
        _report("taxi_type", "") + "\nUNION ALL\n" + _report("payment_type", "payment_type"), _TA, _ING),
    "merge_upsert_moving": f"{_STAYS}\nUNION ALL\n{_MOVED}",
    "delete_insert_moving": f"{_STAYS}\nUNION ALL\n{_MOVED}\nUNION ALL\n{_MOVED}",
    "merge_insert_bucketed": ORACLE["merge_insert_only"],
    "partition_counts_metadata": """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
  COUNT(*) + COUNT(*) FILTER (o_orderstatus = 'F' AND date_trunc('month', o_orderdate) = DATE '1998-06-01') AS total_rows
FROM orders GROUP BY 1""",
    "count_range_vendor_month_ranges": ORACLE["count_range_vendor_month_clustered"],
    "event_time_report": _by_day("NOT is_late AND is_closed"),
    "event_time_open_days": _by_day("NOT is_late AND NOT is_closed"),
    "event_time_late_rows": with_ctes("""
SELECT pickup_datetime, taxi_type, passenger_count, fare_amount, tip_amount, trip_distance
FROM split WHERE is_late""", _TA, _ING, _ARRIVALS),
    "ml_reloaded_predict": ORACLE["ml_predict_categorical"],
    "ml_explain_single_feature": with_ctes("""
SELECT m.payment_type, COUNT(*) AS n, ROUND(MIN(f.intercept + f.slope * f.mean), 6) AS baseline,
  ROUND(SUM(f.slope * (coalesce(m.fare_amount, f.mean) - f.mean)), 3) AS sum_attribution,
  ROUND(SUM(f.intercept + f.slope * coalesce(m.fare_amount, f.mean)), 3) AS sum_prediction
FROM mlt m, (SELECT regr_intercept(tip_amount, fare_amount) AS intercept, regr_slope(tip_amount, fare_amount) AS slope,
               AVG(fare_amount) AS mean FROM mlt WHERE tip_amount IS NOT NULL) f
WHERE m.tip_amount IS NOT NULL GROUP BY m.payment_type""", _TA, _ML),
})
