"""Trip adapter over the TPC-H-shaped test tables.

The test tables hold no trips; this maps ``lineitem ⋈ orders ⋈ customer ⋈
supplier`` to raw yellow (odd line numbers) and green (even) month-file
frames, with NULLs and anomalies placed on purpose so staging, dedup, the
zone joins and the checks all have something to do.  Zones come from
``nation ⋈ region``.

The columns ``l_orderkey, l_linenumber, l_partkey, l_suppkey`` ride along as
tie-breakers for the keep-first dedup and are dropped right after it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.schemas import GREEN_RAW, NUMERIC, YELLOW_RAW
from meterline.sources.tables import dealt, join_tasks, spread, table

TIE_BREAKERS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# Constant surcharges of the synthetic trips.
EXTRA, MTA_TAX, IMPROVEMENT, CONGESTION = (Decimal("0.5"), Decimal("0.5"),
                                           Decimal("0.3"), Decimal("2.5"))


def _num(v) -> Column:
    return F.lit(v).cast(NUMERIC)


def trip_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service-independent trip columns, one row per line item.

    Orders meet their customers first, while their rows are narrow and few;
    large tables are joined by the order key in tasks of bounded size.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    tasks = join_tasks(li)
    li = dealt(li, tasks, "l_orderkey") if tasks else spread(li)
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    od = dealt(od.join(cu, od.o_custkey == cu.c_custkey), tasks, "o_orderkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(su, li.l_suppkey == su.s_suppkey)

    ok = F.col("o_orderkey")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    fare = (F.when(ok % 53 == 0, F.lit(0).cast("decimal(18,2)"))
             .when(ok % 50 == 0, -price)
             .otherwise(price))
    fare4 = fare.cast("decimal(18,4)")
    tip = (fare * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,4)")
    tolls = (fare * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)")
    total = (fare4 + F.lit(EXTRA) + F.lit(MTA_TAX) + tip + tolls + F.lit(IMPROVEMENT)
             + F.lit(CONGESTION)).cast("decimal(18,4)")
    is_green = F.col("l_linenumber") % 2 == 0
    return j.select(
        *TIE_BREAKERS,
        F.nullif(F.col("l_linenumber") % 5, F.lit(0)).cast("string").alias("VendorID"),
        F.col("o_orderdate").alias("pickup_ts"),
        F.col("l_shipdate").alias("dropoff_ts"),
        F.when(is_green & (ok % 11 == 0), F.lit("bad"))
         .otherwise((F.col("l_partkey") % 6 + 1).cast("string")).alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("store_and_fwd_flag"),
        (F.col("l_quantity").cast("bigint") % 7).alias("passenger_count"),
        (F.col("l_quantity").cast("decimal(18,2)") / 2).cast("decimal(18,2)").cast(NUMERIC)
        .alias("trip_distance"),
        F.when(F.col("c_nationkey") == 24, F.lit(999))
         .when(F.col("c_nationkey") == 23, F.lit(None))
         .otherwise(F.col("c_nationkey")).cast("string").alias("PULocationID"),
        F.col("s_nationkey").cast("string").alias("DOLocationID"),
        F.nullif(ok % 7, F.lit(0)).cast("bigint").alias("payment_type"),
        fare.cast(NUMERIC).alias("fare_amount"),
        _num(EXTRA).alias("extra"),
        _num(MTA_TAX).alias("mta_tax"),
        tip.cast(NUMERIC).alias("tip_amount"),
        tolls.cast(NUMERIC).alias("tolls_amount"),
        _num(IMPROVEMENT).alias("improvement_surcharge"),
        total.cast(NUMERIC).alias("total_amount"),
        _num(CONGESTION).alias("congestion_surcharge"),
        F.when(F.col("l_linenumber") == 2, "1").otherwise("2").alias("trip_type"),
    )


def _shape(base: DataFrame, schema, prefix: str, keep_tie_breakers: bool) -> DataFrame:
    cols = []
    for f in schema.fields:
        if f.name == f"{prefix}_pickup_datetime":
            cols.append(F.col("pickup_ts").alias(f.name))
        elif f.name == f"{prefix}_dropoff_datetime":
            cols.append(F.col("dropoff_ts").alias(f.name))
        elif f.name == "ehail_fee":
            cols.append(F.lit(None).cast(NUMERIC).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    if keep_tie_breakers:
        cols += [F.col(c) for c in TIE_BREAKERS]
    return base.select(*cols)


def raw_yellow(spark: SparkSession, sf_dir: str, tie_breakers: bool = True,
               base: DataFrame | None = None) -> DataFrame:
    base = trip_base(spark, sf_dir) if base is None else base
    return _shape(base.filter(F.col("l_linenumber") % 2 == 1), YELLOW_RAW, "tpep", tie_breakers)


def raw_green(spark: SparkSession, sf_dir: str, tie_breakers: bool = True,
              base: DataFrame | None = None) -> DataFrame:
    base = trip_base(spark, sf_dir) if base is None else base
    return _shape(base.filter(F.col("l_linenumber") % 2 == 0), GREEN_RAW, "lpep", tie_breakers)


def raw_both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(yellow, green) over one listing of the tables."""
    base = trip_base(spark, sf_dir)
    return raw_yellow(spark, sf_dir, base=base), raw_green(spark, sf_dir, base=base)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup (locationid, borough, zone, service_zone) from nation ⋈ region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").cast("int").alias("locationid"),
                     F.col("r_name").alias("borough"),
                     F.col("n_name").alias("zone"),
                     F.concat(F.lit("Zone "), F.col("r_regionkey").cast("string"))
                      .alias("service_zone")))


def interval_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Month frames per taxi type as the interval pipeline receives them
    (parquet month files: ids integer, amounts double, service-specific names)."""
    out = {}
    for svc, frame in zip(("yellow", "green"), raw_both(spark, sf_dir)):
        prefix = "tpep" if svc == "yellow" else "lpep"
        cols = [
            F.col("VendorID").cast("int").alias("VendorID"),
            F.col(f"{prefix}_pickup_datetime"), F.col(f"{prefix}_dropoff_datetime"),
            F.col("passenger_count").cast("int").alias("passenger_count"),
            F.col("trip_distance").cast("double").alias("trip_distance"),
            F.col("PULocationID").cast("int").alias("PULocationID"),
            F.col("DOLocationID").cast("int").alias("DOLocationID"),
            F.col("payment_type").cast("int").alias("payment_type"),
        ] + [F.col(c).cast("double").alias(c) for c in (
            "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "improvement_surcharge", "total_amount", "congestion_surcharge")] + [
            F.col(c) for c in TIE_BREAKERS]
        out[svc] = frame.select(*cols)
    return out
