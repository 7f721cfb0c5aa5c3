"""Registered queries of loads that change over time: months of differing
types, audited versions, reports kept up by batches, keys that move, bucketed
targets, counts from the catalog."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import agg_state, audit, merge, sinks
from meterline.operators.explore import partition_counts_from_catalog
from meterline.operators.quality import non_negative, not_null, unique
from meterline.plans import catalog, interval, models
from meterline.plans.catalog import (ORDER_COLS, ORDER_FP, PICK, forget, money, monthly_orders, monthly_table, orders,
                                     register, yellow)
from meterline.sources import drift
from meterline.streaming.daily import DailyStream


def _fresh(spark: SparkSession, stem: str) -> tuple[str, str]:
    """(name, path) of a table of its own."""
    return catalog._table_name(spark, stem), catalog._scratch(spark, stem)


def _before(column: str, day: str):
    return F.col(column) < F.lit(day).cast("timestamp_ntz")


# --- months whose types differ --------------------------------------------------

def drifting_months(spark: SparkSession, sf_dir: str) -> list[str]:
    """The yellow trips as one folder a year, written by three generations of
    a feed: passenger counts are INT until 1996, BIGINT until 1998, DOUBLE
    from then on; the last one lacks the congestion surcharge and spells a
    column otherwise.  The trips are joined once, all writes read them."""
    key = (spark.sparkContext.applicationId, sf_dir, "drifting")
    if key not in catalog._WRITTEN:
        base = catalog._scratch(spark, "drifting_months")
        trips = sinks.materialize(yellow(spark, sf_dir).withColumn("year", F.year(PICK)), "drifting_trips")
        for kind, own in (("int", F.col("year") < 1997), ("bigint", F.col("year").between(1997, 1998)),
                          ("double", F.col("year") > 1998)):
            rows = trips.filter(own).withColumn("passenger_count", F.col("passenger_count").cast(kind))
            if kind == "double":
                rows = rows.drop("congestion_surcharge").withColumnRenamed("tolls_amount", "Tolls_Amount")
            rows.write.partitionBy("year").mode("append").parquet(base)
        years = [r[0] for r in trips.select("year").distinct().collect()]
        catalog._WRITTEN[key] = [f"{base}/year={y}" for y in sorted(years)]
    return catalog._WRITTEN[key]


@register("months_type_drift")
def q_months_type_drift(spark, sf_dir):
    """Files whose types and columns differ read as one frame."""
    rows = drift.read_months(spark, drifting_months(spark, sf_dir))
    return rows.groupBy(F.year(PICK).alias("year")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("passenger_count").alias("passengers"),
        F.count("congestion_surcharge").alias("surcharged"), money(F.sum("tolls_amount")).alias("tolls"))


@register("months_drift_report")
def q_months_drift_report(spark, sf_dir):
    """The columns whose type or presence differs between the files."""
    found = drift.drift(spark, drift.file_schemas(spark, drifting_months(spark, sf_dir)))
    return found.filter("drifts").drop("drifts")


# --- write, audit, publish ----------------------------------------------------------

AUDIT = [not_null("trip_id"), not_null("pickup_datetime"), non_negative("trip_distance"), unique("trip_id")]


def _audited_runs(spark, sf_dir) -> tuple[str, list[audit.Audit]]:
    """Three versions of the fact: the trips before 1997, then a version with
    lost keys and negative distances, then all trips."""
    whole = catalog.materialize(catalog.fact(spark, sf_dir), "audit_fact")
    first = whole.filter(_before("pickup_datetime", "1997-01-01"))
    broken = whole.withColumn("trip_id", F.when(F.col("passenger_count") != 2, F.col("trip_id"))).withColumn(
        "trip_distance", F.when(F.col("passenger_count") == 3, -F.col("trip_distance")).otherwise(F.col("trip_distance")))
    name = catalog._table_name(spark, "fct_published")
    return name, [audit.write_audit_publish(spark, df, name, AUDIT, raises=False) for df in (first, broken, whole)]


@register("audited_publish")
def q_audited_publish(spark, sf_dir):
    """K1 Q1 Q2 Q6: what readers see after a good, a failing and a good run."""
    name, _ = _audited_runs(spark, sf_dir)
    return spark.table(name).select("trip_id", "pickup_datetime", "service_type",
                                    money("total_amount").alias("total_amount"))


@register("audited_publish_report")
def q_audited_publish_report(spark, sf_dir):
    """Q1 Q2 Q6: what each run's checks counted, and whether it was published."""
    _, runs = _audited_runs(spark, sf_dir)
    rows = [(i, *r, a.passed) for i, a in enumerate(runs, start=1) for r in a.results]
    return spark.createDataFrame(rows, "run int, check_name string, column_name string, failed_rows long, "
                                       "passed boolean, published boolean")


# --- a mart kept up by batches --------------------------------------------------------

MART_KEYS = ["pickup_zone", "revenue_month", "service_type"]
MART_MEASURES = [*models.MART_SUMS.values(), "passenger_count", "trip_distance"]


def _mart_rows(fact: DataFrame) -> DataFrame:
    return fact.select(F.coalesce(F.col("pickup_zone"), F.lit(models.UNKNOWN_ZONE)).alias("pickup_zone"),
                       models.month_start("pickup_datetime").alias("revenue_month"), "service_type", *MART_MEASURES)


@register("mart_incremental")
def q_mart_incremental(spark, sf_dir):
    """The mart after three batches into the fact, the last of which
    corrects trips of the first; only touched months are rewritten."""
    whole = catalog.materialize(catalog.fact(spark, sf_dir).withColumn(
        "pickup_month", models.month_start("pickup_datetime")), "mart_fact")
    early = _before("pickup_datetime", "1996-01-01")
    late = ~_before("pickup_datetime", "1998-01-01")
    fixed = whole.filter(early & (F.col("passenger_count") == 3)).withColumn(
        "tip_amount", (F.col("tip_amount") + 1).cast("decimal(38,9)")).withColumn(
        "total_amount", (F.col("total_amount") + 1).cast("decimal(38,9)"))
    fact, fact_path = _fresh(spark, "fct_batches")
    state, state_path = _fresh(spark, "mart_state")
    for batch in (whole.filter(early), whole.filter(~early & ~late), whole.filter(late).unionByName(fixed)):
        replaced = None
        if spark.catalog.tableExists(fact):
            months = merge.in_partitions("pickup_month", merge.partition_values(batch, "pickup_month"))
            replaced = _mart_rows(agg_state.changes(spark.table(fact), batch, "trip_id", months))
        agg_state.apply_batch(spark, state, state_path, "revenue_month", MART_KEYS, MART_MEASURES,
                              _mart_rows(batch), replaced)
        merge.merge_upsert_table(spark, batch, fact, fact_path, "trip_id", "pickup_month", key_fixes_partition=True)
    return spark.table(state).select(
        *MART_KEYS, *[money(agg_state.total(src)).alias(dst) for dst, src in models.MART_SUMS.items()],
        F.col("n_rows").alias("total_monthly_trips"),
        agg_state.average("passenger_count").alias("avg_monthly_passenger_count"),
        agg_state.average("trip_distance").alias("avg_monthly_trip_distance"))


@register("distinct_days_bitmaps")
def q_distinct_days_bitmaps(spark, sf_dir):
    """A3: distinct pickup days a year from bitmaps stored per month by two
    overlapping batches."""
    trips = yellow(spark, sf_dir)
    name, path = _fresh(spark, "pickup_days")
    month = F.trunc(F.to_date(PICK), "month")
    for batch in (trips.filter(_before(PICK, "1997-01-01")), trips.filter(~_before(PICK, "1996-01-01"))):
        own = agg_state.bitmaps(batch, F.unix_date(F.to_date(PICK)), {"pickup_month": month})
        if sinks.create_table_if_absent(spark, own, name, path, partition_by="pickup_month"):
            sinks.append_table_partitions(own, name, "pickup_month")
            continue
        touched = merge.in_partitions("pickup_month", merge.partition_values(batch.select(month.alias("pickup_month")),
                                                                             "pickup_month"))
        both = spark.table(name).filter(touched).unionByName(own)
        with sinks.staged(agg_state.or_bitmaps(both, ["pickup_month"]), "days_next") as after:
            sinks.overwrite_table_partitions(after, name, "pickup_month")
    maps = spark.table(name).withColumn("year", F.year("pickup_month"))
    return agg_state.count_distinct(maps, ["year"], "num_days")


@register("interval_reports_one_pass")
def q_interval_reports_one_pass(spark, sf_dir):
    """Both daily reports from one scan."""
    return interval.daily_reports(catalog.interval_staged(spark, sf_dir), *catalog.INTERVAL)


# --- keys that move, bucketed targets, counts from the catalog ---------------------------

def _moved_orders(spark, sf_dir) -> DataFrame:
    """A tenth of the orders, placed 400 days later than the table has it."""
    o = orders(spark, sf_dir).filter(F.col("o_custkey") % 10 == 3)
    o = o.withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS")).withColumn(
        "o_totalprice", F.col("o_totalprice") + F.lit(1.0))
    return o.withColumn("order_month", F.trunc(F.to_date("o_orderdate"), "month"))


@register("merge_upsert_moving")
def q_merge_upsert_moving(spark, sf_dir):
    """Keys whose row moves to another month leave the old one."""
    name, path = monthly_table(spark, monthly_orders(spark, sf_dir), "orders_moving")
    forget(spark, name)
    merge.merge_upsert_table(spark, _moved_orders(spark, sf_dir), name, path, "o_orderkey", "order_month")
    return spark.table(name).select(*ORDER_COLS)


@register("delete_insert_moving")
def q_delete_insert_moving(spark, sf_dir):
    """As above, the batch's repeated keys all inserted."""
    name, path = monthly_table(spark, monthly_orders(spark, sf_dir), "orders_moving_twice")
    batch = _moved_orders(spark, sf_dir)
    merge.delete_insert_table(spark, batch.unionByName(batch), name, path, "o_orderkey", "order_month")
    return spark.table(name).select(*ORDER_COLS)


BUCKETS = 16


def bucketed_merge(spark, sf_dir) -> tuple[str, str, DataFrame]:
    """(name, path, batch): a target bucketed by its key, and a batch that
    overlaps it by a year."""
    from meterline.functions.exprs import row_fingerprint
    o = orders(spark, sf_dir)
    keyed = o.select(row_fingerprint(o, ORDER_FP).alias("unique_row_id"), *ORDER_COLS)
    name, path = _fresh(spark, "orders_bucketed")
    sinks.save_bucketed(keyed.filter(_before("o_orderdate", "1998-01-01")), name, path, "unique_row_id", BUCKETS)
    return name, path, keyed.filter(~_before("o_orderdate", "1997-01-01"))


@register("merge_insert_bucketed")
def q_merge_insert_bucketed(spark, sf_dir):
    """Insert-only merge into a target bucketed by its key; the
    anti-join moves the batch only."""
    name, path, batch = bucketed_merge(spark, sf_dir)
    with sinks.staged(merge.new_rows(spark.table(name), batch, "unique_row_id"), "bucketed_fresh") as fresh:
        sinks.save_bucketed(fresh, name, path, "unique_row_id", BUCKETS, "append")
    return spark.table(name).select("unique_row_id", *ORDER_COLS)


@register("partition_counts_metadata")
def q_partition_counts_metadata(spark, sf_dir):
    """Rows per month from the catalog's statistics, kept up after an
    append; no data file is opened."""
    o = monthly_orders(spark, sf_dir)
    name, _ = monthly_table(spark, o, "orders_counted")
    sinks.analyze_partitions(spark, name, "order_month")
    again = o.filter((F.col("order_month") == F.lit("1998-06-01").cast("date")) & (F.col("o_orderstatus") == "F"))
    sinks.append_table_partitions(again, name, "order_month")
    sinks.analyze_partitions(spark, name, "order_month", merge.partition_values(again, "order_month"))
    return partition_counts_from_catalog(spark, name, "order_month")


# --- reports by event time --------------------------------------------------------------

def arriving_trips(spark, sf_dir) -> DailyStream:
    """A daily report fed by four arrivals: trips until 1994, until 1996, the
    rest, and in each but the first the trips of two passengers of the arrival
    before.  Days stay open for 400 days after the newest trip."""
    key = (spark.sparkContext.applicationId, sf_dir, "arriving")
    if key not in catalog._WRITTEN:
        year = F.year("pickup_datetime")
        own = F.when(year < 1995, 1).when(year < 1997, 2).otherwise(3)
        trips = (catalog.ingested(spark, sf_dir).withColumnRenamed("tpep_pickup_datetime", "pickup_datetime")
                 .select("pickup_datetime", "taxi_type", "passenger_count", "fare_amount", "tip_amount", "trip_distance")
                 .withColumn("arrival", own + F.when(F.col("passenger_count") == 2, 1).otherwise(0)))
        kept, source = catalog._scratch(spark, "arrivals"), catalog._scratch(spark, "arriving")
        trips.write.partitionBy("arrival").parquet(kept)
        stream = DailyStream(spark, catalog._scratch(spark, "daily"), trips.drop("arrival").schema,
                             delay=dt.timedelta(days=400))
        for arrival in (1, 2, 3, 4):
            spark.read.parquet(kept).filter(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(source)
            stream.run(source)
        catalog._WRITTEN[key] = stream
    return catalog._WRITTEN[key]


@register("event_time_report")
def q_event_time_report(spark, sf_dir):
    """The daily report appended by a stream as its watermark closes days."""
    return arriving_trips(spark, sf_dir).closed()


@register("event_time_open_days")
def q_event_time_open_days(spark, sf_dir):
    """The days the watermark has not closed, as they stand."""
    return arriving_trips(spark, sf_dir).open()


@register("event_time_late_rows")
def q_event_time_late_rows(spark, sf_dir):
    """The trips that came after their day was closed."""
    return arriving_trips(spark, sf_dir).late()


# --- models kept and explained --------------------------------------------------------------

@register("ml_reloaded_predict")
def q_ml_reloaded_predict(spark, sf_dir):
    """M9 M5: a model saved, loaded and applied; per payment type, rows and
    summed predictions (equal to the summed tips for least squares)."""
    from meterline.operators import ml
    data = catalog.ml_table(spark, sf_dir)
    path = ml.save(ml.train(data, numeric=[], categorical=["payment_type"]), catalog._scratch(spark, "reloaded_model"))
    scored = ml.predict(ml.load(path), data.filter(F.col("tip_amount").isNotNull()))
    return scored.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("predicted_tip_amount"), 2).alias("sum_predicted_tip_amount"))


@register("ml_explain_single_feature")
def q_ml_explain_single_feature(spark, sf_dir):
    """M6: with one numeric feature an attribution is slope x (fare - mean);
    per payment type, the baseline and the summed attributions."""
    from meterline.operators import ml
    data = catalog.ml_table(spark, sf_dir).filter(F.col("tip_amount").isNotNull())
    model = ml.train(data, numeric=["fare_amount"], categorical=[])
    told = ml.explain(model, data, top_k=1)
    return told.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("baseline_prediction_value"), 6).alias("baseline"),
        F.round(F.sum(F.col("top_feature_attributions")[0]["attribution"]), 3).alias("sum_attribution"),
        F.round(F.sum("prediction_value"), 3).alias("sum_prediction"))
