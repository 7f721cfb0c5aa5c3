"""Daily report of a stream by event time (T2, A8): days are reported once,
when the watermark has passed their end; rows that come later than that go to
a side table instead of being lost.

A run is two streams, each drained (``availableNow``):

1. Arrivals are split by the watermark that held before their micro-batch
   (newest event time of all earlier ones, less ``delay``): rows of a day that
   has ended by then are late, and so are rows without an event time.  A
   micro-batch is one folder, overwritten if it is replayed, with the newest
   event time beside it.
2. The rows in time are read as a stream with the same watermark, grouped by
   day windows, and appended to the report when a day is closed.  It sees the
   folders of a run in one micro-batch, so its watermark is never ahead of the
   first stream's and it drops none of the rows that were let in.

Every row is in exactly one of ``closed`` (reported), ``open`` (its day may
still grow) and ``late``.  Event times without a zone are taken as UTC, so
that days do not depend on the session's time zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators import sinks
from meterline.plans.interval import MONEY_SCALE, report_measures

EVENT, LATE, BATCH = "event_time", "is_late", "batch"
DAY_MICROS = 86_400_000_000


@dataclass(frozen=True)
class DailyStream:
    """A report kept in ``folder`` (a shared one), one day and ``keys`` a row.

    ``schema`` is that of the arriving files, ``ts`` their event time
    (timestamp with or without a zone).  ``delay`` says how long after the
    newest event a day stays open.
    """
    spark: SparkSession
    folder: str
    schema: T.StructType
    ts: str = "pickup_datetime"
    keys: Sequence[str] = ("taxi_type",)
    delay: dt.timedelta = dt.timedelta(days=1)
    scale: str = MONEY_SCALE

    def __post_init__(self):
        clash = {EVENT, LATE, BATCH} & {f.name.lower() for f in self.schema.fields}
        if clash:
            raise ValueError(f"reserved column names: {sorted(clash)}")
        if self.delay < dt.timedelta(0):
            raise ValueError("the delay must not be negative")

    # ------------------------------------------------------------- running

    def run(self, src_dir: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> None:
        """Take in what has come to ``src_dir`` since the last run.  Without
        ``max_files_per_trigger`` that is one micro-batch."""
        reader = self.spark.readStream.schema(self.schema).format(fmt)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        arrivals = reader.load(src_dir).withColumn(EVENT, self._event_time())
        _drain(arrivals.writeStream.foreachBatch(self._split)
               .option("checkpointLocation", f"{self.folder}/split-checkpoint"))
        if sinks.holds_files(self.spark, f"{self.folder}/rows"):
            rows = self.spark.readStream.schema(self._row_schema()).parquet(f"{self.folder}/rows/{BATCH}=*/{LATE}=false")
            _drain(self._report(rows).writeStream.format("parquet").outputMode("append")
                   .option("checkpointLocation", f"{self.folder}/report-checkpoint")
                   .option("path", f"{self.folder}/report"))

    def _split(self, batch: DataFrame, batch_id: int) -> None:
        before = self._newest(batch_id - 1)
        seen = Observation()
        rows = batch.withColumn(LATE, self._ended(before) | F.col(EVENT).isNull()).observe(
            seen, F.max(F.unix_micros(EVENT)).alias("newest"))
        rows.write.mode("overwrite").partitionBy(LATE).parquet(f"{self.folder}/rows/{BATCH}={batch_id}")
        newest = max((x for x in (before, seen.get["newest"]) if x is not None), default=None)
        (self.spark.createDataFrame([(newest,)], "newest long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.folder}/newest/{BATCH}={batch_id}"))

    def _newest(self, batch_id: int) -> int | None:
        """Newest event time, in microseconds, up to a micro-batch."""
        path = f"{self.folder}/newest/{BATCH}={batch_id}"
        if batch_id < 0 or not sinks.holds_files(self.spark, path):
            return None
        return self.spark.read.schema("newest long").parquet(path).first()[0]

    def _last(self) -> int | None:
        path = f"{self.folder}/newest"
        if not sinks.holds_files(self.spark, path):
            return None
        return self.spark.read.schema(f"newest long, {BATCH} long").parquet(path).agg(F.max("newest")).first()[0]

    def _ended(self, newest: int | None) -> Column:
        """Whether a row's day has ended by the watermark (whole milliseconds,
        as a stream's)."""
        if newest is None:
            return F.lit(False)
        watermark = (newest // 1000 - self.delay // dt.timedelta(milliseconds=1)) * 1000
        micros = F.unix_micros(EVENT)
        return F.coalesce(micros - F.pmod(micros, F.lit(DAY_MICROS)) + DAY_MICROS <= watermark, F.lit(False))

    def _event_time(self) -> Column:
        if isinstance(self.schema[self.ts].dataType, T.TimestampNTZType):
            return F.concat(F.col(self.ts).cast("string"), F.lit("Z")).cast("timestamp")
        return F.col(self.ts).cast("timestamp")

    def _row_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(EVENT, T.TimestampType())])

    def _report(self, rows: DataFrame) -> DataFrame:
        ms = self.delay // dt.timedelta(milliseconds=1)
        day = F.date_from_unix_date(F.floor(F.unix_micros("window.start") / DAY_MICROS).cast("int"))
        return (rows.withWatermark(EVENT, f"{ms} milliseconds")
                .groupBy(F.window(EVENT, "1 day"), *self.keys).agg(*report_measures(self.scale))
                .withColumn("window", day).withColumnRenamed("window", "pickup_date"))

    # ------------------------------------------------------------- reading

    def _rows(self, late: bool) -> DataFrame:
        path = f"{self.folder}/rows"
        if not sinks.holds_files(self.spark, path):
            return self.spark.createDataFrame([], self._row_schema())
        schema = T.StructType([*self._row_schema().fields, T.StructField(BATCH, T.LongType()),
                               T.StructField(LATE, T.BooleanType())])
        return self.spark.read.schema(schema).parquet(path).filter(F.col(LATE) == late).drop(LATE, BATCH)

    def closed(self) -> DataFrame:
        """The report: days the watermark has passed, which change no more."""
        schema = self._report(self.spark.createDataFrame([], self._row_schema())).schema
        if not sinks.holds_files(self.spark, f"{self.folder}/report"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/report")

    def open(self) -> DataFrame:
        """The same report of the days that are still open, as they stand."""
        return self._report(self._rows(False).filter(~self._ended(self._last())))

    def late(self) -> DataFrame:
        """Rows that came after their day was closed, or have no event time."""
        return self._rows(True).drop(EVENT)


def _drain(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
