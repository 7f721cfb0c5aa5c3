"""Exactly-once month-file ingest with Structured Streaming.

A file stream picks up what landed in a folder and puts it, fingerprinted,
into an inbox beside its checkpoint: one folder per micro-batch, overwritten
if the batch is replayed.  When the stream has drained (``availableNow``, as
a monthly schedule drives it), everything in the inbox is merged insert-only
into the day-partitioned target in one step and the inbox is emptied.

A month is the unit of the merge, however many files it came in and however
the stream cut its micro-batches: rows that share a fingerprint inside a
month are all inserted, rows already inserted from an earlier month or run
are not.  A run that broke off leaves its inbox; the next one merges it, and
what had been inserted is not inserted twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators import sinks
from meterline.plans import warehouse
from meterline.schemas import RAW_SCHEMAS
from meterline.sources.files import CORRUPT


def month_unit(path) -> F.Column:
    """The load unit of a file: the month its name or folder gives, else its path."""
    # worked out for every row: the pattern starts where it can match first
    at = F.least(*[F.nullif(F.locate(w, path), F.lit(0)) for w in ("tripdata_", "month=")])
    month = F.regexp_extract(F.substring(path, at, F.length(path)), r"(?:tripdata_|month=)(\d{4}-\d{2})", 1)
    return F.when(month != "", month).otherwise(path)


@contextmanager
def fine_scans(spark: SparkSession) -> Iterator[None]:
    """For a stream run in it: its scans have four tasks a core, where the
    files allow, as gzip files packed to one task a core leave cores idle
    behind the last.  The session's setting is put back after the stream; a
    session that names a number keeps it."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(key)


def stream_month_load(spark: SparkSession, src_dir: str, service: str, target_path: str,
                      checkpoint: str, max_files_per_trigger: int | None = None,
                      table: str | None = None, recursive: bool = False,
                      max_bad_rows: int | None = None) -> warehouse.Loaded:
    """Load every not-yet-seen CSV(.gz) file in ``src_dir`` into ``target_path``
    (registered as catalog table ``table`` when given, see ``load_month``);
    ``recursive`` also picks up files in sub-folders (one folder per month).
    ``max_files_per_trigger`` bounds a micro-batch and changes no result.

    Returns the number of rows inserted by this run and of malformed rows
    seen (their unreadable values are NULL); more than ``max_bad_rows`` of
    those fail the run and stay in the inbox.
    """
    schema = T.StructType(RAW_SCHEMAS[service].fields + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.readStream.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    # The file name must be taken from the stream's scan: a micro-batch frame
    # handed to foreachBatch no longer carries file metadata.
    raw = reader.csv(src_dir).withColumns({
        "filename": F.col("_metadata.file_name"), "unit": month_unit(F.col("_metadata.file_path"))})
    inbox = f"{checkpoint.rstrip('/')}-inbox"

    def keep(batch: DataFrame, batch_id: int) -> None:
        warehouse.stage_month(batch, service).write.mode("overwrite").parquet(f"{inbox}/batch={batch_id}")

    with fine_scans(spark):
        q = (raw.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if not sinks.holds_files(spark, inbox):
        return warehouse.Loaded(0, 0)
    staged = spark.read.parquet(inbox).drop("batch")
    loaded = warehouse.load_month(spark, staged, target_path, table, max_bad_rows, stored=True)
    sinks.delete_folder(spark, inbox)
    return loaded
