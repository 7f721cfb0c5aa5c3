"""Warehouse month load: raw month file -> staging with a row fingerprint and
the file name -> insert-only merge into a day-partitioned table (S6, S13,
X2, K6, K9, K16).

The raw scan feeds the fingerprint projection and is written once; the
anti-join reads only the target partitions of the batch's pickup days, and
the new rows are appended to their day folders.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.exprs import row_fingerprint
from meterline.operators import merge, sinks
from meterline.schemas import FINGERPRINT_COLUMNS, PICKUP_COLUMN, RAW_SCHEMAS
from meterline.sources.files import CORRUPT
from meterline.sources.tables import dealt, join_tasks

PART_COL = "pickup_date"


def stage_month(raw: DataFrame, service: str, filename: str | None = None) -> DataFrame:
    """Staging rows: ``unique_row_id`` (md5 of vendor, pickup, dropoff, PU, DO
    without separator), ``filename`` (a literal, else the source file of each
    row), then the raw columns in file order, plus the derived partition day."""
    if filename:
        fname = F.lit(filename)
    elif "filename" in raw.columns:  # attached upstream (e.g. by a file stream)
        fname = F.col("filename")
    else:
        fname = F.col("_metadata.file_name")
    raw_cols = [f.name for f in RAW_SCHEMAS[service].fields]
    return raw.select(
        row_fingerprint(raw, FINGERPRINT_COLUMNS[service]).alias("unique_row_id"),
        fname.alias("filename"),
        *raw_cols,
        F.to_date(F.col(PICKUP_COLUMN[service])).alias(PART_COL),
        *[c for c in (CORRUPT, "unit") if c in raw.columns],
    )


class BadRows(ValueError):
    """More malformed rows in a batch than the load allows."""


class Loaded(NamedTuple):
    inserted: int
    bad_rows: int


def is_bad(columns) -> F.Column:
    """Malformed: too few values, or a value that is there but could not be
    read.  Further values after the last column are ignored, as an external
    table with unknown values ignored does."""
    service = next(s for s, c in PICKUP_COLUMN.items() if c in columns)
    names = [f.name for f in RAW_SCHEMAS[service].fields]
    values = F.split(F.col(CORRUPT), ",")
    unread = [F.col(n).isNull() & (F.trim(F.get(values, F.lit(i))) != "") for i, n in enumerate(names)]
    return F.col(CORRUPT).isNotNull() & ((F.size(values) < len(names)) | reduce(or_, unread))


@contextmanager
def first_unit_only(stored: DataFrame) -> Iterator[DataFrame]:
    """Rows whose fingerprint is in no earlier ``unit`` (month) of the batch:
    what merging the units one after another would insert.  Rows that share
    a fingerprint inside one unit all stay, as in the warehouse MERGE.

    A narrow pass finds the hashes of fingerprints that occur in several
    units; only fingerprints with such a hash are compared.  What it finds is
    stored, so the planner knows its size: the whole rows are shuffled for it
    only where it is large.
    """
    hashed = stored.select(F.xxhash64("unique_row_id").alias("hash__"), "unit")
    shared = (dealt(hashed, join_tasks(stored), "hash__").groupBy("hash__", "unit").agg(F.lit(1))
              .groupBy("hash__").agg(F.count("*").alias("units")).filter("units > 1").select("hash__"))
    with sinks.staged(shared, "month_shared") as shared:
        if shared.isEmpty():
            yield stored.drop("unit")
            return
        first = (stored.select("unique_row_id", "unit", F.xxhash64("unique_row_id").alias("hash__"))
                 .join(shared, "hash__", "left_semi")
                 .groupBy("unique_row_id").agg(F.min("unit").alias("first_unit")))
        with sinks.staged(first, "month_first") as first:
            yield (stored.join(first, "unique_row_id", "left")
                   .filter("unit = coalesce(first_unit, unit)").drop("unit", "first_unit"))


def load_month(spark: SparkSession, staged: DataFrame, target_path: str,
               table: str | None = None, max_bad_rows: int | None = None,
               stored: bool = False) -> Loaded:
    """Merge staged months into the partitioned target.

    Creates the target when absent, skips an empty batch, and otherwise
    appends only rows whose fingerprint the target lacks (duplicates inside
    a month are all inserted, as the warehouse MERGE does).  Idempotent:
    loading the same month again inserts nothing.

    The batch is parsed once, into a table that the later steps read;
    ``stored`` says that it is read from such a table already.  With
    the column of malformed lines (``files.CORRUPT``) those rows are counted
    and returned; more than ``max_bad_rows`` of them fail the load before
    anything is written.  With ``unit`` the batch may hold several months.

    With ``table`` the target is a catalog table over ``target_path``: the
    anti-join reads the batch's days only, found in the catalog's partition
    list, and appends register their new days.
    """
    bad_col = CORRUPT if CORRUPT in staged.columns else None
    with nullcontext(staged) if stored else sinks.staged(staged, "month_batch") as batch:
        bad = batch.filter(is_bad(batch.columns)).count() if bad_col else 0
        if max_bad_rows is not None and bad > max_bad_rows:
            raise BadRows(f"{bad} malformed rows, {max_bad_rows} allowed")
        rows = batch.drop(bad_col) if bad_col else batch
        with first_unit_only(rows) if "unit" in rows.columns else nullcontext(rows) as rows:
            cols = [c for c in staged.columns if c not in (bad_col, "unit")]
            rows = rows.select(*cols)
            if table:
                created = sinks.create_table_if_absent(spark, rows, table, target_path,
                                                       partition_by=PART_COL)
            else:
                created = sinks.create_if_absent(spark, rows, target_path, partition_by=PART_COL)
            if merge.skip_if_empty(batch):
                return Loaded(0, bad)
            if created:                      # the rows come from the batch alone
                return Loaded(_append(rows, target_path, table), bad)
            target = spark.table(table) if table else spark.read.parquet(target_path)
            rows = merge.new_rows(target, rows, "unique_row_id", prune_on=PART_COL)
            # the append must not re-read its own output
            with sinks.staged(rows, "month_fresh") as fresh:
                return Loaded(_append(fresh, target_path, table), bad)


def _append(rows: DataFrame, target_path: str, table: str | None) -> int:
    """Add stored rows to their days of the target; returns how many."""
    n = rows.count()
    if n and table:
        sinks.save_table(rows, table, target_path, "append", partition_by=PART_COL)
    elif n:
        sinks.append(rows, target_path, partition_by=PART_COL)
    return n
