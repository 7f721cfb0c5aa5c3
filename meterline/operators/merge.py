"""Write strategies without a transactional table format.

Each strategy is a pure function ``(target, source) -> DataFrame`` giving the
table's next content, plus a write step that rewrites only what changed.

Scale notes:
* the anti-joins shuffle both sides on the key once; target keys are
  de-duplicated with a partial aggregate first (same partitioning, so the
  join adds no second exchange), and AQE splits a hot left-side key;
* ``prune_on`` restricts the target to the source's partition range before
  the join, so a monthly batch reads a month of the target, not all of it;
* the high-water mark is one aggregated row, turned into a literal so the
  filter prunes partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators import sinks
from meterline.operators.sinks import write_table


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def partition_values(df: DataFrame, part_col: str) -> list:
    """The values of a partition column (a day or a month) that ``df`` has
    rows for: one small aggregate, as many values as the batch has days."""
    return [r[0] for r in df.select(part_col).distinct().collect()]


def in_partitions(part_col: str, values: Sequence) -> Column:
    known = [v for v in values if v is not None]
    cond = F.col(part_col).isin(known) if known else F.lit(False)
    return cond | F.col(part_col).isNull() if len(known) < len(values) else cond


#: Up to so many partitions stand in a filter as literals.
LITERAL_PARTITIONS = 200


def rows_of_partitions(df: DataFrame, part_col: str, values: Sequence) -> DataFrame:
    """Rows of ``df`` whose partition is among ``values``.

    Few values are a filter.  Many (a backfill of thousands of days) are a
    table joined to the partition column, so the plan stays small; its range
    prunes partitions when planned, the join prunes the rest when run.  The
    values are on the driver already, so their broadcast is no larger.
    """
    known = sorted({v for v in values if v is not None})
    if len(known) <= LITERAL_PARTITIONS:
        return df.filter(in_partitions(part_col, values))
    wanted = df.sparkSession.createDataFrame(
        [(v,) for v in known], T.StructType([T.StructField("wanted__", df.schema[part_col].dataType)]))
    # a comparison on the small side makes the join prune partitions of the other
    wanted = wanted.filter(F.col("wanted__") >= F.lit(known[0]))
    held = df.filter(F.col(part_col).between(F.lit(known[0]), F.lit(known[-1])))
    out = held.join(F.broadcast(wanted), F.col(part_col) == F.col("wanted__"), "left_semi")
    return out.unionByName(df.filter(F.col(part_col).isNull())) if None in values else out


def prune_target(target: DataFrame, source: DataFrame, part_col: str) -> DataFrame:
    """Target rows of the partitions the source has rows for; one stray date
    adds its own partition, not all between.  Exact when the merge key
    determines ``part_col`` (the fingerprint includes the pickup time)."""
    return rows_of_partitions(target, part_col, partition_values(source, part_col))


def aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns in its order; those the batch lacks are NULL."""
    have = {c.lower() for c in source.columns}
    return source.select(*[F.col(f.name) if f.name.lower() in have
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def counted_unique(batch: DataFrame, keys: Sequence[str]) -> int:
    """Rows of a batch; an error if a key repeats (both from one pass)."""
    r = (batch.groupBy(*keys).agg(F.count("*").alias("n"))
         .agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first())
    if (r["most"] or 0) > 1:
        raise ValueError(f"merge source has duplicate keys on {list(keys)}")
    return r["rows"] or 0


def new_rows(target: DataFrame, source: DataFrame, key, prune_on: str | None = None) -> DataFrame:
    """Source rows whose key is absent from the target."""
    ks = _keys(key)
    t = prune_target(target, source, prune_on) if prune_on else target
    return source.join(t.select(*ks).distinct(), ks, "left_anti")


def merge_insert(target: DataFrame, source: DataFrame, key, dedup_source: bool = False,
                 prune_on: str | None = None) -> DataFrame:
    """K9: insert-only MERGE; rows whose key is already in the target are skipped.

    Faithful default: duplicate keys *inside* the batch are all inserted;
    ``dedup_source=True`` keeps one row per key.  Columns are aligned by name.
    """
    ks = _keys(key)
    src = source.dropDuplicates(ks) if dedup_source else source
    return target.unionByName(new_rows(target, src, ks, prune_on))


def merge_upsert(target: DataFrame, source: DataFrame, key,
                 append_new_columns: bool = True, check_unique: bool = True) -> DataFrame:
    """Update matching keys with the source row, insert the rest.

    With ``append_new_columns`` a source column unknown to the target is added
    and old rows get NULL.  A source that repeats a key is an error, unless
    the caller has checked it and says ``check_unique=False``.
    """
    ks = _keys(key)
    if check_unique:
        counted_unique(source, ks)
    kept = target.join(source.select(*ks).distinct(), ks, "left_anti")
    if not append_new_columns:
        source = aligned(source, target)
    return kept.unionByName(source, allowMissingColumns=append_new_columns)


def delete_insert(target: DataFrame, source: DataFrame, key) -> DataFrame:
    """Delete target rows whose key is in the source, insert all source
    rows (source duplicates are kept, unlike K10)."""
    ks = _keys(key)
    return target.join(source.select(*ks).distinct(), ks, "left_anti").unionByName(source)


def in_interval(column: str, start, end):
    """half-open ``start <= column < end``."""
    c = F.col(column)
    return (c >= F.lit(start)) & (c < F.lit(end))


def replace_interval(target: DataFrame, rows: DataFrame, column: str, start, end) -> DataFrame:
    """Delete target rows in [start, end), insert ``rows`` (those in the
    interval).  An interval with no new rows ends up empty."""
    keep = target.filter(~in_interval(column, start, end) | F.col(column).isNull())
    return keep.unionByName(rows.filter(in_interval(column, start, end)))


def skip_if_empty(source: DataFrame) -> bool:
    """True when the staged batch has no rows (reads at most one row)."""
    return source.isEmpty()


def high_water_mark(target: DataFrame | None, column: str, part_col: str | None = None):
    """``max(column)`` of the target, or None for a missing/empty target.

    With ``part_col`` (a partition column that does not decrease as
    ``column`` grows, e.g. its month) only the newest partition is scanned
    for the maximum: the first aggregate reads the partition column alone
    (no data columns), so the mark costs one partition, not the table.
    """
    if target is None:
        return None
    if part_col is not None:
        top = target.agg(F.max(part_col).alias("p")).first()["p"]
        if top is None:
            return None
        target = target.filter(F.col(part_col) == F.lit(top))
    return target.agg(F.max(column).alias("m")).first()["m"]


def incremental_rows(rows: DataFrame, target: DataFrame | None, column: str,
                     policy: str = "high_water_mark", lookback: dt.timedelta | None = None,
                     part_col: str | None = None):
    """Rows to (re)process in an incremental run.

    ``high_water_mark`` (faithful): only rows strictly after the target's max;
    late rows and rows equal to the max are dropped; an empty target is a
    first run.  ``lookback``: rows after ``max - lookback`` are reprocessed
    (write them with :func:`replace_interval`).
    """
    mark = high_water_mark(target, column, part_col)
    if mark is None:
        return rows
    if policy == "lookback":
        return rows.filter(F.col(column) >= F.lit(mark - (lookback or dt.timedelta(0))))
    return rows.filter(F.col(column) > F.lit(mark))


def write_new_version(df: DataFrame, path: str, partition_by=None, cluster_by=None) -> str:
    """Write the next full version of a table to a fresh path."""
    return write_table(df, path, "overwrite", partition_by, cluster_by)


def overwrite_partitions(spark: SparkSession, df: DataFrame, path: str,
                         partition_by: Sequence[str] | str, emptied: Sequence = ()) -> str:
    """Rewrite only the partitions present in ``df`` (dynamic overwrite) and
    remove the partitions listed in ``emptied`` that now have no rows.

    This is the write step of K10/K12/K13 on a partitioned table: untouched
    partitions are not read or rewritten.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    # dynamic overwrite as a write option: no session-wide setting is changed
    write_table(df, path, "overwrite", parts, options={"partitionOverwriteMode": "dynamic"})
    if emptied:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for value in emptied:
            p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{parts[0]}={value}")
            p.getFileSystem(conf).delete(p, True)
    return path


def replace_interval_table(spark: SparkSession, rows: DataFrame, name: str, path: str,
                           column: str, start, end, part_col: str,
                           part_of: Callable[[Column], Column]) -> None:
    """K12 on a partitioned catalog table: the table's rows with ``column``
    in ``[start, end)`` are replaced by ``rows`` in that interval.

    ``part_of`` derives the partition value from ``column`` (a day or month
    of a timestamp: it must not decrease as ``column`` grows) and ``rows``
    carry it as ``part_col``.  Only the interval's first and last partition
    can hold rows outside it; only those are read.  The partitions before
    the run come from the catalog; those left without rows are dropped.  The
    new content is written once to the shared folder first, so the overwrite
    never reads what it replaces, and a run that broke off is repaired by
    running it again.
    """
    created = sinks.create_table_if_absent(spark, rows, name, path, partition_by=part_col)
    target = spark.table(name)
    inside = aligned(rows, target).filter(in_interval(column, start, end))
    if created:  # first run: the interval's rows are the whole table
        sinks.overwrite_table_partitions(inside, name, part_col)
        return
    ctype = rows.schema[column].dataType
    # the interval is half-open: its last partition holds the last instant before ``end``
    last = F.lit(end).cast(ctype)
    last = (F.date_sub(last, 1) if isinstance(ctype, T.DateType)
            else last - F.expr("INTERVAL 1 MICROSECOND"))
    b = spark.range(1).select(part_of(F.lit(start).cast(ctype)).alias("lo"),
                              part_of(last).alias("hi")).first()
    edges = target.filter(in_partitions(part_col, list({b["lo"], b["hi"]})))
    kept = edges.filter(~in_interval(column, start, end) | F.col(column).isNull())
    before = {v for v in sinks.listed_partitions(spark, name)
              if v is not None and str(b["lo"]) <= v <= str(b["hi"])}
    with sinks.staged(kept.unionByName(inside), f"{name}_interval") as new:
        after = {str(v) for v in partition_values(new, part_col)}
        if after:
            sinks.overwrite_table_partitions(new, name, part_col)
    sinks.drop_table_partitions(spark, name, path, part_col, sorted(before - after))


def _registered(spark: SparkSession, source: DataFrame, name: str, path: str, part_col: str,
                append_new_columns: bool, full_refresh: bool) -> tuple[DataFrame, bool]:
    """(target, whether it is empty because it was just made), with the
    source's new columns added to it."""
    if full_refresh:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        sinks.delete_folder(spark, path)
    created = sinks.create_table_if_absent(spark, source, name, path, partition_by=part_col)
    known = {c.lower() for c in spark.table(name).columns}
    extra = [f for f in source.schema.fields if f.name.lower() not in known]
    if extra and append_new_columns:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
        spark.catalog.refreshTable(name)
    return spark.table(name), created


def partitions_of_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str], part_col: str) -> list:
    """Partitions of ``target`` that hold a key of ``batch``: reads the key
    and partition columns only, of the whole table."""
    held = target.select(*keys, part_col).join(batch.select(*keys).distinct(), list(keys), "left_semi")
    return partition_values(held, part_col)


def _merge_partitions(spark: SparkSession, batch: DataFrame, path: str, target: DataFrame, name: str,
                      keys: Sequence[str], part_col: str, created: bool, key_fixes_partition: bool) -> None:
    """Write a staged batch: partitions the table lacks are appended as they
    are; of the others the rows whose key is in the batch give way, also in
    partitions the batch has no row for unless the key fixes the partition."""
    values = partition_values(batch, part_col)
    old = set() if created else sinks.listed_partitions(spark, name)
    shared = [v for v in values if (None if v is None else str(v)) in old]
    left = [] if created or key_fixes_partition else [
        v for v in partitions_of_keys(target, batch, keys, part_col) if v not in shared]
    if shared or left:
        touched = rows_of_partitions(target, part_col, shared + left)
        own = rows_of_partitions(batch, part_col, shared)
        gone = batch if left else own
        merged = touched.join(gone.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns)
        with sinks.staged(merged.unionByName(own), f"{name}_merged") as new:
            still = partition_values(new, part_col) if left else []
            sinks.overwrite_table_partitions(new, name, part_col)
        emptied = [v for v in left if v not in still]
        sinks.drop_table_partitions(spark, name, path, part_col, [v for v in emptied if v is not None])
        if None in emptied:
            sinks.drop_null_partition(spark, name, path, part_col)
    if len(shared) < len(values):
        sinks.append_table_partitions(
            rows_of_partitions(batch, part_col, [v for v in values if v not in shared]), name, part_col)


def merge_upsert_table(spark: SparkSession, source: DataFrame, name: str, path: str, key,
                       part_col: str, append_new_columns: bool = True, full_refresh: bool = False,
                       check: Callable[[DataFrame], object] | None = None,
                       key_fixes_partition: bool = False) -> int:
    """K10/K11 on a partitioned catalog table (an incremental model).

    A key's old row may sit in another partition than its new one (a date
    that was corrected): the partitions that hold keys of the batch are found
    by one scan of the key and partition columns, and rewritten too.  With
    ``key_fixes_partition`` the caller vouches that the key determines
    ``part_col`` (the trip key holds the pickup time and the table is
    partitioned by its month): then only partitions the batch has rows for
    are looked at, and a run costs its batch, not the table.  A source column
    unknown to the table is added to it first (old rows read NULL); one the
    source lacks is NULL in its rows.  A key that repeats in the batch is an
    error, on the first run too.  ``full_refresh`` (K14) drops what is there
    and rebuilds from ``source``, which must not read the table.  ``check``
    (say, an output contract) sees the batch before anything is written.
    Returns the number of source rows (0: nothing written, K16; a table that
    is not registered is, all the same).
    """
    ks = _keys(key)
    if check is not None:
        check(source)
    # the batch is computed once; every later step reads the written copy
    with sinks.staged(source, f"{name}_batch") as batch:
        n = counted_unique(batch, ks)
        if n == 0 and not full_refresh and spark.catalog.tableExists(name):
            return 0
        target, created = _registered(spark, batch, name, path, part_col, append_new_columns, full_refresh)
        _merge_partitions(spark, aligned(batch, target), path, target, name, ks, part_col, created,
                          key_fixes_partition)
        return n


def delete_insert_table(spark: SparkSession, source: DataFrame, name: str, path: str, key,
                        part_col: str, key_fixes_partition: bool = False) -> int:
    """K13 on a partitioned catalog table: as the upsert, but rows that share
    a key in the batch are all inserted."""
    with sinks.staged(source, f"{name}_batch") as batch:
        n = batch.count()
        if n:
            target, created = _registered(spark, batch, name, path, part_col, False, False)
            _merge_partitions(spark, aligned(batch, target), path, target, name, _keys(key), part_col, created,
                              key_fixes_partition)
        return n


def merge_insert_table(spark: SparkSession, source: DataFrame, name: str, path: str, key,
                       part_col: str) -> int:
    """K9 on a partitioned catalog table whose key fixes the partition (a
    fingerprint that holds the pickup time): appends the batch rows whose key the
    table lacks (keys that repeat inside the batch are all inserted); reads
    the batch's partitions only.  Returns the number of rows inserted."""
    with sinks.staged(source, f"{name}_batch") as batch:
        target, created = _registered(spark, batch, name, path, part_col, False, False)
        batch = aligned(batch, target)
        if created:
            fresh = batch
        else:
            fresh = new_rows(target, batch, key, prune_on=part_col).select(*target.columns)
        with sinks.staged(fresh, f"{name}_fresh") as rows:
            n = rows.count()
            if n:
                sinks.append_table_partitions(rows, name, part_col)
            return n
