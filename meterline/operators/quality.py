"""Data-quality checks.

Each check reports one row ``(check_name, column_name, failed_rows, passed)``.
Column checks on one table (not_null, accepted_values, non_negative,
positive) are folded into a single aggregate, so a suite scans the table
once however many such checks it holds.  Key checks (unique, combination,
relationships) each add one aggregation or anti-join; their partial
aggregates keep a hot key from landing whole in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_COLUMNS = ["check_name", "column_name", "failed_rows", "passed"]


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    # Row-level failure predicate (folded into the shared aggregate) ...
    predicate: Callable[[], Column] | None = None
    # ... or a function computing the failure count as a one-row frame.
    frame: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)


def not_null(col: str) -> Check:
    """Q1."""
    return Check("not_null", col, predicate=lambda: F.col(col).isNull())


def accepted_values(col: str, values: Sequence) -> Check:
    """Q3: NULL passes."""
    return Check("accepted_values", col,
                 predicate=lambda: F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def non_negative(col: str) -> Check:
    """Q6: NULL passes."""
    return Check("non_negative", col, predicate=lambda: F.col(col) < 0)


def positive(col: str) -> Check:
    """Q6: NULL passes."""
    return Check("positive", col, predicate=lambda: F.col(col) <= 0)


def _dup_groups(df: DataFrame, cols: Sequence[str], drop_nulls: bool) -> DataFrame:
    src = df.select(*cols)
    if drop_nulls:
        src = src.dropna(subset=list(cols))
    dups = src.groupBy(*cols).count().filter(F.col("count") > 1)
    return dups.agg(F.count(F.lit(1)).alias("failed_rows"))


def unique(col: str) -> Check:
    """Q2: number of non-NULL values that occur more than once."""
    return Check("unique", col, frame=lambda df: _dup_groups(df, [col], True))


def unique_combination(cols: Sequence[str]) -> Check:
    """Q5: number of column combinations (NULL is a value here) occurring more than once."""
    return Check("unique_combination", ",".join(cols),
                 frame=lambda df: _dup_groups(df, list(cols), False))


def primary_key(cols: Sequence[str]) -> list[Check]:
    """Q10: a declared key implies not-null columns and a unique combination."""
    return [not_null(c) for c in cols] + [unique_combination(cols)]


def relationships(col: str, parent: DataFrame, field_name: str) -> Check:
    """Child rows with a non-NULL key missing from the parent."""
    def frame(df: DataFrame) -> DataFrame:
        keys = parent.select(F.col(field_name).alias(col)).distinct()
        # Pre-aggregate the child to (key, rows) first: the anti-join then
        # shuffles one row per distinct key, so a key holding a third of the
        # table never lands whole in one task.
        per_key = (df.select(col).filter(F.col(col).isNotNull())
                     .groupBy(col).agg(F.count(F.lit(1)).alias("n")))
        orphans = per_key.join(keys, col, "left_anti")
        return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed_rows"))
    return Check("relationships", col, frame=frame)


def custom(name: str, query: Callable[[DataFrame], DataFrame], expected) -> Check:
    """A query's single value must equal ``expected``."""
    def frame(df: DataFrame) -> DataFrame:
        q = query(df)
        v = q.select(q.columns[0]).alias("v")
        return v.select(F.when(F.col(q.columns[0]) == F.lit(expected), 0).otherwise(1)
                        .cast("bigint").alias("failed_rows"))
    return Check("custom:" + name, "", frame=frame)


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Run ``checks`` on ``df``: all predicate checks in one aggregate, the
    rest one small job each, concatenated into one result frame."""
    preds = [c for c in checks if c.predicate is not None]
    parts: list[DataFrame] = []
    if preds:
        agg = df.agg(*[F.count_if(c.predicate()).alias(f"f{i}") for i, c in enumerate(preds)])
        rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"),
                                  F.lit(c.column).alias("column_name"),
                                  F.col(f"f{i}").cast("bigint").alias("failed_rows"))
                         for i, c in enumerate(preds)])
        parts.append(agg.select(F.explode(rows).alias("r")).select("r.*"))
    for c in checks:
        if c.frame is not None:
            parts.append(c.frame(df).select(F.lit(c.name).alias("check_name"),
                                            F.lit(c.column).alias("column_name"),
                                            F.col("failed_rows").cast("bigint")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failed_rows") == 0)


def freshness(df: DataFrame, column: str, as_of: dt.datetime, warn_hours: float = 24,
              error_hours: float = 48, source: str = "") -> DataFrame:
    """Q9: age of the newest ``column`` value at ``as_of``; status
    pass / warn (> warn_hours) / error (> error_hours); a missing column is
    ``skipped``.  The clock is an argument, so results are reproducible."""
    if column is None or column not in df.columns:
        return df.sparkSession.createDataFrame(
            [(source, None, None, "skipped")],
            "source string, max_loaded_at timestamp_ntz, age_hours double, status string")
    ref = F.lit(as_of).cast("timestamp_ntz")
    m = df.agg(F.max(column).cast("timestamp_ntz").alias("max_loaded_at"))
    # elapsed time between two zone-free timestamps: no session time zone involved
    age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), ref) / 3.6e9
    return m.select(
        F.lit(source).alias("source"), "max_loaded_at",
        F.round(age, 6).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(age > error_hours, "error")
         .when(age > warn_hours, "warn")
         .otherwise("pass").alias("status"))


def contract_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Q8 report: one row per contract column with the actual type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(f.name, f.dataType.simpleString(), actual.get(f.name),
             actual.get(f.name) == f.dataType.simpleString()) for f in contract.fields]
    rows += [(n, None, t, False) for n, t in actual.items() if n not in contract.fieldNames()]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, actual_type string, matches boolean")


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Q8: fail before writing when names, order or types drift."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in contract.fields]
    if got != want:
        diff = [(w, g) for w, g in zip(want, got) if w != g] or (want, got)
        raise ValueError(f"contract violated: {diff}")
    return df
