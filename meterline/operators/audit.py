"""Write, audit, publish (Q1-Q10, K1).

The checks of a suite that look at single rows are counted while the new
version is written (``Dataset.observe``): the version is computed once and
scanned by no check.  Checks on keys (unique, combination, relationships) and
custom ones read the written version, their columns only.  A version that
passes becomes the current one by one catalog change; one that fails stays
unpublished and readers keep what they had.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterline.operators import sinks
from meterline.operators.quality import RESULT_COLUMNS, Check, run_suite
from meterline.session import new_table_path

ROWS = "rows"


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation]:
    """``df`` whose rows are counted against the row checks when it is
    computed; ask the observation after the write."""
    seen = Observation(f"audit-{uuid.uuid4().hex[:12]}")
    metrics = [F.count(F.lit(1)).alias(ROWS)] + [
        F.count_if(c.predicate()).alias(f"f{i}") for i, c in enumerate(checks) if c.predicate is not None]
    return df.observe(seen, *metrics), seen


def counted(checks: Sequence[Check], seen: Observation) -> list[tuple[str, str, int, bool]]:
    """(check_name, column_name, failed_rows, passed) of the row checks."""
    got = seen.get
    return [(c.name, c.column, int(got[f"f{i}"]), int(got[f"f{i}"]) == 0)
            for i, c in enumerate(checks) if c.predicate is not None]


def observe_suites(suites: Mapping[str, Sequence[Check]], models: Mapping[str, DataFrame]) -> list[tuple]:
    """(model, check_name, column_name, failed_rows, passed) of row checks on
    ``models``, each computed once and discarded."""
    out = []
    for name, checks in suites.items():
        df, seen = observed(models[name], checks)
        df.write.format("noop").mode("overwrite").save()
        out += [(name, *row) for row in counted(checks, seen)]
    return out


class AuditFailed(ValueError):
    """The new version breaks a check; it is not published."""

    def __init__(self, audit: Audit):
        super().__init__("not published: " + ", ".join(
            f"{c} on {on or audit.name}: {n}" for c, on, n, ok in audit.results if not ok))
        self.audit = audit


@dataclass(frozen=True)
class Audit:
    """What an audited write found."""
    name: str
    path: str
    rows: int
    results: list[tuple[str, str, int, bool]]

    @property
    def passed(self) -> bool:
        return all(ok for *_, ok in self.results)

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.results, "check_name string, column_name string, failed_rows long, passed boolean")


def write_audit_publish(spark: SparkSession, df: DataFrame, name: str, checks: Sequence[Check], partition_by=None,
                        cluster_by=None, keep_failed: bool = False, raises: bool = True) -> Audit:
    """Write ``df`` as a new version of ``name``, check it, publish it.

    Every run writes to a fresh folder of the shared one, so a run that broke
    off is repeated without clearing anything, and readers of the version
    before are not disturbed.  A failing version is deleted unless
    ``keep_failed``; with ``raises`` it is an :class:`AuditFailed`.
    """
    path = new_table_path(spark, name.rsplit(".", 1)[-1])
    rows, seen = observed(df, checks)
    sinks.write_table(rows, path, "overwrite", partition_by, cluster_by)
    results = counted(checks, seen)
    later = [c for c in checks if c.frame is not None]
    if later:
        written = spark.read.schema(df.schema).parquet(path)
        results += [tuple(r) for r in run_suite(written, later).select(*RESULT_COLUMNS).collect()]
    audit = Audit(name, path, int(seen.get[ROWS]), results)
    if audit.passed:
        sinks.publish(spark, name, path)
        return audit
    if not keep_failed:
        sinks.delete_folder(spark, path)
    if raises:
        raise AuditFailed(audit)
    return audit
