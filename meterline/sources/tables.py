"""Table scans by logical name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Resolve a logical table name to its parquet data.

    Column pruning and filter pushdown reach the scan because nothing here
    materialises; callers select what they need.  The files are listed on
    every call, so files added since the last one are read.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class Target:
    """V4: where a target's data lives (a folder, or a database of the
    catalog), and the sample of it that its staging models read."""
    root: str
    catalog: bool = False
    sample_range: tuple[str, str] | None = None


@dataclass(frozen=True)
class Sources:
    """The declared sources: which stored table each logical name stands
    for (its own name unless given), per target."""
    targets: Mapping[str, Target]
    default: str
    tables: Mapping[str, str] = field(default_factory=dict)

    def target(self, name: str | None = None) -> Target:
        name = self.default if name is None else name
        if name not in self.targets:
            raise KeyError(f"no target {name!r}; there are {sorted(self.targets)}")
        return self.targets[name]

    def table(self, spark: SparkSession, name: str, target: str | None = None) -> DataFrame:
        t, stored = self.target(target), self.tables.get(name, name)
        return spark.table(f"{t.root}.{stored}") if t.catalog else table(spark, t.root, stored)


def scan_splits(df: DataFrame) -> int:
    """Partitions a scan of splittable files will have, from the sizes its
    listing found: the plan is neither made nor run."""
    spark = df.sparkSession
    state = spark._jsparkSession.sessionState().conf()
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    opening = state.filesOpenCostInBytes()
    cores = spark.sparkContext.defaultParallelism
    split = min(state.filesMaxPartitionBytes(), max(opening, (size + opening) // cores))
    return -(-size // split)


#: File bytes of a joined table's rows that one task takes, and how many tasks
#: a join is dealt over at most (larger tables get larger tasks, which spill).
JOIN_BYTES, JOIN_TASKS = 16 * 1024 ** 2, 10_000


def join_tasks(df: DataFrame) -> int:
    """Tasks to deal a join of the scan ``df`` over, by the sizes its listing
    found: a task's rows stay the same however large the table.  0 where the
    scan is small enough to be left to the planner."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    tasks = min(JOIN_TASKS, -(-size // JOIN_BYTES))
    return tasks if tasks > df.sparkSession.sparkContext.defaultParallelism else 0


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` over ``tasks`` partitions, so that both sides
    of a join meet there.  Left to itself, the planner joins shuffled rows by
    64 MB of compressed bytes, which sorted are over ten times that."""
    return df.repartition(tasks, *keys) if tasks else df


def spread(df: DataFrame, splittable: bool = True) -> DataFrame:
    """Round-robin a scan that has fewer partitions than the cluster has
    cores (e.g. one file with a single row group, or one gzip CSV) over all
    cores, so the work after it runs in parallel.  Round-robin, not by key:
    a key holding a third of the rows still spreads evenly.  A scan that is
    already split (the usual case for large tables: many files) is returned
    unchanged, so this adds no shuffle at scale.  Files that cannot be split
    (gzip) are counted by planning their scan."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if (scan_splits(df) if splittable else df.rdd.getNumPartitions()) >= slots:
        return df
    return df.repartition(slots)


def read_parquet(spark: SparkSession, paths) -> DataFrame:
    """Parquet scan of one or many month files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*paths)
