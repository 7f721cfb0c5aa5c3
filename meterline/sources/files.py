"""File scans.

CSV(.gz) is parsed by Spark with an explicit schema; a gzip file is one task,
so month loads land as parquet once and everything downstream reads parquet.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import PAYMENT_LOOKUP, PAYMENT_TYPES, RAW_SCHEMAS

SERVICES = ("yellow", "green")
CORRUPT = "_corrupt_record"


def validate_month(year: int, month: int) -> tuple[int, int]:
    """V3: months are 1-12; years are four digits."""
    if not 1 <= int(month) <= 12:
        raise ValueError(f"month must be 1-12, got {month}")
    if not 1000 <= int(year) <= 9999:
        raise ValueError(f"year must have four digits, got {year}")
    return int(year), int(month)


def validate_service(service: str) -> str:
    if service not in SERVICES:
        raise ValueError(f"taxi type must be one of {SERVICES}, got {service!r}")
    return service


def month_name(service: str, year: int, month: int) -> str:
    """S9: '{taxi}_tripdata_{yyyy}-{mm}' (month zero-padded)."""
    year, month = validate_month(year, month)
    return f"{validate_service(service)}_tripdata_{year:04d}-{month:02d}"


def month_paths(base: str, services: Iterable[str], start: tuple[int, int],
                end: tuple[int, int], ext: str = ".csv.gz",
                layout: str = "{name}{ext}") -> list[str]:
    """Every month file from ``start`` to ``end`` (inclusive) per service.

    ``layout`` places the name under ``base`` (fields: name, ext, service,
    year, month), e.g. ``"month_file={name}{ext}"`` for files a Spark job
    landed with ``partitionBy``.
    """
    (y0, m0), (y1, m1) = validate_month(*start), validate_month(*end)
    out = []
    for svc in services:
        y, m = y0, m0
        while (y, m) <= (y1, m1):
            rel = layout.format(name=month_name(svc, y, m), ext=ext, service=svc,
                                year=y, month=m)
            out.append(f"{base.rstrip('/')}/{rel}")
            y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Keep the paths that exist (a backfill range may include months
    without a file); checked on the driver through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def read_trips_csv(spark: SparkSession, paths, service: str, strict: bool = False,
                   keep_corrupt: bool = False) -> DataFrame:
    """Month CSV(.gz) with the explicit raw schema and a header row.

    Default (``strict=False``) follows an external table with unknown values
    ignored: extra trailing columns are dropped and a malformed value becomes
    NULL; ``keep_corrupt=True`` adds ``_corrupt_record`` holding the raw line
    of such rows so they can be counted (a line with extra trailing values
    keeps its parsed values and is listed there too).  ``strict=True`` fails
    on them.
    """
    schema = RAW_SCHEMAS[validate_service(service)]
    reader = spark.read.option("header", True)
    if strict:
        reader = reader.option("mode", "FAILFAST")
    else:
        reader = reader.option("mode", "PERMISSIVE")
        if keep_corrupt:
            schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return reader.schema(schema).csv(paths)


def read_csv_inferred(spark: SparkSession, paths) -> DataFrame:
    """CSV with header and inferred types (exploration and small
    lookups only: inference costs an extra pass over the data)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("header", True).option("inferSchema", True).csv(paths)


def external_table(spark: SparkSession, name: str, paths, schema=None) -> DataFrame:
    """Register files (globs allowed) as a temp view named ``name``."""
    df = (read_csv_inferred(spark, paths) if schema is None else
          spark.read.option("header", True).schema(schema).csv(
              [paths] if isinstance(paths, str) else list(paths)))
    df.createOrReplaceTempView(name)
    return df


def with_file_name(df: DataFrame, column: str = "filename") -> DataFrame:
    """The source file's name as a column (lineage when many months are
    read in one scan)."""
    return df.withColumn(column, F.col("_metadata.file_name"))


def read_lookup(spark: SparkSession, path: str, schema=PAYMENT_LOOKUP) -> DataFrame:
    """Seed CSV with typed columns."""
    return spark.read.option("header", True).schema(schema).csv(path)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(list(rows), schema)


def payment_lookup(spark: SparkSession) -> DataFrame:
    """The payment lookup seed (payment_type_id, payment_type_name)."""
    return literal_table(spark, sorted(PAYMENT_TYPES.items()), PAYMENT_LOOKUP)
