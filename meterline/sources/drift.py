"""Month files whose column types or names differ.

A long backfill meets files in which a count is an INT, a BIGINT or a DOUBLE,
or which lack a column.  One scan cannot read them together: parquet columns
are read with the type they were written in.  Here each file's schema comes
from its footer, files of one schema share a scan, every scan casts to one
common type per column, and the scans are joined by name.  Projections and
filters still reach every scan.

Common type of a column, by the types its files have:

* equal types stay; a column that is null-typed in a file takes the others';
* integers take the widest; an integer and a FLOAT, or FLOAT and DOUBLE,
  become DOUBLE (a BIGINT beyond 2**53 is rounded, as a concatenation of data
  frames does);
* decimals keep all digits before and after the point (DOUBLE if that is
  more than 38), an integer counts as a decimal of its digits; a decimal and
  a floating type become DOUBLE;
* DATE and a timestamp become the timestamp; the two timestamps become the
  one without zone;
* anything else becomes STRING.

Columns match by name, whatever the case; the first spelling is kept.  A file
that lacks a column has NULL there.  Files without rows count like others.
No paths is an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = [3, 5, 10, 19]
_FLOATS = (T.FloatType, T.DoubleType)


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_DIGITS[_INTEGERS.index(type(kind))], 0) if type(kind) in _INTEGERS else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _INTEGERS and type(b) in _INTEGERS:
        return max(a, b, key=lambda k: _INTEGERS.index(type(k)))
    da, db = _as_decimal(a), _as_decimal(b)
    if da and db:
        scale = max(da.scale, db.scale)
        whole = max(da.precision - da.scale, db.precision - db.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if (da or isinstance(a, _FLOATS)) and (db or isinstance(b, _FLOATS)):
        return T.DoubleType()
    times = (T.TimestampType, T.TimestampNTZType)
    if isinstance(a, T.DateType) and isinstance(b, times):
        return b
    if isinstance(b, T.DateType) and isinstance(a, times):
        return a
    return T.TimestampNTZType() if isinstance(a, times) and isinstance(b, times) else T.StringType()


def file_schemas(spark: SparkSession, paths: Iterable[str], at_once: int = 8) -> dict[str, T.StructType]:
    """Each path's schema, from one footer a path, a few paths at a time."""
    paths = list(paths)
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(paths, pool.map(lambda p: spark.read.parquet(p).schema, paths)))


def common_schema(schemas: Mapping[str, T.StructType]) -> T.StructType:
    """All columns of all files, in the order they are first met."""
    names: dict[str, str] = {}
    kinds: dict[str, T.DataType] = {}
    for schema in schemas.values():
        for f in schema.fields:
            key = f.name.lower()
            names.setdefault(key, f.name)
            kinds[key] = common_type(kinds[key], f.dataType) if key in kinds else f.dataType
    return T.StructType([T.StructField(n, T.StringType() if isinstance(kinds[k], T.NullType) else kinds[k])
                         for k, n in names.items()])


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def read_months(spark: SparkSession, paths: Sequence[str], schemas: Mapping[str, T.StructType] | None = None) -> DataFrame:
    """One frame of all files: a scan per schema, cast and joined by name."""
    schemas = schemas or file_schemas(spark, paths)
    if not schemas:
        raise ValueError("no month files")
    groups: dict[str, list[str]] = {}
    for path, schema in schemas.items():
        groups.setdefault(schema.json(), []).append(path)
    to = common_schema(schemas)
    scans = [conformed(spark.read.schema(schemas[own[0]]).parquet(*own), to) for own in groups.values()]
    return reduce(DataFrame.unionByName, scans)


def drift(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """(column_name, common_type, file_types, files, missing, drifts): one row
    per column; ``file_types`` are the types it was met with, in text order."""
    rows = []
    for f in common_schema(schemas).fields:
        own = [g.dataType.simpleString() for s in schemas.values() for g in s.fields if g.name.lower() == f.name.lower()]
        kinds = sorted(set(own))
        rows.append((f.name, f.dataType.simpleString(), ", ".join(kinds), len(own), len(schemas) - len(own),
                     len(kinds) > 1 or len(own) < len(schemas)))
    return spark.createDataFrame(rows, "column_name string, common_type string, file_types string, files long, "
                                       "missing long, drifts boolean")
