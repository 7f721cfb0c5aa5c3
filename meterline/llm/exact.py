"""Operator 2: exact dedup by stateful streaming.

The table's files are read as a stream.  Keyed state (RocksDB on the
executors' disks, checkpointed to the shared folder, no watermark and so no
expiry) holds for every digest of a normalised text the earliest row's
stable identifier, its content locator (file and row) and the group's size.
Running again on the same ``state`` folder takes in new files only.

The state is then read as a table; every row meets its digest's entry, and
every hit is compared byte by byte with the text of the row that stays.
Texts that differ in spite of equal digests are grouped by the texts
themselves.

Texts are equal when identical after replacing each run of white space by
one space.  Of equal texts the row with the smallest id stays; null ids come
last, and rows with one id are told apart by their locator.  Null counts as
the empty text, and all empty texts are copies of one another.  Every row
gives one row; other columns are ignored; an empty table gives none.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import materialize

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # else every state partition sets 4 MB aside, however little it holds
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: F.Column | str) -> F.Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")),
                            "[\\x20\\x09-\\x0D]+", " ")


def digested(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, at, text): ``at`` orders rows and names each one."""
    doc_id = F.col(id_col).cast("long")
    return rows.select(
        normalised(text_col).alias("text"),
        F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"),
                 F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.row_index").alias("row")).alias("at"),
    ).select(F.sha2("text", 256).alias("digest"), "at", "text")


def keyed_state(spark: SparkSession, path: str, state: str, id_col: str, text_col: str) -> DataFrame:
    """Stream the files of ``path`` into the state folder; the state as
    (digest, first, size)."""
    schema = spark.read.parquet(path).schema
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        # as a pattern, so that a table may be one file or a folder of files
        pattern = path.rstrip("/")
        stream = spark.readStream.schema(schema).parquet(f"{pattern[:-1]}[{pattern[-1]}]")
        (digested(stream, id_col, text_col)
         .groupBy("digest").agg(F.min("at").alias("first"), F.count("*").alias("size"))
         .writeStream.format("noop").outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", state).start().awaitTermination())
        entries = spark.read.format("statestore").load(state)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    first, size = entries.schema["value"].dataType.fieldNames()
    return entries.select(F.col("key.digest").alias("digest"), F.col(f"value.`{first}`").alias("first"),
                          F.col(f"value.`{size}`").alias("size"))


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                state: str | None = None) -> DataFrame:
    """One row per row of the Parquet table at ``path``."""
    state = state or f"{shared_dir(spark).rstrip('/')}/state/exact-{uuid.uuid4().hex[:12]}"
    entries = keyed_state(spark, path, state, id_col, text_col)
    # texts move once; those of groups are kept for the comparison
    rows = materialize(
        digested(spark.read.parquet(path), id_col, text_col).join(entries, "digest")
        .withColumn("text", F.when(F.col("size") > 1, F.col("text"))), "met")
    kept = rows.filter((F.col("at") == F.col("first")) & (F.col("size") > 1)).select(
        "digest", F.col("text").alias("kept_text"))
    checked = materialize(
        rows.join(kept, "digest", "left")
        .withColumn("same", (F.col("size") == 1) | (F.col("text") == F.col("kept_text")))
        .select("digest", "at", "first", "size", "same",
                F.when(~F.col("same"), F.col("text")).alias("other_text")), "exact")
    if not checked.filter("not same").limit(1).count():
        return result(checked)
    # equal digests, different texts: those that differ make groups of their own
    other = checked.filter("not same")
    lost = other.groupBy("digest").agg(F.count("*").alias("lost"))
    own = other.groupBy("digest", "other_text").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    main = checked.filter("same").join(lost, "digest", "left").withColumn(
        "size", F.col("size") - F.coalesce("lost", F.lit(0)))
    return result(main).unionByName(
        result(other.drop("first", "size").join(own, ["digest", "other_text"])))


def result(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("at.doc_id").alias("doc_id"), F.col("first.doc_id").alias("keep_id"),
                       F.col("size").alias("group_size"), (F.col("at") == F.col("first")).alias("kept"),
                       F.col("digest").alias("text_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d"""
