"""A corpus pipeline over ``documents`` in five stages.

Each stage takes what the one before kept: (spark, docs, sf_dir) to a
DataFrame, written as Parquet and read again for the next.

1. toxicity: documents predicted toxic go.
2. line dedup: lines of recurring templates go; documents left without a
   word by that go too.
3. MinHash near-dedup: one document of each group stays.
4. substring dedup: words of passages that occur before go; documents left
   without a word by that go too.
5. best-fit packing: one row per piece.

Rows with a null id stay throughout; a repeated id stands for several
documents in stages 1 and 2, and the near-dedup keeps the first of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import materialize, read
from meterline.llm.line_templates import drop_recurring_lines
from meterline.llm.minhash import drop_near_duplicates
from meterline.llm.packing import pack, vocabulary_path
from meterline.llm.substring import remove_repeated_passages
from meterline.llm.toxicity import learn, passed

HAS_WORD = "[^\\x20\\x09-\\x0D]"


def bundled(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rest): the other columns in one, so that none can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(None).cast("int").alias("__")).alias("rest"))


def unbundled(rows: DataFrame, like: DataFrame, changed: F.Column) -> DataFrame:
    """Columns as in ``like``; where a text changed, n_chars follows it."""
    out = []
    for f in like.schema:
        if f.name in ("doc_id", "text"):
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == "n_chars":
            out.append(F.when(changed, F.length("text")).otherwise(F.col("rest.n_chars"))
                       .cast(f.dataType).alias("n_chars"))
        else:
            out.append(F.col(f"rest.`{f.name}`").alias(f.name))
    return rows.select(*out)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = learn(docs, read(spark, sf_dir, "labels"))
    return docs.mapInArrow(passed(model), docs.schema)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = drop_recurring_lines(bundled(docs), extra=("rest",))
    changed = F.col("n_dropped") > 0
    return unbundled(rows.filter(~changed | F.col("text").rlike(HAS_WORD)), docs, changed)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return unbundled(drop_near_duplicates(bundled(docs), extra=("rest",)), docs, F.lit(False))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = remove_repeated_passages(bundled(docs), extra=("rest",)).withColumnRenamed("kept_text", "text")
    changed = F.col("n_removed") > 0
    return unbundled(rows.filter(~changed | (F.col("n_removed") < F.col("n_words"))), docs, changed)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: A model, MinHash and a search are no SQL; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
