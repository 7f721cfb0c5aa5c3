"""Operator 11: ranked lexical search over a length-stratified index.

Terms are the maximal runs of ASCII letters and digits and of characters
outside ASCII; only A-Z are lower-cased.  A document's normaliser m follows
from its number of terms, and documents of equal m form a stratum.  Inside a
stratum the postings of a term are grouped by tf, the largest first, so an
impact is computed once per (m, tf) and holds for all documents of the group.

The index has one row per stratum, or per block of one where a stratum has
more than ``BLOCK_POSTINGS`` postings, so that a common length is spread over
tasks.  A search reads the index twice:

1. the largest tf of each term bounds what any document of a block can score
   for an item; each item's ``FIRST`` blocks of highest bound are visited;
2. the score of the k-th document found so far is the item's threshold, and
   every other block whose bound reaches it is visited.  The threshold rises
   within a task as documents are found.

A block is skipped for an item only if no document in it can be among the k,
ties included, so the result is that of scoring everything.

Items are searched in blocks of at most ``BLOCK_TERMS`` terms (or one item);
the terms of a block are what is sent to the executors, so its size does not
grow with the tables.  Each block of items passes once over the documents and
indexes the terms it asks for; N, L and the lengths count all terms.  What a
task returns is at most k documents an item.

Defined results: null and empty texts have no terms, count in neither N nor L
and are never found.  Texts are read whole, a slice at a time.  Items with
the same id are one item with the terms of all; a null item_id is an id.
Repeated rows are documents of their own; a null doc_id ranks after the
others of its score.  Items without a hit have no row.  An empty table gives
an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, read

K, FIRST = 10, 4
BLOCK_TERMS, BLOCK_POSTINGS = 200_000, 1 << 20
#: Bytes of a text whose terms are counted at a time.
PIECE = 4 << 20
#: ASCII letters lower-cased; everything that is in no term becomes a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
             for c in range(256))


# ------------------------------------------------------------------ terms

def counts(text: bytes) -> Counter:
    """How often each term of a text occurs."""
    folded = text.translate(FOLD)
    if len(folded) <= PIECE:
        return Counter(folded.split())
    out, at = Counter(), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        out.update(folded[at:end].split())
        at = end
    return out


def raw(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).fill_null(b"").to_pylist()


def item_terms(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        terms = pa.array([[t.decode() for t in counts(x)] for x in raw(batch.column("text"))], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), terms], names=["item_id", "terms"])


def matching(vocabulary: dict[bytes, int]):
    """mapInArrow: texts to (doc_id, n, terms, tfs) of the terms asked for."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in it:
            sizes, terms, tfs = [], [], []
            for text in raw(batch.column("text")):
                own = counts(text)
                met = own.keys() & known
                sizes.append(own.total())
                terms.append([vocabulary[t] for t in met])
                tfs.append([own[t] for t in met])
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array([n > 0 for n in sizes]))
    return run


# ------------------------------------------------------------------ index

INDEX = pa.schema([("m", pa.int64()), ("block", pa.int64()), ("docs", pa.list_(pa.int64())),
                   ("terms", pa.list_(pa.int32())), ("groups", pa.list_(pa.int32())),
                   ("tfs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("places", pa.list_(pa.int32()))])
INDEX_DDL = ("m long, block long, docs array<long>, terms array<int>, groups array<int>, tfs array<long>, "
             "sizes array<int>, places array<int>")


def inverted(m: int, block: int, rows: pa.Table) -> pa.RecordBatch:
    """One row of the index: terms ascending, each with its number of tf
    groups, largest tf first; a group is a tf and the places of its documents."""
    lists = rows.column("terms").combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    term = lists.flatten().to_numpy()
    tf = rows.column("tfs").combine_chunks().flatten().to_numpy()
    place = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    order = np.lexsort((place, -tf, term))
    term, tf, place = term[order], tf[order], place[order]
    new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])))
    sizes = np.diff(np.append(new, len(term))).astype(np.int32)
    names, first = np.unique(term[new], return_index=True)
    groups = np.diff(np.append(first, len(new))).astype(np.int32)
    own = {"m": m, "block": block, "docs": rows.column("doc_id").combine_chunks(), "terms": names, "groups": groups,
           "tfs": tf[new], "sizes": sizes, "places": place}
    columns = [pa.array([own[f.name]], f.type) if f.name in ("m", "block") else
               pa.ListArray.from_arrays(pa.array([0, len(own[f.name])], pa.int32()),
                                        own[f.name] if f.name == "docs" else pa.array(own[f.name], f.type.value_type))
               for f in INDEX]
    return pa.RecordBatch.from_arrays(columns, names=INDEX.names)


def indexed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (m, block) to one index row each."""
    held: list[pa.RecordBatch] = []
    key = None

    def flush():
        return inverted(*key, pa.Table.from_batches(held))

    for batch in it:
        m, block = (batch.column(c).to_numpy() for c in ("m", "block"))
        cuts = [0, *(np.flatnonzero((m[1:] != m[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            own = int(m[a]), int(block[a])
            if held and own != key:
                yield flush()
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield flush()


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], block_postings: int = BLOCK_POSTINGS
                ) -> tuple[DataFrame, int, np.ndarray]:
    """(index, N, df by term number) of ``docs`` (doc_id, text)."""
    found = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                        .mapInArrow(matching(vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"), "terms")
    n_docs, n_terms = found.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for term, n in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[term] = n
    strata = found.filter(F.size("terms") > 0).withColumn(
        "m", F.expr(f"100 - 90 + ((90 * n * {n_docs}L) div {max(n_terms or 0, 1)}L)")).withColumn("row", F.monotonically_increasing_id())
    blocks = strata.groupBy("m").agg(F.ceil(F.sum(F.size("terms")) / block_postings).cast("long").alias("blocks"))
    dealt = strata.join(blocks, "m").withColumn(
        "block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    index = (dealt.select("m", "block", "doc_id", "terms", "tfs").repartition("m", "block")
             .sortWithinPartitions("m", "block").mapInArrow(indexed, INDEX_DDL))
    return materialize(index, "strata"), n_docs, df


# ----------------------------------------------------------------- search

class Items:
    """The terms of a block of items, one after another, and their weights."""

    def __init__(self, terms: list[list[int]], weight: np.ndarray):
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
        self.term = np.array([t for own in terms for t in own], dtype=np.int64)
        self.weight = weight[self.term]
        self.vocabulary = len(weight)

    def __len__(self) -> int:
        return len(self.at) - 1


class Block:
    """An index row with its impacts."""

    def __init__(self, row: dict, items: Items):
        self.m, self.terms, groups = row["m"], row["terms"], row["groups"].astype(np.int64)
        tf = row["tfs"]
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * self.m)
        self.first = np.cumsum(groups) - groups
        where = np.full(items.vocabulary, -1, dtype=np.int64)
        where[self.terms] = np.arange(len(self.terms))
        self.where = where[items.term]
        top = np.append(self.impact[self.first], 0)
        total = np.concatenate([[0], np.cumsum(items.weight * top[self.where])])
        self.bounds = total[items.at[1:]] - total[items.at[:-1]]

    def score(self, item: int, items: Items, postings: tuple) -> np.ndarray:
        places, impacts, begin, n = postings
        out = np.zeros(n, dtype=np.int64)
        for k in range(items.at[item], items.at[item + 1]):
            t = self.where[k]
            if t >= 0:
                a, b = begin[t], begin[t + 1]
                out[places[a:b]] += items.weight[k] * impacts[a:b]
        return out

    def postings(self, row: dict) -> tuple:
        sizes = row["sizes"].astype(np.int64)
        begin = np.append((np.cumsum(sizes) - sizes)[self.first], sizes.sum())
        return row["places"], np.repeat(self.impact, sizes), begin, len(row["docs"])


def rows_of(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[dict]:
    for i in range(len(batch)):
        row = {"m": batch.column("m")[i].as_py(), "block": batch.column("block")[i].as_py()}
        for name in names:
            values = batch.column(name)[i].values
            row[name] = values if name == "docs" else values.to_numpy()
        yield row


def highest_bounds(items: Items, first: int):
    """mapInArrow: index rows to the ``first`` blocks of highest bound an item."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = np.zeros((len(items), 0), dtype=np.int64)
        unit = np.zeros((len(items), 0, 2), dtype=np.int64)
        for batch in it:
            for row in rows_of(batch, ("terms", "groups", "tfs")):
                own = Block(row, items).bounds
                bound = np.concatenate([bound, own[:, None]], axis=1)
                unit = np.concatenate([unit, np.broadcast_to([row["m"], row["block"]], (len(items), 1, 2))], axis=1)
                if bound.shape[1] > 8 * first:
                    best = np.argsort(-bound, axis=1, kind="stable")[:, :first]
                    bound = np.take_along_axis(bound, best, 1)
                    unit = np.take_along_axis(unit, best[:, :, None], 1)
        best = np.argsort(-bound, axis=1, kind="stable")[:, :first]
        bound, unit = np.take_along_axis(bound, best, 1), np.take_along_axis(unit, best[:, :, None], 1)
        item, k = np.nonzero(bound > 0)
        yield pa.RecordBatch.from_pydict({"item": item, "bound": bound[item, k], "m": unit[item, k, 0],
                                          "block": unit[item, k, 1]})
    return run


class Best:
    """The k best documents of an item so far."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.score, self.null, self.doc = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        self.score, self.null, self.doc = (np.concatenate(x) for x in (
            (self.score, score), (self.null, null), (self.doc, doc)))
        best = np.lexsort((self.doc, self.null, -self.score))[:self.k]
        self.score, self.null, self.doc = self.score[best], self.null[best], self.doc[best]
        if len(best) == self.k:
            self.least = max(self.least, int(self.score[-1]))


def visited(items: Items, k: int, least: np.ndarray, visits: dict[tuple[int, int], set[int]], chosen: bool):
    """mapInArrow: index rows to the k best documents of each item in a task.
    With ``chosen`` only the blocks in ``visits`` are looked at, else all
    others whose bound reaches the item's threshold."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for batch in it:
            for row in rows_of(batch, ("docs", "terms", "groups", "tfs", "sizes", "places")):
                block = Block(row, items)
                own = visits.get((row["m"], row["block"]), set())
                todo = sorted(own) if chosen else [i for i in np.flatnonzero(
                    (block.bounds > 0) & (block.bounds >= least)).tolist() if i not in own]
                if not todo:
                    continue
                postings = block.postings(row)
                null = row["docs"].is_null().to_numpy(zero_copy_only=False)
                docs = row["docs"].fill_null(0).to_numpy()
                for i in todo:
                    if i not in best:
                        best[i] = Best(k, max(int(least[i]), 1))
                    if block.bounds[i] < best[i].least:
                        continue
                    score = block.score(i, items, postings)
                    hit = np.flatnonzero(score >= best[i].least)
                    if len(hit) > 4 * k:
                        # only the k-th highest score and its ties can be among the k
                        low = np.partition(score[hit], len(hit) - k)[len(hit) - k]
                        hit = hit[score[hit] >= low]
                    if len(hit):
                        best[i].add(score[hit], null[hit], docs[hit])
        for i, own in best.items():
            if len(own.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own.score), i, np.int64)), pa.array(own.score),
                     pa.array(own.doc, mask=own.null)], names=["item", "score", "doc_id"])
    return run


FOUND = "item long, score long, doc_id long"


def search_block(docs: DataFrame, asked: list[tuple[object, list[str]]], id_type: T.DataType, k: int, first: int,
                 block_postings: int) -> DataFrame:
    """The k best documents of each of ``asked`` [(item_id, terms)]."""
    spark = docs.sparkSession
    vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for _, own in asked for t in own}))}
    index, n_docs, df = build_index(docs, vocabulary, block_postings)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
    items = Items([[vocabulary[t.encode()] for t in own] for _, own in asked], weight)

    top = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "block")
    chosen = (index.select("m", "block", "terms", "groups", "tfs")
              .mapInArrow(highest_bounds(items, first), "item long, bound long, m long, block long")
              .withColumn("r", F.row_number().over(top)).filter(F.col("r") <= first).collect())
    visits: dict[tuple[int, int], set[int]] = {}
    for row in chosen:                                   # at most ``first`` an item
        visits.setdefault((row["m"], row["block"]), set()).add(row["item"])
    units = spark.createDataFrame([(*u,) for u in visits], "m long, block long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    early = materialize(index.join(F.broadcast(units), ["m", "block"], "left_semi").mapInArrow(
        visited(items, k, np.zeros(len(items), np.int64), visits, True), FOUND)
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "found")
    least = np.zeros(len(items), dtype=np.int64)
    for row in early.filter(F.col("rank") == k).collect():
        least[row["item"]] = row["score"]

    late = index.mapInArrow(visited(items, k, least, visits, False), FOUND)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(asked)],
                                  T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type)]))
    return (early.drop("rank").unionByName(late).withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k).join(names, "item").select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = K, first: int = FIRST, block_terms: int = BLOCK_TERMS,
           block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of ``docs`` (doc_id,
    text) that score highest for each of ``items`` (item_id, text)."""
    spark, id_type = docs.sparkSession, items.schema["item_id"].dataType
    asked = (items.select("item_id", F.col("text").cast("string").alias("text"))
             .mapInArrow(item_terms, f"item_id {id_type.simpleString()}, terms array<string>")
             .groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))
             .filter(F.size("terms") > 0).orderBy("item_id"))
    parts: list[DataFrame] = []
    held, size = [], 0
    for item_id, terms in materialize(asked, "items").toLocalIterator():
        if held and size + len(terms) > block_terms:
            parts.append(search_block(docs, held, id_type, k, first, block_postings))
            held, size = [], 0
        held.append((item_id, terms))
        size += len(terms)
    if held:
        parts.append(search_block(docs, held, id_type, k, first, block_postings))
    if not parts:
        return spark.createDataFrame([], T.StructType([
            T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOLDED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + TERM + "')"

OP11_SQL = f"""
WITH d AS (
  SELECT doc_id, {FOLDED} AS t FROM documents),
n AS (
  SELECT row_number() OVER () AS rid, doc_id, t, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
c AS (
  SELECT count(*)::BIGINT AS total, sum(n)::BIGINT AS length FROM n),
p AS (
  SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT rid, doc_id, n, unnest(t) AS term FROM n) GROUP BY ALL),
q AS (
  SELECT DISTINCT item_id, unnest({FOLDED}) AS term FROM benchmark),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term), c),
s AS (
  SELECT item_id, rid, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * total) // length)))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), c
  GROUP BY item_id, rid, doc_id),
r AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {K}"""
