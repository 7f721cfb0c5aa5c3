"""Operator 5: near-duplicate documents by circulant MinHash.

A document's set holds its distinct five-word shingles.  C-MinHash needs two
permutations only: the first scatters the set over 2**32 places, the second,
circularly shifted by one place per coordinate, gives every coordinate of
the signature.  Bands of four coordinates make candidate buckets; links are
confirmed by the exact Jaccard similarity of the full sets.

No bucket is turned into all its pairs:

* documents with equal sets are one class and meet the rest as one;
* shingles that one candidate alone has can be in no intersection, so a
  pair's similarity is bounded by what either shares with anybody; documents
  that share too little for any link leave here;
* each member of a bucket is compared with the member that shares most,
  which in a cloud of copies is the one next to the original, and with its
  two most similar neighbours in sorted buckets; what is linked that way is
  already connected;
* then only buckets whose members are still in different components are
  looked at.  Members are dealt into blocks; those outside the bucket's
  largest component visit every block, and full sets are compared there where
  that bound and the signatures leave a similarity of 0.75 possible.  A block
  knows which components it has joined and gives one link for each, so links
  are fewer than members; rows shuffled are the members, and for each member
  outside the largest component the blocks of its bucket.

The sets that a popular member is compared with are dealt out in shares, so
no task gets a whole group.  Components are found by alternating large-star
and small-star rounds on written tables.

Misses: four coordinates a band and 32 bands let a pair at exactly 0.75 slip
through with a chance of 5e-6, and a signature that agrees in less than
``POSSIBLE`` of its places with one of 5e-5; both are less above 0.75.
Shingles are compared by 64 bits of hash.

Defined results: null, empty and blank texts have no set, are linked with
nothing and stay.  Fewer words than five are one shingle.  Repeated rows are
linked.  Null or repeated ids: see ``common.identified``.  Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (FIRST, SLICE, U64, hash_ranges, identified, materialize, mix, read, text_buffer,
                     word_bounds)

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 32, 4
#: Pairs whose signatures agree in less than this share are not compared.
POSSIBLE = 0.60
#: Neighbours a document is compared with before its components are known.
NEIGHBOURS = 2
#: Sets compared with one set in one task, and residents of a block.
SHARE, BLOCK = 20_000, 512
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ----------------------------------------------------------------- sets

def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets)
    words = hash_ranges(data, starts, ends)
    at = np.searchsorted(starts, offsets).tolist()
    for a, b in zip(at, at[1:]):
        n = b - a
        if n == 0:
            yield np.zeros(0, U64)
        elif n < SHINGLE:
            own = FIRST.prefix(words[a:b])
            yield FIRST.ranges(own, np.array([0]), np.array([n]))
        else:
            parts = [FIRST.windows(FIRST.prefix(words[c:min(c + SLICE + SHINGLE - 1, b)]), SHINGLE)
                     for c in range(a, b - SHINGLE + 1, SLICE)]
            yield np.unique(np.concatenate(parts) if len(parts) > 1 else parts[0])


def permuted(x: np.ndarray) -> np.ndarray:
    """The second permutation, a bijection of 32-bit places."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """C-MinHash signatures of non-empty sets."""
    begin = np.cumsum([0] + [len(s) for s in sets[:-1]])
    place = (mix(np.concatenate(sets)) >> U64(32)).astype(np.uint32)   # first permutation
    out = np.empty((len(sets), BANDS * ROWS), dtype=np.uint32)
    for k in range(BANDS * ROWS):
        out[:, k] = np.minimum.reduceat(permuted(place - np.uint32(k)), begin)
    return out


def bands_of(signature: np.ndarray) -> np.ndarray:
    word = mix(signature.astype(U64) + U64(1))
    rolled = np.zeros((len(signature), BANDS), dtype=U64)
    for r in range(ROWS):
        rolled = mix(rolled * U64(0x9E3779B97F4A7C15) + word[:, r::ROWS])
    return mix(rolled + np.arange(BANDS, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)).view(np.int64)


def signed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, doc_id, text) to sizes, set fingerprints, bands and signatures
    cut to one byte a coordinate."""
    def emit(batch, lo, hi, sizes, prints, sets, owners):
        bands, short = [None] * (hi - lo), [None] * (hi - lo)
        if sets:
            signature = signatures(sets)
            for i, b, s in zip(owners, bands_of(signature), (signature & 0xFF).astype(np.uint8)):
                bands[i - lo], short[i - lo] = b, s.tobytes()
        return pa.RecordBatch.from_arrays(
            [batch.column("rid").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo),
             pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary())],
            names=["rid", "doc_id", "n_shingles", "print", "bands", "short"])

    for batch in it:
        data, offsets = text_buffer(batch.column("text"))
        i = 0
        while i < len(batch):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, side="right")) - 1)
            sizes, prints, sets, owners, held, lo = [], [], [], [], 0, i
            own = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            for row, s in enumerate(own, start=i):
                sizes.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                if len(s):
                    sets.append(s)
                    owners.append(row)
                    held += len(s)
                if held >= 50_000:             # small enough to stay in a core's cache
                    yield emit(batch, lo, row + 1, sizes, prints, sets, owners)
                    sizes, prints, sets, owners, held, lo = [], [], [], [], 0, row + 1
            if lo < j:
                yield emit(batch, lo, j, sizes, prints, sets, owners)
            i = j


# ------------------------------------------------------------ candidates

def possible(short_a: str, short_b: str):
    """mapInArrow: keep rows whose two signatures agree in enough places."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if not len(batch):
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), -1)
                    for c in (short_a, short_b))
            agree = (a == b).mean(axis=1)
            keep = pa.array(agree >= POSSIBLE)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).filter(keep) for c in ("x", "hub", "star")), pa.array(agree).filter(keep)],
                names=["x", "hub", "star", "agree"])
    return run


def possible_size(shared_a: str, n_a: str, shared_b: str, n_b: str) -> F.Column:
    """Whether two sets may be similar enough, by what each shares with others."""
    most = F.least(shared_a, shared_b)
    return 100 * most >= PERCENT * (F.col(n_a) + F.col(n_b) - most)


def shared_buckets(reps: DataFrame) -> DataFrame:
    """(bucket, rid) of buckets with two members or more.  Most buckets hold
    one document and end here, so what the rounds read is small."""
    buckets = reps.select("rid", F.explode("bands").alias("bucket"))
    several = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    return buckets.join(several, "bucket")


def set_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, text) to (rid, members): the sorted shingle hashes."""
    for batch in it:
        data, offsets = text_buffer(batch.column("text"))
        i = 0
        while i < len(batch):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, side="right")) - 1)
            own = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid").slice(i, j - i), pa.array([x.tobytes() for x in own], pa.binary())],
                names=["rid", "members"])
            i = j


def owners(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, members) to one row per shingle of a batch: its only owner
    there, or null if it has several."""
    for batch in it:
        if not len(batch):
            continue
        blobs = batch.column("members").to_pylist()
        rid = np.repeat(batch.column("rid").to_numpy(), [len(b) // 8 for b in blobs])
        shingle, first, n = np.unique(np.frombuffer(b"".join(blobs), dtype=np.int64),
                                      return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(rid[first], mask=n > 1)],
                                         names=["shingle", "owner"])


def sharing(reps: DataFrame, sets: DataFrame) -> DataFrame:
    """(rid, n_shingles, short, bands, shared) of the candidates that may link with
    anybody: ``shared`` counts the shingles another candidate has too."""
    seen = sets.mapInArrow(owners, "shingle long, owner long").groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("owner").alias("owner"))
    alone = (seen.filter("n = 1 and owner is not null").groupBy("owner")
             .agg(F.count("*").alias("alone")).withColumnRenamed("owner", "rid"))
    return (reps.join(sets.select("rid"), "rid").join(alone, "rid", "left")
            .withColumn("shared", F.col("n_shingles") - F.coalesce("alone", F.lit(0))).drop("alone")
            .filter(100 * F.col("shared") >= PERCENT * F.col("n_shingles")))


def beside(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, places, rid): (x, hub) of neighbours in a
    bucket, and the first and last row of the partition with its number as
    ``part``, so that neighbours across partitions can be paired too."""
    part, first, last = TaskContext.get().partitionId(), None, None
    for batch in it:
        if not len(batch):
            continue
        bucket, rid = (batch.column(c).to_numpy() for c in ("bucket", "rid"))
        if last is not None:
            bucket, rid = np.append(last[0], bucket), np.append(last[1], rid)
        first = first or (int(bucket[0]), int(rid[0]))
        last = int(bucket[-1]), int(rid[-1])
        same = bucket[1:] == bucket[:-1]
        a, b = rid[1:][same], rid[:-1][same]
        yield pa.RecordBatch.from_pydict({
            "x": pa.array(np.maximum(a, b)), "hub": pa.array(np.minimum(a, b)),
            "part": pa.nulls(len(a), pa.int32()), "bucket": pa.nulls(len(a), pa.int64())})
    if first is not None:
        yield pa.RecordBatch.from_pydict({
            "x": pa.array([first[1], last[1]], pa.int64()), "hub": pa.array([0, 1], pa.int64()),
            "part": pa.array([part, part], pa.int32()), "bucket": pa.array([first[0], last[0]], pa.int64())})


def neighbours(members: DataFrame, able: DataFrame) -> DataFrame:
    """(x, hub): neighbours when each bucket is sorted by other places of the
    signature (in a chain of copies of copies, the next link).  A bucket may
    be spread over partitions; their ends are two rows a partition."""
    places = F.substring("short", F.pmod("bucket", F.lit(BANDS * ROWS - 8)).cast("int") + 1, F.lit(8))
    order = ("bucket", "places", "rid")
    pairs = materialize(members.select("bucket", "rid").join(able.select("rid", "short"), "rid")
                        .select("bucket", places.alias("places"), "rid")
                        .repartitionByRange(*order).sortWithinPartitions(*order)
                        .mapInArrow(beside, "x long, hub long, part int, bucket long"), "beside")
    ends = sorted((r["part"], r["hub"], r["bucket"], r["x"]) for r in pairs.filter("part is not null").collect())
    across = [(max(a[3], b[3]), min(a[3], b[3])) for a, b in zip(ends[1::2], ends[2::2]) if a[2] == b[2]]
    return pairs.filter("part is null").select("x", "hub").union(
        members.sparkSession.createDataFrame(across, "x long, hub long"))


def first_pairs(members: DataFrame, able: DataFrame) -> DataFrame:
    """(x, hub): the comparisons made first, few a document: with the member
    of each of its buckets that shares most, and with its most similar
    neighbours in sorted buckets."""
    hubs = members.groupBy("bucket").agg(F.max(F.struct("shared", (-F.col("rid")).alias("r"))).alias("top"))
    stars = (members.join(hubs.select("bucket", (-F.col("top.r")).alias("hub")), "bucket").filter("rid <> hub")
             .select(F.greatest("rid", "hub").alias("x"), F.least("rid", "hub").alias("hub"), F.lit(1).alias("star")))
    own, other = (able.select(F.col("rid").alias(name), F.col("n_shingles").alias(f"n_{name}"),
                              F.col("shared").alias(f"s_{name}"), F.col("short").alias(f"short_{name}"))
                  for name in ("x", "hub"))
    tried = (stars.union(neighbours(members, able).filter("x <> hub").withColumn("star", F.lit(0)))
             .groupBy("x", "hub").agg(F.max("star").alias("star"))
             .join(own, "x").join(other, "hub").filter(possible_size("s_x", "n_x", "s_hub", "n_hub"))
             .mapInArrow(possible("short_x", "short_hub"), "x long, hub long, star int, agree double"))
    best = Window.partitionBy("x").orderBy(F.desc("agree"), "hub")
    return (tried.withColumn("rank", F.row_number().over(best))
            .filter((F.col("star") == 1) | (F.col("rank") <= NEIGHBOURS)).select("x", "hub"))


class Residents:
    """The members of one block of an open bucket, and which of the components
    met there are joined by links found there."""

    def __init__(self):
        self.rows: list[dict] = []
        self.parent: dict[int, int] = {}
        self.columns: tuple | None = None

    def root(self, comp: int) -> int:
        at = self.parent.setdefault(comp, comp)
        while at != self.parent[at]:
            self.parent[at] = at = self.parent[self.parent[at]]
        return at

    def links(self, own: dict, bucket: int) -> Iterator[int]:
        """The residents that ``own`` has to be linked with, one a component."""
        if self.columns is None:
            self.columns = (*(np.array([r[c] for r in self.rows]) for c in ("rid", "comp", "n_shingles", "shared", "settled")),
                            np.frombuffer(b"".join(r["short"] for r in self.rows), np.uint8).reshape(len(self.rows), -1),
                            np.array([r["bands"] for r in self.rows]))
        rid, comp, size, shared, settled, short, bands = self.columns
        most = np.minimum(shared, own["shared"])
        # each pair once: visitors that are residents elsewhere come to the smaller one
        near = np.flatnonzero((comp != own["comp"]) & (settled | (rid < own["rid"]))
                              & (100 * most >= PERCENT * (size + own["n_shingles"] - most)))
        if not len(near):
            return
        agree = (short[near] == np.frombuffer(own["short"], np.uint8)).mean(axis=1)
        near, agree = near[agree >= POSSIBLE], agree[agree >= POSSIBLE]
        # a pair shares several buckets: its first one has it
        mine = np.array(own["bands"])
        near_first = bands[near, np.argmax(bands[near] == mine, axis=1)] == bucket
        near, agree = near[near_first], agree[near_first]
        base = np.frombuffer(own["members"], U64)
        for k in near[np.argsort(-agree, kind="stable")].tolist():
            a, b = self.root(int(comp[k])), self.root(own["comp"])
            if a != b and similar(base, np.frombuffer(self.rows[k]["members"], U64)):
                self.parent[max(a, b)] = min(a, b)
                yield int(rid[k])


def across(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, block, visitor): links (x, hub) that join two
    components.  A block's residents are held, its visitors pass by."""
    key, block = None, Residents()
    for batch in it:
        x, hub = [], []
        # sets are long: a few rows at a time become objects
        rows = (row for at in range(0, len(batch), 128) for row in batch.slice(at, 128).to_pylist())
        for row in rows:
            if key != (row["bucket"], row["block"]):
                key, block = (row["bucket"], row["block"]), Residents()
            if not row["visitor"]:
                block.rows.append(row)
                continue
            for other in block.links(row, row["bucket"]) if block.rows else ():
                x.append(max(other, row["rid"]))
                hub.append(min(other, row["rid"]))
        if x:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(hub, pa.int64())], names=["x", "hub"])


def open_links(members: DataFrame, able: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, hub): links of buckets whose members are still in different
    components.  The members of a bucket are dealt into blocks by hash; those
    of its largest component stay there, the others visit every block, are
    compared with the full sets of what may be similar, and only a link that
    joins two components is kept (fewer than a block has components)."""
    known = members.select("bucket", "rid").join(labels, "rid", "left").withColumn(
        "comp", F.coalesce("comp", "rid"))
    open_ = (known.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
             .groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("comps"),
                                    F.max(F.struct("n", "comp"))["comp"].alias("largest"))
             .filter("comps > 1").select("bucket", "largest", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    home = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    # residents have visitor 0; every member outside the largest component visits
    stays = F.array(F.struct(home.alias("block"), F.lit(0).alias("visitor")))
    goes = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), F.lit(1).alias("visitor")))
    dealt = (known.join(open_, "bucket").withColumn("settled", F.col("comp") == F.col("largest"))
             .select("bucket", "rid", "comp", "settled", F.explode(
                 F.when(F.col("settled"), stays).otherwise(F.concat(stays, goes))).alias("to"))
             .select("bucket", "rid", "comp", "settled", "to.*")
             .join(able.select("rid", "n_shingles", "shared", "short", "bands"), "rid").join(sets, "rid"))
    return (dealt.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "visitor", "rid")
            .mapInArrow(across, "x long, hub long").distinct())


# ---------------------------------------------------------- verification

def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are linked."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def confirmed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hub, share, member): the hub's set, then those to
    compare with it, one at a time."""
    key, base = None, None
    for batch in it:
        x, hub = [], []
        columns = zip(*(batch.column(c).to_pylist() for c in ("hub", "share", "member", "rid")),
                      batch.column("members"))
        for h, share, member, rid, blob in columns:
            own = np.frombuffer(blob.as_buffer(), dtype=U64)
            if not member:
                key, base = (h, share), own.copy()
                continue
            if key != (h, share):
                raise ValueError("a set came before the one it is compared with")
            if similar(base, own):
                x.append(rid)
                hub.append(h)
        if x:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(hub, pa.int64())],
                                             names=["x", "hub"])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, hub) whose full sets are similar enough.  A hub's set
    goes to each of its shares, every other set to its hubs."""
    shares = pairs.groupBy("hub").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    member = (pairs.join(shares, "hub")
              .select(F.col("x").alias("rid"), "hub", F.pmod(F.xxhash64("x"), F.col("shares")).cast("int").alias("share"),
                      F.lit(1).alias("member")))
    hubs = shares.select(F.col("hub").alias("rid"), "hub",
                         F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
                         F.lit(0).alias("member"))
    return (sets.join(member.unionByName(hubs), "rid").select("hub", "share", "member", "rid", "members")
            .repartition("hub", "share").sortWithinPartitions("hub", "share", "member")
            .mapInArrow(confirmed, "x long, hub long"))


# ------------------------------------------------------------ components

def components(links: DataFrame) -> DataFrame:
    """(rid, comp): the smallest rid reachable, for every rid in a link."""
    edges = materialize(links.select(F.greatest("x", "hub").alias("u"), F.least("x", "hub").alias("v"))
                        .filter("u <> v").distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.select(F.col("u").alias("rid"), F.col("v").alias("comp"))
        before = mark
        # large star: larger neighbours point to the smallest of all
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        # small star: smaller neighbours and the node itself point to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")


def drop_near_duplicates(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, *extra) of the first document of each component."""
    base = identified(docs, extra=extra)
    gone = near_duplicates(base).filter("not kept").select("rid")
    return base.join(gone, "rid", "left_anti").drop("rid")


def near_duplicates(base: DataFrame) -> DataFrame:
    """One row per document of ``identified`` documents:
    (rid, doc_id, n_shingles, component_id, kept)."""
    own = materialize(base.mapInArrow(
        signed, "rid long, doc_id long, n_shingles long, print binary, bands array<long>, short binary"), "signatures")
    classes = own.filter("n_shingles > 0").groupBy("print").agg(F.min("rid").alias("rep"))
    reps = own.join(classes.select(F.col("rep").alias("rid")), "rid", "left_semi").select(
        "rid", "n_shingles", "bands", "short")
    buckets = materialize(shared_buckets(reps), "buckets")
    candidates = buckets.select("rid").distinct()
    sets = materialize(base.select("rid", "text").join(candidates, "rid")
                       .mapInArrow(set_rows, "rid long, members binary"), "sets")
    able = materialize(sharing(reps, sets), "able")
    members = materialize(buckets.join(able.select("rid", "shared"), "rid"), "members")
    first = materialize(confirm(first_pairs(members, able), sets), "links")
    labels = components(first)
    more = materialize(open_links(members, able, sets, labels), "links")
    if more.limit(1).count():
        labels = components(first.union(more))
    names = own.select(F.col("rid").alias("to"), F.col("doc_id").alias("component_id"))
    return (own.select("rid", "doc_id", "n_shingles", "print")
            .join(classes, "print", "left")
            .join(labels.select(F.col("rid").alias("rep"), "comp"), "rep", "left")
            .withColumn("to", F.coalesce("comp", "rep", "rid"))
            .join(names, "to")
            .select("rid", "doc_id", "n_shingles", "component_id", (F.col("rid") == F.col("to")).alias("kept")))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(identified(read(spark, sf_dir, "documents"))).drop("rid")
