"""Candidate search for windows of ``width`` symbols that occur twice.

A symbol is a byte or a word.  Every window picks one anchor: its run of
``k`` symbols with the smallest hash.  Equal windows pick the same place, so
windows can only be equal when their anchors have the same run (``key``).
Consecutive windows mostly share an anchor; one row stands for them, with
``o1..o2`` the distances from a window's start to the anchor, and ``ctx``
the hash of all symbols those windows touch.

* Rows with equal (key, ctx) hold the same windows: the earliest stays as
  their representative, all windows of the others repeat.  Within a batch
  this is settled before the shuffle, like a map-side combine.
* A key with one context holds no further repeat.
* A key with several contexts goes to the operator's own sorter or tree,
  which gets the text around the anchor.
* A key so frequent that its group would not fit a task (found on a sample
  of documents, which only routes) has its rows replaced by one row per
  window, keyed by the whole window: then every group is one window's
  copies, of which only the earliest matters.  Both routes are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FIRST, SECOND, SLICE, U64, list_slices, mix, row_slices, sorted_by, text_buffer

ROW = pa.schema([("key", pa.int64()), ("ctx", pa.int64()), ("rid", pa.int64()),
                 ("a", pa.int64()), ("o1", pa.int32()), ("o2", pa.int32()),
                 ("spans", pa.binary())])
ROW_DDL = "key long, ctx long, rid long, a long, o1 int, o2 int, spans binary"
CONTEXT_DDL = "key long, rid long, a long, o1 int, o2 int, context binary"
CONTEXT = pa.schema([("key", pa.int64()), ("rid", pa.int64()), ("a", pa.int64()),
                     ("o1", pa.int32()), ("o2", pa.int32()), ("context", pa.binary())])
SPAN_DDL = "rid long, s long, e long"
SPAN = pa.schema([("rid", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])

#: One document in so many is looked at for frequent keys.
SAMPLE = 32
#: A key below so many rows is never treated as frequent.
GROUP_ROWS = 5_000
#: Rows sorted at once in a task, more only if one key has more.
BLOCK_ROWS = 20_000
#: Bytes of text of which a task holds the symbols at once, more only for one row.
TEXT_BYTES = 4 << 20


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n, size, m = len(x) - w + 1, 1, x
    while 2 * size <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:n], m[w - size:w - size + n])


def window_anchors(symbols: np.ndarray, offsets: np.ndarray, width: int, k: int):
    """Yields (key, ctx, first window, last window, anchor) arrays, slice by
    slice; positions count over the whole array, windows stay inside rows."""
    total = len(symbols)
    for c in range(0, max(total - width + 1, 0), SLICE):
        part = symbols[c:c + SLICE + width - 1]
        n = len(part) - width + 1
        p1, p2 = FIRST.prefix(part), SECOND.prefix(part)
        keys = FIRST.windows(p1, k)
        place = np.arange(len(keys), dtype=U64)
        low = sliding_min((keys & ~U64(0xFFFFFF)) | place, width - k + 1) & U64(0xFFFFFF)
        # a window may not hold a row's end in its inside
        cuts = offsets[np.searchsorted(offsets, c, "right"):np.searchsorted(offsets, c + len(part))] - c
        crossing = np.zeros(n + 1, dtype=np.int32)
        np.add.at(crossing, np.clip(cuts - width + 1, 0, n), 1)
        np.add.at(crossing, np.minimum(cuts, n), -1)
        v = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
        if not len(v):
            continue
        a = low[v].astype(np.int64)
        new = np.ones(len(v), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (v[1:] != v[:-1] + 1)
        at = np.flatnonzero(new)
        s1, s2, a = v[at], v[np.append(at[1:], len(v)) - 1], a[at]
        ctx = mix(SECOND.ranges(p2, s1, s2 + width) + (a - s1).astype(U64) * U64(0x9E3779B97F4A7C15))
        yield keys[a], ctx, s1 + c, s2 + c, a + c


def split_frequent(symbols, width, key, ctx, s1, s2, a, hot):
    """Rows of frequent keys become one row per window, keyed by the window."""
    if not len(hot):
        return key, ctx, s1, s2, a
    at = np.searchsorted(hot, key)
    is_hot = hot[np.minimum(at, len(hot) - 1)] == key
    if not is_hot.any():
        return key, ctx, s1, s2, a
    n = (s2 - s1 + 1)[is_hot]
    start = np.repeat(s1[is_hot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    order = np.argsort(start, kind="stable")
    start, anchor = start[order], np.repeat(a[is_hot], n)[order]
    k2, c2 = np.zeros(len(start), U64), np.zeros(len(start), U64)
    i = 0
    while i < len(start):
        j = int(np.searchsorted(start, start[i] + SLICE))
        lo = int(start[i])
        part = symbols[lo:int(start[j - 1]) + width]
        k2[i:j] = mix(FIRST.ranges(FIRST.prefix(part), start[i:j] - lo, start[i:j] - lo + width) + U64(1))
        c2[i:j] = SECOND.ranges(SECOND.prefix(part), start[i:j] - lo, start[i:j] - lo + width)
        i = j
    cold = ~is_hot
    out = [np.concatenate(x) for x in ((key[cold], k2), (ctx[cold], c2), (s1[cold], start),
                                       (s2[cold], start), (a[cold], anchor))]
    order = np.argsort(out[2], kind="stable")
    return tuple(x[order] for x in out)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals sorted by start; touching ones join."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return starts[at], reach[np.append(at[1:], len(starts)) - 1]


def extract(symbols_of: Callable, width: int, k: int, hot: np.ndarray) -> Callable:
    """mapInArrow function from (rid, text) rows to ROW rows."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            batch = sorted_by(batch, "rid")
            rid = batch.column("rid").to_numpy(zero_copy_only=False).astype(np.int64)
            data, at = text_buffer(batch.column("text"))
            parts, offsets, total = [], [np.zeros(1, dtype=np.int64)], 0
            for i, j in row_slices(at, TEXT_BYTES):
                symbols, own = symbols_of(data[at[i]:at[j]], at[i:j + 1] - at[i])
                for x in window_anchors(symbols, own, width, k):
                    x = split_frequent(symbols, width, *x, hot)
                    parts.append((*x[:2], *(place + total for place in x[2:])))
                offsets.append(own[1:] + total)
                total += len(symbols)
            if not parts:
                continue
            offsets = np.concatenate(offsets)
            key, ctx, s1, s2, a = (np.concatenate(x) for x in zip(*parts))
            # equal rows of this batch: the earliest stands for all
            _, first, group = np.unique(key * U64(0x9E3779B97F4A7C15) + ctx,
                                        return_index=True, return_inverse=True)
            lead = first[group]
            later = (lead != np.arange(len(key))) & (key[lead] == key) & (ctx[lead] == ctx)
            row = np.searchsorted(offsets, s1, side="right") - 1
            keep = ~later
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key[keep].view(np.int64), ctx[keep].view(np.int64),
                                       rid[row[keep]], a[keep] - offsets[row[keep]],
                                       (a - s2)[keep].astype(np.int32),
                                       (a - s1)[keep].astype(np.int32))]
                + [pa.nulls(int(keep.sum()), pa.binary())], schema=ROW)
            if later.any():
                lr = row[later]
                order = np.lexsort((s1[later], lr))
                s, e, lr = s1[later][order], s2[later][order] + width, lr[order]
                cuts = np.flatnonzero(np.append(True, lr[1:] != lr[:-1]))
                ends = np.append(cuts[1:], len(lr))
                who, blobs = lr[cuts], []
                for i, j, r in zip(cuts, ends, who):
                    x, y = merged(s[i:j] - offsets[r], e[i:j] - offsets[r])
                    blobs.append(np.stack([x, y], axis=1).astype("<i8").tobytes())
                m, nil = len(who), pa.nulls(len(who), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(rid[who].view(U64)).view(np.int64)), pa.nulls(m, pa.int64()),
                     pa.array(rid[who]), pa.nulls(m, pa.int64()), nil, nil,
                     pa.array(blobs, type=pa.binary())], schema=ROW)
    return run


def frequent_keys(docs: DataFrame, symbols_of: Callable, width: int, k: int) -> np.ndarray:
    """Keys that would hold more than a quarter of a shuffle partition.

    At most four times as many keys as shuffle partitions can: that bounds
    what is collected and shipped with the tasks.  The sample only decides
    which exact route a key takes.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = docs.select("rid", "text").filter(F.pmod(F.xxhash64("rid"), F.lit(SAMPLE)) == 0)
    rows = sample.mapInArrow(extract(symbols_of, width, k, np.zeros(0, U64)), ROW_DDL)
    counts = rows.filter("spans is null").groupBy("key").count()
    counts = counts.filter(F.col("count") * SAMPLE > GROUP_ROWS)
    found = counts.orderBy(F.desc("count"), "key").limit(4 * parts).collect()
    return np.sort(np.array([r["key"] for r in found], dtype=np.int64).view(U64))


def repeated(docs: DataFrame, width: int, k: int, symbols_of: Callable, context_of: Callable,
             resolve: Callable, cut: Callable, cut_schema: T.StructType) -> DataFrame:
    """The whole job as one plan.

    ``symbols_of(data, offsets)`` gives symbols and their row offsets,
    ``context_of(text, a, o1, o2)`` the bytes the windows touch, ``resolve``
    (a block of contexts sorted by key, rid, a) the repeated spans in
    symbols, and ``cut`` is the mapInArrow function from ``docs`` with marks
    and found to the result.  The texts and the marks are shuffled by rid
    once: both joins read the same exchanges.
    """
    hot = frequent_keys(docs, symbols_of, width, k)
    rows = docs.select("rid", "text").mapInArrow(extract(symbols_of, width, k, hot), ROW_DDL)
    of_key = Window.partitionBy("key")
    marks = (rows.repartition("key")
             .withColumn("rn", F.row_number().over(
                 Window.partitionBy("key", "ctx").orderBy("rid", "a")))
             .withColumn("multi", F.min("ctx").over(of_key) != F.max("ctx").over(of_key))
             .filter("spans is not null or rn > 1 or multi"))
    by_doc = marks.groupBy("rid").agg(F.collect_list(F.struct(
        "key", "a", "o1", "o2", (F.col("spans").isNull() & (F.col("rn") == 1)).alias("open"),
        "spans")).alias("marks"))
    joined = docs.join(by_doc, "rid", "left")
    contexts = joined.mapInArrow(cut_contexts(context_of), CONTEXT_DDL)
    found = (contexts.repartition("key").sortWithinPartitions("key", "rid", "a")
             .mapInArrow(in_blocks(resolve, width), SPAN_DDL))
    found = found.groupBy("rid").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    return joined.join(found, "rid", "left").mapInArrow(cut, cut_schema)


def cut_contexts(context_of: Callable) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            at, marks = list_slices(batch.column("marks"))
            if not len(marks):
                continue
            open_ = marks.field("open").to_numpy(zero_copy_only=False).astype(bool)
            key = marks.field("key").to_numpy(zero_copy_only=False)
            a, o1, o2 = (marks.field(x).fill_null(0).to_numpy(zero_copy_only=False)
                         for x in ("a", "o1", "o2"))
            count = np.add.reduceat(np.append(open_, False).astype(np.int64), at[:-1]) * (at[1:] > at[:-1])
            rid, texts = batch.column("rid"), batch.column("text").cast(pa.binary())
            for i in np.flatnonzero(count):
                pick = np.arange(at[i], at[i + 1])[open_[at[i]:at[i + 1]]]
                blobs = context_of(texts[i].as_py(), a[pick], o1[pick], o2[pick])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[pick]), pa.array(np.full(len(pick), rid[i].as_py())),
                     pa.array(a[pick]), pa.array(o1[pick]), pa.array(o2[pick]),
                     pa.array(blobs, type=pa.binary())], schema=CONTEXT)
    return run


def in_blocks(resolve: Callable, width: int) -> Callable:
    """Blocks of whole keys; each gives spans (rid, start, end) in symbols."""
    def emit(table: pa.Table):
        rid, a = (table.column(x).to_numpy() for x in ("rid", "a"))
        o1, o2 = (table.column(x).to_numpy().astype(np.int64) for x in ("o1", "o2"))
        marks = resolve(table.column("key").to_numpy(), o1, o2,
                        table.column("context").combine_chunks())  # n x offsets, True: repeats
        lead = np.zeros((len(marks), 1), dtype=bool)
        edge = np.diff(np.hstack([lead, marks, lead]).astype(np.int8), axis=1)
        i, first = np.nonzero(edge == 1)
        _, past = np.nonzero(edge == -1)      # runs come in the same order
        return pa.RecordBatch.from_arrays(
            [pa.array(rid[i]), pa.array(a[i] - (past - 1)), pa.array(a[i] - first + width)],
            schema=SPAN)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in it:
            held.append(batch)
            size += len(batch)
            if size < BLOCK_ROWS:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))    # the last key may go on
            if cut:
                yield emit(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            size = len(key) - cut
        if size:
            yield emit(pa.Table.from_batches(held))
    return run


def spans_of(marks: pa.Array, found: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All repeated spans of one document, merged, in symbols."""
    s, e = [], []
    if len(marks):
        blobs = marks.field("spans")
        plain = ~(marks.field("open").to_numpy(zero_copy_only=False).astype(bool)) \
            & blobs.is_null().to_numpy(zero_copy_only=False)
        a, o1, o2 = (marks.field(x).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[plain]
                     for x in ("a", "o1", "o2"))
        s.append(a - o2)
        e.append(a - o1 + width)
        for b in blobs.drop_null():
            x = np.frombuffer(b.as_py(), dtype="<i8").reshape(-1, 2)
            s.append(x[:, 0])
            e.append(x[:, 1])
    if len(found):
        s.append(found.field("s").to_numpy(zero_copy_only=False))
        e.append(found.field("e").to_numpy(zero_copy_only=False))
    if not s:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, e = np.concatenate(s), np.concatenate(e)
    order = np.argsort(s, kind="stable")
    return merged(s[order], e[order])
