"""Operator 1: byte-level duplicate removal by a sparse suffix array.

Contract: a byte goes when a string of ``width`` bytes that covers it also
starts earlier (smaller document, or same document and earlier start).

Anchors (``anchors.py``) pick the suffixes worth sorting.  For the anchors
of one key the text to the right and the text to the left (read backwards)
are two families of suffixes; each is ordered by deep-shallow sorting:

* shallow: multikey quicksort, eight bytes a character, all segments of a
  block partitioned together in numpy (less / equal / greater than the
  segment's pivot; equal moves on by eight bytes);
* deep: groups still equal at the shallow depth have long common prefixes;
  a blind trie (branch depths and branch bytes only) orders each group with
  one full comparison per string.

The common prefixes of neighbours in both orders then tell for each offset
which windows are equal; the earliest of each class stays.

Defined results: null and empty texts, and texts shorter than ``width``,
keep every byte.  Identical rows are copies, the later loses what repeats.
Null or repeated ids: see ``common.identified``.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import anchors
from .common import by_bytes, identified, read

WIDTH, RUN = 100, 32
SHALLOW_RIGHT, SHALLOW_LEFT = 6, 2      # in characters of eight bytes
RESULT_DDL = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "spans array<struct<s: long, e: long>>")


# ------------------------------------------------------ deep-shallow sorting

def multikey_quicksort(words: np.ndarray, segment: np.ndarray, depth: int):
    """Order rows of ``words`` within segments by their first ``depth``
    columns.  Returns the order and, beside it, final segment numbers: rows
    share one only if those columns are equal."""
    n = len(words)
    order, at = np.arange(n), np.zeros(n, dtype=np.int64)
    seg = segment.astype(np.int64)
    live = np.ones(n, dtype=bool)
    while True:
        # settled: alone in a segment, or equal to the full depth
        bounds = np.flatnonzero(np.append(True, seg[1:] != seg[:-1])) if n else np.zeros(0, int)
        sizes = np.diff(np.append(bounds, n))
        live = np.repeat(sizes > 1, sizes) & (at < depth)
        work = np.flatnonzero(live)
        if not len(work):
            return order, seg
        char = words[order[work], at[work]]
        wseg = seg[work]
        start = np.flatnonzero(np.append(True, wseg[1:] != wseg[:-1]))
        length = np.diff(np.append(start, len(work)))
        pivot = np.repeat(char[start + length // 2], length)
        code = (char > pivot).astype(np.int8) - (char < pivot).astype(np.int8)
        rank = np.repeat(np.arange(len(start)), length) * 3 + code + 1
        move = np.argsort(rank, kind="stable")
        order[work] = order[work][move]
        at[work] += code == 0
        at[work] = at[work][move]
        # new segment numbers, in place order: three parts of each old one
        wide = seg * 3
        wide[work] += code[move] + 1
        seg = np.cumsum(np.append(0, wide[1:] != wide[:-1])) if n else wide


def blind_trie(strings: list[bytes]) -> list[int]:
    """Sorted order of equally long strings; equal ones keep their order.

    A node is [depth, {byte: child}], a leaf a list of equal strings.  A
    string goes down by branch bytes alone, is compared once with the leaf
    it meets, and is put in at the depth where they part.
    """
    if len(strings) == 2:
        return [0, 1] if strings[0] <= strings[1] else [1, 0]
    bits = 8 * len(strings[0])
    ints = [int.from_bytes(s, "big") for s in strings]
    root = [0, {strings[0][0]: [0]}]      # a leaf holds numbers only
    for i in range(1, len(strings)):
        s, node, is_leaf = strings[i], root, False
        while not is_leaf:
            children = node[1]
            node = children.get(s[node[0]]) or next(iter(children.values()))
            is_leaf = len(node) < 2 or not isinstance(node[1], dict)
        parts = (bits - (ints[i] ^ ints[node[0]]).bit_length()) >> 3
        if parts == bits >> 3:
            node.append(i)
            continue
        parent, child = None, root
        while True:
            inner = len(child) == 2 and isinstance(child[1], dict)
            if not inner or child[0] > parts:      # split the edge above
                old = strings[leaf_of(child)][parts]
                parent[1][s[parent[0]]] = [parts, {old: child, s[parts]: [i]}]
                break
            if child[0] == parts:
                child[1][s[parts]] = [i]
                break
            parent, child = child, child[1][s[child[0]]]
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if len(node) == 2 and isinstance(node[1], dict):
            stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def leaf_of(node: list) -> int:
    while len(node) == 2 and isinstance(node[1], dict):
        node = next(iter(node[1].values()))
    return node[0]


def deep_shallow(text: np.ndarray, segment: np.ndarray, shallow: int):
    """Order rows of a byte matrix (width a multiple of 8) within segments;
    returns the order and each row's common prefix with the one before
    (-1 where a segment begins)."""
    words = np.ascontiguousarray(text).view(">u8").astype(np.uint64)
    order, seg = multikey_quicksort(words, segment, shallow)
    n = len(order)
    bounds = np.flatnonzero(np.append(True, seg[1:] != seg[:-1])) if n else np.zeros(0, int)
    sizes = np.diff(np.append(bounds, n))
    tail = np.ascontiguousarray(text[:, 8 * shallow:])
    for b, m in zip(bounds[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        own = order[b:b + m]
        order[b:b + m] = own[blind_trie([tail[i].tobytes() for i in own])]
    lcp = np.full(n, -1, dtype=np.int64)
    if n > 1:
        differ = words[order[1:]] ^ words[order[:-1]]
        col = np.argmax(differ != 0, axis=1)
        x = differ[np.arange(n - 1), col]
        zero = np.zeros(n - 1, dtype=np.int64)
        for b in range(1, 8):               # leading equal bytes of the word
            zero += x < np.uint64(1 << (8 * b))
        zero = np.where(x == 0, 0, zero)
        lcp[1:] = np.where(x == 0, text.shape[1], 8 * col + zero)
        lcp[1:][segment[order[1:]] != segment[order[:-1]]] = -1
    return order, lcp


# --------------------------------------------------------------- the block

def padded(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int,
           backwards: bool = False) -> np.ndarray:
    step = np.arange(width)
    inside = step < length[:, None]
    at = (start[:, None] - 1 - step) if backwards else (start[:, None] + step)
    return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8)


def resolve(key: np.ndarray, o1: np.ndarray, o2: np.ndarray, context: pa.Array) -> np.ndarray:
    """Rows sorted by key and place; True where the window that starts
    ``offset`` bytes before a row's anchor also starts at an earlier row."""
    off = np.frombuffer(context.buffers()[1], dtype=np.int32)[context.offset:context.offset + len(context) + 1]
    data = np.frombuffer(context.buffers()[2], dtype=np.uint8)
    n, offsets = len(key), WIDTH - RUN + 1
    segment = np.cumsum(np.append(0, key[1:] != key[:-1]))
    anchor = off[:-1].astype(np.int64) + o2
    right, lcp_right = deep_shallow(
        padded(data, anchor, WIDTH - o1, -(-WIDTH // 8) * 8), segment, SHALLOW_RIGHT)
    left, lcp_left = deep_shallow(
        padded(data, anchor, o2, -(-(offsets - 1) // 8) * 8, backwards=True), segment, SHALLOW_LEFT)
    out = np.zeros((n, offsets), dtype=bool)
    rclass, lclass = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(offsets):
        active = np.flatnonzero((o1 <= o) & (o2 >= o))
        if len(active) < 2:
            continue
        rclass[right] = np.cumsum(lcp_right < WIDTH - o)
        lclass[left] = np.cumsum(lcp_left < o)
        both = rclass[active] * (n + 1) + lclass[active]
        _, first, group = np.unique(both, return_index=True, return_inverse=True)
        out[active, o] = first[group] != np.arange(len(active))
    return out


def bytes_of(data: np.ndarray, offsets: np.ndarray):
    return data, offsets


def context_of(text: bytes, a: np.ndarray, o1: np.ndarray, o2: np.ndarray) -> list[bytes]:
    return [text[x:y] for x, y in zip((a - o2).tolist(), (a - o1 + WIDTH).tolist())]


def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", span)])
    for batch in (part for whole in it for part in by_bytes(whole, anchors.TEXT_BYTES)):
        m_at, marks = anchors.list_slices(batch.column("marks"))
        f_at, found = anchors.list_slices(batch.column("found"))
        texts = batch.column("text").cast(pa.binary())
        out: list[list] = [[], [], [], [], []]
        for i in range(len(batch)):
            text = texts[i].as_py()
            s, e = anchors.spans_of(marks[m_at[i]:m_at[i + 1]], found[f_at[i]:f_at[i + 1]], WIDTH)
            s, e = s.tolist(), e.tolist()
            sha, at = hashlib.sha256(), 0
            for x, y in zip(s, e):
                sha.update(text[at:x])
                at = y
            sha.update(text[at:])
            row = (len(text), sum(e) - sum(s), len(s), sha.hexdigest(),
                   [{"s": x, "e": y} for x, y in zip(s, e)])
            for column, value in zip(out, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(v, type=f.type) for v, f in zip(out, list(schema)[1:]))],
            schema=schema)


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): sizes, digest of what
    is left, and the removed byte spans."""
    return anchors.repeated(identified(docs), WIDTH, RUN, bytes_of, context_of, resolve, cut,
                            T.StructType.fromDDL(RESULT_DDL))


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(read(spark, sf_dir, "documents")).drop("spans")
