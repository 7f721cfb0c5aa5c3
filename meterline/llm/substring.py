"""Operator 6: word-level removal of repeated passages by suffix trees.

Contract: a window is ``width`` consecutive words of one document; a word
goes when a window that covers it also starts earlier.

Suffixes are split by a prefix of variable length: the anchor's six words,
or the whole window where six words are too frequent to fit a task
(``anchors.py``).  In each group a suffix tree is written top-down, all
groups of a block level by level: a node is split by the next word, a node
with one leaf is not followed.  A second tree holds the words before the
anchor.  Two leaves under the same deep nodes (together ``width`` words)
are the same window; its first place stays.

Defined results: null and empty texts, and texts of fewer words than
``width``, keep every word.  Identical rows are copies.  Null or repeated
ids: see ``common.identified``.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import anchors
from .common import by_bytes, hash_ranges, identified, read, word_bounds

WIDTH, RUN = 20, 6
RESULT_DDL = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
              "kept_text string, spans array<struct<s: long, e: long>>")


def words_of(data: np.ndarray, offsets: np.ndarray):
    starts, ends = word_bounds(data, offsets)
    return hash_ranges(data, starts, ends), np.searchsorted(starts, offsets)


def context_of(text: bytes, a: np.ndarray, o1: np.ndarray, o2: np.ndarray) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[x:y]) for x, y in zip((a - o2).tolist(), (a - o1 + WIDTH).tolist())]


def tree_levels(symbols: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Write-only top-down suffix tree: the node of each row at each depth.
    Column d is the node spelled by the first d words; leaves get a node of
    their own from where they part on."""
    n, depth = symbols.shape
    node = np.empty((depth + 1, n), dtype=np.int64)
    node[0] = roots
    own = roots.max(initial=0) + 1 + np.arange(n)      # numbers for leaves
    live = np.arange(n)
    for d in range(depth):
        node[d + 1] = own
        if not len(live):
            continue
        spelled = node[d, live] * (symbols.max(initial=0) + 2) + symbols[live, d] + 1
        _, first, inner, size = np.unique(spelled, return_index=True, return_inverse=True,
                                          return_counts=True)
        node[d + 1, live] = own[live[first]][inner]
        live = live[size[inner] > 1]
    return node


def resolve(key: np.ndarray, o1: np.ndarray, o2: np.ndarray, context: pa.Array) -> np.ndarray:
    """Rows sorted by key and place; True where the window that starts
    ``offset`` words before a row's anchor also starts at an earlier row."""
    n, offsets = len(key), WIDTH - RUN + 1
    numbers: dict[bytes, int] = {}
    words = np.full((n, WIDTH + offsets - 1), -1, dtype=np.int64)
    for i, (text, before) in enumerate(zip(context.to_pylist(), o2.tolist())):
        own = [numbers.setdefault(w, len(numbers)) for w in text.split()]
        shift = offsets - 1 - before                   # anchors in one column
        words[i, shift:shift + len(own)] = own
    roots = np.cumsum(np.append(0, key[1:] != key[:-1]))
    right = tree_levels(words[:, offsets - 1:], roots)
    left = tree_levels(words[:, :offsets - 1][:, ::-1], roots)
    out = np.zeros((n, offsets), dtype=bool)
    for o in range(offsets):
        active = np.flatnonzero((o1 <= o) & (o2 >= o))
        if len(active) < 2:
            continue
        both = right[WIDTH - o, active] * (2 * n + 2) + left[o, active]
        _, first, group = np.unique(both, return_index=True, return_inverse=True)
        out[active, o] = first[group] != np.arange(len(active))
    return out


def cut_with(extra: tuple[str, ...]):
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(),
                 "kept_text": pa.binary(), "spans": span}
        for batch in (part for whole in it for part in by_bytes(whole, anchors.TEXT_BYTES)):
            m_at, marks = anchors.list_slices(batch.column("marks"))
            f_at, found = anchors.list_slices(batch.column("found"))
            texts = batch.column("text").cast(pa.binary())
            out: list[list] = [[], [], [], [], []]
            for i in range(len(batch)):
                text = texts[i].as_py()
                words = text.split()
                s, e = anchors.spans_of(marks[m_at[i]:m_at[i + 1]], found[f_at[i]:f_at[i + 1]], WIDTH)
                s, e = s.tolist(), e.tolist()
                kept, at = [], 0
                for x, y in zip(s, e):
                    kept += words[at:x]
                    at = y
                left = b" ".join(kept + words[at:])
                # untouched texts keep their own white space; only cut ones are joined
                row = (len(words), sum(e) - sum(s), hashlib.sha256(left).hexdigest(),
                       left if s else text, [{"s": x, "e": y} for x, y in zip(s, e)])
                for column, value in zip(out, row):
                    column.append(value)
            arrays = [pa.array(v, type=t) for v, t in zip(out, kinds.values())]
            arrays[3] = arrays[3].view(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays, *(batch.column(c) for c in extra)],
                names=["doc_id", *kinds, *extra])
    return cut


def remove_repeated_passages(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text, *extra): word counts,
    the text that is left and its digest, and the removed spans in words."""
    base = identified(docs, extra=extra)
    schema = T.StructType(T.StructType.fromDDL(RESULT_DDL).fields + [base.schema[c] for c in extra])
    return anchors.repeated(base, WIDTH, RUN, words_of, context_of, resolve, cut_with(extra), schema)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(read(spark, sf_dir, "documents")).drop("kept_text", "spans")
