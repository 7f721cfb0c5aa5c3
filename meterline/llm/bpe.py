"""Operator 10: byte-level BPE encoding and decoding by a pair occurrence
index.

Texts are cut into pretokens by the vocabulary's pattern; equal pretokens
have equal ids, so each is encoded once a task.  The new pretokens of a
batch are laid out in one array of symbols, and an index maps every pair of
neighbours that has a rank to all its positions.  Ranks in the index are
applied in ascending order: a pair is merged at all its positions, left to
right, and the pairs this makes or breaks beside them are added to or
skipped in the lists of the index.

Ids go back to text through the bytes of each id.

Defined results: null is the empty text (no ids).  Bytes that are no UTF-8
read as U+FFFD.  The vocabulary's special strings in a text become their
ids, as the library does.  One row per input row, repeated rows and ids
included; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bytes, read
from .packing import byte_alphabet, vocabulary_path

#: Fixed value: the pretoken pattern of this kind of vocabulary, with white
#: space as Unicode has it.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: More than any id: a pair as one number.
MANY = 1 << 31
#: Pretokens a task remembers; beyond that it starts anew.
REMEMBERED = 500_000
#: Bytes of text cut together (more only for one row), and bytes of new pretokens in one index.
TEXT_BYTES, INDEXED = 8 << 20, 2_000_000


class Vocabulary:
    """Merge ranks by pair, bytes by id, and special strings of a file in
    the tokenizers library's format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        back = {c: b for b, c in byte_alphabet().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.names = np.array([str(i) for i in range(size)], dtype=object)
        self.bytes_of = np.full(size, b"", dtype=object)
        for t, i in ids.items():
            self.bytes_of[i] = t.encode() if t in self.special else bytes(back[c] for c in t)
        self.first = np.array([ids[c] for _, c in sorted(byte_alphabet().items())], dtype=np.int64)
        pairs = (p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"])
        self.by_rank = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        codes = np.array([a * MANY + b for a, b, _ in self.by_rank], dtype=np.int64)
        self.ranks = np.argsort(codes, kind="stable")
        self.codes = codes[self.ranks]
        self.pattern = regex.compile(PATTERN)
        self.specials = (regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
                         if self.special else None)


def encode_pretokens(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pretokens in a row, and where each one's ids begin (n + 1),
    by one pair occurrence index over all of them."""
    v = vocabulary
    if not words:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    data = np.frombuffer(b"\n".join(words) + b"\n", dtype=np.uint8)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = len(data)
    symbol = v.first[data]
    symbol[stops] = -1                     # between pretokens
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    index: dict[int, list[np.ndarray]] = {}        # rank -> positions of its pair
    active: list[int] = []

    def enter(left: np.ndarray, right: np.ndarray, positions: np.ndarray) -> None:
        """Add positions to the lists of their pairs' ranks."""
        inside = (left >= 0) & (right >= 0)
        code = left[inside] * MANY + right[inside]
        at = np.searchsorted(v.codes, code)
        at[at == len(v.codes)] = 0
        ranked = v.codes[at] == code
        ranks = v.ranks[at[ranked]]
        if not len(ranks):
            return
        positions = positions[inside][ranked]
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, own in zip(ranks[np.append(0, cuts)].tolist(), np.split(positions, cuts)):
            if rank in index:
                index[rank].append(own)
            else:
                index[rank] = [own]
                heappush(active, rank)

    enter(symbol[:-1], symbol[1:], np.arange(n - 1))
    while active:
        rank = heappop(active)
        found = index.pop(rank)
        left, right, merged = v.by_rank[rank]
        i = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
        i = i[symbol[i] == left]
        i = i[symbol[after[i]] == right]
        if left == right and len(i) > 1:
            # of pairs that overlap, every second one, from the left
            chained = after[i[:-1]] == i[1:]
            run = np.arange(len(i)) - np.maximum.accumulate(
                np.where(np.append(True, ~chained), np.arange(len(i)), 0))
            i = i[run % 2 == 0]
        if not len(i):
            continue
        j = after[i]
        k = after[j]
        symbol[i], symbol[j] = merged, -2  # -2: gone
        after[i], before[k] = k, i
        enter(symbol[i], symbol[k], i)
        h = before[i]
        h, i = h[h >= 0], i[h >= 0]
        enter(symbol[h], symbol[i], h)
    begin = np.zeros(len(words) + 1, dtype=np.int64)
    begin[1:] = np.cumsum(symbol >= 0)[stops]
    return symbol[symbol >= 0], begin


def pretokens(text: str, vocabulary: Vocabulary) -> list[str]:
    find = vocabulary.pattern.findall
    if vocabulary.specials is None or not vocabulary.specials.search(text):
        return find(text)
    out, at = [], 0
    for hit in vocabulary.specials.finditer(text):
        out += find(text[at:hit.start()])
        out.append(hit.group())
        at = hit.end()
    return out + find(text[at:])


def coded(path: str, keep_ids: bool):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        known: dict[str, tuple[str, bytes]] = {}       # its ids, and their bytes

        def learn(words: list[str]) -> None:
            ids, begin = encode_pretokens([w.encode() for w in words], vocabulary)
            begin, names = begin.tolist(), vocabulary.names[ids].tolist()
            back = vocabulary.bytes_of[ids].tolist()
            known.update(zip(words, zip(
                (",".join(names[i:j]) for i, j in zip(begin, begin[1:])),
                (b"".join(back[i:j]) for i, j in zip(begin, begin[1:])))))

        for batch in it:
            for part in by_bytes(batch, TEXT_BYTES):
                texts = [t.decode("utf-8", "replace") for t in
                         part.column("text").fill_null("").cast(pa.binary()).to_pylist()]
                cut = [pretokens(t, vocabulary) for t in texts]
                if len(known) > REMEMBERED:
                    known.clear()
                known.update((t, (str(i), t.encode())) for t, i in vocabulary.special.items())
                new, size, begin = list(set().union(*cut).difference(known)), 0, 0
                for k, w in enumerate(new):
                    size += len(w)
                    if size > INDEXED or k == len(new) - 1:
                        learn(new[begin:k + 1])
                        size, begin = 0, k + 1
                count, ids_sha, text_sha, lists = [], [], [], []
                for own in cut:
                    ids, back = zip(*map(known.__getitem__, own)) if own else ((), ())
                    ids = ",".join(ids)
                    decoded = b"".join(back).decode("utf-8", "replace")
                    count.append(ids.count(",") + 1 if ids else 0)
                    ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if keep_ids:
                        lists.append(list(map(int, ids.split(","))) if ids else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids_sha),
                     pa.array(text_sha)] + ([pa.array(lists, pa.list_(pa.int32()))] if keep_ids else []),
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)
    return run


def encode_decode(docs: DataFrame, vocabulary: str, keep_ids: bool = False) -> DataFrame:
    """One row per document: how many ids, digests of the ids and of the text
    decoded from them, and with ``keep_ids`` the ids."""
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        coded(vocabulary, keep_ids), ddl + (", ids array<int>" if keep_ids else ""))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))
