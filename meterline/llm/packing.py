"""Operator 3: best-fit packing of tokenised documents by bin completion.

Documents become pieces of at most ``capacity`` tokens.  How many sequences
they need depends only on the count of each piece length, a histogram of at
most ``capacity`` rows whatever the corpus; that is what the search sees.
It fills one kind of sequence at a time around the largest length left:
undominated fillings of the room beside it are enumerated, each is used as
often as the counts allow, and branches whose waste already rules out a
better result than the incumbent are cut.  The first incumbent is best-fit
decreasing.  The search ends at the lower bound, or after ``nodes`` branches
and ``DESCENTS`` more per distinct length, so that several complete packings
are reached however many lengths there are (then the incumbent stands; it is
a complete packing at any time).  A branch looks at the first ``FILLINGS``
fillings in order of waste, found in 40 times as many steps, and takes one as
often as the counts allow: where that hides a better packing, the incumbent
stands above the bound.

Spark then deals pieces to the places of the chosen fillings: a piece's
number among those of its length (counted within salted sub-groups, whose
sizes are added up first, so a length held by a third of all rows is split)
names its sequence and offset.

Defined results: null and empty texts are a piece of one token, the closing
id.  Repeated rows and ids are pieces of their own.  Other columns are
ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read

CAPACITY, CLOSING_ID = 4096, 1
#: Words whose ids a task remembers; beyond that it starts anew.
REMEMBERED = 700_000
#: Sub-groups in which the pieces of one length are numbered: at least so
#: many, and one for so many pieces of the commonest length.
SALTS, SALTED = 256, 20_000
#: Branches the search may take, and fillings looked at in each; and more
#: branches per distinct length (a complete packing takes about one each).
NODES, FILLINGS = 2_000, 24
DESCENTS = 8

PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ------------------------------------------------------------- tokenising

#: One full stop or comma after a letter or digit ends a word.
END_MARK = re.compile(rb"(?<=[a-z0-9])([.,])(?![^ \n])")
TAIL = b".,!?;:|%*$&#"
#: A capital letter that a combining mark may follow: the vocabulary composes
#: before it lower-cases, and some letters compose in lower case only.
MAY_COMPOSE = re.compile(rb"[A-Z][\xcc\xcd\xe0-\xf4]")


def cut_tail(word: bytes) -> tuple[bytes, bytes]:
    """A word and the punctuation after its last letter or digit, which the
    vocabulary always takes apart; uncertain characters stay together."""
    stem = word.rstrip(TAIL)
    if len(stem) == len(word) or not stem:
        return word, b""
    last = stem.decode("utf-8", "replace")[-1]
    # a letter whose lower case ends in a combining mark would take the punctuation with it
    if last.isalnum() and last < "\u0250" and len(last.lower()) == 1:
        return stem, word[len(stem):]
    return word, b""


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if visible in Latin-1, else the next letter from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


ALPHABET = byte_alphabet()


def byte_letters(word: bytes) -> str:
    """A word of letters as the vocabulary's alphabet spells it: lower case,
    composed, in byte stand-ins.  Empty if anything else is in it."""
    if word.isascii():
        return ""                          # letters alone are told by isalpha()
    text = word.decode("utf-8", "replace")
    if not unicodedata.is_normalized("NFC", text):
        return ""
    text = text.lower()
    if text.isalpha() and max(text) < "\u0250" and unicodedata.is_normalized("NFC", text):
        return text.encode().decode("latin-1").translate(ALPHABET)
    return ""


def tokenised(path: str, capacity: int, keep_ids: bool):
    """mapInArrow: (doc_id, text) to pieces.

    The vocabulary drops white space and never joins over it, so a text's
    ids are those of its words in a row; each word is encoded once a task,
    and punctuation after a letter or digit is a word of its own.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        encoder = Tokenizer.from_file(path)
        known: dict[bytes, bytes] = {}
        plain = Tokenizer(encoder.model)
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = plain.get_vocab()
        ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

        def in_bulk(words: list[bytes], spelled: list[str]) -> None:
            """Words of plain letters: many at once, cut where a word ends."""
            if not words:
                return
            ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in plain.encode_batch_fast(
                [" ".join(spelled[k:k + 2000]) for k in range(0, len(spelled), 2000)],
                add_special_tokens=False)])
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(ends_word[ids]) + 4).tolist()
            if len(ends) != len(words):
                raise ValueError("words and their ids differ in number")
            known.update(zip(words, map(raw.__getitem__, map(slice, [0, *ends], ends))))

        def learn(words: set[bytes]) -> None:
            ascii_ = [w for w in words if w.isalpha()]
            in_bulk(ascii_, b" ".join(ascii_).decode().lower().split())
            rest = [w for w in words if not w.isalpha()]
            spelled = [byte_letters(w) for w in rest]
            in_bulk([w for w, x in zip(rest, spelled) if x], [x for x in spelled if x])
            rest = [w for w, x in zip(rest, spelled) if not x]
            cuts = [(w, *cut_tail(w)) for w in rest]
            parts = {x for _, a, b in cuts if b for x in (a, b)}.difference(known)
            if parts:
                learn(parts)
            whole = [w for w, _, b in cuts if not b]
            for w, e in zip(whole, encoder.encode_batch_fast(
                    [w.decode("utf-8", "replace") for w in whole], add_special_tokens=False)):
                known[w] = array("I", e.ids).tobytes()
            known.update((w, known[a] + known[b]) for w, a, b in cuts if b)
        closing = np.array([CLOSING_ID], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in it:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                # letters are lower-cased by the vocabulary; its special
                # strings are not, so texts that may hold one stay as they are,
                # and so do those in which the case of a letter decides
                words = [(t if b"<|" in t or MAY_COMPOSE.search(t) else END_MARK.sub(rb" \1", t.lower())).split() for t in
                         part.column("text").fill_null("").cast(pa.binary()).to_pylist()]
                if len(known) > REMEMBERED:
                    known.clear()
                learn(set().union(*words).difference(known))
                rows: list[list] = [[], [], [], [], [], []]
                for doc, own in zip(part.column("doc_id").to_pylist(), words):
                    ids = b"".join(map(known.__getitem__, own)) + closing
                    for k in range(0, len(ids), step):
                        piece = ids[k:k + step]
                        for column, value in zip(rows, (doc, k // step, k // 4, len(piece) // 4,
                                                        zlib.crc32(piece), piece)):
                            column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = 6 if keep_ids else 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=t) for v, t in zip(rows[:n], kinds)], names=names[:n])
    return run


# --------------------------------------------------------- bin completion

def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """[(times, {length: count})]; equal bins move together."""
    room: dict[int, list] = {}            # room left -> [(times, filling)]
    keys: list[int] = []

    def put(r: int, times: int, filling: dict[int, int]) -> None:
        if r not in room:
            room[r] = []
            keys.insert(bisect_left(keys, r), r)
        room[r].append((times, filling))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(keys, length)
            if k == len(keys):
                per = capacity // length
                full, rest = divmod(left, per)
                if full:
                    put(capacity - per * length, full, {length: per})
                if rest:
                    put(capacity - rest * length, 1, {length: rest})
                break
            r = keys[k]
            times, filling = room[r].pop()
            if not room[r]:
                del room[r]
                keys.pop(k)
            per = r // length             # the same bin stays the best fit
            used = min(times, left // per)
            if used:
                put(r - per * length, used, filling | {length: filling.get(length, 0) + per})
                left -= used * per
                times -= used
            elif left:
                put(r - left * length, 1, filling | {length: filling.get(length, 0) + left})
                left, times = 0, times - 1
            if times:
                put(r, times, filling)
    return [b for bins in room.values() for b in bins]


def fillings(lengths: list[int], counts: dict[int, int], room: int, most: int) -> list[dict[int, int]]:
    """Undominated ways to fill ``room``, least waste first.

    A filling is dropped when a length left over still fits in its waste,
    or could take the place of one or two of its members (then the larger
    single piece dominates: what it frees can go wherever it went).
    """
    found: list[tuple[int, int, dict[int, int]]] = []
    steps = [40 * most]

    def left(length: int, chosen: dict[int, int]) -> int:
        return counts[length] - chosen.get(length, 0)

    def dominated(chosen: dict[int, int], waste: int) -> bool:
        members = [x for x, c in chosen.items() for _ in range(min(c, 2))]
        singles = set(members)
        pairs = {a + b for i, a in enumerate(members) for b in members[i + 1:]}
        for x in singles:
            k = bisect_right(lengths, x + waste) - 1
            if k >= 0 and lengths[k] > x and left(lengths[k], chosen):
                return True
        for x in pairs:
            k = bisect_right(lengths, x + waste) - 1
            if k >= 0 and lengths[k] >= x and left(lengths[k], chosen):
                return True
        return False

    def search(top: int, free: int, chosen: dict[int, int]) -> bool:
        """True when nothing better can follow."""
        steps[0] -= 1
        k = min(top, bisect_right(lengths, free) - 1)
        tried = False
        while k >= 0 and steps[0] > 0:
            x = lengths[k]
            for n in range(min(free // x, left(x, chosen)), 0, -1):
                tried = True
                chosen[x] = n
                stop = search(k - 1, free - n * x, chosen)
                del chosen[x]
                if stop or len(found) >= most:
                    return True
            k -= 1
        fits = lengths[:bisect_right(lengths, free)]
        if not tried and not any(left(x, chosen) for x in fits) and not dominated(chosen, free):
            found.append((free, sum(chosen.values()), dict(chosen)))
            return free == 0 and sum(chosen.values()) <= 1
        return False

    if lengths and room >= lengths[0]:
        search(len(lengths) - 1, room, {})
    if not found:
        return [{}]
    return [f for _, _, f in sorted(found, key=lambda x: (x[0], x[1]))]


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = NODES,
                   width: int = FILLINGS) -> list[tuple[int, dict[int, int]]]:
    """Fillings and how often each is used; together they use all counts."""
    total = sum(x * c for x, c in counts.items())
    large = sum(c for x, c in counts.items() if 2 * x > capacity)
    bound = max(-(-total // capacity), large)
    best = best_fit_decreasing(counts, capacity)
    size = sum(t for t, _ in best)
    budget = [nodes + DESCENTS * len(counts)]

    def extend(left: dict[int, int], used: list, bins: int, waste: int) -> bool:
        nonlocal best, size
        while True:
            if not left:
                if bins < size:
                    best, size = list(used), bins
                return size == bound
            if budget[0] <= 0:
                return True
            budget[0] -= 1
            lengths = sorted(left)
            top = lengths[-1]
            own = left | {top: left[top] - 1}
            ways = fillings([x for x in lengths if own[x]], own, capacity - top, width)
            allowed = (size - 1) * capacity - total
            ways = [w for w in ways if waste + capacity - top - sum(x * c for x, c in w.items()) <= allowed]
            if not ways:
                return False
            branches = []
            for way in ways:
                whole = dict(way)
                whole[top] = whole.get(top, 0) + 1
                lost = capacity - sum(x * c for x, c in whole.items())
                times = min(left[x] // c for x, c in whole.items())
                if lost:
                    times = min(times, max(1, (allowed - waste) // lost))
                branches.append((times, whole, lost))
            # the first way is the likeliest; the others are tried after it
            for times, whole, lost in branches[:-1] if len(branches) > 1 else []:
                rest = {x: c - times * whole.get(x, 0) for x, c in left.items()}
                if extend({x: c for x, c in rest.items() if c}, used + [(times, whole)],
                          bins + times, waste + times * lost):
                    return True
                if budget[0] <= 0:
                    return True
            times, whole, lost = branches[-1]
            left = {x: c - times * whole.get(x, 0) for x, c in left.items()}
            left = {x: c for x, c in left.items() if c}
            used, bins, waste = used + [(times, whole)], bins + times, waste + times * lost

    if size > bound and counts:
        import sys
        before = sys.getrecursionlimit()
        sys.setrecursionlimit(max(before, 20_000))
        try:
            extend({x: c for x, c in counts.items() if c}, [], 0, 0)
        finally:
            sys.setrecursionlimit(before)
    return best


# ------------------------------------------------------------- assignment

def places(chosen: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """One row per (length, filling): the numbers of its pieces among those
    of the length, and where they go.  Sorted by length, then first number."""
    rows, taken, base = [], {}, 0
    for times, filling in chosen:
        offset = 0
        for length in sorted(filling, reverse=True):
            per = filling[length]
            first = taken.get(length, 0)
            rows.append((length, first, per, base, offset))
            taken[length] = first + times * per
            offset += per * length
        base += times
    rows.sort()
    return dict(zip(("length", "first", "per", "base", "offset"),
                    np.array(rows, dtype=np.int64).reshape(-1, 5).T))


def dealt(table: dict[str, np.ndarray]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, begin = np.unique(table["length"], return_index=True)
        end = np.append(begin[1:], len(table["length"]))
        for batch in it:
            if not len(batch):
                continue
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.zeros(len(batch), dtype=np.int64)
            which = np.searchsorted(lengths, length)
            for k in np.unique(which):
                own = np.flatnonzero(which == k)
                first = table["first"][begin[k]:end[k]]
                at[own] = begin[k] + np.searchsorted(first, number[own], side="right") - 1
            nth = number - table["first"][at]
            per = table["per"][at]
            keep = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keep]
                + [pa.array(table["base"][at] + nth // per),
                   pa.array(table["offset"][at] + (nth % per) * length)],
                names=keep + ["sequence_id", "offset"])
    return run


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: its place among its document's ids, the checksum
    of its ids (and with ``keep_ids`` the ids, unsigned 32-bit), its sequence
    and its offset there."""
    ddl = PIECE_DDL + (", ids binary" if keep_ids else "")
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    pieces = materialize(pieces.mapInArrow(tokenised(vocabulary, capacity, keep_ids), ddl), "pieces")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}   # <= capacity rows
    salts = max(SALTS, -(-max(counts.values(), default=0) // SALTED))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = groups.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    table = places(bin_completion(counts, capacity))
    numbered = (salted.withColumn("nth", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
        .join(before, ["length", "salt"])
        .withColumn("number", F.col("before") + F.col("nth") - 1)
        .select(*pieces.columns, "number"))
    return numbered.mapInArrow(dealt(table), ddl + ", sequence_id long, offset long")


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))
