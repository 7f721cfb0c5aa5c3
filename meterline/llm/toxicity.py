"""Operator 7: toxicity of texts restored by noisy-channel decoding.

Noisy words are found by pattern: words that mix letters with marks that
stand for letters or set them apart, runs of single letters with anything
between them, and words with a letter three times in a row.  Marks at a
word's ends that are only punctuation do not count.  Each spans a lattice: a
character may stand for itself, for letters it resembles, for nothing (separators, repeats) or
for a word boundary.  Viterbi picks the reading with the best sum of channel
costs and a character trigram model counted over all texts.  Words of more
than ``LONGEST`` characters have their runs of one character shortened to
three and are then read in overlapping pieces; as they may be keys or
digests, a mark costs no more as itself there than as a letter, so that the
model alone decides.

Restored texts are scored by five-letter runs and whole words.  Weights are
log-odds on a bounded sample of labelled rows (``TOXIC`` and ``CLEAN`` rows
by smallest hash of the id); a second part of that sample calibrates the
score.  Only rows outside the held-out fold are learnt from.

Both classes are counted before any run or word is left out; what ranks them
is the log-odds less a multiple (``CAUTION``) of its standard error, so that
no share of the toxic rows is asked for, however many they are.

Sizes that are collected: the trigram table (at most 61**3 counts), the
features kept (``FEATURES``) and the calibration rows (``TOXIC`` +
``CLEAN``).

Defined results: null and empty texts score what no evidence gives.  A null
id counts as held out.  One row per input row; repeated rows and ids score
alike; other columns are never looked at.  Without toxic or clean examples
no feature is learnt and every text scores low.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FIRST, SLICE, U64, materialize, mix, read

#: Labelled rows learnt from, at most; one in FOLD calibrates.
TOXIC, CLEAN, FOLD = 4_000, 12_000, 6
#: Features kept, at most: those of the greatest weight.
FEATURES = 4_000
RUN, LOWEST_WEIGHT, STRONGEST, CAUTION = 5, 1.0, 3, 2.5
#: Rows restored and scored together.
ROWS = 256

#: Symbols of the language model: 0 boundary, a-z, ß-ÿ, and one for the rest.
OTHER = 60
SYMBOL = np.full(256, OTHER, dtype=np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[0xDF:0x100] = np.arange(27, 60)
SYMBOL[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
SYMBOLS = OTHER + 1
LETTER = "a-zß-öø-ÿ"
#: Letters a character may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
              "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h"}
SEPARATORS = " ._-~*'"
EDGE = " .,!?;:%&\"()[]{}<>"
#: Marks that make a word noisy: anywhere, or only before more of the word.
MARK, INNER = r"0-9@$|+*#_\-~'", ".!("
SINGLE = rf"[{LETTER}0-9@$!|+#]"
NOISE = re.compile(
    rf"(?P<spaced>(?<![^\s\"'(\[{{<])(?:{SINGLE}[\s._\-~*']+){{2,}}{SINGLE}(?![^\s.,!?;:\"')\]}}>]))"
    rf"|(?<!\S)(?=[^\s{LETTER}]*+[{LETTER}])(?=\S*?(?:[{MARK}]|[{INNER}][^\s{re.escape(EDGE)}]))\S++"
    rf"|([{LETTER}])\2\2")
#: Characters of a word decoded at once; longer ones in pieces with a look ahead.
LONGEST, PIECE, AHEAD = 64, 48, 16
LITERAL = 0.6          # cost of a mark that stands for itself in those, which may be keys or digests
RUNS, WORD = re.compile(r"(.)\1{3,}"), re.compile(r"\S*")


# ------------------------------------------------------- language model

def lowered(batch: pa.RecordBatch) -> list[str]:
    return [t.decode("utf-8", "replace").lower()
            for t in batch.column("text").fill_null("").cast(pa.binary()).to_pylist()]


def points(texts: list[str]) -> np.ndarray:
    return np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "replace"), dtype=np.uint32)


def trigrams(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS ** 3, dtype=np.int64)
    for batch in it:
        for at in range(0, len(batch), ROWS):
            p = points(lowered(batch.slice(at, ROWS)))
            s = np.where(p < 256, SYMBOL[np.minimum(p, 255)], OTHER)
            total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Costs -log P(symbol | two before), from counts over all texts."""
    rows = (docs.select("text").mapInArrow(trigrams, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())       # <= SYMBOLS ** 3
    n = np.zeros(SYMBOLS ** 3)
    n[[r["gram"] for r in rows]] = [r["n"] for r in rows]
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two = n.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 0.5) / (one.sum() + 0.5 * SYMBOLS)
    p2 = (two + 10 * p1) / (two.sum(axis=1, keepdims=True) + 10)
    p3 = (n + 10 * p2) / (n.sum(axis=2, keepdims=True) + 10)
    return -np.log(p3).astype(np.float32)


def symbol_of(c: str) -> int:
    return int(SYMBOL[ord(c)]) if ord(c) < 256 else OTHER


def readings(word: str, i: int, own: float = 8.0) -> list[tuple[str, float]]:
    """What the character at ``i`` may stand for, and the channel's cost;
    ``own`` is that of a mark that stands for itself."""
    c = word[i]
    out: list[tuple[str, float]] = []
    if c in SEPARATORS:
        between = 0 < i < len(word) - 1
        out.append((" ", 1.0 if c == " " else 2.5))
        if between:
            out.append(("", 0.3))
    if c in LOOKS_LIKE:
        out += [(x, 0.7 if c != "*" else 2.0) for x in LOOKS_LIKE[c]]
        out.append((c, own))
    elif c not in SEPARATORS:
        out.append((c, 0.0))
    if i and word[i - 1] == c:                      # repeats may be one letter
        run = i + 1 < len(word) and word[i + 1] == c or i > 1 and word[i - 2] == c
        out.append(("", 0.1 if run else 3.0))
        if run:
            out = [(x, cost + (4.0 if x else 0.0)) for x, cost in out]
    return out


def decoded(word: str, cost: np.ndarray, lo: int, hi: int, state: tuple[int, int], own: float = 8.0) -> list[str]:
    """The best reading of each character of word[lo:hi] after the two symbols
    of ``state``, boundaries as spaces."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {state: (0.0, None)}
    for i in range(lo, hi):
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        options = [(x, symbol_of(x) if x else -1, c) for x, c in readings(word, i, own)]
        for (a, b), (total, path) in best.items():
            for x, s, c in options:
                if s < 0:
                    key, value = (a, b), total + c
                else:
                    key, value = (b, s), total + c + float(cost[a, b, s])
                if key not in step or value < step[key][0]:
                    step[key] = (value, (path, x))
        best = step
    if hi == len(word):
        best = {(a, b): (total + float(cost[a, b, 0]), path) for (a, b), (total, path) in best.items()}
    path, out = min(best.values(), key=lambda x: x[0])[1], []
    while path is not None:
        path, x = path
        out.append(x)
    return out[::-1]


def viterbi(word: str, cost: np.ndarray) -> str:
    """The best reading of a noisy word, boundaries as spaces."""
    return "".join(decoded(word, cost, 0, len(word), (0, 0)))


def in_pieces(word: str, cost: np.ndarray, own: float) -> str:
    """A long word's reading, PIECE characters at a time, each with AHEAD more
    in sight."""
    out, state = [], (0, 0)
    for lo in range(0, len(word), PIECE):
        text = "".join(decoded(word, cost, lo, min(len(word), lo + PIECE + AHEAD), state, own)[:PIECE])
        for c in text:
            state = state[1], symbol_of(c)
        out.append(text)
    return "".join(out)


class Restorer:
    """Replaces noisy words of lower-cased texts; remembers their readings."""

    def __init__(self, cost: np.ndarray):
        self.cost, self.known = cost, {}

    def read(self, word: str, spaced: bool = False) -> str:
        core = word.strip(EDGE)
        if not core:
            return word
        if word[:word.index(core)].endswith("!"):       # !diot
            core = "!" + core
        found = self.known.get(core)
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            found = self.decode(core, spaced)
            if len(core) <= 4 * LONGEST:
                self.known[core] = found
        at = word.index(core)
        return word[:at] + found + word[at + len(core):]

    def decode(self, core: str, spaced: bool) -> str:
        if len(core) > LONGEST:
            core = RUNS.sub(r"\1\1\1", core)
        if len(core) > LONGEST:
            return in_pieces(core, self.cost, 8.0 if spaced else LITERAL)
        return viterbi(core, self.cost)

    def __call__(self, text: str) -> str:
        out, at = [], 0
        for hit in NOISE.finditer(text):
            a, b = hit.span()
            if a < at:
                continue
            if not hit["spaced"]:
                while a > at and not text[a - 1].isspace():
                    a -= 1
                b = WORD.match(text, b).end()
            word = text[a:b]
            out += [text[at:a], self.read(re.sub(r"\s", " ", word), True) if hit["spaced"] else self.read(word)]
            at = b
        return "".join(out) + text[at:] if out else text


# --------------------------------------------------------------- features

def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every five-letter run and word, row by row."""
    p = points(texts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = (p == 32) | ((p >= 9) & (p <= 13))
    inside = ~space & ((p >= 0xC0) | ((p >= 97) & (p <= 122)) | ((p >= 48) & (p <= 57)))
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    blank = np.concatenate([[0], np.cumsum(space)])
    where, what = [], []
    for c in range(0, len(p), SLICE):
        part = p[c:c + SLICE + RUN - 1].astype(U64) + U64(1)
        prefix = FIRST.prefix(part)
        runs = FIRST.windows(prefix, RUN)
        at = np.flatnonzero(blank[c + RUN:c + RUN + len(runs)] == blank[c:c + len(runs)])
        where.append(at + c)
        what.append(runs[at])
        i, j = np.searchsorted(start, (c, c + SLICE))
        s, e = start[i:j], end[i:j]
        fits = e - c <= len(part)                  # a word over the edge is longer than any feature
        where.append(s[fits])
        what.append(mix(FIRST.ranges(prefix, s[fits] - c, e[fits] - c) + U64(1)))
    where, what = np.concatenate(where), np.concatenate(what)
    return np.searchsorted(ends, where, side="right"), what


def distinct(row: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((what, row))
    row, what = row[order], what[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (what[1:] != what[:-1])
    return row[new], what[new]


def known_only(row, what, table: np.ndarray, seen: np.ndarray):
    """Of (row, hash) pairs those in a sorted table; ``seen`` marks the high
    bits that occur in it, so that few pairs are looked up."""
    hit = seen[(what >> U64(44)).astype(np.int64)]
    row, what = row[hit], what[hit]
    if not len(table):
        return row, what
    at = np.minimum(np.searchsorted(table, what), len(table) - 1)
    good = table[at] == what
    return row[good], what[good]


def high_bits(table: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << 20, dtype=bool)
    seen[(table >> U64(44)).astype(np.int64)] = True
    return seen


def counted(cost: np.ndarray):
    """mapInArrow: in how many of the rows each feature is, summed over
    ``ROWS`` rows at a time."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(cost)
        for batch in it:
            for at in range(0, len(batch), ROWS):
                row, what = features([restore(t) for t in lowered(batch.slice(at, ROWS))])
                what, n = np.unique(distinct(row, what)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(what.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["feature", "n"])
    return run


def weight_of(t, n, toxic: int, clean: int) -> F.Column:
    """Log-odds of a feature in ``t`` of the toxic and ``n`` of the clean rows,
    less what chance may add among so many features."""
    odds = F.log((t + 0.5) / (toxic + 1)) - F.log((n + 2) / (clean + 1))
    return odds - CAUTION * F.sqrt(1 / (t + 0.5) + 1 / (n + 2))


# ------------------------------------------------------------------ model

@dataclass
class Model:
    cost: np.ndarray
    table: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: float = 1.0
    centre: float = 6.0

    def evidence(self, texts: list[str], seen: np.ndarray) -> np.ndarray:
        """Sum of a text's strongest distinct features."""
        out = np.zeros(len(texts))
        row, what = distinct(*known_only(*features(texts), self.table, seen))
        if len(row):
            w = self.weight[np.searchsorted(self.table, what)]
            order = np.lexsort((-w, row))
            row, w = row[order], w[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            np.add.at(out, row[rank < STRONGEST], w[rank < STRONGEST])
        return out


def scored(model: Model):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, seen = Restorer(model.cost), high_bits(model.table)
        for batch in it:
            others = [n for n in batch.schema.names if n != "text"]
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                e = model.evidence([restore(t) for t in lowered(part)], seen)
                score = 1 / (1 + np.exp(-np.clip(model.slope * (e - model.centre), -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in others]
                    + [pa.array(e), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=others + ["evidence", "score", "predicted"])
    return run


def calibrate(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and centre of the logistic curve, by Newton's method with a weak
    prior; the default curve if one class is missing."""
    if not (0 < toxic.sum() < len(toxic)):
        return 1.0, 6.0
    x = np.stack([np.ones(len(evidence)), evidence], axis=1)
    beta, ridge, prior = np.array([-6.0, 1.0]), np.diag([0.01, 0.1]), np.array([-6.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge,
                               x.T @ (toxic - p) - ridge @ (beta - prior))
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(beta[1], 0.05)
    return float(slope), float(-beta[0] / slope)


def held_out(doc_id: str = "doc_id") -> F.Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """``docs`` (doc_id, text), ``labels`` (doc_id, toxic)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = Model(language_model(docs))
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .filter("doc_id is not null and toxic in (0, 1)").filter(~held_out())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("draw", F.xxhash64("doc_id")))
    drawn = (rows.filter("toxic = 1").orderBy("draw", "doc_id").limit(TOXIC)
             .union(rows.filter("toxic = 0").orderBy("draw", "doc_id").limit(CLEAN)))
    # at most TOXIC + CLEAN ids: small enough to broadcast
    sample = materialize(docs.join(F.broadcast(drawn), "doc_id").select(
        "doc_id", "text", "toxic", (F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLD)) == 0).alias("check")),
        "labelled")
    sizes = {r["toxic"]: r["n"] for r in
             sample.filter("not check").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return model
    parts = sample.sparkSession.sparkContext.defaultParallelism

    def count(label: int) -> DataFrame:
        own = sample.filter((F.col("toxic") == label) & ~F.col("check")).select("text").repartition(parts)
        n = own.mapInArrow(counted(model.cost), "feature long, n long")
        return n.select("feature", *[(F.col("n") if label == x else F.lit(0)).alias(f"of{x}") for x in (0, 1)])

    both = count(1).unionByName(count(0)).groupBy("feature").agg(F.sum("of1").alias("t"), F.sum("of0").alias("n"))
    found = (both.withColumn("weight", weight_of(F.col("t"), F.col("n"), toxic, clean))
             .filter(F.col("weight") >= LOWEST_WEIGHT).orderBy(F.desc("weight"), "feature").limit(FEATURES).collect())
    table = np.array([r["feature"] for r in found], dtype=np.int64).view(U64)
    order = np.argsort(table)
    model.table, model.weight = table[order], np.array([r["weight"] for r in found], dtype=float)[order]
    rows = (sample.filter("check").select("toxic", "text").repartition(parts)
            .mapInArrow(scored(model), "toxic int, evidence double, score double, predicted int")
            .select("toxic", "evidence").collect())           # <= TOXIC + CLEAN
    rows = sorted((r["evidence"], r["toxic"]) for r in rows)
    model.slope, model.centre = calibrate(np.array([e for e, _ in rows]), np.array([x for _, x in rows], dtype=float))
    return model


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: held_out, evidence, score and predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored(model), "doc_id long, held_out boolean, evidence double, score double, predicted int")


def passed(model: Model):
    """mapInArrow: the rows, all columns, whose text is not predicted toxic."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, seen = Restorer(model.cost), high_bits(model.table)
        for batch in it:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                e = model.evidence([restore(t) for t in lowered(part)], seen)
                yield part.filter(pa.array(model.slope * (e - model.centre) < 0))
    return run


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity(docs, learn(docs, read(spark, sf_dir, "labels"))).drop("evidence")
