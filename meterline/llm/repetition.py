"""Operator 9: quality rules by repetition coverage.

Texts are judged many at a time in numpy: rolling hashes over the words give
every n-gram of several lengths, equal hashes inside one text are repeats,
and what is measured is the share of a text's characters inside n-grams and
lines that occur before in it.  An n-gram can only repeat where its first
words do, so each length looks only at the places where the one before
repeats.

Limits (shares of the characters in words) are the ones in common use for
web text, see ``LIMITS``; a text is kept when it passes the base rules and
exceeds none.

Defined results: null and empty texts have no words and fail the base rule.
One row per input row, repeated rows and ids included; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FIRST, SLICE, U64, hash_ranges, mix, read, text_buffer, word_bounds

#: Longest share of characters inside repeated n-grams of each length, and
#: inside repeated lines; the largest share of lines that repeat.
LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHARS, LINES = 0.20, 0.30
MIN_WORDS, BASE_RUN, BASE_SHARE = 50, 3, 50

IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT_DDL = ("doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, "
              "kept boolean, dup_line_chars long, " + ", ".join(f"dup_{n}gram_chars long" for n in LIMITS))


def per_row(flags_at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of an array over each row's stretch."""
    total = np.concatenate([[0], np.cumsum(flags_at, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice; and is this not its first place."""
    n = len(keys)
    twice, later = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    if n < 2:
        return twice, later
    order = np.argsort(keys)
    ranked = keys[order]
    start = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    size = np.diff(np.append(start, n))
    twice[order] = np.repeat(size > 1, size)
    later[:] = twice
    later[np.minimum.reduceat(order, start)] = False
    return twice, later


def covered(places: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside any run of n words that starts at ``places``."""
    step = np.zeros(total + 1, dtype=np.int32)
    step[places] += 1                       # places differ from one another
    step[places + n] -= 1
    return np.cumsum(step[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    starts, ends = word_bounds(data, offsets)
    words_at = np.searchsorted(starts, offsets)
    total = len(starts)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(words_at))
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = lead[ends] - lead[starts]
    out = {"n_words": np.diff(words_at), "word_chars": per_row(chars, words_at),
           "n_symbols": per_row(IS_SYMBOL[data], offsets)}
    # lines
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    line_end = line_end - (data[line_end - 1] == 10) if len(line_end) else line_end
    first, past = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
    full = past > first
    line_start, line_end, first, past = line_start[full], line_end[full], first[full], past[full]
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    lines = hash_ranges(data, line_start, line_end)
    _, later = repeats(mix(lines + line_row.astype(U64) * U64(0x9E3779B97F4A7C15)))
    word_sum = np.concatenate([[0], np.cumsum(chars)])
    lines_at = np.searchsorted(line_start, offsets)
    out["n_dup_lines"] = per_row(later, lines_at)
    out["n_lines"] = np.diff(lines_at)
    out["dup_line_chars"] = per_row((word_sum[past] - word_sum[first]) * later, lines_at)
    # n-grams
    hashes = hash_ranges(data, starts, ends)
    room = words_at[row + 1] - np.arange(total)          # words left in the text
    places = np.arange(total)
    for n in (BASE_RUN, *LIMITS):
        places = places[room[places] >= n]
        keys = np.empty(len(places), dtype=U64)
        for c in range(0, total, SLICE):
            i, j = np.searchsorted(places, (c, c + SLICE))
            if i < j:
                prefix = FIRST.prefix(hashes[c:c + SLICE + n])
                at = places[i:j] - c
                keys[i:j] = FIRST.ranges(prefix, at, at + n)
        twice, later = repeats(mix(keys + row[places].astype(U64) * U64(0x9E3779B97F4A7C15)))
        if n == BASE_RUN:
            out["n_repeat_words"] = per_row(covered(places[twice], n, total), words_at)
        else:
            out[f"dup_{n}gram_chars"] = per_row(chars * covered(places[later], n, total), words_at)
        places = places[twice]
    return out


def judged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        data, offsets = text_buffer(batch.column("text"))
        i = 0
        while i < len(batch):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, side="right")) - 1)
            m = measure(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            words, chars = m["n_words"], np.maximum(m["word_chars"], 1)
            failed = (words < MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_SHARE * words)
            too_much = ((m["dup_line_chars"] > LINE_CHARS * chars)
                        | (m["n_dup_lines"] > LINES * np.maximum(m["n_lines"], 1)))
            for n, limit in LIMITS.items():
                too_much |= m[f"dup_{n}gram_chars"] > limit * chars
            names = [*COUNTS, "base_failed", "kept", "dup_line_chars", *(f"dup_{n}gram_chars" for n in LIMITS)]
            m |= {"base_failed": failed, "kept": ~failed & ~too_much}
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), *(pa.array(m[x]) for x in names)],
                names=["doc_id", *names])
            i = j


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per document: the base counts, the verdict, and the characters
    inside repeated lines and n-grams."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(judged, RESULT_DDL)


def op9_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(read(spark, sf_dir, "documents"))
