"""Helpers shared by the operators: document identity, text buffers, word
boundaries and polynomial hashes over symbol sequences, all in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path

U64 = np.uint64
SLICE = 1 << 20          # symbols hashed at a time
#: `[\x20\x09-\x0D]`, the white space of every operator here.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once under the shared folder and read back (cuts lineage)."""
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               extra: tuple[str, ...] = (), nulls_last: bool = True) -> DataFrame:
    """(rid, doc_id, text, *extra): ``rid`` orders rows by id and is unique.

    With unique, non-null ids (checked by one pass over the id column) rid
    is the id itself and nothing moves.  Otherwise rows are sorted by id
    (nulls last, or first), then text, numbered in that order, and written
    once: a repeated id is a row of its own, and its twins are copies.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       *[F.col(x) for x in extra])
    ids = base.select("doc_id").groupBy("doc_id").count()
    odd = ids.agg(F.max(F.when(F.col("doc_id").isNull() | (F.col("count") > 1), 1))).first()[0]
    if not odd:
        return base.select(F.col("doc_id").alias("rid"), "*")
    by_id = F.col("doc_id").asc_nulls_last() if nulls_last else F.col("doc_id").asc_nulls_first()
    # ids of sorted partitions grow with the sort order; writing pins them
    ranked = base.orderBy(by_id, "text", *extra).select(
        F.monotonically_increasing_id().alias("rid"), "*")
    return materialize(ranked, "identified")


# ------------------------------------------------------------ text buffers

def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row begins (n + 1 offsets)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``most`` bytes together, or one row;
    ``offsets`` (n + 1) say where each row begins."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def by_bytes(batch: pa.RecordBatch, most: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts hold at most ``most`` bytes, or one row."""
    size = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    for i, j in row_slices(np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), most):
        yield batch.slice(i, j - i)


def sorted_by(batch: pa.RecordBatch, name: str) -> pa.RecordBatch:
    return batch.take(pc.sort_indices(batch.column(name)))


def list_slices(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets (n + 1) and values of a list column; a null is an empty list."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), column.flatten()


# ---------------------------------------------------------------- hashing

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


class Rolling:
    """Hashes of any range of a symbol slice from one prefix sum, mod 2**64."""

    _powers: dict = {}

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2 ** 64, 256, dtype=U64)
        self.base = int(rng.integers(2 ** 40, 2 ** 62)) * 8 + 5
        self.salt = U64(int(rng.integers(1, 2 ** 62)) * 2 + 1)
        self.seed = seed

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = Rolling._powers.get(self.seed)
        if have is None or len(have[0]) < n:
            m = max(n, SLICE + 4096)
            inverse = pow(self.base, -1, 2 ** 64)

            def run(b: int) -> np.ndarray:
                out = np.full(m, b % 2 ** 64, dtype=U64)
                out[0] = 1
                return np.multiply.accumulate(out)
            have = Rolling._powers[self.seed] = (run(self.base), run(inverse))
        return have

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        """Prefix sums; symbols are bytes or 64-bit words."""
        values = self.table[symbols] if symbols.dtype == np.uint8 else symbols * self.salt
        out = np.zeros(len(symbols) + 1, dtype=U64)
        np.cumsum(values * self.powers(len(symbols) + 1)[0][:len(symbols)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = self.powers(len(prefix))[1]
        return mix((prefix[end] - prefix[start]) * inverse[start]
                   + (end - start).astype(U64) * self.salt)

    def windows(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hash of every run of k symbols."""
        n = len(prefix) - k
        if n <= 0:
            return np.zeros(0, dtype=U64)
        return mix((prefix[k:] - prefix[:n]) * self.powers(len(prefix))[1][:n])


WORDS, FIRST, SECOND = Rolling(11), Rolling(23), Rolling(37)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word never crosses rows."""
    space = IS_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    first = first[:-1]
    before = np.ones(len(data), dtype=bool)
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | first))
    after = np.ones(len(data), dtype=bool)
    after[:-1] = space[1:] | first[1:]
    return starts, np.flatnonzero(~space & after) + 1


#: Longer words and lines are hashed by BLAKE2b: a polynomial modulo 2**64
#: takes long patterns of two symbols for each other whatever its base.
POLYNOMIAL = 64
KEY = b"meterline"


def digest_of(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8, key=KEY).digest(), "little")


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                with_: Rolling = WORDS) -> np.ndarray:
    """Hashes of ordered, disjoint byte ranges, a slice of bytes at a time
    (a range longer than a slice makes its slice as long)."""
    out = polynomials(data, starts, ends, with_)
    for i in np.flatnonzero(ends - starts > POLYNOMIAL).tolist():
        out[i] = digest_of(data[starts[i]:ends[i]].tobytes())
    return out


def polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, with_: Rolling) -> np.ndarray:
    out = np.zeros(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, side="right")))
        a = int(starts[i])
        prefix = with_.prefix(data[a:int(ends[j - 1])])
        out[i:j] = with_.ranges(prefix, starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


def batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for columns in rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
