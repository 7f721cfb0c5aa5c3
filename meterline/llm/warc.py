"""Operator 4: WARC archives with dictionary-compressed records.

Each archive begins with a skippable frame (magic 0x184D2A5D) that holds a
Zstandard dictionary built from records of that archive; every record
follows as a frame of its own, compressed with the dictionary.  Spark's text
writer puts one archive in one file through the committer of the shared
file system, so a lost executor leaves no half-written archive; the line
end it adds after an archive is an empty skippable frame, which readers of
the format step over.

Of pages with equal payloads of at least ``least`` bytes the one with the
largest id is written as a response, the others as revisits that refer to
it and hold no payload.  Which ones is settled on digests alone, with
partial aggregation, before any payload moves.

Defined results: a null payload is the empty one; a null address is written
as ``urn:page:`` and the id.  A repeated or null id is a record of its own:
null ids come before all others, equal ids are ordered by payload.  Other
columns are ignored.  An empty table gives an empty folder and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path
from .common import identified, read

DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
#: An empty skippable frame, in ASCII: what the text writer puts at the end.
LINE_END = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
#: Bytes of records in an archive before compression, and of its dictionary.
ARCHIVE_BYTES, DICTIONARY_BYTES = 16 << 20, 48 << 10
#: Bytes of records a dictionary is built from, taken evenly.
TRAINING_BYTES = 4 << 20
LEVEL = 6
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESULT_DDL = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, archive string")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(rid: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=rid % 2 ** 64)}>"


def clean(value: str) -> str:
    """A header value in one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record(rid: int, page_id: int | None, url: str | None, payload: bytes, date: str,
           response: tuple[int, int | None] | None) -> bytes:
    """A response, or with ``response`` (its rid and page id) a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if response else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if response else 'response'}",
            f"WARC-Record-ID: {record_id(rid)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {clean(url) if url else f'urn:page:{page_id}'}",
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if response:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(response[0])}"]
        if response[1] is not None:
            head.append(f"Refers-To-Page-Id: {response[1]}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    total = sum(map(len, records))
    every = max(1, -(-total // TRAINING_BYTES))
    samples = [r[:1 << 17] for r in records[::every]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:            # too little to learn from
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES],
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes]) -> bytes:
    learnt = dictionary(records)
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(learnt.as_bytes())
    writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=learnt)
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(packed)), packed,
                     *map(writer.compress, records)])


def archives(date: str):
    """mapInArrow: pages to archives, one row each."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in it:
            cols = [batch.column(c) for c in ("rid", "doc_id", "url", "text", "to_rid", "to_id")]
            cols[2] = cols[2].cast(pa.binary())
            cols[3] = cols[3].cast(pa.binary())
            for i in range(len(batch)):
                rid, page_id, url, text, to_rid, to_id = (c[i].as_py() for c in cols)
                held.append(record(rid, page_id, url and url.decode("utf-8", "replace"), text, date,
                                   None if to_rid is None else (to_rid, to_id)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_pydict({"archive": [archive(held)]})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"archive": [archive(held)]})
    return run


def write_archives(pages: DataFrame, path: str, least: int = 0,
                   date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as archives in the folder ``path``."""
    base = identified(pages, "page_id", "html", extra=("url",), nulls_last=False)
    keyed = base.select("rid", "doc_id", F.sha2("text", 256).alias("key")).where(
        F.octet_length("text") >= least)
    groups = keyed.groupBy("key").agg(F.max(F.struct("rid", "doc_id")).alias("last"),
                                      F.count("*").alias("n")).filter("n > 1")
    revisits = (keyed.select("rid", "key").join(groups, "key").filter("rid <> last.rid")
                .select("rid", F.col("last.rid").alias("to_rid"), F.col("last.doc_id").alias("to_id")))
    rows = base.withColumn("url", F.col("url").cast("string")).join(revisits, "rid", "left")
    (rows.mapInArrow(archives(date), "archive binary")
     .select(F.col("archive").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", LINE_END).text(path))


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of one archive."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary at the start of the archive")
    if not data.endswith(LINE_END.encode()):
        raise ValueError("the archive's last frame is missing: it was cut short")
    learnt = data[8:8 + size]
    if learnt[:4] == struct.pack("<I", FRAME_MAGIC):
        learnt = zstandard.ZstdDecompressor().decompress(learnt)
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learnt)).stream_reader(
        io.BytesIO(memoryview(data)[8 + size:]), read_across_frames=True)
    source = io.BufferedReader(plain, 1 << 20)
    while line := source.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("a record does not begin where it should")
        head: dict[str, str] = {}
        while (line := source.readline()) != b"\r\n":
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            head[name] = value
        block = source.read(int(head["Content-Length"]))
        if source.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")
        yield head, block


def parsed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("archive", pa.string())])
    for batch in it:
        for i in range(len(batch)):
            out = []
            for head, block in records_of(batch.column("content")[i].as_py()):
                kind = head["WARC-Type"]
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                    raise ValueError(f"damaged record {head['WARC-Record-ID']}")
                number = [int(head[x]) if x in head else None for x in ("Page-Id", "Refers-To-Page-Id")]
                out.append((number[0], size, digest, kind, number[1], batch.column("path")[i].as_py()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(zip(*out), schema)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; payloads of responses are checked on the way."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parsed, RESULT_DDL)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).drop("archive")


OP4_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h,
         max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(((CAST('0x' || substr(h, CAST((i // 4) * 5 + 1 AS INT), 5) AS INT)
                  >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM g"""
