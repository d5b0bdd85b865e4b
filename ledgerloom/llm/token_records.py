"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record: length of the payload (8 bytes), masked checksum of these 8 bytes (4), payload, masked checksum of the
payload (4), line feed. All numbers are little-endian. A checksum is CRC-32, rotated right by 15 bits plus a
constant, so that checksums of data that hold checksums stay meaningful. The payload: width of an id in bytes (1),
1 if the document has an id (1), the document's id (8), the token ids. Spark's text writer, whose rows end in a
line feed, writes the records: files appear by its commit protocol, in any store, also when tasks run again.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm.batches import groups_of_rows
from ledgerloom.llm.columns import quoted
from ledgerloom.llm.encoding import encoder
from ledgerloom.llm.prefix import prefix_sums

FILE_BYTES = 16 << 20
MASK_DELTA = 0xA282EAD8
HEADER = struct.Struct("<QI")
PREFIX = struct.Struct("<BBq")
READ_SCHEMA = "file string, record_offset long, record_length long, doc_id long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = PREFIX.pack(width, doc_id is not None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload)) + b"\n"


def records(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """Offset, length, document id and token ids of each record; a damaged record is an error."""
    at = 0
    while at < len(content):
        size, check = HEADER.unpack_from(content, at)
        if masked(content[at : at + 8]) != check:
            raise ValueError(f"damaged length at byte {at}")
        payload = content[at + 12 : at + 12 + size]
        (check,) = struct.unpack_from("<I", content, at + 12 + size)
        if masked(payload) != check:
            raise ValueError(f"damaged record at byte {at}")
        width, known, doc_id = PREFIX.unpack_from(payload)
        yield at, size + 17, doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=PREFIX.size)
        at += size + 17


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Write ``folder/records`` in ascending order of the ids (null first, ties by text) and ``folder/index``.

    A null text is empty and gives the end id alone. Texts are dealt out by ranges of the id, about ``file_bytes``
    of text a file, so each file is one task's work and no task sees more than a range. An empty table gives no
    records.
    """
    spark = docs.sparkSession
    slim = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = 2 if max(encode.size, end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            for first, texts in groups_of_rows(batch):
                names = batch.column("doc_id").slice(first, len(texts)).to_pylist()
                # The writer adds the line feed.
                framed = [frame(n, np.append(x, np.uint32(end_id)), width)[:-1] for n, x in zip(names, encode.encode(texts))]
                yield pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], ["record"])

    dealt = slim.repartitionByRange(max(1, -(-size // file_bytes)), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    lines = ordered.mapInArrow(framed, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.mode("overwrite").text(f"{folder}/records")
    read_files(spark, folder).write.mode("overwrite").parquet(f"{folder}/index")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of ``folder/records``, checked: its place, document id, number and checksum of its ids."""

    columns = [("file", pa.string()), ("record_offset", pa.int64()), ("record_length", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(columns)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                file = path.as_py().rpartition("/")[2]
                rows = [(file, at, length, name, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for at, length, name, ids in records(content.as_py())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/records")
    return files.select("path", "content").mapInArrow(parsed, READ_SCHEMA)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``: the number of ids in all records before, in file order and then offset."""
    index = spark.read.schema(READ_SCHEMA).parquet(f"{folder}/index")
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    numbered = totals.select("file", "tokens", number.alias("number"), F.floor(number / 1000).alias("thousand"), F.lit(0).alias("all"))
    starts = prefix_sums(numbered, ["all"], ["thousand"], ["number"], value="tokens", name="file_start")
    within = Window.partitionBy("file").orderBy("record_offset").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    placed = index.withColumn("before", before).join(starts.select("file", "file_start"), "file")
    return placed.withColumn("start", F.col("file_start") + F.col("before")).drop("file_start", "before")
