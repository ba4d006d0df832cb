"""Token-id files: length-delimited binary records with masked checksums and an offset index (operator 8).

A file has a header and then records in ascending key order:

    header   8 bytes magic, uint32 bytes per id, uint32 masked checksum of the 12 bytes before
    record   uint64 payload length, uint32 masked checksum of it, payload, uint32 masked checksum of the payload
    payload  1 byte (0 where the key is null), int64 key, ids

Numbers are little-endian. The checksum is CRC-32, masked by rotation and a
constant as in record files of that kind, so that a checksum stored in a payload
does not weaken the outer one. Every file is written under a name of its own;
the index, written by Spark's committer, names the files that count, so files of
lost or repeated tasks are never read. One index row per record has the file,
the byte offset and the length; ``read_at`` follows it in any order.

Defined cases: null text counts as empty and gives a record with the end id
alone; null keys come first; repeated rows are records of their own, in an order
among equals that the text's hash fixes; an empty table writes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewire.llm.shared import arrow_batch, arrow_type, bounded_slices, tasks_for
from tablewire.llm.tokens import word_tokenizer
from tablewire.scratch import shared_dir

MAGIC = b"TWREC001"
INDEX = "key long, file string, part int, offset long, length long, n_tokens long"
RECORD = "key long, part int, place long, n_tokens long, ids binary"
_MASK = 0xA282EAD8


class BrokenRecord(ValueError):
    """A checksum, length or header that does not fit."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def header(width: int) -> bytes:
    head = MAGIC + struct.pack("<I", width)
    return head + struct.pack("<I", masked(head))


def read_header(stream) -> int:
    head = stream.read(16)
    if len(head) < 16 or head[:8] != MAGIC or struct.unpack("<I", head[12:])[0] != masked(head[:12]):
        raise BrokenRecord("not a record file")
    return struct.unpack("<I", head[8:12])[0]


def read_record(stream) -> bytes | None:
    """The next payload, or None at the end of the file."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise BrokenRecord("length of a record is damaged")
    size = struct.unpack("<Q", head[:8])[0]
    body = stream.read(size + 4)
    if len(body) < size + 4 or struct.unpack("<I", body[size:])[0] != masked(body[:size]):
        raise BrokenRecord("a record is damaged")
    return body[:size]


def _payload(key: int | None, ids: bytes) -> bytes:
    return struct.pack("<?q", key is not None, key or 0) + ids


def _parsed(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    has, key = struct.unpack("<?q", payload[:9])
    return (key if has else None), np.frombuffer(payload, f"<u{width}", offset=9).astype("<u4")


def _open(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


@dataclass(frozen=True)
class RecordSet:
    """Where a set of record files lies: ``base`` has the files, ``index`` their offset index."""

    base: str
    index: str

    def index_table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(INDEX).parquet(self.index)


def write_records(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    base: str | None = None,
    text: str = "text",
    key: str = "doc_id",
    n_files: int | None = None,
    width: int = 2,
) -> RecordSet:
    """Encodes the texts and writes record files in ascending key order, one per range of places in that order.

    ``width`` bytes hold one id; an id beyond it is an error, nothing is cut.
    """
    spark = docs.sparkSession
    base = base or shared_dir(spark, "records")
    files = f"{base}/files"

    def encoded(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
        encoder, end = word_tokenizer(tokenizer), np.array([end_id], np.uint32)
        for piece in bounded_slices(batch, "text"):
            ids, places = encoder.encode(piece.column("text"))
            top = max(int(ids.max(initial=0)), end_id)
            if top >> (8 * width):
                raise ValueError(f"id {top} needs more than {width} bytes")
            ids = np.insert(ids, places[1:], end).astype(f"<u{width}").tobytes()
            places = (width * (places + np.arange(len(places)))).tolist()
            own = (ids[a:b] for a, b in zip(places, places[1:], strict=False))
            yield from zip(piece.column("key").to_pylist(), own, strict=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, sink, at, part = arrow_type(INDEX), None, 0, TaskContext.get().partitionId()
        name = f"{files}/part-{part:06d}-{uuid.uuid4().hex}.rec"
        try:
            for batch in batches:
                rows = []
                for row_key, ids in encoded(batch):
                    if sink is None:
                        system, path = _open(name)
                        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        sink = system.open_output_stream(path, buffer_size=1 << 20)
                        sink.write(header(width))
                        at = 16
                    record = frame(_payload(row_key, ids))
                    sink.write(record)
                    rows.append((row_key, name, part, at, len(record), len(ids) // width))
                    at += len(record)
                yield arrow_batch(rows, schema)
        finally:
            if sink is not None:
                sink.close()

    # compressed texts are hardly longer than their ids, and the range sample must not tokenize
    texts = docs.select(
        F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    place = ("key", "h", "row")  # rows that share a key, or are equal, are spread too
    ordered = texts.repartitionByRange(n_files or tasks_for(spark), *place).sortWithinPartitions(*place)
    found = RecordSet(files, f"{base}/index")
    ordered.mapInArrow(write, INDEX).write.parquet(found.index)
    return found


def read_records(spark: SparkSession, records: RecordSet) -> DataFrame:
    """Every record, read from the files and checked: ``(key, part, place, n_tokens, ids, start)``.

    ``start`` is the number of ids in all records before, in file order.
    """
    index = records.index_table(spark)
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("ids"), F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    out = RECORD + ", start long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(out)
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _open(row["file"])
                with system.open_input_stream(path, buffer_size=1 << 20) as stream:
                    width, rows, size, start, place = read_header(stream), [], 0, row["first"], 0
                    while (payload := read_record(stream)) is not None:
                        key, ids = _parsed(payload, width)
                        rows.append((key, row["part"], place, len(ids), ids.tobytes(), start))
                        start, place, size = start + len(ids), place + 1, size + 4 * len(ids)
                        if size > 4 << 20:
                            yield arrow_batch(rows, schema)
                            rows, size = [], 0
                if (place, start) != (row["n"], row["first"] + row["ids"]):
                    raise BrokenRecord(f"{row['file']} has other records than its index")
                yield arrow_batch(rows, schema)

    # one row per file, dealt out by its number
    return files.repartitionByRange(tasks_for(spark), "part").mapInArrow(read, out)


def read_at(chosen: DataFrame) -> DataFrame:
    """Records of some index rows, read by offset in the order given within a partition."""
    out = "key long, n_tokens long, ids binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(out)
        for batch in batches:
            rows, opened = [], {}
            try:
                for row in batch.to_pylist():
                    if row["file"] not in opened:
                        system, path = _open(row["file"])
                        stream = system.open_input_file(path)
                        opened[row["file"]] = stream, read_header(stream)
                    stream, width = opened[row["file"]]
                    stream.seek(row["offset"])
                    key, ids = _parsed(read_record(stream) or b"", width)
                    rows.append((key, len(ids), ids.tobytes()))
            finally:
                for stream, _ in opened.values():
                    stream.close()
            yield arrow_batch(rows, schema)

    return chosen.select("file", "offset").mapInArrow(read, out)

