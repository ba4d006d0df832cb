"""Web archives: a deterministic sharded WARC writer and its reader (operator 12).

Writing takes these steps:

1. One narrow table of all rows, read once: key, place in the input, digest and size of
   the payload. Of it come the total size, the repeated payloads with their response
   (the largest key, then the largest tie value) and a sample of keys.
2. Shard borders are quantiles of that sample, the rows with the least hashes, so they
   depend on the data alone and not on partitions. A row's place in the order is its key
   and then a tie value, a hash of its place in the input: rows that share a key, or are
   equal, spread over shards too. The number of shards follows from the size.
3. Rows find their type by the digest (repeated payloads only), revisits drop their
   payload, and ``repartitionById`` brings a shard to one task, sorted. The task writes
   records as gzip members and begins a new file when the compressed size passes
   ``roll_bytes``. Record ids, block digests and payload digests are computed anew.
4. Files get temporary names, one folder per attempt; Spark's committer keeps the manifest
   rows of the attempts that count, and these files alone are renamed. A repeated rename
   finds its work done. The manifest of final names is written last: readers follow it, so
   files of lost attempts are never read.

The same stored rows give the same archives, byte by byte: no clock, no random number.
Reading checks length, block digest and payload digest of every record.

Defined cases: a null payload is an empty one; a null key sorts first and never wins over
a key, and its id in the archive is empty; of equal payloads of at least ``revisit_bytes``
one row is the response and all others, repeated rows too, revisit it, smaller ones are all
responses; a null URL gives a record without target; an empty table writes no file and an
empty manifest; columns not named are not looked at. Line breaks and other control
characters in URLs are percent-escaped, so that no header can be forged.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tablewire.llm.shared import arrow_batch, arrow_type, settle
from tablewire.scratch import shared_dir

MANIFEST = "shard int, file string, n_records long, n_bytes long, sha256 string"
RECORD = (
    "key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long,"
    "shard int, file string, offset long"
)
#: Borders of shards are taken from so many rows a shard.
SAMPLE_A_SHARD = 32
MOST_SHARDS = 4096
VERSION = "WARC/1.1"


class BrokenArchive(ValueError):
    """A record, digest or file that does not fit its headers or manifest."""


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(key: int | None, tie: int) -> str:
    return f"<urn:page:{'' if key is None else key}:{tie & 0xFFFFFFFFFFFFFFFF:016x}>"


def _key_of(record_id: str) -> int | None:
    key = record_id.split(":")[2]
    return int(key) if key else None


def _block(headers: list[tuple[str, str]], content: bytes) -> bytes:
    head = [VERSION, *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(content)}", "", ""]
    return "\r\n".join(head).encode() + content + b"\r\n\r\n"


def info_record(name: str, date: str) -> bytes:
    """The record that opens a file."""
    content = b"format: WARC File Format 1.1\r\n"
    digest = _sha1(name.encode())
    return _block(
        [
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{digest}>"), ("WARC-Date", date),
            ("WARC-Filename", name), ("WARC-Block-Digest", "sha1:" + _sha1(content)),
            ("Content-Type", "application/warc-fields"),
        ],
        content,
    )


def page_record(key, tie, url, payload: bytes | None, size: int, digest: str, winner, date: str) -> bytes:
    """A response with its payload or, where ``winner`` (key, tie) is given, a revisit of that record without it.

    ``size`` and ``digest`` are those of the full payload.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    content = http if winner else http + payload
    headers = [("WARC-Type", "revisit" if winner else "response"), ("WARC-Record-ID", _record_id(key, tie)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if winner:
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(*winner)),
        ]
    headers += [
        ("WARC-Block-Digest", "sha1:" + _sha1(content)), ("WARC-Payload-Digest", "sha1:" + digest),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _block(headers, content)


def read_members(stream) -> Iterator[tuple[int, bytes]]:
    """Offsets and contents of the gzip members of a file, one at a time."""
    at, rest = 0, b""
    while True:
        inflate, begin, out = zlib.decompressobj(31), at, []
        while not inflate.eof:
            data = rest or stream.read(1 << 18)
            if not data:
                if out or at != begin:
                    raise BrokenArchive("a file ends within a record")
                return
            out.append(inflate.decompress(data))
            rest = inflate.unused_data
            at += len(data) - len(rest)
        yield begin, b"".join(out)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and the block of a record, with its block digest checked."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != VERSION:
        raise BrokenArchive("not a record")
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
    length = int(headers["content-length"])
    content = rest[:length]
    if rest[length:] != b"\r\n\r\n" or headers["warc-block-digest"] != "sha1:" + _sha1(content):
        raise BrokenArchive(f"record {headers.get('warc-record-id')} is damaged")
    return headers, content


def _page_row(headers: dict[str, str], content: bytes) -> tuple:
    http, _, payload = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    size, digest = int(fields["Content-Length"]), headers["warc-payload-digest"].removeprefix("sha1:")
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or _sha1(payload) != digest):
        raise BrokenArchive(f"payload of {headers['warc-record-id']} is damaged")
    refers = _key_of(headers["warc-refers-to"]) if revisit else None
    return _key_of(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], size, digest, refers


def _system(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


@dataclass(frozen=True)
class Archive:
    """Where a set of archive files lies: the files below ``files``, their manifest in ``manifest``."""

    files: str
    manifest: str

    def manifest_table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(self.manifest)


def _placed(pages: DataFrame, purpose: str) -> DataFrame:
    """``pages`` with a column ``_tie``, a hash of the row's place in stored files; rows without files are stored first."""
    tie = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_tie")
    try:
        return pages.select("*", tie)
    except AnalysisException:
        return settle(pages, purpose).select("*", tie)


def write_archive(
    pages: DataFrame,
    base: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_bytes: int = 0,
    shard_bytes: int = 1 << 30,
    roll_bytes: int = 256 << 20,
    date: str = "2000-01-01T00:00:00Z",
    level: int = 6,
) -> Archive:
    """Writes one record per row in key order and returns where the archive lies.

    ``shard_bytes`` is the payload that one task is to write (at most ``MOST_SHARDS`` tasks), and
    ``roll_bytes`` the compressed size at which a new file begins.
    """
    spark = pages.sparkSession
    base = base or shared_dir(spark, "archive")
    narrow = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(payload).cast("binary").alias("payload"))
    rows = _placed(narrow, "pages").withColumn("payload", F.coalesce("payload", F.lit(b"")))
    rows = rows.withColumnRenamed("_tie", "tie")
    digest, size = F.sha2("payload", 256), F.octet_length("payload").cast("long")

    brief = settle(rows.select("key", "tie", F.unhex(digest).alias("digest"), size.alias("size")), "archive-rows")
    repeated = brief.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(
        F.max(F.struct("key", "tie")).alias("winner"), F.count("*").alias("n")
    )
    repeated = settle(repeated.where("n > 1").select("digest", "winner"), "archive-repeated")
    total = brief.agg(F.coalesce(F.sum(F.col("size") + 512), F.lit(0)).alias("total")).first()["total"]
    shards = int(min(MOST_SHARDS, max(1, -(-total // shard_bytes))))
    drawn = brief.select("key", "tie").orderBy(F.xxhash64("key", "tie"), "key", "tie").limit(SAMPLE_A_SHARD * shards)
    borders = _borders([(r["key"], r["tie"]) for r in drawn.collect()] if shards > 1 else [], shards)

    typed = rows.withColumn("digest", F.unhex(digest)).withColumn("size", size).join(repeated, "digest", "left")
    typed = typed.withColumn("winner", F.when((F.col("size") >= revisit_bytes) & ~F.col("winner").eqNullSafe(F.struct("key", "tie")), F.col("winner")))
    again = F.col("winner").isNotNull()
    records = typed.select(
        "key", "tie", "url", "size",
        F.unhex(F.sha1("payload")).alias("digest"),
        F.when(~again, F.col("payload")).alias("payload"),
        again.alias("again"), F.col("winner.key").alias("winner_key"), F.col("winner.tie").alias("winner_tie"),
        _shard_of(borders).alias("shard"),
    )
    ordered = records.repartitionById(shards, "shard").sortWithinPartitions(F.col("key").asc_nulls_first(), "tie")
    write = _writer(f"{base}/files", roll_bytes, date, level)
    written = settle(ordered.mapInArrow(write, MANIFEST), "archive-temporary")
    found = Archive(f"{base}/files", f"{base}/manifest")
    # few rows, one per file; each is renamed by one task, and a repeated task finds the new name
    committed = written.repartition(min(shards, 64), "file").mapInArrow(_renamer(found.files), MANIFEST)
    committed.write.parquet(found.manifest)
    return found


def _borders(sample: list[tuple[int | None, int]], shards: int) -> list[tuple[int, int]]:
    """At most ``shards - 1`` rising (key, tie) pairs that cut the sample evenly."""
    known = sorted((k, t) for k, t in sample if k is not None)
    nulls = len(sample) - len(known)
    cuts = (len(sample) * s // shards - nulls for s in range(1, shards))
    return sorted({known[c] for c in cuts if 0 <= c < len(known)})


def _shard_of(borders: list[tuple[int, int]]) -> F.Column:
    """The number of borders at or below a row; rows without a key are in the first shard."""
    if not borders:
        return F.lit(0)
    keys = np.array([b[0] for b in borders], np.int64)
    ties = np.array([b[1] for b in borders], np.int64)

    @F.pandas_udf("int")
    def shard(key, tie):
        low = np.searchsorted(keys, key.fillna(0).to_numpy(np.int64), "left")
        high = np.searchsorted(keys, key.fillna(0).to_numpy(np.int64), "right")
        ends = np.array([a + np.searchsorted(ties[a:b], t, "right") for a, b, t in zip(low, high, tie, strict=True)], np.int32)
        return type(key)(np.where(key.isna(), 0, ends))

    return shard("key", "tie")


def _writer(files: str, roll_bytes: int, date: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, schema, rows = uuid.uuid4().hex, arrow_type(MANIFEST), []
        shard, number, sink, sums, n, size = TaskContext.get().partitionId(), 0, None, None, 0, 0

        def put(record: bytes) -> None:
            nonlocal n, size
            member = gzip.compress(record, level, mtime=0)
            sink.write(member)
            sums.update(member)
            n, size = n + 1, size + len(member)

        def finish() -> None:
            nonlocal sink
            sink.close()
            sink = None
            rows.append((shard, f"{attempt}/{name}", n, size, sums.hexdigest()))

        try:
            for batch in batches:
                for at in range(batch.num_rows):
                    if sink is None:
                        name = f"shard-{shard:05d}-{number:05d}.warc.gz"
                        system, path = _system(f"{files}/_temporary/{attempt}/{name}")
                        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        sink, sums, n, size = system.open_output_stream(path, compression=None, buffer_size=1 << 20), hashlib.sha256(), 0, 0
                        number += 1
                        put(info_record(name, date))
                    row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                    winner = (row["winner_key"], row["winner_tie"]) if row["again"] else None
                    text_digest = base64.b32encode(row["digest"]).decode()
                    put(page_record(row["key"], row["tie"], row["url"], row["payload"], row["size"], text_digest, winner, date))
                    if size >= roll_bytes:
                        finish()
            if sink is not None:
                finish()
            yield arrow_batch(rows, schema)
        finally:
            if sink is not None:
                sink.close()

    return write


def _renamer(files: str):
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                name = row["file"].rsplit("/", 1)[1]
                system, source = _system(f"{files}/_temporary/{row['file']}")
                _, target = _system(f"{files}/{name}")
                if system.get_file_info(source).type != FileType.NotFound:
                    system.move(source, target)
                if system.get_file_info(target).size != row["n_bytes"]:
                    raise BrokenArchive(f"{name} has {system.get_file_info(target).size} bytes, its task wrote {row['n_bytes']}")
                rows.append((row["shard"], f"{files}/{name}", row["n_records"], row["n_bytes"], row["sha256"]))
            yield arrow_batch(rows, batch.schema)

    return rename


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every page record of the files that the manifest names, checked; ``offset`` is that of its gzip member."""
    names = RECORD.replace("\n", "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_type(names)
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _system(row["file"])
                rows, n = [], 0
                with system.open_input_stream(path, compression=None, buffer_size=1 << 20) as stream:
                    for offset, data in read_members(stream):
                        headers, content = parse_record(data)
                        n += 1
                        if headers["warc-type"] != "warcinfo":
                            rows.append((*_page_row(headers, content), row["shard"], row["file"], offset))
                        if len(rows) >= 10_000:
                            yield arrow_batch(rows, schema)
                            rows = []
                if n != row["n_records"]:
                    raise BrokenArchive(f"{row['file']} has {n} records, its manifest {row['n_records']}")
                yield arrow_batch(rows, schema)

    listed = archive.manifest_table(spark)
    return listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").mapInArrow(read, names)
