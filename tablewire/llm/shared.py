"""What the operators share: tables written between stages, Arrow text buffers, word hashes."""

from __future__ import annotations

import dataclasses
import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewire.scratch import shared_dir

U64 = np.uint64


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage: a lost executor costs only the tasks that it ran, and a
    table that is read several times is computed once.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(spark: SparkSession) -> int:
    """Number of partitions for a deal-out of our own: that of Spark's shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_prefix(columns: list[str]) -> str:
    """A beginning for names of one's own that none of ``columns`` has."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def plain(record) -> tuple:
    """The fields of a dataclass, to be broadcast: workers have no copy of the package to find its class in."""
    return tuple(getattr(record, field.name) for field in dataclasses.fields(record))


def fold_of(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 5; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0)).cast("int")


def worker_cache(name: str, make):
    """A value that a Python worker keeps between tasks."""
    home = sys.modules.setdefault("_tablewire_worker", types.ModuleType("_tablewire_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def bounded_slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most ``limit`` bytes; a longer text is alone."""
    n = batch.num_rows
    if not n:
        return
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    places = np.frombuffer(places, np.int64 if wide else np.int32)
    places = places[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), places - places[0]
    data = np.frombuffer(data, np.uint8)[places[0] : places[-1]]
    return data, places - places[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)
LONG_WORD = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, per text, the first word's number."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    edge = offsets[:-1][offsets[:-1] < size]
    before = np.empty(size, bool)
    before[0], before[1:] = True, space[:-1]
    before[edge] = True
    after = np.empty(size, bool)
    after[-1], after[:-1] = True, space[1:]
    after[edge[edge > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of the words, with A-Z in lower case or (``fold`` off) as they are, eight bytes a step."""
    if not len(starts):
        return np.zeros(0, U64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _LOWER[data] if fold else data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    h = mix(length.astype(U64) + U64(0x9E3779B97F4A7C15))
    live = np.arange(len(starts))
    at = starts.copy()
    left = np.where(length > LONG_WORD, 0, length)
    long_words = np.flatnonzero(length > LONG_WORD)
    while True:
        keep = left > 0
        if not keep.all():
            live, at, left = live[keep], at[keep], left[keep]
        if not len(live):
            break
        h[live] = mix((h[live] ^ (eight[at] & _MASK[np.minimum(left, 8)])) * U64(0x9E3779B97F4A7C15))
        at, left = at + 8, left - 8
    for k in long_words:
        digest = hashlib.blake2b(padded[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        h[k] = U64(int.from_bytes(digest, "little"))
    return h


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
    "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
}


def arrow_type(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark DDL text of plain types; workers have no session to ask."""
    fields = (field.split() for field in ddl.split(","))
    return pa.schema([(name, _ARROW[kind]) for name, kind in fields])


def arrow_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
