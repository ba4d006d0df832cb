"""Framed Arrow payloads: writing, checking and decoding them.

Layout of a payload: chunk size (u32, big endian); the data cut at the chunk
size, each *full* chunk followed by its CRC-32C (u32, big endian); the CRC-32C
of all data at the end.  The data is a run of Arrow record batch messages.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewire.functions.checksums import contribution, crc32c_many
from tablewire.sources.catalog import CatalogColumn, as_bytes, spark_schema, wire_schema

CHUNK_SIZE = 65_536
# A payload is one binary value; keep it far below the limit of a row.
PAYLOAD_BYTES = 16 << 20

FRAME_ERROR = "frame_error"


# -- one payload, inside a task -------------------------------------------


def frame_bytes(data: bytes, chunk_size: int = CHUNK_SIZE) -> bytes:
    view = memoryview(data)
    parts = [view[at : at + chunk_size] for at in range(0, len(view), chunk_size)] or [view]
    sums = crc32c_many(parts)
    ends = np.minimum(np.arange(1, len(parts) + 1) * chunk_size, len(view))
    whole = int(np.bitwise_xor.reduce(contribution(sums, len(view) - ends)))
    out = [struct.pack(">I", chunk_size)]
    for part, checksum in zip(parts, sums):
        out.append(part)
        if len(part) == chunk_size:
            out.append(struct.pack(">I", int(checksum)))
    out.append(struct.pack(">I", whole))
    return b"".join(out)


def frame_data(payload: bytes) -> tuple[bytes, str | None]:
    """The data of a payload and what is wrong with it, if anything."""
    if len(payload) < 8:
        return b"", "frame:short"
    chunk_size = struct.unpack_from(">I", payload)[0]
    full, rest = divmod(len(payload) - 8, chunk_size + 4)
    if chunk_size == 0 or rest >= chunk_size:
        return b"", "frame:length"
    view = memoryview(payload)
    starts = [4 + i * (chunk_size + 4) for i in range(full + 1)]
    parts = [view[s : s + chunk_size] for s in starts[:full]]
    parts.append(view[starts[full] : starts[full] + rest])
    sums = crc32c_many(parts)
    stored = [struct.unpack_from(">I", payload, s + chunk_size)[0] for s in starts[:full]]
    if list(map(int, sums[:full])) != stored:
        return b"", "frame:chunk_checksum"
    after = np.maximum(full * chunk_size + rest - np.arange(1, full + 2) * chunk_size, 0)
    whole = int(np.bitwise_xor.reduce(contribution(sums, after)))
    if whole != struct.unpack_from(">I", payload, len(payload) - 4)[0]:
        return b"", "frame:total_checksum"
    return b"".join(parts), None


# -- jobs over tables of payloads -----------------------------------------


def frame_payloads(
    df: DataFrame,
    columns: Sequence[CatalogColumn],
    chunk_size: int = CHUNK_SIZE,
    batches_per_payload: int = 1,
    payload_bytes: int = PAYLOAD_BYTES,
) -> DataFrame:
    """``(payload_id, payload)``: the rows of ``df`` as framed Arrow payloads.

    Every task frames its own Arrow batches; there is no exchange.  A batch over
    ``payload_bytes`` is halved until it fits or has one row.
    """
    wire = wire_schema(columns)

    def halves(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.nbytes <= payload_bytes or batch.num_rows <= 1:
            yield batch
            return
        middle = batch.num_rows // 2
        yield from halves(batch.slice(0, middle))
        yield from halves(batch.slice(middle))

    def on_the_wire(batch: pa.RecordBatch) -> pa.RecordBatch:
        # Only milliseconds may cut a value; anything else that does not fit fails.
        return pa.RecordBatch.from_arrays(
            [
                column.cast(f.type, safe=not (pa.types.is_timestamp(f.type) and f.type.unit == "ms"))
                for column, f in zip(batch.columns, wire)
            ],
            schema=wire,
        )

    def payload(messages: list[bytes]) -> pa.RecordBatch:
        framed = frame_bytes(b"".join(messages), chunk_size)
        return pa.RecordBatch.from_pydict({"payload": [framed]}, schema=pa.schema([("payload", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for piece in halves(on_the_wire(batch)):
                message = piece.serialize().to_pybytes()
                if waiting and (len(waiting) == batches_per_payload or size + len(message) > payload_bytes):
                    yield payload(waiting)
                    waiting, size = [], 0
                waiting.append(message)
                size += len(message)
        if waiting:
            yield payload(waiting)

    carried = [
        as_bytes(F.col(f"`{c.name}`"), df.schema[c.name].dataType).alias(c.name)
        if isinstance(c.spark_type(), T.BinaryType)
        else F.col(f"`{c.name}`")
        for c in columns
    ]
    framed = df.select(*carried).mapInArrow(run, "payload binary")
    return framed.select(F.monotonically_increasing_id().alias("payload_id"), "payload")


def _unsigned(four_bytes: Column) -> Column:
    return F.conv(F.hex(four_bytes), 16, 10).cast("long")


def frame_chunks(df: DataFrame, id_col: str = "payload_id", payload_col: str = "payload") -> DataFrame:
    """One row per chunk, cut in the JVM by arithmetic on the payload length.

    ``stored`` is the chunk's own checksum (null for a last partial chunk),
    ``bytes_after`` the data bytes that follow the chunk in its payload.
    """
    payload = F.col(payload_col)
    size, full, rest = F.col("_size"), F.col("_full"), F.col("_rest")
    headed = df.select(
        F.col(id_col),
        payload,
        F.octet_length(payload).cast("long").alias("_length"),
        F.when(F.octet_length(payload) >= 8, _unsigned(F.substring(payload, 1, 4))).alias("_size"),
    )
    shaped = headed.select(
        "*",
        F.when(size > 0, F.floor((F.col("_length") - 8) / (size + 4))).cast("long").alias("_full"),
        F.when(size > 0, F.pmod(F.col("_length") - 8, size + 4)).alias("_rest"),
    ).withColumn("well_formed", F.coalesce(rest < size, F.lit(False)))
    chunks = F.when(
        F.col("well_formed"),
        F.greatest(F.lit(0), full + F.when(rest > 0, 0).otherwise(-1)),
    ).otherwise(F.lit(0))
    exploded = shaped.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), chunks.cast("long"))).alias("chunk_index")
    )
    index = F.col("chunk_index")
    whole = F.col("well_formed") & (index < full)
    start = index * (size + 4) + 4
    length = F.when(whole, size).when(F.col("well_formed"), rest).otherwise(0)
    return exploded.select(
        id_col,
        "chunk_index",
        "well_formed",
        F.when(F.col("well_formed"), F.substring(payload, (start + 1).cast("int"), length.cast("int")))
        .otherwise(F.lit(b""))
        .alias("data"),
        F.when(whole, _unsigned(F.substring(payload, (start + size + 1).cast("int"), F.lit(4)))).alias("stored"),
        F.when(
            F.col("well_formed"), F.greatest(F.lit(0), full * size + rest - (index + 1) * size)
        ).otherwise(0).alias("bytes_after"),
        F.when(
            F.col("well_formed"),
            _unsigned(F.substring(payload, (F.col("_length") - 3).cast("int"), F.lit(4))),
        ).alias("total_stored"),
    )


def verify_frames(df: DataFrame, id_col: str = "payload_id", payload_col: str = "payload") -> DataFrame:
    """``(id, n_chunks, bad_chunks, total_ok)`` per payload.

    Checksums run over chunks, so one large payload spreads over tasks; the
    total is an exclusive-or of chunk contributions, combined before the shuffle.
    """
    chunks = frame_chunks(df, id_col, payload_col)
    id_type = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [memoryview(v.as_buffer()) for v in batch.column("data")]
            sums = crc32c_many(data)
            shares = contribution(sums, batch.column("bytes_after").to_numpy(zero_copy_only=False))
            stored = batch.column("stored").to_pylist()
            formed = batch.column("well_formed").to_pylist()
            bad = [not ok or (s is not None and s != int(c)) for ok, s, c in zip(formed, stored, sums)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    pa.array([len(d) for d in data], pa.int64()),
                    pa.array(bad, pa.bool_()),
                    pa.array(shares.astype(np.int64), pa.int64()),
                    batch.column("total_stored"),
                ],
                names=[id_col, "n_bytes", "bad", "share", "total_stored"],
            )

    out = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("bad", T.BooleanType()),
            T.StructField("share", T.LongType()),
            T.StructField("total_stored", T.LongType()),
        ]
    )
    checked = chunks.mapInArrow(run, out)
    return checked.groupBy(id_col).agg(
        F.count_if(F.col("n_bytes") > 0).alias("n_chunks"),
        F.count_if(F.col("bad")).alias("bad_chunks"),
        F.coalesce(F.bit_xor("share") == F.max("total_stored"), F.lit(False)).alias("total_ok"),
    )


def decode_frames(
    df: DataFrame,
    columns: Sequence[CatalogColumn],
    id_col: str = "payload_id",
    payload_col: str = "payload",
    keep_ns: bool = False,
) -> DataFrame:
    """Table rows of the payloads, with the id of the payload they came from.

    Every checksum is checked.  A payload that fails gives one row whose columns
    are null and whose ``frame_error`` says why; good rows have null there.  With
    ``keep_ns`` a column of nanosecond timestamps also comes as ``<name>_ns``.
    """
    wire = wire_schema(columns)
    ns = [c.name for c in columns if keep_ns and c.type in ("timestamp", "timestamp_ntz")]
    row = spark_schema(columns)
    fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in row.fields]
    fields += [T.StructField(f"{name}_ns", T.LongType()) for name in ns]
    out = T.StructType(
        [df.schema[id_col], *fields, T.StructField(FRAME_ERROR, T.StringType())]
    )
    micros = {
        f.name: pa.timestamp("us", tz=f.type.tz) for f in wire if pa.types.is_timestamp(f.type)
    }
    shown = [pa.field(f.name, micros.get(f.name, f.type)) for f in wire]
    shown += [pa.field(f"{name}_ns", pa.int64()) for name in ns]

    def arrays(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [
            batch.column(i).cast(micros[f.name], safe=False) if f.name in micros else batch.column(i)
            for i, f in enumerate(wire)
        ]
        return found + [batch.column(wire.get_field_index(name)).cast(pa.int64()) for name in ns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = wire.serialize().to_pybytes()
        for batch in batches:
            id_type = batch.schema.field(id_col).type
            answer = pa.schema([pa.field(id_col, id_type), *shown, pa.field(FRAME_ERROR, pa.string())])
            for key, payload in zip(batch.column(id_col), batch.column(payload_col)):
                data, error = frame_data(payload.as_buffer().to_pybytes() if payload.is_valid else b"")
                decoded = []
                if error is None:
                    try:
                        decoded = list(pa.ipc.open_stream(head + data)) if data else []
                    except pa.ArrowInvalid:
                        error = "frame:arrow"
                if error is not None:
                    nulls = [pa.nulls(1, f.type) for f in shown]
                    ids = pa.array([key.as_py()], id_type)
                    yield pa.RecordBatch.from_arrays([ids, *nulls, pa.array([error])], schema=answer)
                for rows in decoded:
                    ids = pa.array([key.as_py()] * rows.num_rows, id_type)
                    none = pa.nulls(rows.num_rows, pa.string())
                    yield pa.RecordBatch.from_arrays([ids, *arrays(rows), none], schema=answer)

    return df.select(id_col, payload_col).mapInArrow(run, out)
