import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewire.functions.checksums import crc32c
from tablewire.sources import frames
from tablewire.sources.catalog import CatalogColumn, declared_columns, wire_schema

COLUMNS = [CatalogColumn("name", "string"), CatalogColumn("age", "bigint")]


def one_batch(name="lkj", age=4):
    batch = pa.RecordBatch.from_pydict({"name": [name], "age": [age]}, schema=wire_schema(COLUMNS))
    return batch.serialize().to_pybytes()


def payloads(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "payload_id long, payload binary")


def test_layout_below_one_chunk():
    data = one_batch()
    framed = frames.frame_bytes(data)
    assert framed[:4] == struct.pack(">I", 65536)
    assert framed[4:8] == b"\xff\xff\xff\xff"
    assert framed[4:-4] == data
    assert struct.unpack(">I", framed[-4:])[0] == crc32c(data)


def test_a_full_last_chunk_has_both_checksums():
    data = bytes(range(200))
    framed = frames.frame_bytes(data, 100)
    assert len(framed) == 4 + 200 + 2 * 4 + 4
    assert struct.unpack(">I", framed[104:108])[0] == crc32c(data[:100])
    partial = frames.frame_bytes(data[:150], 100)
    assert len(partial) == 4 + 150 + 4 + 4


@pytest.mark.parametrize("size", [0, 1, 99, 100, 101, 199, 200, 201, 1000])
def test_data_comes_back(size):
    data = bytes(i * 7 % 256 for i in range(size))
    assert frames.frame_data(frames.frame_bytes(data, 100)) == (data, None)


def test_decode_one_row(spark):
    row = frames.decode_frames(payloads(spark, frames.frame_bytes(one_batch())), COLUMNS).first()
    assert (row["name"], row["age"], row["frame_error"]) == ("lkj", 4, None)


def test_decode_many_chunks_and_batches(spark):
    data = one_batch("a" * 900, 1) + one_batch("b" * 900, 2)
    rows = frames.decode_frames(payloads(spark, frames.frame_bytes(data, 64)), COLUMNS).orderBy("age").collect()
    assert [(r["name"][0], r["age"]) for r in rows] == [("a", 1), ("b", 2)]


def damaged(framed, at):
    return framed[:at] + bytes([framed[at] ^ 1]) + framed[at + 1 :]


def test_damage_is_found_and_named(spark):
    framed = frames.frame_bytes(one_batch("c" * 900, 1), 64)
    tail = len(framed) - 10
    df = payloads(
        spark,
        framed,
        damaged(framed, 30),  # data of the first chunk
        damaged(framed, 69),  # checksum of the first chunk
        damaged(framed, tail),  # last chunk, which has no checksum of its own
        damaged(framed, len(framed) - 1),  # total
        b"\x00\x00",
        framed + b"\x00",
    )
    verified = {r["payload_id"]: r for r in frames.verify_frames(df).collect()}
    assert [verified[i]["bad_chunks"] for i in range(6)] == [0, 1, 1, 0, 0, 1]
    assert [verified[i]["total_ok"] for i in range(7)] == [True, False, True, False, False, False, False]
    errors = {r["payload_id"]: r["frame_error"] for r in frames.decode_frames(df, COLUMNS).collect()}
    assert errors[0] is None
    assert errors[1] == errors[2] == "frame:chunk_checksum"
    assert errors[3] == errors[4] == "frame:total_checksum"
    assert errors[5] == "frame:short" and errors[6] is not None


def test_empty_and_impossible_payloads(spark):
    empty, impossible = frames.frame_bytes(b"", 100), struct.pack(">I", 4) + b"x" * 4 + b"y" * 7
    verified = {r["payload_id"]: r for r in frames.verify_frames(payloads(spark, empty, impossible, None)).collect()}
    assert (verified[0]["n_chunks"], verified[0]["bad_chunks"], verified[0]["total_ok"]) == (0, 0, True)
    assert not verified[1]["total_ok"] and not verified[2]["total_ok"]


def test_not_arrow(spark):
    df = payloads(spark, frames.frame_bytes(b"this is not arrow", 100))
    assert frames.decode_frames(df, COLUMNS).first()["frame_error"] == "frame:arrow"


def test_table_round_trip_in_small_payloads(spark, table):
    events = table("events")
    columns = declared_columns(events.schema)
    framed = frames.frame_payloads(events, columns, chunk_size=512, payload_bytes=8192)
    assert framed.count() > 5
    assert framed.agg(F.max(F.octet_length("payload"))).first()[0] < 20000
    back = frames.decode_frames(framed, columns).drop("payload_id", "frame_error")
    assert back.exceptAll(events).isEmpty() and back.count() == events.count()
    assert frames.verify_frames(framed).where("not total_ok or bad_chunks > 0").isEmpty()


def test_nanoseconds_are_kept_apart(spark):
    columns = [CatalogColumn("t", "timestamp_ntz")]
    batch = pa.RecordBatch.from_pydict({"t": [1_000_000_123]}, schema=wire_schema(columns))
    df = payloads(spark, frames.frame_bytes(batch.serialize().to_pybytes()))
    row = frames.decode_frames(df, columns, keep_ns=True).first()
    assert row["t_ns"] == 1_000_000_123 and row["t"].microsecond == 0 and row["t"].second == 1


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_every_type_with_nulls(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "select 'é' string, X'00ff' binary, 1Y tinyint, -2S smallint, 3 int, 4L bigint, true boolean, 1.5F float, "
            "2.5D double, date'2024-02-29' date, timestamp'2024-07-01 10:00:00.123456' datetime, "
            "timestamp'1969-12-31 23:59:59.999999' timestamp, timestamp_ntz'2024-03-10 02:30:00.000001' timestamp_ntz"
        )
        nulls = df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        both = df.unionByName(nulls)
        columns = [CatalogColumn(n, n) for n in df.columns]
        back = frames.decode_frames(frames.frame_payloads(both, columns), columns)
        assert back.where("frame_error is not null").isEmpty()
        got = back.drop("payload_id", "frame_error")
        expected = both.withColumn("datetime", F.date_trunc("millisecond", "datetime"))
        assert got.exceptAll(expected).isEmpty() and got.count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_other_types_travel_as_text(spark):
    df = spark.sql("select cast(1.50 as decimal(5,2)) d, array(1, 2) a, named_struct('x', 'y') s")
    columns = declared_columns(df.schema)
    row = frames.decode_frames(frames.frame_payloads(df, columns), columns).first()
    assert (bytes(row["d"]), bytes(row["a"]), bytes(row["s"])) == (b"1.50", b"[1,2]", b'{"x":"y"}')
