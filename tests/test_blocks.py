import random
import hashlib
import zlib

from pyspark.sql import functions as F

from tablewire.operators import blocks


def test_raw_size_by_type(spark):
    df = spark.sql(
        "select true a, 1Y b, 1S c, 1 d, 1L e, 1F f, 1D g, date'2024-01-01' h, "
        "timestamp'2024-01-01 00:00:00' i, 'né' j, X'010203' k, cast(null as bigint) l, array(1,2) m"
    )
    assert df.select(blocks.row_bytes(df.schema).alias("n")).first()["n"] == (
        1 + 1 + 2 + 4 + 8 + 4 + 8 + 4 + 8 + 3 + 3 + 0 + len('{"m":[1,2]}')
    )


def test_blocks_cover_the_range_and_negative_keys(spark):
    df = blocks.assign_blocks(spark.range(-50, 50), ["id"], 7, hashed=False)
    assert {r["block_id"] for r in df.collect()} == set(range(7))
    hashed = blocks.assign_blocks(spark.range(1000), ["id"], 7)
    assert hashed.groupBy("block_id").count().count() == 7


def test_assignment_has_no_exchange_and_ledger_sums_first(spark, plan):
    df = blocks.assign_blocks(spark.range(100), ["id"], 4)
    assert "Exchange" not in plan(df)
    text = plan(blocks.block_ledger(df))
    assert "partial_count" in text and "partial_sum" in text


def test_latest_block_wins(spark):
    df = spark.createDataFrame(
        [("u", 0, 1, "old"), ("u", 0, 3, "new"), ("u", 1, 2, "only"), ("w", 0, 1, "other")],
        "upload_id string, block_id int, version int, file_name string",
    )
    got = {(r["upload_id"], r["block_id"]): r["file_name"] for r in blocks.latest_blocks(df).collect()}
    assert got == {("u", 0): "new", ("u", 1): "only", ("w", 0): "other"}


def test_guard_names_the_field_and_keeps_the_edge(spark):
    df = spark.createDataFrame([("aaaa", b"1"), ("aaaaa", b"1"), ("a", b"123456"), (None, None)], "t string, b binary")
    good, rejected = blocks.oversize_guard(df, 4)
    assert good.count() == 2
    assert sorted(r["oversize_field"] for r in rejected.collect()) == ["b", "t"]


def test_guard_counts_bytes_not_characters(spark):
    good, rejected = blocks.oversize_guard(spark.createDataFrame([("éé",)], "t string"), 3)
    assert good.isEmpty() and rejected.count() == 1


def test_chunks_against_brute_force(spark):
    texts = ["", "a", "b" * 9, "c" * 10, "d" * 11, "é" * 25]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    rows = blocks.chunk_ledger(df, ["id"], "t", 10).collect()
    got = {(r["id"], r["chunk_index"]): (r["n_bytes"], r["checksum"]) for r in rows}
    expected = {}
    for i, text in enumerate(texts):
        data = text.encode()
        for k in range(max(1, -(-len(data) // 10))):
            piece = data[k * 10 : k * 10 + 10]
            expected[i, k] = (len(piece), zlib.crc32(piece))
    assert got == expected


def test_checksum_kinds(spark):
    df = spark.createDataFrame([(1, "123456789")], "id long, t string")
    assert blocks.payload_checksum(df, ["id"], "t").first()["checksum"] == 3421780262
    digest = blocks.chunk_ledger(df, ["id"], "t", 100, "md5").first()["checksum"]
    assert digest == hashlib.md5(b"123456789").hexdigest()


def test_chunks_need_no_exchange(spark, plan):
    df = spark.range(3).select("id", F.lit("abc").alias("t"))
    assert "Exchange" not in plan(blocks.chunk_ledger(df, ["id"], "t", 2))


def test_equal_versions_do_not_depend_on_the_order_of_rows(spark):
    rows = [("u", 1, f"f{k}", 7) for k in range(40)] + [("u", 2, "g", None), ("u", 2, "h", 3)]
    for seed in range(3):
        df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "upload_id string, block_id long, file string, version long")
        found = blocks.latest_blocks(df.repartition(5)).collect()
        assert sorted(map(tuple, found)) == [("u", 1, "f9", 7), ("u", 2, "h", 3)]


def test_oversize_fields_at_every_depth(spark):
    kind = "id int, a string, s struct<x: int, y: binary, l: array<array<struct<t: string>>>>, m map<string, map<string, string>>, n array<int>"
    big = "b" * 11
    rows = [
        (1, "ok", (1, b"0123456789", [[("t",)], None, [None]]), {"k": {"i": "v"}}, [1]),
        (2, big, (1, b"01234567890", None), None, None),
        (3, None, (1, b"01234567890", None), {big: None}, None),
        (4, None, (1, None, [[("t",)], [("t",), (big,)]]), None, None),
        (5, None, None, {"k": None, big: {}}, None),
        (6, None, None, {"k": {"i": big}}, None),
        (7, None, None, {"k": {big: "i"}}, None),
        (8, "é" * 6, None, None, None),
        (9, None, None, None, None),
    ]
    good, rejected = blocks.oversize_guard(spark.createDataFrame(rows, kind), 10)
    assert sorted(r["id"] for r in good.collect()) == [1, 9]
    assert {r["id"]: r["oversize_field"] for r in rejected.collect()} == {
        2: "a", 3: "s.y", 4: "s.l[][].t", 5: "m{key}", 6: "m{}{}", 7: "m{}{key}", 8: "a",
    }
