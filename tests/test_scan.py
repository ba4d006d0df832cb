import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tablewire.sources import row_range, scan


def test_spec_forms():
    assert scan.partition_values("k=v,k2='v2'") == {"k": "v", "k2": "v2"}
    assert scan.partition_values('day=2024-01-01/h="a,b"') == {"day": "2024-01-01", "h": "a,b"}
    for text in ("", "nothing", "=x", "a=b,,"):
        with pytest.raises(ValueError):
            scan.partition_values(text)


def test_unknown_key_is_an_error(spark):
    with pytest.raises(ValueError):
        scan.read_partition(spark.range(1), "other=1")


def test_partition_filters_reach_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.range(20).select("id", (F.col("id") % 4).cast("int").alias("p")).write.partitionBy("p").parquet(path)
    df = scan.read_partition(spark.read.parquet(path), "p=3")
    assert "PartitionFilters: [isnotnull(p" in plan(df)
    assert sorted(r["id"] for r in df.collect()) == [3, 7, 11, 15, 19]


@pytest.fixture(scope="module")
def numbers(spark):
    # A first key that holds a third of all rows, nulls in both keys, text order.
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))
    )
    return spark.range(0, 6000, 1, 4).select(hot.alias("a"), F.col("id").alias("b")).cache()


@pytest.mark.parametrize("start,count", [(0, 10), (10, 2500), (1999, 1), (5990, 100), (6000, 5), (100, 0)])
def test_row_range_equals_sorted_slice(numbers, monkeypatch, start, count):
    monkeypatch.setattr(row_range, "SKETCH_SIZE", 40)
    expected = sorted(
        ((r["a"], r["b"]) for r in numbers.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1])
    )[start : start + count]
    got = scan.read_row_range(numbers, ["a", "b"], start, count, top_rows=50)
    assert sorted((r["b"] for r in got.collect())) == sorted(b for _, b in expected)


EPOCH = datetime.datetime(2020, 1, 1)


@pytest.mark.parametrize("kind,make", [
    ("double", lambda r: r.choice([float("nan"), float("inf"), -0.5, 0.25, r.random()])),
    ("float", lambda r: r.uniform(-1, 1)),
    ("decimal(12,3)", lambda r: decimal.Decimal(r.randrange(-500, 500)).scaleb(-3)),
    ("decimal(30,3)", lambda r: decimal.Decimal(r.randrange(-10**25, 10**25)).scaleb(-3)),
    ("date", lambda r: (EPOCH + datetime.timedelta(days=r.randrange(90))).date()),
    ("timestamp", lambda r: EPOCH + datetime.timedelta(microseconds=r.randrange(300))),
    ("timestamp_ntz", lambda r: EPOCH + datetime.timedelta(seconds=r.randrange(10**6), microseconds=r.randrange(10**6))),
    ("boolean", lambda r: r.random() < 0.3),
    ("string", lambda r: "https://www.example.org/" + "é" * r.randrange(3) + "x" * r.randrange(40)),
    ("binary", lambda r: bytes(r.randrange(2) for _ in range(r.randrange(12)))),
])
def test_keys_of_every_type_are_ordered(spark, kind, make):
    rng = random.Random(kind)
    rows = [(None if i % 17 == 0 else make(rng), i) for i in range(900)]
    df = spark.createDataFrame(rows, f"a {kind}, b long").repartition(3)
    in_order = [r["b"] for r in df.orderBy("a", "b").collect()]
    for start, count in ((40, 300), (333, 700)):
        got = row_range.read_row_range(df, ["a", "b"], start, count, top_rows=30)
        assert sorted(r["b"] for r in got.collect()) == sorted(in_order[start : start + count])


def test_keys_without_numbers_are_sorted(spark):
    df = spark.range(300).select(F.struct((F.col("id") % 7).alias("x"), F.col("id").alias("y")).alias("k"), "id")
    order = row_range.KeyOrder(df, ["k"], top_rows=20)
    assert order.numbers == [] and not order.whole
    total, found = order.at_ranks([50, 299])
    assert total == 300 and not any(f.tied_before or f.tied_behind for f in found)


def test_one_hot_key_takes_few_jobs(spark):
    df = spark.range(0, 60_000, 1, 8).select(F.lit("hot").alias("a"), (F.col("id") * 7919 % 60_000).alias("b"))
    group = "row-range-jobs"
    spark.sparkContext.setJobGroup(group, group)
    got = row_range.read_row_range(df, ["a", "b"], 20_000, 30_000, top_rows=1_000)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs <= 9  # adaptive execution makes a job of every stage of the three actions
    assert got.agg(F.min("b"), F.max("b"), F.count("*")).first() == (20_000, 49_999, 30_000)


def test_range_behind_the_end_and_no_rows(spark):
    df = spark.range(100)
    for start, count, top_rows in ((100, 5, 10), (500, 5, 10), (100, 5, 1000), (3, 0, 10)):
        assert row_range.read_row_range(df, ["id"], start, count, top_rows).count() == 0
    assert row_range.read_row_range(df.where("id < 0"), ["id"], 0, 50, top_rows=10).count() == 0
    assert row_range.read_row_range(df, ["id"], 95, 50, top_rows=10).count() == 5


def test_long_range_needs_no_exchange(spark, plan):
    df = spark.range(0, 5000, 1, 4)
    read = scan.read_row_range(df, ["id"], 1000, 3000, top_rows=100)
    assert "Exchange" not in plan(read) and "Sort" not in plan(read)


def test_ties_at_the_edge_are_an_error(spark):
    df = spark.range(5000).select((F.col("id") % 10).alias("k"))
    with pytest.raises(ValueError):
        scan.read_row_range(df, ["k"], 250, 3000, top_rows=10)


@pytest.mark.parametrize(("start", "count", "tied"), [(25, 30, True), (20, 35, True), (20, 30, False), (0, 30, False), (0, 31, True), (1, 5000, True), (0, 5000, False), (7, 0, False)])
def test_ties_at_the_edge_of_a_short_range(spark, start, count, tied):
    df = spark.range(100).select(F.floor(F.col("id") / 10).alias("k"))
    if tied:
        with pytest.raises(ValueError, match="not unique"):
            scan.read_row_range(df, ["k"], start, count)
    else:
        assert scan.read_row_range(df, ["k"], start, count).count() == min(count, 100 - start)


def test_ties_inside_are_no_error(spark):
    df = spark.range(5000).select(F.when(F.col("id").between(100, 4000), 100).otherwise(F.col("id")).alias("k"))
    assert scan.read_row_range(df, ["k"], 50, 4500, top_rows=10).count() == 4500


def test_short_range_is_a_top_k(spark, plan):
    text = plan(scan.read_row_range(spark.range(1000), ["id"], 5, 10))
    assert "TakeOrderedAndProject" in text


def test_batches_pass_through_user_code(spark):
    def double(batch):
        import pyarrow.compute as pc

        return batch.set_column(0, "id", pc.multiply(batch.column(0), 2))

    assert scan.map_batches(spark.range(5), double, "id long").agg(F.sum("id")).first()[0] == 20


def test_first_bad_batch_fails_the_job(spark):
    def fail(batch):
        raise RuntimeError("bad batch")

    with pytest.raises(Exception, match="bad batch"):
        scan.map_batches(spark.range(5), fail, "id long").collect()


def test_snapshot_without_partition(spark):
    row = scan.snapshot_session(spark.range(7), "t").first()
    assert (row["record_count"], row["partition"], row["status"]) == (7, None, "normal")
