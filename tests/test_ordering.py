import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewire.functions.ordering import running_before, slice_of, unplaced, with_first, with_next

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(-40, 400), st.integers(0, 5)),
    max_size=80,
    unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, size=st.sampled_from([1, 4, 64]), levels=st.integers(0, 3))
def test_prefix_sums_and_next_rows_match_brute_force(spark, rows, size, levels):
    df = spark.createDataFrame(rows, "k int, p long, v int")
    sums = {
        (r["k"], r["p"]): r["before"]
        for r in running_before(df, ["k"], "p", {"before": F.col("v")}, size, levels).collect()
    }
    following = {
        (r["k"], r["p"]): r["nxt"] and r["nxt"]["p"]
        for r in with_next(df, ["k"], "p", F.struct("p"), "nxt", size, levels).collect()
    }
    for k, p, _ in rows:
        assert sums[k, p] == sum(v for k2, p2, v in rows if k2 == k and p2 < p)
        assert following[k, p] == min((p2 for k2, p2, _ in rows if k2 == k and p2 > p), default=None)
    assert len(sums) == len(following) == len(rows)


def test_rows_without_key_or_position_are_set_aside(spark):
    df = spark.createDataFrame([(None, 1, 1), (1, None, 1), (1, 2, 1)], "k int, p long, v int")
    assert running_before(df, ["k"], "p", {"b": F.col("v")}).count() == 1
    assert with_next(df, ["k"], "p", F.struct("p"), "n").count() == 1
    assert with_first(df, ["k"], "p", F.lit(True), "f").count() == 1
    assert {tuple(r) for r in unplaced(df, "k", "p").collect()} == {(None, 1, 1), (1, None, 1)}


@pytest.mark.parametrize("rows", [1, 3, 16, 1024])
def test_first_chosen_position(spark, rows):
    rng = random.Random(rows)
    data = [(rng.randrange(4), rng.randrange(60), rng.random() < 0.05) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, p long, c boolean")
    for r in with_first(df, ["k"], "p", F.col("c"), "f", rows).collect():
        assert r["f"] == min((p for k, p, c in data if k == r["k"] and c), default=None)


def test_then_by_orders_rows_of_one_position(spark):
    rows = [(1, c, l) for c in range(40) for l in range(3)]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, c long, l int")
    out = running_before(df, ["k"], "c", {"n": F.lit(1)}, rows=8, then_by=["l"])
    assert all(r["n"] == r["c"] * 3 + r["l"] for r in out.collect())


def test_slices_round_down(spark):
    got = spark.range(-5, 6).select("id", slice_of("id", 4).alias("s")).collect()
    assert all(r["s"] == r["id"] // 4 for r in got)


def test_no_window_over_a_whole_key(spark, plan):
    df = spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("p"))
    text = plan(running_before(df, ["k"], "p", {"n": F.lit(1)}))
    wide = [line for line in text.splitlines() if "Window [" in line and "_slice" not in line]
    assert not wide
