import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewire.llm import blockjoin, kdtree, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector int, score double"


@pytest.fixture
def table(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_LEAST", 16)

    def make(rows):
        return spark.createDataFrame([(i, v, 0, "x", 1, 0.5) for i, v in rows], SCHEMA).repartition(3)

    return make


def rows_of(seed, n=150, width=6):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.choice([rng.gauss(0, 1), 0.5, -0.25]))) for _ in range(width)]) for i in range(n)]
    rows += [(i + n, rows[i][1]) for i in range(0, 40)] + [rows[3], rows[10]]
    odd = [(901, None), (902, [1.0, None] + [0.0] * 4), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (905, [0.0] * 6), (None, [9.0] * 6), (906, [9.0, 9.0]), (910, []), (911, None)]
    return rows + odd


def usable(rows, zero):
    found = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v) or (not zero and not any(v)):
            continue
        found[key] = min(found.get(key, v), v)
    return found


def brute(found, asked, k, score):
    out = []
    for q in sorted(found):
        if asked(q):
            best = sorted((-score(found[q], found[c]), c) for c in found if c != q)[:k]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(best, 1)]
    return out


def whole(a, b):
    return sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b))


def real(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_top_k(table, seed):
    rows = rows_of(seed)
    got = kdtree.exact_top_k(table(rows), F.col("id") % 10 == 0, 10).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute(usable(rows, True), lambda q: q % 10 == 0, 10, whole)


@pytest.mark.parametrize("seed", [1, 2])
def test_block_join(table, seed, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 8)
    monkeypatch.setattr(blockjoin, "TILE_QUERIES", 3)
    monkeypatch.setattr(blockjoin, "TILE_CANDIDATES", 7)
    rows = rows_of(seed)
    got = blockjoin.nearest(table(rows), F.col("id") % 5 == 0, 20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute(usable(rows, False), lambda q: q % 5 == 0, 20, real)


def test_few_or_no_candidates(table):
    rows = [(0, [1.0, 2.0]), (10, [2.0, 1.0]), (20, [0.5, 0.5])]
    for found in (kdtree.exact_top_k(table(rows), F.col("id") == 0, 10), blockjoin.nearest(table(rows), F.col("id") == 0, 10)):
        assert [(r.query_id, r.rank, r.vec_id) for r in found.orderBy("rank").collect()] == [(0, 1, 10), (0, 2, 20)]
    for rows in ([], [(0, [1.0])], [(1, [1.0]), (2, [1.0])]):
        assert kdtree.exact_top_k(table(rows), F.col("id") % 10 == 0, 3).collect() == []
        assert blockjoin.nearest(table(rows), F.col("id") % 10 == 0, 3).collect() == []


def test_tree_boxes_and_large_numbers():
    rng = np.random.default_rng(1)
    v = rng.integers(-(2**40), 2**40, (500, 5)).astype(object)
    tree = kdtree.KdTree(np.arange(500), v, leaf=8)
    for q in v[:5]:
        want = sorted(((int(x @ q), -i) for i, x in enumerate(v)), reverse=True)[:7]
        assert sorted(tree.search(-1, q, 7, None), reverse=True) == want
        assert sorted(tree.search(-1, q, 7, want[-1][0]), reverse=True) == want
    assert kdtree._exact(v.astype(np.int64), v.astype(np.int64)) is object


def test_error_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, (50, 64)), rng.normal(0, 3, (70, 64))
    about, off = blockjoin.tile(blockjoin.Quantised(a), blockjoin.Quantised(b))
    assert (np.abs(about - a @ b.T) <= off).all() and off.max() < 10


LARGE = [(0, [1e300, 1.0]), (5, [0.0, 5.0]), (7, [1e300, 3.0]), (10, [-1e300, 2.0]), (11, [1e-300, 1e300]), (12, [1.0, 1.0]), (20, [1e308, -1e308])]


def test_very_large_components(spark):
    """All candidates come out, by true products; what is beyond a double is an infinity and ties by id."""
    df = spark.createDataFrame([(i, v, "x") for i, v in LARGE], "vec_id long, embedding array<double>, id string")
    got = {}
    for r in blockjoin.nearest(df, F.col("id") % 10 == 0, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    inf = float("inf")
    assert got[0] == [(7, inf), (20, inf), (11, 1e300), (12, 1e300), (5, 5.0), (10, -inf)]
    assert [i for i, _ in got[10]] == [11, 5, 12, 0, 7, 20] and [s for _, s in got[10]][-3:] == [-inf] * 3
    assert [i for i, _ in got[20]] == [0, 7, 12, 5, 10, 11] and got[20][2] == (12, 0.0)
    whole = {i: [max(min(math.floor(1024 * Fraction(x)), 2**63 - 1), -(2**63)) for x in v] for i, v in LARGE}
    want = []
    for q in (0, 10, 20):
        scores = {c: max(min(sum(x * y for x, y in zip(whole[q], whole[c])), 2**63 - 1), -(2**63)) for c in whole if c != q}
        want += [(q, n, c, scores[c]) for n, c in enumerate(sorted(scores, key=lambda c: (-scores[c], c))[:4], 1)]
    tops = kdtree.exact_top_k(df, F.col("id") % 10 == 0, 4).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in tops] == want


def test_the_tree_leaves_boxes_out():
    rng = np.random.default_rng(4)
    v = (rng.normal(0, 1, (8_000, 4)) * 1024).astype(np.int64).astype(float)
    tree = kdtree.KdTree(np.arange(8_000), v, leaf=32)
    for q in v[:20]:
        want = sorted(((int(x @ q), -i) for i, x in enumerate(v)), reverse=True)[:10]
        assert sorted(tree.search(-1, q, 10, None), reverse=True) == want
    assert tree.scanned < 20 * 8_000 / 5
