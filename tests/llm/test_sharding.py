import random
import zlib

import pytest
from pyspark.sql import functions as F

from tablewire.llm import sharding


def minimax(sizes, n):
    """Least largest sum of at most n contiguous runs."""
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        middle, runs, own = (low + high) // 2, 1, 0
        for size in sizes:
            if own + size > middle:
                runs, own = runs + 1, 0
            own += size
        low, high = (low, middle) if runs <= n else (middle + 1, high)
    return low


def check(docs, rows, n):
    got = sharding.shard_documents(docs, n).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (k is None, k or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t, _ in rows
    )
    for shard in {r.shard for r in got}:
        assert 0 <= shard < n
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    return got


@pytest.mark.parametrize("seed,n,cells", [(1, 4, 4), (2, 7, 16), (3, 7, 16_384), (4, 40, 64), (5, 1, 4)])
def test_capacity_is_the_least(docs_of, seed, n, cells, monkeypatch):
    monkeypatch.setattr(sharding, "CELLS", cells)
    rng = random.Random(seed)
    rows = [(i, "x" * rng.randint(0, 60) + str(rng.randint(0, 300)), "a") for i in range(400)]
    docs = docs_of(rows)
    got = check(docs, rows, n)
    place = {r.doc_id: r.p for r in docs.select("doc_id", F.shiftrightunsigned(F.xxhash64("text"), 2).alias("p")).collect()}
    groups, shards = {}, {}
    for r in got:
        groups[place[r.doc_id]] = groups.get(place[r.doc_id], 0) + r.size
        assert shards.setdefault(place[r.doc_id], r.shard) == r.shard
    order = sorted(groups)
    assert [shards[p] for p in order] == sorted(shards.values())
    load = {}
    for r in got:
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert max(load.values()) == minimax([groups[p] for p in order], n)


def test_a_large_group_has_a_shard_of_its_own(docs_of):
    rows = [(i, "same text over and over", "a") for i in range(300)] + [(1000 + i, f"text number {i}", "a") for i in range(300)]
    got = check(docs_of(rows), rows, 5)
    own = {r.shard for r in got if r.doc_id < 1000}
    assert len(own) == 1 and not own & {r.shard for r in got if r.doc_id >= 1000}
    load = [sum(r.size for r in got if r.shard == s) for s in range(5) if s not in own]
    assert max(load) - min(load) < 200


def test_rows_of_every_kind(docs_of, odd_rows):
    check(docs_of(odd_rows), odd_rows, 4)
    check(docs_of(odd_rows), odd_rows, 40)
    check(docs_of([]), [], 40)
    check(docs_of([(None, None, None)] * 3), [(None, None, None)] * 3, 40)


def test_the_main_path_has_no_python(docs_of, odd_rows, plan):
    text = plan(sharding.shard_documents(docs_of(odd_rows), 4))
    assert "Python" not in text and "Arrow" not in text
