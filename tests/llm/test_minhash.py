import random
import re

import numpy as np
import pytest

from tablewire.llm import minhash
from tablewire.llm.components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = WORD.findall(lower)
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def expected(rows):
    """n_shingles and component of every id, by comparing all pairs of sets."""
    sets = {}
    for key, text, _ in rows:
        sets[key] = shingles(text)
    keys, parent = sorted(sets), {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def check(docs_of, rows):
    got = minhash.near_duplicates(docs_of(rows, 4)).collect()
    want = expected([r for r in rows if r[0] is not None])
    assert {r.key: (r.n_shingles, r.component_id) for r in got if r.key is not None} == want
    assert all(r.kept == (r.key == r.component_id) for r in got if r.key is not None)
    return got


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def test_a_large_group_of_near_copies(docs_of, monkeypatch):
    monkeypatch.setattr(minhash, "TILE_OUT", 8)
    monkeypatch.setattr(minhash, "TILE_ALL", 16)
    rng = random.Random(1)
    base = [f"w{rng.randrange(2000)}" for _ in range(150)]
    rows = [(i, changed(rng, base, rng.randint(0, 9)), "a") for i in range(150)]
    rows += [(1000 + i, " ".join(f"z{rng.randrange(300)}" for _ in range(rng.randint(1, 60))), "b") for i in range(60)]
    rows += [(2000 + i, rows[i][1], "c") for i in range(0, 150, 3)]
    got = check(docs_of, rows)
    assert 2 < len({r.component_id for r in got if r.key < 1000}) < 150


def test_a_chain_is_one_component(docs_of):
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 100]), "a") for k in range(40)]
    got = check(docs_of, rows)
    assert {r.component_id for r in got} == {0}


def test_cliques_beside_the_centre(docs_of, monkeypatch):
    """The smallest node is linked with nothing, the others form two groups that it cannot find."""
    monkeypatch.setattr(minhash, "TILE_OUT", 4)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    apart = base[:]
    for k in range(0, 200, 40):
        apart[k] = f"other{k}"
    rows = [(0, changed(rng, base, 9), "a")]
    rows += [(10 + i, changed(rng, base, 1), "a") for i in range(12)] + [(40 + i, changed(rng, apart, 1), "a") for i in range(12)]
    check(docs_of, rows)


def test_rows_of_every_kind(docs_of, odd_rows):
    got = check(docs_of, odd_rows)
    nameless = {r.n_shingles: r for r in got if r.key is None}
    assert nameless[8].component_id == 1 and not nameless[8].kept  # an equal text has an id
    assert nameless[1].component_id is None and nameless[1].kept
    assert minhash.near_duplicates(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs_of([]), percent=50)


def test_signature_estimates_similarity():
    rings, rng = minhash._rings(), np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    errors = []
    for share in (0.3, 0.6, 0.85):
        for _ in range(20):
            both = rng.choice(pool, 1000, replace=False)
            n = int(1000 * share)
            rest = (1000 - n) // 2
            a, b = both[: n + rest], np.concatenate([both[:n], both[n + rest :]])
            equal = (minhash.signature(np.sort(a), rings) == minhash.signature(np.sort(b), rings)).mean()
            errors.append(equal - n / (n + rest + len(both) - n - rest))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 360)] + [(500, 500 + k) for k in range(1, 80)]
    parent = {n: n for e in edges for n in e}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {n for n in parent if n not in got}
    assert got == {n: find(n) for n in got}
    assert all(find(n) == n and not any(n in e and e[0] != e[1] for e in edges) for n in alone)


def test_pairs_between_80_and_85_percent(docs_of):
    rng = random.Random(12)
    rows = []
    for i in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(100 + 5 * i)]
        rows.append((i, " ".join(words), "a"))
        n = len(words) - 4
        # a new tail of t words changes t shingles on either side: 0.80 <= (n - t) / (n + t) < 0.85
        t = n // 9
        rows.append((100 + i, " ".join(words[:-t] + [f"tail{i}x{k}" for k in range(t)]), "a"))
    sets = {k: shingles(text) for k, text, _ in rows}
    assert all(0.80 <= len(sets[i] & sets[100 + i]) / len(sets[i] | sets[100 + i]) < 0.85 for i in range(30))
    at_80 = {r.key: r.component_id for r in minhash.near_duplicates(docs_of(rows), percent=80).collect()}
    assert at_80 == {k: k % 100 for k, _, _ in rows}
    at_85 = {r.key: r.component_id for r in minhash.near_duplicates(docs_of(rows), percent=85).collect()}
    assert at_85 == {k: k for k, _, _ in rows}


def test_layouts():
    assert minhash.layout_of(85) == minhash.layout_of(95) == (25, 125, 84)
    bands, size, agree = minhash.layout_of(80)
    assert (1 - 0.8**5) ** bands <= 5e-7 and size == 5 * bands and agree == 118


def test_repeated_rows_have_one_set(spark, docs_of):
    text = " ".join(f"w{k}" for k in range(60))
    docs = docs_of([(k % 2, text + (" more" if k % 2 else ""), "s") for k in range(20_000)], parts=4)
    wanted = spark.createDataFrame([(0,), (1,)], "node long")
    sets = minhash._sets_of(docs, wanted, 5, "text", "doc_id").collect()
    assert sorted((r["node"], len(r["shingles"]) // 8) for r in sets) == [(0, 56), (1, 57)]
    found = minhash.near_duplicates(docs).groupBy("key", "component_id").count().collect()
    assert sorted(map(tuple, found)) == [(0, 0, 10_000), (1, 0, 10_000)]
