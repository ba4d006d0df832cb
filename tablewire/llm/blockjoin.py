"""Approximate nearest neighbours by a block matrix join (operator 5).

Vectors are quantised to 8-bit integers with a scale of their own. Every query
block meets every shard of candidates; a product of integer tiles gives all inner
products up to an error that the quantisation residues bound. A pair survives
where the upper end of its interval reaches the query's kth lower end so far. Survivors
are computed again from the original components in double precision and go to the
query's heap; the heaps of all shards are merged. The bound is strict, so the
result is exact: recall is 1 up to rounding in the last place.

Products are summed component after component, so that equal vectors have equal
scores wherever they are.

Defined cases: null or zero vectors, vectors with null or non-finite components
and rows without an id take no part; vectors of different length end in zeros; of
rows that share an id the least vector takes part; ties go to the smaller id; fewer
candidates than k give all of them; a product beyond the range of a double is an
infinity, one whose parts alone go beyond it is computed from scaled rows; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewire.llm.vectors import deal, everywhere, finite, matrix, meet, nothing, one_per_id, ranked

#: Queries and candidates of one tile.
TILE_QUERIES, TILE_CANDIDATES = 256, 4_096
#: Pairs that are computed again at a time.
PAIRS = 1 << 16


class Quantised:
    """Rows as whole numbers from -127 to 127 times a scale, with the length of the row and of what is lost."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        # powers of two change no digit and keep the squares of very large components within a double
        self.power = np.maximum(np.frexp(np.abs(rows).max(1, initial=0.0))[1] - 1, 0)
        rows = np.ldexp(rows, -self.power[:, None])
        top = np.abs(rows).max(1, initial=0.0)
        self.scale = np.where(top > 0, top / 127, 1.0)
        whole = np.rint(rows / self.scale[:, None])
        near = whole * self.scale[:, None]
        # 127 * 127 * 1,040 < 2**24: a float32 product of such numbers is exact up to 1,040 components
        self.whole = whole.astype(np.float32 if rows.shape[1] <= 1_040 else np.float64)
        self.near = np.sqrt((near**2).sum(1))
        self.lost = np.sqrt(((rows - near) ** 2).sum(1))
        self.length = np.sqrt((rows**2).sum(1))

    def part(self, begin: int, end: int) -> Quantised:
        out = object.__new__(Quantised)
        for name in ("rows", "power", "scale", "whole", "near", "lost", "length"):
            setattr(out, name, getattr(self, name)[begin:end])
        return out


def tile(queries: Quantised, candidates: Quantised) -> tuple[np.ndarray, np.ndarray]:
    """Approximate inner products, and how far each can be off; no numbers where they go beyond a double."""
    about = (queries.whole @ candidates.whole.T) * np.outer(queries.scale, candidates.scale)
    off = np.outer(queries.near, candidates.lost) + np.outer(queries.lost, candidates.length)
    off = off * (1 + 1e-9) + 1e-12 * np.outer(queries.length, candidates.length)
    if queries.power.any() or candidates.power.any():
        power = np.add.outer(queries.power, candidates.power)
        with np.errstate(over="ignore", invalid="ignore"):
            about, off = np.ldexp(about, power), np.ldexp(off, power)
            beyond = ~np.isfinite(np.abs(about) + off)
        about[beyond] = off[beyond] = np.nan
    return about, off


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component after component."""
    out = np.zeros(len(left))
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(left.shape[1]):
            out += left[:, k] * right[:, k]
        beyond = np.flatnonzero(~np.isfinite(out))
        if len(beyond):
            powers = [np.frexp(np.abs(rows[beyond]).max(1))[1] for rows in (left, right)]
            scaled = [np.ldexp(rows[beyond], -power[:, None]) for rows, power in zip((left, right), powers, strict=True)]
            out[beyond] = np.ldexp(products(*scaled), powers[0] + powers[1])
    return out


def nearest(df: DataFrame, query: Column, k: int, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``query`` holds, on ``id``, its ``k`` nearest others."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = finite(F.col(vector)) & F.exists(F.col(vector), lambda x: x != 0)
    table = one_per_id(df.where(usable), key, doubles, "vectors")
    candidates, queries, shards, blocks = deal(table, query)

    def search(asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(shard):
            return nothing("float64")
        width = max(max(map(len, asked["vector"])), max(map(len, shard["vector"])))
        q, c = Quantised(matrix(asked["vector"], width)), Quantised(matrix(shard["vector"], width))
        query_ids, ids = asked["id"].to_numpy(), shard["id"].to_numpy()
        rows = []
        for a in range(0, len(query_ids), TILE_QUERIES):
            own = q.part(a, a + TILE_QUERIES)
            names = query_ids[a : a + TILE_QUERIES]
            heaps: list[list[tuple[float, int]]] = [[] for _ in names]
            for b in range(0, len(ids), TILE_CANDIDATES):
                _visit(own, names, c.part(b, b + TILE_CANDIDATES), ids[b : b + TILE_CANDIDATES], heaps, k)
            rows += [(int(n), -other, score) for n, heap in zip(names, heaps, strict=True) for score, other in heap]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]) if rows else nothing("float64")

    spread = everywhere(queries.drop("home"), "shard", shards)
    found = meet(spread, everywhere(candidates, "block", blocks), ["shard", "block"], search, "double")
    return ranked(found, k)


def _visit(own: Quantised, names: np.ndarray, other: Quantised, ids: np.ndarray, heaps: list, k: int) -> None:
    """One tile: survivors of the bounds are computed exactly and offered to the queries' heaps."""
    about, off = tile(own, other)
    itself = names[:, None] == ids[None, :]
    lower, upper = np.where(itself | np.isnan(about), -np.inf, about - off), about + off
    least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    if lower.shape[1] >= k:
        least = np.maximum(least, np.partition(lower, -k, axis=1)[:, -k])
    rows, columns = np.nonzero(~(upper < least[:, None]) & ~itself)  # a bound that is no number excludes nothing
    for at in range(0, len(rows), PAIRS):
        i, j = rows[at : at + PAIRS], columns[at : at + PAIRS]
        for n, score, name in zip(i.tolist(), products(own.rows[i], other.rows[j]).tolist(), ids[j].tolist(), strict=True):
            heap, found = heaps[n], (score, -name)
            if len(heap) < k:
                heapq.heappush(heap, found)
            elif found > heap[0]:
                heapq.heapreplace(heap, found)
