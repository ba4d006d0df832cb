"""Exact top-k search with a KD-tree per shard (operator 3).

Every shard of candidates becomes a tree by median splits along the widest side;
each node has the tight box of its vectors. The inner product of a query with
any vector of a box is at most the sum of the larger product at either side of the
box, so nodes are visited best bound first until no bound reaches the kth score;
a bound is computed when the parent of its box is opened, not before.
A query first searches the shard that its own id falls into; the kth score found
there goes with it to all other shards, which then need not better it from
nothing. Scores are integers and exact.

Defined cases: null vectors, vectors with null or non-finite components and rows
without an id take no part; vectors of different length end in zeros; of rows that
share an id the least vector takes part; ties go to the smaller id; fewer
candidates than k give all of them; components and scores beyond the range of a
long count as its nearest end; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewire.llm.shared import settle
from tablewire.llm.vectors import deal, everywhere, finite, matrix, meet, nothing, one_per_id, ranked

LEAF = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class KdTree:
    """Vectors in leaf order, and per node its range, its first child (the second follows it) and its box."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, longs: bool = False):
        self.longs = longs and vectors.dtype == object  #: scores beyond a long count as its nearest end
        order = np.arange(len(ids))
        self.begin, self.end, self.child, low, high = [0], [len(ids)], [], [], []
        for node, (begin, end) in enumerate(self._ranges()):
            own = vectors[order[begin:end]]
            low.append(own.min(0))
            high.append(own.max(0))
            self.child.append(-1)
            side = int(np.argmax(high[-1] - low[-1])) if own.shape[1] else 0
            if end - begin > leaf and high[-1][side] > low[-1][side]:
                middle = (begin + end) // 2
                order[begin:end] = order[begin:end][np.argpartition(own[:, side], middle - begin)]
                self.child[node] = len(self.begin)
                self.begin += [begin, middle]
                self.end += [middle, end]
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = np.array(low), np.array(high)
        self.scanned = 0  #: vectors whose products were computed, over all searches

    def _ranges(self) -> Iterator[tuple[int, int]]:
        """The range of every node, also of those that are added on the way."""
        node = 0
        while node < len(self.begin):
            yield self.begin[node], self.end[node]
            node += 1

    def _bounds(self, query: np.ndarray, begin: int, end: int) -> np.ndarray:
        return self._shown(np.maximum(self.low[begin:end] * query, self.high[begin:end] * query).sum(1))

    def _shown(self, numbers: np.ndarray) -> np.ndarray:
        return np.minimum(np.maximum(numbers, LEAST), MOST) if self.longs else numbers

    def search(self, query_id: int, query: np.ndarray, k: int, kth: int | None) -> list[tuple[int, int]]:
        """Up to ``k`` of (score, -id) that reach the score ``kth``, if one is given, as a heap."""
        best: list[tuple[int, int]] = []
        least = kth
        waiting = [(-self._bounds(query, 0, 1)[0], 0)]
        while waiting:
            top, node = heapq.heappop(waiting)
            if least is not None and -top < least:
                break  # no other node can reach the kth score
            first = self.child[node]
            if first >= 0:
                for child, bound in enumerate(self._bounds(query, first, first + 2), first):
                    if least is None or bound >= least:
                        heapq.heappush(waiting, (-bound, child))
                continue
            begin, end = self.begin[node], self.end[node]
            self.scanned += end - begin
            scores = self._shown(self.vectors[begin:end] @ query)
            hit = np.arange(len(scores)) if least is None else np.flatnonzero(scores >= least)
            for at in hit.tolist():
                found = (int(scores[at]), -int(self.ids[begin + at]))
                if -found[1] == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            if len(best) == k and (least is None or best[0][0] > least):
                least = best[0][0]
        return best


def _exact(queries: np.ndarray, vectors: np.ndarray) -> type:
    """A number type in which all inner products are exact."""
    largest = [int(max(abs(int(m.max())), abs(int(m.min())))) if m.size else 0 for m in (queries, vectors)]
    most = largest[0] * largest[1] * max(queries.shape[1], 1)  # a bound of a box is no larger
    return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object


def exact_top_k(df: DataFrame, query: Column, k: int, scale: int = 1024, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``query`` holds, on ``id``, its ``k`` best others.

    Components are floor(``scale`` x component); the score is their integer inner product.
    """
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))  # keeps within a long
    table = one_per_id(df.where(finite(F.col(vector))), key, whole, "whole-vectors")
    candidates, queries, shards, blocks = deal(table, query)

    def search(asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(shard):
            return nothing("int64")
        width = max(max(map(len, asked["vector"])), max(map(len, shard["vector"])))
        q, v = matrix(asked["vector"], width), matrix(shard["vector"], width)
        kind = _exact(q, v)
        tree = KdTree(shard["id"].to_numpy(), v.astype(kind), longs=True)
        kths = [None if pd.isna(x) else int(x) for x in asked["kth"]] if "kth" in asked else [None] * len(asked)
        rows = [
            (query_id, -other, score)
            for query_id, own, kth in zip(asked["id"].tolist(), q.astype(kind), kths, strict=True)
            for score, other in tree.search(query_id, own, k, kth)
        ]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]) if rows else nothing("int64")

    at_home = queries.select("id", "vector", F.col("home").alias("shard"))
    home = settle(meet(at_home, candidates, ["shard"], search, "long"), "home")
    kth = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    told = settle(queries.join(kth, F.col("id") == F.col("query_id"), "left").drop("query_id"), "told")
    away = everywhere(told, "shard", shards).where("shard <> home").drop("home")
    others = meet(away, everywhere(candidates, "block", blocks), ["shard", "block"], search, "long")
    return ranked(home.unionByName(others), k)
