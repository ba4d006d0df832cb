"""Vectors dealt out in blocks: every query block meets every shard of candidates once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewire.llm.shared import settle, tasks_for

#: Rows of a shard at least and at most, and of a query block at most.
SHARD_LEAST, SHARD_MOST, BLOCK = 512, 65_536, 2_048
FOUND = "query_id long, vec_id long, score {score}"


def finite(vector: Column) -> Column:
    """True where the vector and all its components are numbers."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )


def one_per_id(df: DataFrame, key: str, vector: Column, purpose: str) -> DataFrame:
    """``(id, vector)`` of the rows with an id; of rows that share it the least vector."""
    rows = df.select(F.col(key).cast("long").alias("id"), vector.alias("vector")).where("id IS NOT NULL")
    return settle(rows.groupBy("id").agg(F.min("vector").alias("vector")), purpose)


def deal(table: DataFrame, query: Column) -> tuple[DataFrame, DataFrame, int, int]:
    """Candidates with ``shard``, queries with ``home`` and ``block``, and the numbers of shards and blocks.

    Shards follow the tasks at hand within fixed bounds; results do not depend on them.
    """
    n = table.agg(F.count("*").alias("all"), F.count_if(query).alias("queries")).first()
    shards = max(1, -(-n["all"] // SHARD_MOST), min(tasks_for(table.sparkSession), -(-n["all"] // SHARD_LEAST)))
    blocks = max(1, -(-n["queries"] // BLOCK))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(blocks)).cast("int")
    candidates = table.select("id", "vector", shard.alias("shard"))
    queries = table.where(query).select("id", "vector", shard.alias("home"), block.alias("block"))
    return candidates, queries, shards, blocks


def everywhere(frame: DataFrame, column: str, n: int) -> DataFrame:
    """A copy of each row for every number below ``n``."""
    return frame.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def meet(queries: DataFrame, candidates: DataFrame, keys: list[str], search: Callable, score: str) -> DataFrame:
    """``search(queries, candidates)`` of each pair of blocks; results are ``(query_id, vec_id, score)``."""
    return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(search, FOUND.format(score=score))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def matrix(column: pd.Series, width: int = 0) -> np.ndarray:
    """The vectors as rows; shorter ones end in zeros, which changes no inner product."""
    width = max([width, *map(len, column)])
    out = np.zeros((len(column), width), column.iloc[0].dtype if len(column) else np.float64)
    for row, vector in zip(out, column, strict=True):
        row[: len(vector)] = vector
    return out


def nothing(score: str) -> pd.DataFrame:
    return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, score)})
