"""Line dedup by distinct-site spread (operator 4).

A line that many distinct sites carry is boilerplate. Sites are counted per line
hash with HyperLogLog sketches that merge by partial aggregation, so a line that
every document holds is a small sketch before the shuffle. Where an estimate is
too close to the threshold to be sure, the sites of that line are counted
exactly. Boilerplate lines are taken out of every document but one: the smallest
id that holds the line keeps its first occurrence, so no content of the corpus
is lost, and the only copy of a line is never touched. A document that consists
of such lines by more than ``max_share`` of its words and whose text another id has
too is a copy rather than a carrier of boilerplate; it is left whole, to be judged
as a document. Where ``copies`` is given, it tells instead which of the documents
above ``max_share`` are copies. All others lose their repeated lines.

A line is what stands between line feeds; for comparison its white space is
trimmed and inner runs count as one space. Lines of fewer than ``min_words``
words are never boilerplate.

Defined cases: a null text stays null, an empty one empty; a null site counts as
no site; every row stays; of equal rows that hold a line first each keeps it; rows
whose id is null count for the spread, but their texts stay as they are; rows that
share an id but not a text are told apart by a hash of the text; an empty table
gives no rows; extra columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewire.llm.shared import free_prefix, settle

#: log2 of the registers of a sketch; its standard error is about 1.04 / sqrt(2**LOG_K).
LOG_K = 10
#: Standard errors around the threshold inside which sites are counted exactly.
MARGIN = 6


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"[\t-\r ]+", " "))


def line_table(docs: DataFrame, text: str, key: str, site: str, min_words: int) -> DataFrame:
    """``(key, version, place, site, line, words)`` for every line that can be boilerplate.

    ``line`` is a hash of the line, ``version`` one of the whole text.
    """
    lines = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(F.col(text)).alias("version"),
        F.col(site).cast("string").alias("site"),
        F.posexplode(F.split(F.col(text), "\n")).alias("place", "raw"),
    )
    clean = lines.select("key", "version", "site", "place", normal_line(F.col("raw")).alias("body"))
    words = F.length("body") - F.length(F.replace(F.col("body"), F.lit(" "), F.lit(""))) + 1
    return clean.where(words >= min_words).select("key", "version", "place", "site", F.xxhash64("body").alias("line"))


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """``(line, first, n_sites, exact)`` of the lines that ``min_sites`` sites or more carry.

    ``first`` is the smallest (id, place); ``n_sites`` is exact near the threshold and an estimate above.
    """
    error = MARGIN * 1.04 / (1 << LOG_K) ** 0.5
    spread = settle(
        lines.groupBy("line")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("estimate"),
            F.min(F.when(F.col("key").isNotNull(), F.struct("key", "place"))).alias("first"),
        )
        .where(F.col("estimate") >= min_sites * (1 - error)),
        "spread",
    )
    near = settle(spread.where(F.col("estimate") <= min_sites * (1 + error)).select("line"), "near")
    sites = lines.select("line", "site").join(near, "line").distinct()
    exact = settle(sites.groupBy("line").agg(F.count("site").alias("n")), "exact")
    return (
        spread.join(exact, "line", "left")
        .select("line", "first", F.coalesce("n", "estimate").alias("n_sites"), F.col("n").isNotNull().alias("exact"))
        .where(F.col("n_sites") >= min_sites)
    )


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = 8,
    max_share: float = 0.9,
    min_words: int = 4,
    text: str = "text",
    key: str = "doc_id",
    site: str = "source",
    copies: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text column.

    ``copies`` gets the documents above ``max_share`` as ``(candidate, key, text)`` and
    gives the ``candidate`` of those to be left whole; without it those are left whole
    whose text has another id too.
    """
    lines = settle(line_table(docs, text, key, site, min_words), "lines")
    shared = settle(boilerplate_lines(lines, min_sites).select("line", "first"), "boilerplate")
    again = F.struct("key", "place") != F.col("first")
    per_doc = (
        lines.where("key IS NOT NULL")
        .join(shared, "line")
        .groupBy(F.col("key").alias("_key"), F.col("version").alias("_version"))
        .agg(F.collect_set("place").alias("_shared"), F.collect_set(F.when(again, F.col("place"))).alias("_again"))
    )
    own = free_prefix(docs.columns)
    held = docs.withColumns({f"{own}held_key": F.col(key), f"{own}held_version": F.xxhash64(F.col(text))})
    marked = settle(per_doc.select(*[F.col(c).alias(own + c[1:]) for c in ("_key", "_version", "_shared", "_again")]), "marked")
    _key, _version, _shared, _again, _whole = (own + c for c in ("key", "version", "shared", "again", "whole"))
    holds = (F.col(f"{own}held_key") == F.col(_key)) & (F.col(f"{own}held_version") == F.col(_version))
    losing = marked.where(F.size(_again) > 0)
    if copies is None:
        ids = marked.groupBy(_version).agg(F.min(_key).alias("a"), F.max(_key).alias("b"))
        several = settle(ids.where("a < b").select(_version, F.lit(True).alias(_whole)), "several")
        drops = settle(losing.join(several, _version, "left").fillna(False, [_whole]), "drops")
    else:

        @F.pandas_udf("boolean")
        def above(texts: pd.Series, shared: pd.Series) -> pd.Series:
            return pd.Series([exceeds(t, s, max_share) for t, s in zip(texts, shared, strict=True)], dtype=bool)

        candidate = F.xxhash64(_key, _version).alias("candidate")
        mostly = held.join(marked, holds).select(candidate, F.col(_key).alias("key"), F.col(text).alias("text"), _shared)
        mostly = settle(mostly.where(above("text", _shared)).drop(_shared), "candidates")
        found = settle(copies(mostly).select("candidate").distinct(), "copies")
        drops = losing.withColumn("candidate", candidate).join(found.withColumn(_whole, F.lit(True)), "candidate", "left")
        drops = settle(drops.drop("candidate").fillna(False, [_whole]), "drops")

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, shared: pd.Series, again: pd.Series, whole: pd.Series) -> pd.Series:
        rows = zip(texts, shared, again, whole, strict=True)
        return pd.Series(
            [t if t is None or a is None or (w and exceeds(t, s, max_share)) else without(t, a) for t, s, a, w in rows],
            dtype=object,
        )

    joined = held.join(drops, holds, "left")
    kept = [cleaned(F.col(text), _shared, _again, _whole).alias(c) if c == text else held[f"`{c}`"] for c in docs.columns]
    return joined.select(*kept)


_WORD = re.compile(r"[^\t-\r ]+")


def exceeds(text: str, shared: list[int], max_share: float) -> bool:
    """Whether the lines ``shared`` hold more than ``max_share`` of the words."""
    words = [len(_WORD.findall(line)) for line in text.split("\n")]
    return sum(words[i] for i in shared) > max_share * sum(words)


def without(text: str, again: list[int]) -> str:
    gone = set(again)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
