"""Audit of how filters interact when they are applied one after another (operator 13).

Every filter has one table with the ids of the rows that fail it. What an order of
filters does at a step depends only on the set of filters before it, so there are
few cases: for ``k`` filters, ``k * 2**(k - 1)`` pairs of a filter and a set. For each
pair, the failing rows that are in the filter's table (left-semi) and in no table of the
set (left-anti) are those that the step removes. All pairs are held in one relation that
grows by one filter a round, so each round is one join whatever the number of sets. All
orders are read off its counts:

* kept: the rows of the part less all removals up to the step;
* redundant: rows of the filter's table that the set had removed already;
* unique_fails: removals after all other filters;
* good_lost, toxic_lost: labels of the removed rows;
* shapley: removals summed over all orders, each set weighted by its orderings.

Ids are numbers given to the rows when they are first written, narrow and unique,
whatever the keys are, so no join key is frequent, and removals are summed on the map
side. Copies are found by a digest of the text: the least key per digest
is a partial minimum, only digests with several keys are joined back, and both sides
of that join are tables, so that adaptive execution can split a frequent one.

Defined cases: a null text counts as empty, a null part as the empty one; a row with
a null key is nobody's copy and makes no copies; rows that share key and text are rows
of their own, none the copy of another; of several labels of a key any with the value 1
counts, and a key without labels loses none; an empty table gives no rows; columns other
than those named are not looked at.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewire.llm.shared import settle
from tablewire.scratch import shared_dir

_STEP = "array<struct<filter_order: string, step: int, filter: int, own: int, alone: int, codes: array<int>>>"


def word_filters(text: str = "text") -> dict[str, F.Column]:
    """Failure conditions on a text, A to D: few words, repeated words, capitals, odd characters."""
    body = F.col(text)
    words = F.regexp_extract_all(body, F.lit(r"[^\x20\x09-\x0D]+"), 0)
    capitals = F.length(F.regexp_replace(body, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals.cast("long") > 5 * F.length(body).cast("long"),
        "D": body.rlike("[#$%&*|]"),
    }


def failing_rows(
    docs: DataFrame, labels: DataFrame, filters: dict[str, F.Column], copies: str | None,
    part: str = "source", text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``: ``(row, part, good, toxic, failed)``; ``failed`` lists the filters that it fails.

    ``filters`` are conditions on a column ``text`` that has no nulls; ``copies`` names the
    filter that a text fails if a smaller key has the same one.
    """
    # each condition is computed once, in the pass that reads the texts
    texts = docs.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    failed = [F.when(condition, F.lit(name)) for name, condition in filters.items()]
    rows = settle(
        texts.select(
            F.monotonically_increasing_id().alias("row"), "id", "part",
            F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
            F.array_compact(F.array(*failed)).alias("failed"),
        ),
        "audit-rows",
    )
    marks = [F.max((F.col(name) == 1).cast("int")).alias(mark) for name, mark in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.select(F.col("doc_id").cast("long").alias("id"), "quality", "toxic").where("id IS NOT NULL")
    known = settle(known.groupBy("id").agg(*marks).where("good = 1 OR toxic = 1"), "audit-labels")
    rows = rows.join(known, "id", "left")
    if copies:
        several = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        several = settle(several.where("least < most").select("digest", "least"), "audit-copies")
        rows = rows.join(several, "digest", "left")
        again = F.when(F.col("id") > F.col("least"), F.array(F.lit(copies))).otherwise(F.array().cast("array<string>"))
        rows = rows.withColumn("failed", F.concat("failed", again))
    good, toxic = (F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("good", "toxic"))
    return settle(rows.select("row", "part", good, toxic, "failed"), "audit-marked")


def _together(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole


def interactions(marked: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of ``names`` and step, with the counts of that step; parts of ``marked`` without failures too."""
    spark, k = marked.sparkSession, len(names)
    folder = shared_dir(spark, "audit-ids")
    marked.select("row", F.explode("failed").alias("filter")).write.partitionBy("filter").parquet(folder)
    stored = spark.read.schema("row long, filter string").parquet(folder)
    ids = [stored.where(F.col("filter") == name).select("row") for name in names]
    failing = marked.where(F.size("failed") > 0).select("row", "part", "good", "toxic")

    def code(own: int, before) -> int:
        return own << k | sum(1 << b for b in before)

    # (row, filter, set): the rows of the filter's table that the set leaves; sets grow by one filter a round
    own = [failing.join(ids[f], "row", "left_semi").withColumn("code", F.lit(code(f, []))) for f in range(k)]
    left = [settle(_together(own), "audit-left")]
    for f in range(k):
        longer = _together(left).where(F.shiftright("code", k) != f).join(ids[f], "row", "left_anti")
        left.append(settle(longer.withColumn("code", F.col("code").bitwiseOR(1 << f)), "audit-left"))
    cells = _together(left).groupBy("part", "code").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    weights = F.array(*[F.lit(factorial(size) * factorial(k - 1 - size)) for size in range(k)])
    orders = F.get(weights, F.bit_count(F.col("code").bitwiseAND((1 << k) - 1)))
    cells = cells.withColumn("orders", orders).withColumn("own", F.shiftright("code", k))
    # a handful of rows a part: one per pair of a filter and a set
    shares = [F.coalesce(F.sum(F.when(F.col("own") == own, F.col("n") * F.col("orders"))), F.lit(0).cast("long")) for own in range(k)]
    by_part = cells.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("code", F.struct("n", "good", "toxic")))).alias("cells"),
        F.array(*shares).alias("shares"),
    )
    totals = marked.groupBy("part").agg(F.count("*").alias("total"))

    steps = []
    for order in permutations(range(k)):
        codes = [code(own, order[:at]) for at, own in enumerate(order)]
        label = "".join(names[own] for own in order)
        for at, own in enumerate(order):
            others = [o for o in range(k) if o != own]
            steps.append([label, at + 1, own, code(own, []), code(own, others), codes[: at + 1]])
    table = [dict(zip(("filter_order", "step", "filter", "own", "alone", "codes"), s, strict=True)) for s in steps]

    def of(cell, field: str) -> F.Column:
        return F.coalesce(F.try_element_at("cells", cell)[field], F.lit(0).cast("long"))

    s = F.col("s")
    here = F.element_at(s["codes"], -1)
    return (
        totals.join(by_part, "part", "left")
        .withColumn("s", F.explode(F.from_json(F.lit(json.dumps(table)), _STEP)))
        .select(
            "part",
            s["filter_order"].alias("filter_order"),
            s["step"].alias("step"),
            F.aggregate(s["codes"], F.col("total"), lambda left, c: left - of(c, "n")).alias("kept"),
            of(here, "n").alias("removed"),
            (of(s["own"], "n") - of(here, "n")).alias("redundant"),
            of(s["alone"], "n").alias("unique_fails"),
            of(here, "good").alias("good_lost"),
            of(here, "toxic").alias("toxic_lost"),
            F.coalesce(F.get("shares", s["filter"]), F.lit(0).cast("long")).alias("shapley"),
        )
    )


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, F.Column], copies: str | None = None, **names: str) -> DataFrame:
    """The interactions of ``filters`` over ``docs``, by part; see the module's text."""
    marked = failing_rows(docs, labels, filters, copies, **names)
    return interactions(marked, sorted([*filters, *([copies] if copies else [])]))
