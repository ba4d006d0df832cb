"""Sharding: minimax contiguous partition of documents into size-balanced shards (operator 10).

Equal texts form one atomic group. Groups are ordered by a hash of their text,
and a shard is a contiguous run of that order, so a document finds its shard by
comparing its own hash with at most ``n_shards - 1`` cuts: no join and no
exchange of texts. The smallest capacity for which a greedy filling needs no
more than ``n_shards`` runs is found by binary search.

The greedy check needs sums over ranges of the order only. They come from an
aggregate over equal cells of the hash range; where a run may end inside of a cell
of several groups the answer has a lower and an upper bound, and only the cells
between the two are cut finer by the next aggregate. Each round returns at most
``CELLS`` rows whatever the input. The search ends when the smallest capacity
is known exactly, and every cut is the end of a group.

Defined cases: a null text counts as empty (size is the fixed part); equal rows
stay together and take different slots; an empty table gives no rows; fewer
groups than shards leave shards empty; a group larger than an equal share gets
a shard of its own and the others are balanced over the rest.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewire.llm.shared import settle

#: Rows that one round of sums may return to the driver.
CELLS = 16_384
#: Ranges that one round looks at.
RANGES = 64
#: Windows of a shard in which slots are counted.
SLOT_GROUPS = 64
_RANGE = 1 << 62


def shard_documents(
    docs: DataFrame, n_shards: int = 40, text: str = "text", key: str = "doc_id", fixed_bytes: int = 16
) -> DataFrame:
    """``(key, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    Shards hold nearly equal bytes (``law`` is ``bytes``); slots of a shard run
    from 0 without gaps. Columns of ``docs`` other than the two named are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = settle(
        docs.select(
            F.col(key).alias("id"),
            (F.octet_length(body) + F.lit(fixed_bytes)).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("crc"),
            F.shiftrightunsigned(F.xxhash64(body), 2).alias("place"),
        ),
        "shard-sizes",
    )
    shard = shard_of(narrow, n_shards)
    dealt = narrow.withColumn("shard", shard).withColumn(
        "sub", F.pmod(F.xxhash64("id", "crc"), F.lit(SLOT_GROUPS)).cast("int")
    )
    counts = dealt.groupBy("shard", "sub").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    # n_shards x SLOT_GROUPS rows at most
    first = F.broadcast(counts.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    own = Window.partitionBy("shard", "sub").orderBy("id", "place")
    return dealt.join(first, ["shard", "sub"]).select(
        F.col("id").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.row_number().over(own) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_of(sizes: DataFrame, n_shards: int) -> Column:
    """The shard of a row of ``sizes`` (``place``, ``size``) as an expression on ``place``."""
    cells = _sums(sizes, [(0, _RANGE)], CELLS)
    alone: list[tuple] = []
    while True:  # groups above an equal share leave, largest share first; fewer than n_shards can
        room = n_shards - len(alone)
        rest = [c for c in cells if c not in alone]
        total = sum(c[2] for c in rest)
        heavy = [c for c in rest if room > 1 and c[2] * room > total]
        if not heavy:
            break
        coarse = [c for c in heavy if c[0] != c[1]]
        if coarse:
            cells = _finer(sizes, cells, coarse)
        else:
            alone.append(max(heavy, key=lambda c: c[2]))
    cells = [c for c in cells if c not in alone]
    while True:
        low, high, cuts, coarse = _capacity(cells, n_shards - len(alone))
        if high - low <= 1:
            break
        cells = _finer(sizes, cells, coarse)
    place = F.col("place")
    shard = F.lit(len(alone))
    for last in cuts:
        shard = shard + F.when(place > F.lit(last), 1).otherwise(0)
    for number, cell in enumerate(alone):
        shard = F.when(place == F.lit(cell[0]), number).otherwise(shard)
    return shard.cast("int")


def _capacity(cells: list[tuple], n_shards: int) -> tuple[int, int, list[int], list[tuple]]:
    """Bounds of the smallest capacity, the cuts at the upper one, and the cells that keep them apart.

    The first bound is infeasible for certain, the second feasible for certain.
    A cut is the last place of a shard.
    """
    ends = list(accumulate(c[2] for c in cells))
    total = ends[-1] if ends else 0

    def reach(capacity: int, upper: bool) -> list[int]:
        """Ends of the runs of a greedy filling: never beyond, or never before, the true ones."""
        at, runs = 0, []
        for _ in range(n_shards):
            full = bisect_right(ends, at + capacity)
            end = ends[full - 1] if full else 0
            if upper and full < len(cells) and cells[full][0] != cells[full][1]:
                end = at + capacity  # some group inside the next cell may end here
            at = max(at, min(end, total))
            runs.append(at)
        return runs

    def smallest(upper: bool) -> int:
        low, high = -1, total
        while high - low > 1:
            middle = (low + high) // 2
            if reach(middle, upper)[-1] >= total:
                high = middle
            else:
                low = middle
        return high

    high, low = smallest(False), smallest(True) - 1
    runs = reach(high, False)
    cuts = [cells[bisect_right(ends, end) - 1][1] for end in runs[:-1] if 0 < end < total]
    if high - low <= 1:
        return low, high, cuts, []
    coarse = []
    windows = list(zip(reach(low, False), reach(high, True), strict=True))
    for cell, end in zip(cells, ends, strict=True):
        if cell[0] != cell[1] and any(end >= a and end - cell[2] <= b for a, b in windows):
            coarse.append(cell)
    return low, high, cuts, coarse


def _finer(sizes: DataFrame, cells: list[tuple], coarse: list[tuple]) -> list[tuple]:
    """``cells`` with the coarse ones, and what lies between close ones, cut into smaller ranges."""
    chosen = {c[0] for c in coarse}
    at = [i for i, c in enumerate(cells) if c[0] in chosen]
    gaps = sorted((b - a, i) for i, (a, b) in enumerate(zip(at, at[1:], strict=False)))
    split = {i for gap, i in gaps[-(RANGES - 1) :] if gap > 1}
    runs, first = [], 0
    for i in range(len(at)):
        if i in split or i == len(at) - 1:
            runs.append((at[first], at[i]))
            first = i + 1
    inside = {i for a, b in runs for i in range(a, b + 1)}
    kept = [c for i, c in enumerate(cells) if i not in inside]
    widest = max(b - a + 1 for a, b in runs)  # every cell becomes several
    return sorted(kept + _sums(sizes, [(cells[a][0], cells[b][1] + 1) for a, b in runs], max(8 * widest, CELLS // len(runs))))


def _sums(sizes: DataFrame, ranges: list[tuple[int, int]], parts: int) -> list[tuple]:
    """``(first place, last place, bytes)`` of the non-empty cells of some ranges, each cut in ``parts``."""
    place, cell = F.col("place"), F.lit(None).cast("long")
    for number, (start, stop) in enumerate(ranges):
        step = -(-(stop - start) // parts)
        own = F.expr(f"{number * parts}L + (place - {start}L) div {step}L")
        cell = F.when((place >= F.lit(start)) & (place < F.lit(stop)), own).otherwise(cell)
    found = (
        sizes.withColumn("cell", cell)
        .where("cell IS NOT NULL")
        .groupBy("cell")
        .agg(F.min("place").alias("a"), F.max("place").alias("b"), F.sum("size").alias("bytes"))
        .collect()
    )
    return sorted((r["a"], r["b"], r["bytes"]) for r in found)
