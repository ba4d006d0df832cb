"""Best-fit packing with dominance reduction (operator 1).

Texts become pieces of at most ``capacity`` tokens. Which sequences there are
depends on the piece lengths alone, so the plan is made from the histogram of
lengths (``capacity`` rows whatever the input):

* Reduction after Martello and Toth: for the longest piece left, a set of at
  most three pieces is fixed as a sequence where it provably dominates every
  other set that could hold that piece. A fixed set is repeated while its
  lengths last, so each step uses up a length.
* The rest is packed best-fit, longest first, a whole length at a time: equal
  open sequences form one run.

The plan maps (length, rank among the pieces of this length) to a place. Ranks
are counted in salted groups, so that a length that a third of all pieces share
is not one task. The plan has at most a few runs per length and distinct lengths
per run, so its size is bounded by ``capacity`` alone, and it is broadcast.

Defined cases: a null text counts as empty, and an empty text is its end token
alone; equal rows are packed each; an empty table gives no rows; a piece of full
capacity is a sequence of its own; null ids are packed like others.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewire.llm.shared import arrow_batch, arrow_type, bounded_slices, settle
from tablewire.llm.tokens import word_tokenizer

#: Groups in which the ranks of one length are counted.
RANK_GROUPS = 64
PIECE = "key long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = 2048,
    text: str = "text",
    key: str = "doc_id",
    keep_ids: bool = False,
) -> DataFrame:
    """The texts as pieces of at most ``capacity`` tokens: ``(key, piece, start, length, ids_crc32[, ids])``."""
    out = PIECE + (", ids binary" if keep_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, encoder = arrow_type(out), word_tokenizer(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in bounded_slices(batch, "text"):
                rows = []
                ids, places = encoder.encode(part.column("text"))
                whole, places = ids.astype("<u4").tobytes(), places.tolist()
                for row_key, a, b in zip(part.column("key").to_pylist(), places, places[1:], strict=False):
                    ids = whole[4 * a : 4 * b] + end
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append((row_key, number, at // 4, len(own) // 4, zlib.crc32(own), own)[: len(schema)])
                yield arrow_batch(rows, schema)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(cut, out)


def pack_pieces(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("key", "piece", "ids_crc32")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` must be a settled table with ``length`` in 1..capacity."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(RANK_GROUPS)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = _Plan.of(pack_histogram(histogram, capacity))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "salt").orderBy(*order)
    ranked = (
        salted.withColumn("rank", F.row_number().over(own) - 1)
        .join(first, ["length", "salt"])
        .withColumn("rank", F.col("first") + F.col("rank"))
        .drop("first", "salt")
    )
    shared = pieces.sparkSession.sparkContext.broadcast(plan.arrays)
    out = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = _Plan(shared.value)
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = plan.places(length, rank)
            kept = [batch.column(n) for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=out.names
            )

    return ranked.mapInArrow(place, out)


def sequences(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """``(sequence_id, n_tokens, ids)`` from packed pieces that carry ``ids``; a group has ``capacity`` tokens at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


class _Plan:
    """Runs of places: (length, first rank, first sequence, pieces per sequence, offset)."""

    def __init__(self, arrays: tuple[np.ndarray, ...]):
        self.arrays = arrays

    @classmethod
    def of(cls, runs: list[tuple[int, int, int, int, int]]) -> _Plan:
        table = np.array(sorted(runs), np.int64).reshape(-1, 5)
        return cls(tuple(table[:, k].copy() for k in range(5)))

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths, ranks, sequence, per, offset = self.arrays
        low = np.searchsorted(lengths, length, "left")
        high = np.searchsorted(lengths, length, "right")
        while True:  # the last run of the length that begins at the rank or before
            wide = high - low > 1
            if not wide.any():
                break
            middle = np.where(wide, (low + high) // 2, low)
            left = ranks[middle] <= rank
            low = np.where(wide & left, middle, low)
            high = np.where(wide & ~left, middle, high)
        step = rank - ranks[low]
        return sequence[low] + step // per[low], offset[low] + step % per[low] * length


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs of places for ``histogram[length]`` pieces of every length."""
    if any(not 0 < size <= capacity for size in histogram):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    counts = {s: n for s, n in histogram.items() if n}
    runs, taken, sequence = [], dict.fromkeys(counts, 0), 0

    def put(size: int, pieces: int, first: int, per: int, offset: int) -> None:
        runs.append((size, taken[size], first, per, offset))
        taken[size] += pieces

    for chosen, times in _dominating_sets(counts, capacity):
        offset = 0
        for size in sorted(set(chosen), reverse=True):
            per = chosen.count(size)
            put(size, per * times, sequence, per, offset)
            offset += per * size
        sequence += times
    open_runs: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (first sequence, sequences)
    free: list[int] = []

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_runs:
                open_runs[room] = []
                insort(free, room)
            open_runs[room].append((first, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            tightest = bisect_left(free, size)
            if tightest == len(free):
                n = -(-left // (capacity // size))
                leave(capacity, sequence, n)
                sequence += n
                continue
            room = free[tightest]
            first, n = open_runs[room].pop()
            if not open_runs[room]:
                del open_runs[room]
                free.pop(tightest)
            per = room // size
            full = min(n, left // per)
            if full:
                put(size, full * per, first, per, capacity - room)
                leave(room - per * size, first, full)
                left -= full * per
            elif left:
                put(size, left, first, left, capacity - room)
                leave(room - left * size, first, 1)
                full, left = 1, 0
            leave(room, first + full, n - full)
    return runs


def _dominating_sets(counts: dict[int, int], capacity: int) -> Iterator[tuple[list[int], int]]:
    """Sets to fix, with how often; takes their pieces out of ``counts``."""
    sizes = sorted(counts)
    for longest in sorted(counts, reverse=True):
        while counts.get(longest):
            chosen = _dominating_set(longest, sizes, counts, capacity)
            if not chosen:
                break
            times = min(counts[s] // chosen.count(s) for s in chosen)
            for size in chosen:
                counts[size] -= times
                if not counts[size]:
                    del counts[size]
                    sizes.remove(size)
            yield chosen, times


def _dominating_set(longest: int, sizes: list[int], counts: dict[int, int], capacity: int) -> list[int] | None:
    """A set with ``longest`` that no other set with it can beat, or None if none of up to three is known to."""
    room = capacity - longest

    def others(size: int) -> int:
        return counts[size] - (size == longest)

    fitting = [s for s in sizes[: bisect_right(sizes, room)] if others(s)]
    if not fitting:
        return [longest]
    best = fitting[-1]
    if best == room:
        return [longest, best]
    small: list[int] = []
    for size in fitting:
        small += [size] * min(3 - len(small), others(size))
        if len(small) == 3:
            break
    if len(small) < 2 or sum(small[:2]) > room:
        return [longest, best]  # no set has two more pieces
    if len(small) == 3 and sum(small) <= room:
        return None  # sets with three more pieces: not decided
    pair, low, high = (0, 0), 0, len(fitting) - 1
    while low <= high:
        if fitting[low] + fitting[high] > room or (low == high and others(fitting[low]) < 2):
            high -= 1
        else:
            pair = max(pair, (fitting[low] + fitting[high], fitting[high]))
            low += 1
    total, large = pair
    if best >= total:
        return [longest, best]
    if best == large:
        above: list[int] = []  # the two smallest pieces above the lesser of the pair
        for size in fitting[bisect_right(fitting, total - large) :]:
            above += [size] * min(2 - len(above), others(size))
            if len(above) == 2:
                break
        if len(above) < 2 or sum(above) > room:
            return [longest, large, total - large]
    return None


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """All texts of ``docs`` cut into pieces and packed."""
    return pack_pieces(settle(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
