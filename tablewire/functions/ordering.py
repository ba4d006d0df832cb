"""Ordered work inside a key without putting a whole key into one task.

A key (one session, one conversation, one request) may hold a large share of
all rows.  ``Window.partitionBy(key)`` would then run that share in one task.
The helpers here cut a key into *slices* of consecutive positions, solve each
slice on its own and carry only one small row per slice to the next level, so
no window runs over the rows of a whole key.  The input is read twice: once
narrow, for the totals of the slices, and once for the result.

``LEVELS`` is how often this is repeated on the slice rows themselves.  With one
level the rows of a key meet in one task as one row per ``SLICE_ROWS`` of them,
20 million rows for a key of 300 billion.

Positions are integers, unique and nearly dense within a key (arrival numbers,
turn numbers, line numbers). Rows that share a position are ordered by ``then_by``.

One rule for all ordered operators: a row without a key or a position has no place
in an order. Filters (``until_finished``) keep such rows; operators that join rows in
order cannot use them, and give way to three functions that make them visible:
``unplaced`` returns them with the error ``place``, ``place_counts`` counts them, and
``watched`` counts them while a job runs. They never meet in one group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

SLICE_ROWS = 16_384
LEVELS = 1
# Slices that become one output row (a text, an audio, a list) are smaller.
PART_ROWS = 1024
# The error of rows that have no place in an order.
PLACE = "place"


def placed(df: DataFrame, *columns: str) -> DataFrame:
    """The rows that have a place: key and position are there."""
    return df.dropna(subset=list(columns))


def unplaced(df: DataFrame, *columns: str) -> DataFrame:
    """The rows that have no place, for the quarantine: with ``error`` set to ``place``.

    A plain filter on columns that are read anyway: no exchange, and file statistics
    skip what has no nulls.
    """
    return df.where(_lacks(columns)).withColumn("error", F.lit(PLACE))


def _lacks(columns: Sequence[str]) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return missing


def place_counts(df: DataFrame, key: str, position: str) -> DataFrame:
    """``(missing, n)``: rows without a key, without a position, without both, and (null) placed ones.

    Four partial sums a task, whatever the number of rows without a key.
    """
    no_key, no_position = F.col(key).isNull(), F.col(position).isNull()
    missing = F.when(no_key & no_position, "both").when(no_key, "key").when(no_position, "position")
    return df.groupBy(missing.alias("missing")).agg(F.count(F.lit(1)).alias("n"))


def watched(df: DataFrame, observation: Observation, *columns: str) -> DataFrame:
    """``df``; ``observation`` has ``n_rows`` and ``n_unplaced`` once a job has read it.

    An operator that reads its input twice counts the first time.
    """
    lacks = F.count_if(_lacks(columns))
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows"), lacks.alias("n_unplaced"))


def slice_of(position: Column | str, rows: int = SLICE_ROWS) -> Column:
    """Number of the slice that holds ``position``: floor(position / rows)."""
    pos = F.col(position) if isinstance(position, str) else position
    return F.call_function("div", pos - F.pmod(pos, F.lit(rows)), F.lit(rows)).cast("long")


def with_first(
    df: DataFrame, keys: Sequence[str], position: str, chosen: Column, name: str, rows: int = SLICE_ROWS
) -> DataFrame:
    """Add ``name``: the smallest position of a row of the same key where ``chosen`` holds, else null.

    A partial minimum per slice, a window over one row per slice, and a join back by
    key and slice: rows are neither sorted within a key nor counted.  The slice
    number is kept as ``SLICE_COLUMN``.
    """
    keys = list(keys)
    sliced = placed(df, *keys, position).withColumn(SLICE_COLUMN, slice_of(position, rows))
    own = sliced.groupBy(*keys, SLICE_COLUMN).agg(F.min(F.when(chosen, F.col(position))).alias("_first_here"))
    least = own.select(*keys, SLICE_COLUMN, F.min("_first_here").over(Window.partitionBy(*keys)).alias(name))
    return sliced.join(least, [*keys, SLICE_COLUMN], "left").select(*df.columns, SLICE_COLUMN, name)


def _slice_name(level: int) -> str:
    return f"_slice_{level}"


# The slice column that ``running_before`` leaves behind.
SLICE_COLUMN = _slice_name(LEVELS)


def parts_within_slices(part_rows: int, slice_rows: int) -> None:
    """Parts can be made without another exchange if no part lies in two slices."""
    if slice_rows % part_rows:
        raise ValueError("the slice length must be a multiple of the part length")


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    measures: Mapping[str, Column],
    rows: int = SLICE_ROWS,
    levels: int = LEVELS,
    then_by: Sequence[str] = (),
) -> DataFrame:
    """Add, per measure, its sum over the rows of the same key strictly before.

    ``then_by`` orders rows that share a position, such as lines of one chunk.

    The result is hash-partitioned by ``keys`` plus the slice column, which is
    kept under the name ``_slice_<levels>``: an aggregation by keys, slice and
    anything else needs no further exchange.
    """
    keys = list(keys)
    names = list(measures)
    rows_in = {n: f"_in_{n}" for n in names}
    prepared = placed(df, *keys, position).select("*", *[measures[n].cast("long").alias(rows_in[n]) for n in names])
    out = _running_before(prepared, keys, position, list(then_by), rows_in, rows, levels)
    return out.drop(*rows_in.values())


def _running_before(df, keys, position, then_by, inputs, rows, level):
    earlier = Window.partitionBy(*keys).orderBy(position, *then_by).rowsBetween(
        Window.unboundedPreceding, -1
    )
    if level == 0:
        return df.select(
            "*",
            *[F.coalesce(F.sum(i).over(earlier), F.lit(0)).alias(n) for n, i in inputs.items()],
        )
    part = _slice_name(level)
    sliced = df.withColumn(part, slice_of(position, rows))
    totals = sliced.groupBy(*keys, part).agg(
        *[F.sum(i).alias(i) for i in inputs.values()]
    )
    carried = {n: f"_carried_{level}_{n}" for n in inputs}
    base = _running_before(
        totals, keys, part, [], {carried[n]: i for n, i in inputs.items()}, rows, level - 1
    ).select(*keys, part, *carried.values())
    within = Window.partitionBy(*keys, part).orderBy(position, *then_by).rowsBetween(
        Window.unboundedPreceding, -1
    )
    kept = df.columns
    return sliced.join(base, [*keys, part], "left").select(
        *kept,
        part,
        *[
            (F.coalesce(carried[n], F.lit(0)) + F.coalesce(F.sum(i).over(within), F.lit(0))).alias(n)
            for n, i in inputs.items()
        ],
    )


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    name: str,
    rows: int = SLICE_ROWS,
    levels: int = LEVELS,
    then_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: ``value`` of the next row of the same key, else null.

    ``value`` must not be null itself; wrap nullable columns in a struct.
    """
    keys = list(keys)
    own = f"_own_{name}"
    prepared = placed(df, *keys, position).withColumn(own, value)
    return _with_next(prepared, keys, position, list(then_by), own, name, rows, levels).select(*df.columns, name)


def _with_next(df, keys, position, then_by, own, name, rows, level):
    if level == 0:
        return df.withColumn(name, F.lead(own).over(Window.partitionBy(*keys).orderBy(position, *then_by)))
    part = _slice_name(level)
    sliced = df.withColumn(part, slice_of(position, rows))
    firsts = sliced.groupBy(*keys, part).agg(F.min_by(own, F.struct(position, *then_by)).alias(own))
    following = f"_following_{level}"
    base = _with_next(firsts, keys, part, [], own, following, rows, level - 1).select(
        *keys, part, following
    )
    within = Window.partitionBy(*keys, part).orderBy(position, *then_by)
    return sliced.join(base, [*keys, part], "left").withColumn(
        name, F.coalesce(F.lead(own).over(within), F.col(following))
    )


def with_last(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    name: str,
    rows: int = SLICE_ROWS,
    levels: int = LEVELS,
    then_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: ``value`` of the last row of the same key, up to this one, where it is not null.

    Rows before the first such row have null. What a slice passes on is one value, so
    keep ``value`` small. The slice number is kept, as ``_slice_<levels>``.
    """
    keys = list(keys)
    own = f"_own_{name}"
    prepared = placed(df, *keys, position).withColumn(own, value)
    kept = [*df.columns, *([_slice_name(levels)] if levels else []), name]
    return _with_last(prepared, keys, position, list(then_by), own, name, rows, levels, 0).select(*kept)


def _with_last(df, keys, position, then_by, own, name, rows, level, end):
    """Up to the row itself (``end`` 0) or up to the one before (-1)."""
    order = Window.partitionBy(*keys).orderBy(position, *then_by)
    if level == 0:
        return df.withColumn(name, F.last(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, end)))
    part, earlier = _slice_name(level), f"_earlier_{level}"
    sliced = df.withColumn(part, slice_of(position, rows))
    there = F.when(F.col(own).isNotNull(), F.struct(position, *then_by))
    lasts = sliced.groupBy(*keys, part).agg(F.max_by(own, there).alias(own))
    base = _with_last(lasts, keys, part, [], own, earlier, rows, level - 1, -1).select(*keys, part, earlier)
    within = Window.partitionBy(*keys, part).orderBy(position, *then_by).rowsBetween(Window.unboundedPreceding, end)
    return sliced.join(base, [*keys, part], "left").withColumn(
        name, F.coalesce(F.last(own, ignorenulls=True).over(within), F.col(earlier))
    )
