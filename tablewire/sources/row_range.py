"""Row ranges of a table in the order of unique keys (A4).

The keys at the two edges of a range are found by narrowing.  A step takes quantile
sketches of the candidates, which merge in two levels, and then counts exactly how many
rows lie below, at and above a few of their values around the wanted rank; both edges
share the two jobs of a step.  Sketches are of numbers, so every key is read as a
sequence of numbers in the same order: an integer or a time is one, a text is one per
seven bytes.  A value that many rows share is set apart, and the next number goes on
inside of it, so a hot first key costs one more step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most rows that are put in order by one task.
TOP_ROWS = 100_000
# Size of a sketch, its usual error in rank as a share of the rows, and tasks that merge sketches first.
SKETCH_SIZE = 2_048
SKETCH_ERROR = 0.0016
SKETCH_GROUPS = 64
# Where the counted values lie around the wanted rank, in usual errors.
AROUND = (-8.0, -2.0, -1.0, -0.4, 0.0, 0.4, 1.0, 2.0, 8.0)
# Bytes of a text in one number, and how many numbers of a text are looked at.
TEXT_BYTES, TEXT_NUMBERS = 7, 16


@dataclass(frozen=True)
class _Number:
    """One number of a key; ``first`` of its key, and ``last`` if equal numbers up to here mean equal keys."""

    value: Column
    key: int
    first: bool
    last: bool
    double: bool = False


def _text_number(text: Column, at: int) -> Column:
    piece = F.substring(text, TEXT_BYTES * at + 1, TEXT_BYTES)
    padded = F.rpad(F.hex(piece), 2 * TEXT_BYTES, "0")
    # The length tells a text from one with zero bytes behind it.
    return F.conv(padded, 16, 10).cast("long") * (TEXT_BYTES + 1) + F.octet_length(piece)


def _numbers(column: Column, kind: T.DataType, key: int) -> list[_Number]:
    """The key as numbers that order rows as it does; none where its type has no such form."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        odd = F.isnan(column)
        return [
            _Number(F.when(column.isNotNull(), odd.cast("int").cast("long")), key, True, False),
            _Number(F.when(odd, F.lit(0.0)).otherwise(column.cast("double")), key, False, True, double=True),
        ]
    if kind == T.StringType() or isinstance(kind, T.BinaryType):
        text = column.cast("binary")
        return [_Number(_text_number(text, i), key, i == 0, False) for i in range(TEXT_NUMBERS)]
    if isinstance(kind, T.DecimalType) and kind.precision > 18:
        return [_Number(column.cast("double"), key, True, False, double=True)]
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        value = column.cast("long")
    elif isinstance(kind, T.BooleanType):
        value = column.cast("int").cast("long")
    elif isinstance(kind, T.DateType):
        value = F.unix_date(column).cast("long")
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(column)
    elif isinstance(kind, T.TimestampNTZType):
        seconds = F.unix_date(column.cast("date")).cast("long") * 86_400 + F.hour(column) * 3_600 + F.minute(column) * 60
        value = seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), column) * 1_000_000).cast("long")
    elif isinstance(kind, T.DecimalType):
        value = (column * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("long")
    else:
        return []
    return [_Number(value, key, True, True)]


@dataclass
class _Edge:
    """The row at ``rank`` among the rows ``inside``, all of which agree in the numbers before ``level``."""

    rank: int
    inside: Column = field(default_factory=lambda: F.lit(True))
    size: int | None = None
    level: int = 0
    bounds: list = field(default_factory=list)


@dataclass(frozen=True)
class Found:
    key: tuple
    tied_before: bool
    tied_behind: bool


class KeyOrder:
    """Rows of ``df`` in the order of ``keys``, nulls first."""

    def __init__(self, df: DataFrame, keys: Sequence[str], top_rows: int = TOP_ROWS):
        self.keys, self.top_rows = list(keys), top_rows
        self.types = [df.schema[k].dataType for k in self.keys]
        self.columns = [F.col(f"`{k}`") for k in self.keys]
        self.rows = df.select(*self.columns)
        self.numbers: list[_Number] = []
        self.whole = True  # the numbers tell all keys apart
        for i, (column, kind) in enumerate(zip(self.columns, self.types)):
            found = _numbers(column, kind, i)
            self.numbers += found
            if not found:
                self.whole = False
                break

    # -- comparisons with a constant key, written out so that they stay plain comparisons of columns

    def _constants(self, key: tuple) -> list[Column]:
        return [_constant(v, t) for v, t in zip(key, self.types)]

    def after(self, key: tuple) -> Column:
        """The row's key is greater than ``key``."""
        found = F.lit(False)
        for column, constant, value in reversed(list(zip(self.columns, self._constants(key), key))):
            greater = column.isNotNull() if value is None else F.coalesce(column > constant, F.lit(False))
            found = greater | (column.eqNullSafe(constant) & found)
        return found

    def equal(self, key: tuple) -> Column:
        found = F.lit(True)
        for column, constant in zip(self.columns, self._constants(key)):
            found = found & column.eqNullSafe(constant)
        return found

    def between(self, low: tuple, high: tuple) -> Column:
        """Range filter over the whole key, plus one on the first key for pruning."""
        exact = (self.after(low) | self.equal(low)) & ~self.after(high)
        first, kind = self.columns[0], self.types[0]
        if low[0] is None or high[0] is None or isinstance(kind, (T.FloatType, T.DoubleType)):
            return exact
        pruning = first.between(_constant(low[0], kind), _constant(high[0], kind))
        return pruning & exact if len(self.keys) > 1 else pruning

    # -- ranks

    def at_ranks(self, ranks: Sequence[int]) -> tuple[int, list[Found]]:
        """Number of rows, and the keys at ``ranks``, of which those beyond the end stand for the last row."""
        edges = [_Edge(rank) for rank in ranks]
        total = self._measure(edges)
        if not total:
            return 0, []
        while open_edges := [e for e in edges if e.size > self.top_rows and e.level < len(self.numbers)]:
            counted = [e for e in open_edges if e.bounds]
            if counted:
                self._cut(counted)
            self._measure([e for e in open_edges if e.size > self.top_rows and e.level < len(self.numbers)])
        return total, self._keys_of(edges)

    def _measure(self, edges: list[_Edge]) -> int:
        """Size, differing number and values to count at, for every edge in one job; the rows seen by the first."""
        if not edges:
            return 0
        aggregates, merged, answers = [], [], []
        for i, edge in enumerate(edges):
            inside = F.when(edge.inside, F.lit(1))
            aggregates.append(F.count(inside).alias(f"n{i}"))
            merged.append(F.sum(f"n{i}").alias(f"n{i}"))
            answers.append(F.col(f"n{i}"))
            here = self.numbers[edge.level] if self.numbers else None
            if here is not None:
                key = F.when(edge.inside, self.columns[here.key])
                aggregates += [F.min(key).alias(f"low{i}"), F.max(key).alias(f"high{i}"), F.count(key).alias(f"some{i}")]
                merged += [F.min(f"low{i}").alias(f"low{i}"), F.max(f"high{i}").alias(f"high{i}"), F.sum(f"some{i}").alias(f"some{i}")]
                one = F.col(f"low{i}").eqNullSafe(F.col(f"high{i}")) & F.col(f"some{i}").isin(F.lit(0), F.col(f"n{i}"))
                answers.append(one.alias(f"one{i}"))
            for level in self._looked_at(edge):
                number, name = self.numbers[level], f"{i}_{level}"
                kind = "double" if number.double else "bigint"
                value = F.when(edge.inside, number.value)
                sketch, merge = getattr(F, f"kll_sketch_agg_{kind}"), getattr(F, f"kll_merge_agg_{kind}")
                aggregates += [
                    sketch(value, SKETCH_SIZE).alias(f"sketch{name}"), F.count(value).alias(f"some{name}"),
                    F.min(value).alias(f"least{name}"), F.max(value).alias(f"most{name}"),
                ]
                merged += [
                    merge(F.when(F.col(f"some{name}") > 0, F.col(f"sketch{name}")), SKETCH_SIZE).alias(f"sketch{name}"),
                    F.sum(f"some{name}").alias(f"some{name}"),
                    F.min(f"least{name}").alias(f"least{name}"), F.max(f"most{name}").alias(f"most{name}"),
                ]
                answers += [f"sketch{name}", f"some{name}", f"least{name}", f"most{name}"]
        group = (F.spark_partition_id() % SKETCH_GROUPS).alias("_group")
        rows = self.rows.where(_any([e.inside for e in edges]))
        row = rows.groupBy(group).agg(*aggregates).agg(*merged).select(*answers).first()
        for i, edge in enumerate(edges):
            looked, edge.size, edge.bounds = self._looked_at(edge), row[f"n{i}"] or 0, []
            edge.rank = min(edge.rank, edge.size - 1)
            for level in looked:
                name = f"{i}_{level}"
                if level > edge.level and not row[f"one{i}"]:
                    edge.level = self._next(edge.level)  # this number is the same everywhere, the key is not
                    break
                if row[f"least{name}"] != row[f"most{name}"] or row[f"some{name}"] not in (0, edge.size):
                    edge.level = level
                    if row[f"some{name}"]:
                        edge.bounds = self._around(edge, level, row[f"some{name}"], bytes(row[f"sketch{name}"]))
                    break
            else:
                edge.level = self._next(looked[-1]) if looked else edge.level
        return row["n0"] or 0

    def _next(self, level: int) -> int:
        """The level after one whose number is the same everywhere; none after a key that its numbers do not tell apart."""
        here, more = self.numbers[level], level + 1 < len(self.numbers)
        if more and self.numbers[level + 1].key != here.key and not here.last:
            return len(self.numbers)
        return level + 1

    def _around(self, edge: _Edge, level: int, some: int, sketch: bytes) -> list:
        """Values of the sketch around the rank of an edge; constants, so no job runs."""
        at = (edge.rank - (edge.size - some)) / some  # nulls come first
        shares = sorted({min(max(at + a * SKETCH_ERROR, 0.0), 1.0) for a in AROUND})
        quantile = getattr(F, f"kll_sketch_get_quantile_{'double' if self.numbers[level].double else 'bigint'}")
        row = self.rows.sparkSession.sql("SELECT 1").select(*[quantile(F.lit(sketch), F.lit(s)) for s in shares]).first()
        return sorted(set(row))

    def _looked_at(self, edge: _Edge) -> list[int]:
        """The level of an edge and the first one of the next key, which counts if the rows share this key."""
        if edge.level >= len(self.numbers):
            return []
        key = self.numbers[edge.level].key
        after = [n for n in range(edge.level + 1, len(self.numbers)) if self.numbers[n].key == key + 1]
        return [edge.level, *after[:1]]

    def _cut(self, edges: list[_Edge]) -> None:
        """Counts below and at each value, all in one job, and narrows every edge to where its rank lies."""
        counts = []
        for i, edge in enumerate(edges):
            value = self.numbers[edge.level].value
            counts.append(F.count_if(edge.inside & value.isNull()).alias(f"null{i}"))
            for j, bound in enumerate(edge.bounds):
                counts.append(F.count_if(edge.inside & (value < F.lit(bound))).alias(f"below{i}_{j}"))
                counts.append(F.count_if(edge.inside & (value <= F.lit(bound))).alias(f"upto{i}_{j}"))
        row = self.rows.where(_any([e.inside for e in edges])).agg(*counts).first()
        for i, edge in enumerate(edges):
            value, bounds = self.numbers[edge.level].value, edge.bounds
            steps, lower = [(row[f"null{i}"], value.isNull(), True)], None
            for j, bound in enumerate(bounds):
                below = value < F.lit(bound)
                steps.append((row[f"null{i}"] + row[f"below{i}_{j}"], below if lower is None else below & lower, False))
                steps.append((row[f"null{i}"] + row[f"upto{i}_{j}"], value == F.lit(bound), True))
                lower = value > F.lit(bound)
            steps.append((edge.size, lower, False))
            before = 0
            for upto, condition, alike in steps:
                if edge.rank < upto:
                    edge.inside = edge.inside & F.coalesce(condition, F.lit(False))
                    edge.rank, edge.size, edge.bounds = edge.rank - before, upto - before, []
                    edge.level = self._next(edge.level) if alike else edge.level
                    break
                before = upto

    def _keys_of(self, edges: list[_Edge]) -> list[Found]:
        """The rows at the ranks of all edges; one task orders ``top_rows`` keys at most."""
        found: dict[int, Found] = {}
        few = [(i, e) for i, e in enumerate(edges) if e.size <= self.top_rows]
        parts = [self.rows.where(e.inside).select(F.lit(i).alias("_edge"), F.lit(e.rank).alias("_rank"), *self.columns) for i, e in few]
        if parts:
            both = parts[0]
            for part in parts[1:]:
                both = both.unionByName(part)
            found |= self._ranked(both)
        for i, edge in enumerate(edges):
            if i in found:
                continue
            if self._told_apart(edge):  # every row inside has the same key
                (row,) = self._carried(self.rows.where(edge.inside).limit(1)).collect()
                found[i] = Found(tuple(row), edge.rank > 0, edge.rank < edge.size - 1)
            else:  # Spark's own distributed sort
                ordered = self.rows.where(edge.inside).orderBy(*self.columns)
                near = ordered.offset(max(edge.rank - 1, 0)).limit(3 if edge.rank else 2)
                near = near.select(F.lit(i).alias("_edge"), F.lit(min(edge.rank, 1)).alias("_rank"), *self.columns)
                found |= self._ranked(near)
        return [found[i] for i in range(len(edges))]

    def _told_apart(self, edge: _Edge) -> bool:
        # A text that outlives its numbers, or a type without any, is never told apart by them.
        last_of_key = {n.key: n.last for n in self.numbers}
        return self.whole and edge.level == len(self.numbers) and all(last_of_key.values())

    def _carried(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[_carried(c, t).alias(f"_key{i}") for i, (c, t) in enumerate(zip(self.columns, self.types))])

    def _ranked(self, rows: DataFrame) -> dict[int, Found]:
        """``rows(_edge, _rank, keys)``: the row at the rank of each edge, and whether a neighbour shares its key."""
        order = Window.partitionBy("_edge").orderBy(*self.columns)
        before, behind = F.lag(F.lit(1)).over(order).isNotNull(), F.lead(F.lit(1)).over(order).isNotNull()
        for column in self.columns:
            before = before & column.eqNullSafe(F.lag(column).over(order))
            behind = behind & column.eqNullSafe(F.lead(column).over(order))
        placed = rows.select(
            "*", (F.row_number().over(order) - 1).alias("_at"), before.alias("_before"), behind.alias("_behind")
        ).where(F.col("_at") == F.col("_rank"))
        keys = [_carried(c, t).alias(f"_key{i}") for i, (c, t) in enumerate(zip(self.columns, self.types))]
        out = {}
        for row in placed.select("_edge", "_before", "_behind", *keys).collect():
            out[row["_edge"]] = Found(tuple(row)[3:], row["_before"], row["_behind"])
        return out

    def at_ranks_of_prefix(self, ranks: Sequence[int]) -> dict[int, Found]:
        """The same by one top-k of keys, for small ranks; those beyond the end are not there."""
        prefix = self.rows.orderBy(*self.columns).limit(max(ranks) + 2)
        edges = F.explode(F.array(*[F.struct(F.lit(i).alias("edge"), F.lit(r).alias("rank")) for i, r in enumerate(ranks)]))
        rows = prefix.select(edges.alias("_e"), *self.columns)
        return self._ranked(rows.select(F.col("_e.edge").alias("_edge"), F.col("_e.rank").alias("_rank"), *self.columns))


def _any(conditions: Sequence[Column]) -> Column:
    found = conditions[0]
    for condition in conditions[1:]:
        found = found | condition
    return found


def _carried(column: Column, kind: T.DataType) -> Column:
    """The key on its way to the driver: with its type, times as exact microseconds or text."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    return column.cast("string") if not isinstance(kind, _PLAIN) else column


def _constant(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType) and value is not None:
        return F.timestamp_micros(F.lit(value))
    if isinstance(value, bytearray):
        value = bytes(value)
    return F.lit(value).cast(kind)


_PLAIN = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.FloatType, T.DoubleType,
    T.DecimalType, T.StringType, T.BinaryType, T.DateType,
)


def read_row_range(
    df: DataFrame,
    order_keys: Sequence[str],
    start: int,
    count: int,
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """Rows ``start .. start + count`` in the order of ``order_keys``, nulls first.

    Rows that share their keys across an edge of the range are an error, whatever its size;
    ties inside are none.  A short prefix is a top-k.  Otherwise the keys at the edges are
    found first, in three jobs where the first key tells rows apart, and the read itself is
    a plain range filter on the keys: no sort, no exchange, and file statistics can skip
    the rest.  The driver sees a few keys and counts.  An empty table or a range
    behind the end gives no rows.
    """
    if start < 0 or count < 0:
        raise ValueError("start and count must not be negative")
    keys = list(order_keys)
    if not count:
        return df.where(F.lit(False))
    order = KeyOrder(df, keys, top_rows)
    stop = start + count
    if stop <= top_rows:
        found = order.at_ranks_of_prefix([start, stop - 1])
        first, last = found.get(0), found.get(1)
        if (first is not None and first.tied_before) or (last is not None and last.tied_behind):
            raise ValueError(f"{keys} are not unique at the edge of the row range")
        return df.orderBy(*order.columns).offset(start).limit(count)
    total, found = order.at_ranks([start, stop - 1])
    if start >= total:
        return df.where(F.lit(False))
    low, high = found
    if low.tied_before or high.tied_behind:
        raise ValueError(f"{keys} are not unique at the edge of the row range")
    return df.where(order.between(low.key, high.key))
