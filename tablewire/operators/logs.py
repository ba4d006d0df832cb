"""Log lines and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewire.functions.ordering import PART_ROWS, PLACE, SLICE_ROWS, slice_of, unplaced, with_last

# Fixed value: "2026-03-04 09:18:59.123 [ThreadId(1)] INFO [module] message".
LOG_LINE = (
    r"(?s)^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}) \[([^\]]*)\] "
    r"(TRACE|DEBUG|INFO|WARN|ERROR) \[([^\]]*)\] (.*)$"
)
KEEP_DAYS = 30


def parse_log_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Add ``ts, thread, level, module, message`` and ``error``.

    ``error`` is null for a good line, ``log:format`` for a line of another shape
    (such as the second line of a message) and ``log:time`` for a time that does
    not exist.
    """
    value = F.col(line)

    def piece(group: int) -> Column:
        return F.when(F.col("_fits"), F.regexp_extract(value, LOG_LINE, group))

    fitted = df.withColumn("_fits", F.coalesce(value.rlike(LOG_LINE), F.lit(False)))
    out = fitted.select(
        "*",
        piece(1).try_cast("timestamp_ntz").alias("ts"),
        piece(2).alias("thread"),
        piece(3).alias("level"),
        piece(4).alias("module"),
        piece(5).alias("message"),
    )
    error = F.when(~F.col("_fits"), "log:format").when(F.col("ts").isNull(), "log:time")
    return out.withColumn("error", error).drop("_fits")


def log_records(
    df: DataFrame,
    file: str = "file",
    line_no: str = "line_no",
    line: str = "value",
    part_lines: int = PART_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``(file, line_no, part, ts, thread, level, module, message, n_lines, error)``: one record per message.

    A line of another shape continues the message of the last line of its file that has
    the shape, however far back and in whatever input split that is: the values of that
    line are carried forward over slices of the file, so no file is one task. ``line_no``
    is the number of the record's first line. A record of lines that span more than
    ``part_lines`` numbers comes as parts, each with the record's fields; joined by line
    feeds in order they are the whole message.

    Defined cases: lines before the first line of that shape are quarantined as
    records with the error ``log:format`` and no fields, in parts by line number; lines
    without a file or a number are records of their own, with the error ``place`` if
    they only could continue another; lines that share a number are ordered by their
    text, equal heads there are one record whose ``n_lines`` counts both; a null line is
    an empty one.
    """
    fields = ("ts", "thread", "level", "module", "error")
    text = F.coalesce(F.col(line), F.lit(""))
    lines = df.select(F.col(file).alias("file"), F.col(line_no).cast("long").alias("line_no"), text.alias("value"))
    parsed = parse_log_lines(lines)
    heads = F.coalesce(F.col("error") != "log:format", F.lit(True))
    # what is carried is small: the message itself stays in its line
    head = F.when(heads, F.struct("line_no", F.md5("value").alias("digest"), *fields))
    shown = parsed.select("file", "line_no", head.alias("_head"), F.when(heads, F.col("message")).otherwise(F.col("value")).alias("_text"))
    carried = with_last(shown, ["file"], "line_no", F.col("_head"), "_of", slice_rows, then_by=["_text"])
    first = F.coalesce(F.col("_of.line_no"), F.lit(0))
    parts = carried.withColumn("part", slice_of(F.col("line_no") - first, part_lines))
    joined = parts.groupBy("file", "_of", "part").agg(
        F.expr("listagg(_text, '\n') WITHIN GROUP (ORDER BY line_no, _text)").alias("message"),
        F.count(F.lit(1)).alias("n_lines"),
        F.min("line_no").alias("_least"),
    )
    orphan = F.col("_of").isNull()
    records = joined.select(
        "file",
        F.coalesce("_of.line_no", "_least").alias("line_no"),
        "part",
        *[F.col(f"_of.{name}").alias(name) for name in fields[:-1]],
        "message",
        "n_lines",
        F.when(orphan, "log:format").otherwise(F.col("_of.error")).alias("error"),
    )
    alone = unplaced(shown, "file", "line_no").select(
        "file",
        "line_no",
        F.lit(0).cast("long").alias("part"),
        *[F.col(f"_head.{name}").alias(name) for name in fields[:-1]],
        F.col("_text").alias("message"),
        F.lit(1).cast("long").alias("n_lines"),
        F.when(F.col("_head").isNull(), PLACE).otherwise(F.col("_head.error")).alias("error"),
    )
    return records.unionByName(alone)


def oldest_kept(df: DataFrame, day: Column, keep: int) -> Column:
    """The oldest of the newest ``keep`` days that occur, as a scalar subquery.

    Days are counted on the map side first; the top-k holds ``keep`` rows.
    """
    days = df.select(day.alias("day")).where(F.col("day").isNotNull()).distinct()
    return days.orderBy(F.desc("day")).limit(keep).agg(F.min("day")).scalar()


def retain_days(df: DataFrame, ts: str, keep: int = KEEP_DAYS) -> DataFrame:
    """Rows of the newest ``keep`` days that occur, and all rows without a time: nothing tells that they are old.

    ``undated`` gives the latter alone, for a quarantine.
    """
    day = F.to_date(F.col(ts))
    return df.where(day >= oldest_kept(df, day, keep)).unionByName(undated(df, ts).drop("error"))


def undated(df: DataFrame, ts: str) -> DataFrame:
    """The rows that belong to no day, with the error ``log:time``; a filter without an exchange."""
    return df.where(F.to_date(F.col(ts)).isNull()).withColumn("error", F.lit("log:time"))


def day_counts(df: DataFrame, ts: str, keep: int = KEEP_DAYS) -> DataFrame:
    """``(fate, n)``: how many rows retention keeps, removes, and finds without a time."""
    day = F.to_date(F.col(ts))
    fate = F.when(day.isNull(), "undated").when(day >= oldest_kept(df, day, keep), "kept").otherwise("removed")
    return df.groupBy(fate.alias("fate")).agg(F.count(F.lit(1)).alias("n"))


def write_by_day(df: DataFrame, ts: str, path: str) -> None:
    """Write with one folder per day; a day that holds much data is split over tasks."""
    (
        df.withColumn("day", F.to_date(F.col(ts)))
        .hint("rebalance", "day")
        .write.mode("append")
        .partitionBy("day")
        .parquet(path)
    )


def retain_partitions(df: DataFrame, keep: int = KEEP_DAYS, day: str = "day") -> DataFrame:
    """The same on a table stored by day: older folders are not read at all, and the folder without a day is kept."""
    return df.where(F.col(day) >= oldest_kept(df, F.col(day), keep)).unionByName(df.where(F.col(day).isNull()))
