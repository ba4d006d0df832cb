import datetime
import random

import pytest
from pyspark.sql import functions as F

from tablewire import scratch
from tablewire.operators import logs, quality


def test_log_lines(spark):
    good = "2026-03-04 09:18:59.123 [ThreadId(1)] INFO [a::b] text [x] more\nsecond"
    rows = [
        (good,), ("2026-03-04 09:18:59.123 [ThreadId(1)] WARN [<unnamed>] ",), ("  at somewhere",), (None,),
        ("2026-13-04 09:18:59.123 [t] INFO [m] x",), ("2026-03-04 09:18:59 [t] INFO [m] x",), ("2026-03-04 09:18:59.123 [t] NOTE [m] x",),
    ]
    out = logs.parse_log_lines(spark.createDataFrame(rows, "value string")).collect()
    first = out[0]
    assert first["ts"] == datetime.datetime(2026, 3, 4, 9, 18, 59, 123000)
    assert (first["thread"], first["level"], first["module"]) == ("ThreadId(1)", "INFO", "a::b")
    assert first["message"] == "text [x] more\nsecond"
    assert (out[1]["module"], out[1]["message"], out[1]["error"]) == ("<unnamed>", "", None)
    assert [r["error"] for r in out[2:]] == ["log:format", "log:format", "log:time", "log:format", "log:format"]


HEAD = "2026-03-04 09:18:59.{:03d} [t{}] INFO [m] say {}"


def records_of(rows):
    """Records of (file, line_no, value) rows, in plain Python: file -> list of (first line, message, lines)."""
    found = {}
    for file in {f for f, n, _ in rows if f is not None}:
        own = sorted((n, v.split("] ", 2)[2] if v.startswith("2026") else v, v) for f, n, v in rows if f == file and n is not None)
        for n, text, value in own:
            records = found.setdefault(file, [])
            if value.startswith("2026"):
                records.append([n, text, 1, value])
            elif records:
                records[-1][1] += "\n" + text
                records[-1][2] += 1
            else:
                records.append([n, text, 1, ""])
    for records in found.values():
        while len(records) > 1 and not records[1][3]:
            records[0][1] += "\n" + records[1][1]
            records[0][2] += 1
            del records[1]
    return found


@pytest.mark.parametrize(("part_lines", "slice_rows"), [(1 << 20, 4), (1 << 20, 1 << 14), (8, 8), (8, 64)])
def test_messages_of_several_lines(spark, part_lines, slice_rows):
    rng = random.Random(slice_rows)
    rows = []
    for file in ("a", "b", "hot"):
        for n in range(600 if file == "hot" else 90):
            chance = 0.01 if 200 < n < 400 else 0.4
            text = HEAD.format(n, n % 3, n) if rng.random() < chance else f"  at {n}"
            rows.append((file, n + (file == "b") * 10_000, text))
    rows += [("hot", 5, "  again"), ("a", None, "  no number"), (None, 3, HEAD.format(1, 1, "alone")), (None, None, None)]
    df = spark.createDataFrame(rows, "file string, line_no long, value string").repartition(5)
    found = logs.log_records(df, part_lines=part_lines, slice_rows=slice_rows).collect()
    assert sum(r["n_lines"] for r in found) == len(rows)
    placed = [r for r in found if r["file"] is not None and r["line_no"] is not None and r["error"] != "place"]
    for file, expected in records_of(rows).items():
        own = sorted((r for r in placed if r["file"] == file), key=lambda r: (r["thread"] is not None, r["line_no"], r["part"]))
        whole = {}
        for r in own:
            message, lines, _ = whole.get(key := (r["line_no"] if r["thread"] else None), (None, 0, None))
            text = r["message"] if message is None else message + "\n" + r["message"]
            whole[key] = text, lines + r["n_lines"], r["thread"]
        want = {(n if value else None): (text, lines, value and value.split("[")[1].split("]")[0] or None) for n, text, lines, value in expected}
        assert whole == want
    alone = [r for r in found if r["file"] is None or r["error"] == "place"]
    assert sorted((r["message"], r["thread"] or "", r["error"] or "") for r in alone) == [
        ("", "", "place"), ("  no number", "", "place"), ("say alone", "t1", "")
    ]


def test_no_task_holds_a_whole_file(spark, plan):
    df = spark.createDataFrame([("a", 1, "x")], "file string, line_no long, value string")
    windows = [line for line in plan(logs.log_records(df)).splitlines() if "Window [last" in line]
    assert any("_slice_1" in line for line in windows) and "SinglePartition" not in plan(logs.log_records(df))


def test_rows_without_a_time_are_kept_and_counted(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-01",), (None,), (None,)], "d string").select(F.to_timestamp("d").alias("ts"))
    assert sorted(str(r["ts"]) for r in logs.retain_days(df, "ts", 1).collect()) == ["2024-03-01 00:00:00", "None", "None"]
    assert [r["error"] for r in logs.undated(df, "ts").collect()] == ["log:time"] * 2
    assert {r["fate"]: r["n"] for r in logs.day_counts(df, "ts", 1).collect()} == {"kept": 1, "removed": 1, "undated": 2}
    path = str(tmp_path / "days")
    logs.write_by_day(df, "ts", path)
    assert logs.retain_partitions(spark.read.parquet(path), 1).count() == 3
    nothing = df.where("ts IS NULL")
    assert logs.retain_days(nothing, "ts", 1).count() == 2 and logs.retain_days(df.limit(0), "ts").count() == 0


def test_retention_counts_days_that_occur(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-01",), ("2024-03-01",), ("2024-06-01",)], "d string")
    df = df.select(F.to_timestamp("d").alias("ts"))
    assert logs.retain_days(df, "ts", 2).count() == 3
    assert logs.retain_days(df, "ts").count() == 4


def test_old_folders_are_pruned(spark, tmp_path, plan, table):
    path = str(tmp_path / "days")
    logs.write_by_day(table("events"), "ts", path)
    kept = logs.retain_partitions(spark.read.parquet(path), 3)
    filters = [line for line in plan(kept).splitlines() if "PartitionFilters: [isnotnull(day" in line]
    assert any("Subquery" in line.split("PartitionFilters")[1] for line in filters)
    assert kept.count() == logs.retain_days(table("events"), "ts", 3).count()


@pytest.mark.parametrize("name", list(quality.ERROR_MESSAGES))
def test_error_classes(spark, name):
    words = quality.ERROR_MESSAGES[name] + "detail"
    if name in quality.NAMED_SERVICE:
        words = "some service " + words
    df = spark.createDataFrame([(words,), ("x " + "y" * 30 + words,), (None,)], "m string")
    got = {r["error_class"]: r["n"] for r in quality.classify_errors(df, "m").collect()}
    assert got == {name: 1, "other": 2}


def test_split_errors_loses_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "json:text")], "id int, error string")
    good, bad = quality.split_errors(df)
    assert [r["id"] for r in good.collect()] == [1] and [tuple(r) for r in bad.collect()] == [(2, "json:text")]


def test_scratch_follows_the_session_setting():
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        pass

    session = Session()
    session.conf = Conf(**{"spark.checkpoint.dir": "hdfs://shared/dir/", "spark.master": "yarn"})
    assert scratch.shared_dir(session, "x").startswith("hdfs://shared/dir/x-")
    session.conf = Conf(**{"spark.master": "yarn"})
    with pytest.raises(ValueError):
        scratch.shared_dir(session, "x")
