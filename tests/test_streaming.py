import base64
import json
import random

import pytest
from pyspark.sql import functions as F

from tablewire.operators import sessions
from tablewire.plans import publish
from tablewire.streaming import block_sink, slices

EVENTS = "session_id long, seq long, ts timestamp, payload string, frame string"


def test_blocks_are_committed_once(spark, tmp_path, table):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "table", "cp"))
    events = table("events")

    def run():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = block_sink.stream_to_blocks(stream, path, checkpoint)
        query.awaitTermination()

    for low in (0, 300, 600):
        events.where(F.col("event_id").between(low, low + 299)).coalesce(1).write.mode("append").parquet(source)
    run()
    assert publish.current_version(spark, path) == 3
    run()
    assert publish.current_version(spark, path) == 3
    events.where("event_id >= 900").coalesce(1).write.mode("append").parquet(source)
    run()
    got = publish.published_table(spark, path)
    assert got.exceptAll(events).isEmpty() and got.count() == events.count()
    blocks = publish.manifest(spark, path).groupBy("block_id").agg(F.sum("record_count").alias("n"))
    assert sorted(map(tuple, blocks.collect())) == [(0, 300), (1, 300), (2, 300), (3, events.count() - 900)]


def test_a_replayed_batch_is_skipped(spark, tmp_path, monkeypatch):
    """The commit succeeds, then the batch fails: the replay must add nothing."""
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "table", "cp"))
    spark.range(10).coalesce(1).write.parquet(source)
    real = block_sink.commit_upload

    def commit_then_fail(*args):
        real(*args)
        raise RuntimeError("lost after the commit")

    def run():
        stream = spark.readStream.schema("id long").parquet(source)
        block_sink.stream_to_blocks(stream, path, checkpoint).awaitTermination()

    monkeypatch.setattr(block_sink, "commit_upload", commit_then_fail)
    with pytest.raises(Exception, match="lost after the commit"):
        run()
    monkeypatch.setattr(block_sink, "commit_upload", real)
    run()
    assert publish.current_version(spark, path) == 1
    assert publish.published_table(spark, path).count() == 10


def test_a_batch_that_failed_before_its_commit_is_written_again(spark, tmp_path, monkeypatch):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "table", "cp"))
    spark.range(10).coalesce(1).write.parquet(source)
    real = block_sink.commit_upload

    def fail(*args):
        raise RuntimeError("lost before the commit")

    def run():
        stream = spark.readStream.schema("id long").parquet(source)
        block_sink.stream_to_blocks(stream, path, checkpoint).awaitTermination()

    monkeypatch.setattr(block_sink, "commit_upload", fail)
    with pytest.raises(Exception, match="lost before the commit"):
        run()
    monkeypatch.setattr(block_sink, "commit_upload", real)
    run()
    assert publish.published_table(spark, path).count() == 10


# -- sessions -------------------------------------------------------------


def event(kind, **more):
    return json.dumps({"type": kind, **more})


def session_rows(session, n, end=None, ending="finished", base=1000):
    rows = []
    for seq in range(n):
        payload, frame = event("response.done"), "text"
        if seq == 0:
            payload = event("session.created")
        elif seq == end:
            payload, frame = (event("session.finished"), "text") if ending == "finished" else (None, ending)
        elif seq % 2:
            text = base64.b64encode(f"{session}:{seq};".encode()).decode()
            payload = event("response.audio.delta", delta="?" if seq == 9 else text)
        rows.append((session, seq, base + seq, payload, frame))
    return rows


@pytest.fixture
def replay(spark, tmp_path):
    """Runs files of rows through the stream, one per batch; a last one moves the time on."""
    count = [0]

    def run(files, slice_events=8, timeout_ms=10_000):
        count[0] += 1
        source, sink, checkpoint = (str(tmp_path / f"{n}{count[0]}") for n in ("in", "out", "cp"))
        clock = [(-1, 0, 10_000_000, event("clock"), "text")]
        spark.conf.set(slices.STATE_STORE, slices.ROCKSDB)
        everything = None
        for rows in [*files, clock]:
            df = spark.createDataFrame(rows, "session_id long, seq long, at long, payload string, frame string")
            df = df.select("session_id", "seq", F.timestamp_seconds("at").alias("ts"), "payload", "frame")
            if rows is not clock:
                everything = df if everything is None else everything.unionByName(df)
            df.coalesce(1).write.mode("append").parquet(source)
            # A new query on the same checkpoint each time: the state survives restarts.
            stream = spark.readStream.schema(EVENTS).parquet(source)
            query = (
                slices.stream_sessions(stream, "1 hour", timeout_ms, slice_events, "frame")
                .writeStream.format("parquet")
                .option("checkpointLocation", checkpoint)
                .option("path", sink)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        spark.conf.unset(slices.STATE_STORE)
        out = spark.read.schema(slices.SLICE_SCHEMA).parquet(sink).where("session_id >= 0")
        return out, sessions.route_events(everything, frame="frame")

    return run


def as_rows(df, *order):
    return [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.orderBy(*order).collect()]


def test_stream_equals_batch_over_restarts(replay):
    rows = (
        session_rows(1, 20, end=13) + session_rows(2, 11) + session_rows(3, 16, end=4, ending="close")
        + session_rows(4, 8, end=7, ending="error") + session_rows(5, 24)
    )
    # Events arrive out of order, over three batches.
    files = [[r for i, r in enumerate(rows) if i % 3 == k] for k in range(3)]
    out, routed = replay(files)
    kept = sessions.until_finished(routed)
    assert as_rows(slices.lifecycle(out), "session_id") == as_rows(sessions.session_lifecycle(routed), "session_id")
    expected = sessions.assemble_audio(kept, part_events=8)
    assert as_rows(slices.audio_parts(out), "session_id", "part") == as_rows(expected, "session_id", "part")
    assert as_rows(slices.late_counts(out), "session_id") == as_rows(sessions.late_events(routed), "session_id")
    reasons = {(r["session_id"], r["part"]): r["reason"] for r in out.collect()}
    assert reasons[1, 0] == "complete" and reasons[1, 1] == "ended" and reasons[3, 0] == "ended"
    assert reasons[2, 1] == "timeout" and reasons[5, 2] == "complete"


def test_events_after_their_slice_come_as_late_rows(replay):
    first = session_rows(1, 8, end=3)[:4]
    second = session_rows(1, 8, end=3)[4:]
    out, _ = replay([first, second])
    rows = {r["reason"]: r for r in out.collect()}
    assert rows["ended"]["n_events"] == 4 and rows["late"]["n_events"] == 4
    assert (rows["ended"]["revision"], rows["late"]["revision"]) == (1, 2)
    assert as_rows(slices.late_counts(out), "session_id") == [(1, 4)]


@pytest.mark.parametrize("seed", [1, 2])
def test_late_events_come_as_revisions_and_the_stream_equals_the_batch(replay, seed):
    rng = random.Random(seed)
    rows = (
        session_rows(1, 20, end=13) + session_rows(2, 11) + session_rows(3, 16, end=4, ending="close")
        + session_rows(4, 8, end=7, ending="error") + session_rows(5, 24) + session_rows(6, 30, end=9)
    )
    rows += [(*r[:3], event("response.audio.delta", delta=base64.b64encode(b"again").decode()), "text") for r in rng.sample(rows, 12)]
    rng.shuffle(rows)
    # a third on time, then time passes, then the rest in two batches with fresh times: every slice has revisions
    cuts = [rows[0::3], [(-1, 1, 50_000, event("clock"), "text")], rows[1::3], [(-1, 2, 90_000, event("clock"), "text")], rows[2::3]]
    files = [[(*r[:2], r[2] + (50_000 * (k // 2) if k % 2 == 0 else 0), *r[3:]) for r in part] for k, part in enumerate(cuts)]
    out, routed = replay(files)
    routed = routed.where("session_id >= 0")
    assert out.where("revision > 1").count() > 5
    assert as_rows(slices.lifecycle(out), "session_id") == as_rows(sessions.session_lifecycle(routed), "session_id")
    expected = sessions.assemble_audio(sessions.until_finished(routed), part_events=8)
    assert as_rows(slices.audio_parts(out), "session_id", "part") == as_rows(expected, "session_id", "part")
    assert as_rows(slices.late_counts(out), "session_id") == as_rows(sessions.late_events(routed), "session_id")


def test_without_a_watermark_nothing_is_too_late(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.conf.set(slices.STATE_STORE, slices.ROCKSDB)
    rows = session_rows(1, 12)
    # The newest events come first, the others are days older; then time passes.
    for part in ([r for r in rows if r[1] >= 6], [r for r in rows if r[1] < 6], session_rows(2, 8)):
        df = spark.createDataFrame(part, "session_id long, seq long, at long, payload string, frame string")
        day = F.when(F.col("seq") >= 6, 900_000).otherwise(0)
        df = df.select("session_id", "seq", F.timestamp_seconds(F.col("at") + day).alias("ts"), "payload", "frame")
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENTS).parquet(source)
        query = (
            slices.stream_sessions(stream, None, 1, 8, "frame")
            .writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .option("path", sink)
            .trigger(once=True)
            .start()
        )
        assert query.awaitTermination(60)
    spark.conf.unset(slices.STATE_STORE)
    out = spark.read.schema(slices.SLICE_SCHEMA).parquet(sink)
    seen = out.groupBy("session_id").agg(F.sum("n_events").alias("n")).collect()
    assert {r["session_id"]: r["n"] for r in seen} == {1: 12, 2: 8}


def test_user_function_sees_every_slice(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    df = spark.createDataFrame(
        session_rows(1, 16) + session_rows(2, 8, end=5), "session_id long, seq long, at long, payload string, frame string"
    )
    df = df.select("session_id", "seq", F.timestamp_seconds("at").alias("ts"), "payload")
    df.write.parquet(source)

    def sizes(row):
        return row.assign(kind="slice " + row["reason"])[["session_id", "part", "kind", "n_bytes"]]

    spark.conf.set(slices.STATE_STORE, slices.ROCKSDB)
    stream = spark.readStream.schema(df.schema).parquet(source)
    shape = "session_id long, part long, kind string, n_bytes long"
    query = (
        slices.stream_sessions(stream, "1 hour", slice_events=8, on_slice=sizes, schema=shape)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", sink)
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(100)
    spark.conf.unset(slices.STATE_STORE)
    rows = spark.read.schema(shape).parquet(sink).orderBy("session_id", "part").collect()
    assert [(r["session_id"], r["part"], r["kind"]) for r in rows] == [
        (1, 0, "slice complete"), (1, 1, "slice complete"), (2, 0, "slice ended"),
    ]
    assert rows[2]["n_bytes"] == len(b"2:1;2:3;")
