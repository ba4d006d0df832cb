import base64
import json

import pytest
from pyspark.sql import functions as F

from tablewire.operators import sessions


def event(kind, **more):
    return json.dumps({"type": kind, **more})


def delta(data):
    return event("response.audio.delta", delta=base64.b64encode(data).decode())


def routed(spark, rows):
    df = spark.createDataFrame(rows, "session_id long, seq long, payload string, frame string").repartition(3)
    return sessions.route_events(df, frame="frame")


def test_commands(spark):
    df = spark.createDataFrame([(1, 20, "b"), (1, 10, "a"), (2, 5, "c")], "session_id long, seq long, text string")
    rows = sessions.session_commands(df, "v").orderBy("session_id", "cmd_seq").collect()
    assert [(r["session_id"], r["cmd_seq"], r["type"]) for r in rows] == [
        (1, 0, "session.update"), (1, 1, "input_text_buffer.append"), (1, 2, "input_text_buffer.append"),
        (1, 3, "session.finish"), (2, 0, "session.update"), (2, 1, "input_text_buffer.append"), (2, 2, "session.finish"),
    ]
    first = json.loads(rows[0]["payload"])
    assert first["session"] == {"mode": "server_commit", "response_format": "pcm", "sample_rate": 24000, "voice": "v"}
    assert "text" not in first and json.loads(rows[1]["payload"])["text"] == "a"
    assert set(json.loads(rows[3]["payload"])) == {"event_id", "type"}
    assert len({r["event_id"] for r in rows}) == 7
    again = sessions.session_commands(df.repartition(5), "v").orderBy("session_id", "cmd_seq").collect()
    assert [r["event_id"] for r in again] == [r["event_id"] for r in rows]


@pytest.mark.parametrize(
    "payload,frame,expected",
    [
        (event("session.created"), "text", "created"), (delta(b"x"), None, "audio"), (event("response.done"), "text", "done"),
        (event("session.finished"), "text", "finished"), (event("other"), "text", "unknown"), ("{}", "text", "ignored"),
        ('{"type":7}', "text", "ignored"), ("[1]", "text", "ignored"), ("5", "text", "ignored"), ("{", "text", "invalid"),
        (None, "close", "close"), (None, "error", "error"), (event("session.finished"), "binary", "binary"),
    ],
)
def test_classes(spark, payload, frame, expected):
    assert routed(spark, [(1, 1, payload, frame)]).first()["event_class"] == expected


@pytest.mark.parametrize("size", [1, 2, 4, 1024])
def test_reading_stops_at_the_first_end(spark, size):
    done, end = event("response.done"), event("session.finished")
    rows = [(1, i, end if i in (5, 7) else done, "text") for i in range(10)]
    rows += [(2, i, None if i == 3 else done, "close" if i == 3 else "text") for i in range(6)]
    rows += [(3, i, done, "text") for i in range(4)]
    kept = sessions.until_finished(routed(spark, rows), slice_rows=size).groupBy("session_id").agg(
        F.max("seq"), F.count("*")
    )
    assert sorted(map(tuple, kept.collect())) == [(1, 5, 6), (2, 3, 4), (3, 3, 4)]


def test_audio_in_order_and_in_parts(spark):
    pieces = [bytes([i]) * (i % 5) for i in range(40)]
    rows = [(1, i, delta(p), "text") for i, p in enumerate(pieces)]
    for size in (1, 7, 1024):
        parts = sessions.assemble_audio(routed(spark, rows), part_events=size).orderBy("part").collect()
        assert b"".join(bytes(p["audio"]) for p in parts) == b"".join(pieces)
        assert sum(p["n_bytes"] for p in parts) == len(b"".join(pieces))


@pytest.mark.parametrize("text", ["@@@@", "YQ", "YR==", "Y Q==", "YQ==\n", "YQ=", "=", "é"])
def test_only_canonical_base64_decodes(spark, text):
    df = routed(spark, [(1, 0, event("response.audio.delta", delta=text), "text"), (1, 1, delta(b"ok"), "text")])
    row = sessions.assemble_audio(df).first()
    assert (bytes(row["audio"]), row["n_bad"]) == (b"ok", 1)


def test_long_deltas_decode(spark):
    data = bytes(range(256)) * 40
    row = sessions.assemble_audio(routed(spark, [(1, 0, delta(data), "text")])).first()
    assert bytes(row["audio"]) == data and row["n_bad"] == 0
    assert row["seconds"] == len(data) / 48000


@pytest.mark.parametrize("size", [2, 6, 1024])
def test_audio_at_once_equals_the_two_steps(spark, plan, size):
    end = event("session.finished")
    rows = [(s, i, end if i == 11 * s else delta(f"{s}:{i};".encode()), "text") for s in (1, 2, 3) for i in range(30)]
    df = routed(spark, rows)
    once = sessions.session_audio(df, part_events=2, slice_rows=size)
    steps = sessions.assemble_audio(sessions.until_finished(df, slice_rows=size), part_events=2)
    assert once.exceptAll(steps).isEmpty() and once.count() == steps.count()
    assert plan(once).count("Exchange hashpartitioning") < plan(steps).count("Exchange hashpartitioning")
    with pytest.raises(ValueError):
        sessions.session_audio(df, part_events=4, slice_rows=6)


def test_events_without_delta_text_add_nothing(spark):
    rows = [(1, 0, event("response.audio.delta"), "text"), (1, 1, event("response.audio.delta", delta=5), "text")]
    assert sessions.assemble_audio(routed(spark, rows)).isEmpty()


def test_sizes_equal_the_audio(spark):
    rows = [(1, i, delta(b"x" * i), "text") for i in range(9)] + [(1, 9, event("response.audio.delta", delta="?"), "text")]
    row = sessions.audio_sizes(routed(spark, rows)).first()
    assert (row["n_bytes"], row["n_bad"]) == (36, 1)


def test_lifecycle(spark):
    created, end, done = event("session.created"), event("session.finished"), event("response.done")
    rows = [
        (1, 0, created, "text"), (1, 1, end, "text"), (1, 2, None, "close"), (1, 3, done, "text"),
        (2, 0, created, "text"), (2, 1, None, "close"), (2, 2, end, "text"),
        (3, 0, done, "text"), (3, 1, None, "error"),
        (4, 0, created, "text"), (4, 9, done, "text"),
        (5, 0, None, "error"), (5, 1, created, "text"),
    ]
    got = [tuple(r) for r in sessions.session_lifecycle(routed(spark, rows)).orderBy("session_id").collect()]
    assert got == [
        (1, True, True, False, False, 1), (2, True, False, True, False, 1), (3, False, False, False, True, 1),
        (4, True, False, False, False, 9), (5, False, False, False, True, 0),
    ]


def test_lifecycle_is_summed_before_the_shuffle(spark, plan):
    text = plan(sessions.session_lifecycle(routed(spark, [(1, 0, "{}", "text")])))
    assert "partial_min" in text and "Window" not in text
