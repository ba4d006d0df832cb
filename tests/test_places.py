"""Null keys, null positions and repeated positions in every ordered operator, whatever the slice length."""

import base64
import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tablewire.functions import ordering
from tablewire.operators import requests, responses, sessions
from tablewire.operators.quality import split_errors

SIZES = [3, 16, 1024]


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(2)
    rows = [(k, rng.randrange(40), rng.choice(["user", "assistant"]), f"t{rng.randrange(50)}") for k in (1, 2, None) for _ in range(60)]
    rows += [(1, None, "user", "nowhere"), (None, None, "user", "nothing")]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def ordered(rows, key):
    return sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: (r[1], r[2], r[3]))


@pytest.mark.parametrize("size", SIZES)
def test_history(turns, size):
    rows, df = turns
    want = []
    for key in (1, 2):
        own = ordered(rows, key)
        want += [(key, a[1], a[3], b[3]) for a, b in zip(own, own[1:]) if (a[2], b[2]) == ("user", "assistant")]
    assert sorted(tuple(r) for r in requests.history_pairs(df, slice_turns=size).collect()) == sorted(want)


@pytest.mark.parametrize("size", SIZES)
def test_messages_and_requests(turns, size):
    rows, df = turns
    parts = requests.collect_messages(df, part_turns=size).orderBy("part").collect()
    bodies = requests.conversation_requests(df, F.lit("m"), part_turns=size).orderBy("part").collect()
    for key in (1, 2):
        want = [(m[3], m[2]) for m in sorted(ordered(rows, key), key=lambda r: (r[1], r[3], r[2]))]
        own = [p for p in parts if p.conv_id == key]
        assert [(m.content, m.role) for p in own for m in p.messages] == want
        assert [p.is_first for p in own] == [True] + [False] * (len(own) - 1)
        assert [p.is_last for p in own] == [False] * (len(own) - 1) + [True]
        whole = json.loads("".join(b.body for b in bodies if b.conv_id == key))
        assert [(m["content"], m["role"]) for m in whole["input"]["messages"]] == want
    assert {p.conv_id for p in parts} == {b.conv_id for b in bodies} == {1, 2}


def test_a_part_of_a_conversation_is_no_request(turns):
    _, df = turns
    parts = requests.collect_messages(df, part_turns=8)
    made = requests.build_requests(parts, F.lit("m"), messages=F.col("messages"), whole=F.col("is_first") & F.col("is_last"))
    assert {(r.body, r.error) for r in made.collect()} == {(None, requests.PARTIAL)}
    with pytest.raises(ValueError):
        requests.build_requests(parts, F.lit("m"), messages=F.col("messages"))


def test_a_long_conversation_is_one_request(spark):
    df = spark.range(5000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"), F.lit("c").alias("call"),
    )
    extras = spark.createDataFrame([(1, "p")], "conv_id long, prompt string").withColumn(
        "history", F.array(F.struct(F.lit("b").alias("bot"), F.lit("u").alias("user")))
    ).withColumn("parameters", F.struct(F.lit(3).alias("top_k")))
    texts = set()
    for size in (100, 1024, 8192):
        made = requests.conversation_requests(df, F.lit("m"), tool_call_id="call", extras=extras, part_turns=size)
        texts.add("".join(r.body for r in made.orderBy("part").collect()))
    (text,) = texts
    whole = json.loads(text)
    assert [m["content"] for m in whole["input"]["messages"]] == [f"t{i}" for i in range(5000)]
    assert whole["input"]["messages"][0] == {"content": "t0", "role": "user", "tool_call_id": "c"}
    assert whole["input"]["prompt"] == "p" and whole["input"]["history"] == [{"bot": "b", "user": "u"}]
    assert whole["parameters"] == {"top_k": 3} and whole["model"] == "m"
    assert list(whole) == ["input", "model", "parameters"] and list(whole["input"]) == ["history", "messages", "prompt"]


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(3)
    rows = []
    for key in (1, 2, 3, None):
        for i in range(80):
            kind = "session.finished" if key != 3 and i in (30, 60) else rng.choice(["response.audio.delta", "response.done"])
            data = base64.b64encode(bytes([rng.randrange(256)])).decode()
            rows.append((key, i // 3 if i != 7 else None, json.dumps({"type": kind, "delta": data}), kind, data))
    df = spark.createDataFrame(rows, "session_id long, seq long, payload string, kind string, data string").repartition(3)
    return rows, sessions.route_events(df.select("session_id", "seq", "payload"))


@pytest.mark.parametrize("size", SIZES)
def test_sessions(events, size):
    rows, routed = events
    kept, late, audio = {None: sum(r[0] is None for r in rows)}, {}, {}
    for key in (1, 2, 3):
        own = [r for r in rows if r[0] == key and r[1] is not None]
        end = min((r[1] for r in own if r[3] == "session.finished"), default=None)
        read = [r for r in own if end is None or r[1] <= end]
        kept[key], late[key] = len(read) + sum(r[0] == key and r[1] is None for r in rows), len(own) - len(read)
        deltas = sorted((r[1], base64.b64decode(r[4])) for r in read if r[3] == "response.audio.delta")
        audio[key] = b"".join(d for _, d in deltas)
    got = sessions.until_finished(routed, slice_rows=size).groupBy("session_id").count().collect()
    assert {r.session_id: r["count"] for r in got} == kept
    counted = sessions.late_events(routed, slice_rows=size).collect()
    assert {r.session_id: r.n_late for r in counted} == {k: n for k, n in late.items() if n}
    parts = sessions.session_audio(routed, part_events=size, slice_rows=2 * size).orderBy("part").collect()
    assert {k: b"".join(bytes(p.audio) for p in parts if p.session_id == k) for k in audio} == audio
    assert {p.session_id for p in parts} == {1, 2, 3}
    assert {r.session_id for r in sessions.session_lifecycle(routed).collect()} == {1, 2, 3}


@pytest.mark.parametrize("size", SIZES)
def test_commands(events, size):
    rows, routed = events
    made = sessions.session_commands(routed.withColumnRenamed("payload", "text"), "v", slice_rows=size).collect()
    for key in (1, 2, 3):
        want = sorted((r[1], r[2]) for r in rows if r[0] == key and r[1] is not None)
        own = sorted((m for m in made if m.session_id == key), key=lambda m: m.cmd_seq)
        assert [m.cmd_seq for m in own] == list(range(len(want) + 2))
        assert [json.loads(m.payload)["text"] for m in own[1:-1]] == [t for _, t in want]
    assert {m.session_id for m in made} == {1, 2, 3}


@pytest.mark.parametrize("size", SIZES)
def test_lines_and_answers(spark, size):
    rng = random.Random(5)
    pieces = ["data: a", "b\n", "data:", " c\nda", "ta: d", "\n", "x\ndata: e\n"]
    rows = [(k, i // 2, rng.choice(pieces)) for k in (1, 2, None) for i in range(70)] + [(1, None, "data: lost\n")]
    df = spark.createDataFrame(rows, "request_id long, chunk_seq long, body string").repartition(3)
    got = responses.sse_data_lines(df, reassemble=True, slice_chunks=size).collect()
    for key in (1, 2):
        text = "".join(b for _, b in sorted((s, b) for k, s, b in rows if k == key and s is not None))
        want = [(n, line[5:].strip()) for n, line in enumerate(text.split("\n")) if line.startswith("data:")]
        assert sorted((r.line_no, r.json) for r in got if r.request_id == key) == want
    assert {r.request_id for r in got} == {1, 2}
    choice = "array<struct<message: struct<content: string, reasoning_content: string>>>"
    lines = [(k, s, n, [((f"c{s}{n}", "r" if s == 20 and n == 1 else None),)]) for k in (1, None) for s in range(30) for n in range(2)]
    good = spark.createDataFrame(lines, f"request_id long, chunk_seq long, line_no long, choices {choice}")
    (whole,) = {"".join(r.answer for r in responses.assemble_answers(good, part_chunks=p, slice_chunks=4 * p).orderBy("part").collect()) for p in (3, size)}
    assert whole == "".join(f"c{s}{n}" for s in range(30) for n in range(2))
    gated = responses.assemble_answers(good, compat=True, part_chunks=size, slice_chunks=size).orderBy("part").collect()
    assert "".join(r.answer for r in gated) == "".join(f"c{s}{n}" for s in range(30) for n in range(2) if (s, n) <= (20, 1))


def test_lines_without_a_place_are_kept_and_quarantined(spark):
    doc = {
        "request_id": "r", "output": {"choices": [{"finish_reason": "stop", "index": 0, "message": {"content": "c", "role": "a"}}]},
        "usage": {"input_tokens": 1, "output_tokens": 2, "total_tokens": 3, "output_tokens_details": {}, "prompt_tokens_details": {}},
    }
    body = f"data: {json.dumps(doc)}\n"
    rows = [(1, 0, body), (None, 0, body), (None, None, body + body), (1, None, body)]
    lines = responses.sse_data_lines(spark.createDataFrame(rows, "request_id long, chunk_seq long, body string"))
    assert lines.count() == 5
    good, bad = split_errors(responses.parse_responses(lines))
    assert [(r.request_id, r.chunk_seq) for r in good.collect()] == [(1, 0)]
    assert [r.error for r in bad.collect()] == ["place"] * 4


def test_rows_without_a_place_are_visible(spark, events):
    rows, routed = events
    lost = [r for r in rows if r[0] is None or r[1] is None]
    found = ordering.unplaced(routed, "session_id", "seq").collect()
    assert sorted((str(r.session_id), str(r.seq)) for r in found) == sorted((str(r[0]), str(r[1])) for r in lost)
    assert {r.error for r in found} == {"place"}
    counts = {r.missing: r.n for r in ordering.place_counts(routed, "session_id", "seq").collect()}
    assert counts == {
        "both": sum(r[0] is None and r[1] is None for r in rows), "key": sum(r[0] is None and r[1] is not None for r in rows),
        "position": sum(r[0] is not None and r[1] is None for r in rows), None: len(rows) - len(lost),
    }
    observation = Observation("places")
    sessions.late_events(ordering.watched(routed, observation, "session_id", "seq")).collect()
    assert observation.get == {"n_rows": len(rows), "n_unplaced": len(lost)}


@pytest.mark.parametrize("rows", [2, 5, 1 << 14])
@pytest.mark.parametrize("levels", [0, 1, 2])
def test_last_value(spark, rows, levels):
    rng = random.Random(rows)
    data = [(k, rng.randrange(60), rng.choice(["x", "y", "z"]), rng.choice([None, None, None, 1, 2, 3])) for k in (1, 2, None) for _ in range(50)]
    data = list({r[:3]: r for r in data}.values()) + [(1, None, "x", 5)]
    df = spark.createDataFrame(data, "k long, p long, t string, v long").repartition(3)
    found = ordering.with_last(df, ["k"], "p", F.col("v"), "last", rows=rows, levels=levels, then_by=["t"]).collect()
    want = []
    for key in (1, 2):
        last = None
        for r in sorted((r for r in ((p, t, v) for k, p, t, v in data if k == key and p is not None)), key=lambda r: r[:2]):
            last = r[2] if r[2] is not None else last
            want.append((key, *r[:2], last))
    assert sorted((r.k, r.p, r.t, r["last"]) for r in found) == sorted(want)
