"""One key holds a third of all rows; every operator against brute force in Python."""

import base64
import json
import random

import pytest
from pyspark.sql import functions as F

from tablewire.operators import requests, responses, sessions
from tablewire.operators.quality import split_errors

HOT, OTHERS = 1500, 60


@pytest.fixture(scope="module")
def lengths():
    rng = random.Random(3)
    return {0: HOT} | {k: rng.randint(1, 2 * HOT * 2 // OTHERS) for k in range(1, OTHERS)}


def most_rows_per_group(df, *keys):
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0]


@pytest.fixture(scope="module")
def turns(spark, lengths):
    rng = random.Random(4)
    rows = [
        (k, t, rng.choice(["user", "assistant", "tool"]), f"{k}:{t}") for k, n in lengths.items() for t in range(n)
    ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)


def by_key(rows):
    out = {}
    for row in sorted(rows):
        out.setdefault(row[0], []).append(row)
    return out


def test_messages(turns):
    rows, df = turns
    parts = requests.collect_messages(df, part_turns=64)
    assert parts.agg(F.max(F.size("messages"))).first()[0] <= 64
    got = {}
    for p in parts.orderBy("conv_id", "part").collect():
        got.setdefault(p["conv_id"], []).extend(m["content"] for m in p["messages"])
    assert got == {k: [r[3] for r in group] for k, group in by_key(rows).items()}


def test_request_text(turns):
    rows, df = turns
    got = {}
    for p in requests.conversation_requests(df, F.lit("m"), part_turns=64).orderBy("conv_id", "part").collect():
        got[p["conv_id"]] = got.get(p["conv_id"], "") + p["body"]
    for k, group in by_key(rows).items():
        assert [m["content"] for m in json.loads(got[k])["input"]["messages"]] == [r[3] for r in group]


def test_history(turns):
    rows, df = turns
    expected = [
        (a[0], a[1], a[3], b[3])
        for group in by_key(rows).values()
        for a, b in zip(group, group[1:])
        if (a[2], b[2]) == ("user", "assistant")
    ]
    got = requests.history_pairs(df, slice_turns=64).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_commands(turns):
    rows, df = turns
    segments = df.select(F.col("conv_id").alias("session_id"), (F.col("turn") * 3).alias("seq"), "text")
    got = sessions.session_commands(segments, "v", slice_rows=64).collect()
    numbers, texts = {}, {}
    for r in got:
        numbers.setdefault(r["session_id"], []).append(r["cmd_seq"])
        texts[r["session_id"], r["cmd_seq"]] = json.loads(r["payload"]).get("text")
    for k, group in by_key(rows).items():
        assert sorted(numbers[k]) == list(range(len(group) + 2))
        assert [texts[k, i + 1] for i in range(len(group))] == [r[3] for r in group]


@pytest.fixture(scope="module")
def events(spark, lengths):
    rng = random.Random(5)
    rows = []
    for k, n in lengths.items():
        end = rng.randrange(n * 2)
        for seq in range(n):
            if seq == end or rng.random() < 0.001:
                payload = json.dumps({"type": "session.finished"})
            else:
                data = base64.b64encode(f"{k}.{seq};".encode()).decode()
                payload = json.dumps({"type": "response.audio.delta", "delta": data})
            rows.append((k, seq, payload))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "session_id long, seq long, payload string").repartition(4)
    return rows, sessions.route_events(df)


def read(rows):
    out = {}
    for k, group in by_key(rows).items():
        ends = [seq for _, seq, payload in group if "finished" in payload]
        out[k] = [r for r in group if not ends or r[1] <= ends[0]]
    return out


def test_reading_and_lateness(events):
    rows, routed = events
    kept = sessions.until_finished(routed, slice_rows=64).select("session_id", "seq").collect()
    expected = read(rows)
    assert sorted(map(tuple, kept)) == sorted((k, r[1]) for k, group in expected.items() for r in group)
    late = {r["session_id"]: r["n_late"] for r in sessions.late_events(routed, slice_rows=64).collect()}
    whole = by_key(rows)
    assert late == {k: len(whole[k]) - len(g) for k, g in expected.items() if len(g) < len(whole[k])}


def test_audio(events):
    rows, routed = events
    parts = sessions.session_audio(routed, part_events=32, slice_rows=64)
    assert most_rows_per_group(parts, "session_id", "part") == 1
    got = {}
    for p in parts.orderBy("session_id", "part").collect():
        assert p["n_bytes"] <= 32 * len("59.1499;")
        got[p["session_id"]] = got.get(p["session_id"], b"") + bytes(p["audio"])
    for k, group in read(rows).items():
        deltas = [json.loads(r[2]).get("delta") for r in group]
        assert got.get(k, b"") == b"".join(base64.b64decode(d) for d in deltas if d)


def test_answers_and_lines(spark, lengths):
    rng = random.Random(6)
    docs, texts = [], {}
    for k, n in lengths.items():
        thinks = rng.randrange(2 * n)
        answer, gated, body = "", "", ""
        for i in range(n):
            said, thought = f"{k}.{i};", "hm" if i == thinks else ""
            answer += said
            gated += said if i <= thinks else ""
            message = {"content": said, "reasoning_content": thought, "role": "assistant"}
            doc = {
                "request_id": "r", "output": {"choices": [{"finish_reason": "null", "index": 0, "message": message}]},
                "usage": {
                    "input_tokens": 1, "output_tokens": 1, "total_tokens": 2,
                    "output_tokens_details": {}, "prompt_tokens_details": {},
                },
            }
            body += f"data:{json.dumps(doc)}\n"
        texts[str(k)] = (answer, gated)
        cuts = [0]
        while cuts[-1] < len(body):
            cuts.append(cuts[-1] + rng.randint(1, 900))
        docs += [(str(k), i, body[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "request_id string, chunk_seq long, body string").repartition(4)
    lines = responses.sse_data_lines(df, reassemble=True, slice_chunks=64)
    assert lines.count() == sum(lengths.values())
    good, bad = split_errors(responses.parse_responses(lines))
    assert bad.isEmpty()
    for compat, which in ((False, 0), (True, 1)):
        got = {}
        parts = responses.assemble_answers(good, compat=compat, part_chunks=32, slice_chunks=64)
        for p in parts.orderBy("request_id", "part").collect():
            got[p["request_id"]] = got.get(p["request_id"], "") + p["answer"]
        assert got == {k: v[which] for k, v in texts.items()}
