import json

import pytest
from pyspark.sql import functions as F

from tablewire.operators import requests


@pytest.fixture(scope="module")
def turns(spark):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", 'say "hello"'),
        (1, 3, "user", "and?"), (1, 4, "user", "well?"), (1, 5, "assistant", "no"),
        (2, 1, "assistant", "first"), (2, 2, "user", "alone"),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def test_messages_are_ordered_and_whole(turns):
    for size in (1, 2, 4, 1024):
        parts = requests.collect_messages(turns, part_turns=size).collect()
        said = [m["content"] for p in sorted(parts, key=lambda p: p["part"]) if p["conv_id"] == 1 for m in p["messages"]]
        assert said == ["be brief", "hi", 'say "hello"', "and?", "well?", "no"]
        assert max(len(p["messages"]) for p in parts) <= size


def test_history_pairs_across_slices(turns):
    for size in (1, 2, 3, 1024):
        pairs = requests.history_pairs(turns, slice_turns=size).collect()
        assert sorted((p["conv_id"], p["turn"], p["user"], p["bot"]) for p in pairs) == [
            (1, 1, "hi", 'say "hello"'), (1, 4, "well?", "no"),
        ]


def body(spark, **parts):
    row = requests.build_requests(spark.range(1), F.lit("m"), **parts).first()
    return row["body"], row["error"]


def test_body_keys_are_alphabetical_and_absent_parts_left_out(spark):
    history = F.array(F.struct(F.lit("b").alias("bot"), F.lit("u").alias("user")))
    text, error = body(spark, prompt=F.lit("p"), history=history)
    assert error is None
    assert text == '{"input":{"history":[{"bot":"b","user":"u"}],"prompt":"p"},"model":"m","parameters":{}}'


def test_tool_call_id_only_where_given(spark):
    df = spark.createDataFrame([(1, 0, "user", "q", None), (1, 1, "tool", "r", "c1")], "conv_id long, turn long, role string, text string, call string")
    parts = requests.collect_messages(df, tool_call_id="call", part_turns=1024)
    text = requests.build_requests(parts, F.lit("m"), messages=F.col("messages"), whole=F.col("is_first") & F.col("is_last")).first()["body"]
    assert json.loads(text)["input"]["messages"] == [
        {"content": "q", "role": "user"}, {"content": "r", "role": "tool", "tool_call_id": "c1"},
    ]


def test_neither_prompt_nor_messages(spark):
    assert body(spark) == (None, requests.NO_INPUT)
    assert body(spark, history=F.array(F.struct(F.lit("b").alias("bot")))) == (None, requests.NO_INPUT)
    none = F.lit(None).cast("string")
    assert body(spark, prompt=none) == (None, requests.NO_INPUT)


@pytest.mark.parametrize("size", [1, 2, 4, 1024])
def test_pieces_join_to_one_json_text(spark, turns, size):
    pieces = requests.conversation_requests(turns, F.lit('m"x'), part_turns=size).collect()
    for conv, first in ((1, "be brief"), (2, "first")):
        text = "".join(p["body"] for p in sorted(pieces, key=lambda p: p["part"]) if p["conv_id"] == conv)
        parsed = json.loads(text)
        assert parsed["model"] == 'm"x' and parsed["parameters"] == {}
        assert parsed["input"]["messages"][0]["content"] == first
        assert len(parsed["input"]["messages"]) == {1: 6, 2: 2}[conv]


def parse(spark, text):
    return requests.parse_parameters(spark.createDataFrame([(text,)], "params string")).first()


def test_stop_union(spark):
    assert parse(spark, '{"stop":["[1]","b"]}')["stop_strings"] == ["[1]", "b"]
    row = parse(spark, '{"stop":[[1,2],[]]}')
    assert row["stop_ids"] == [[1, 2], []] and row["stop_strings"] is None
    assert parse(spark, '{"stop":[]}')["stop_strings"] == []
    assert parse(spark, '{"stop":null}')["error"] is None
    for bad in ('{"stop":["a",1]}', '{"stop":[[1],"a"]}', '{"stop":"a"}', '{"stop":[[3000000000]]}', '{"stop":[[1.5]]}', '{"stop":[null]}'):
        assert parse(spark, bad)["error"] == "json:stop"


@pytest.mark.parametrize(
    "text,error",
    [
        ("{}", None), ('{"top_k":4294967295}', None), ('{"top_k":4294967296}', "json:top_k"),
        ('{"max_tokens":-1}', "json:max_tokens"), ('{"max_tokens":1.0}', "json:max_tokens"),
        ('{"temperature":1}', None), ('{"temperature":"1"}', "json:temperature"), ('{"stream":1}', "json:stream"),
        ('{"result_format":5}', "json:result_format"), ('{"other":{"a":1}}', None), ("[1]", "json:text"), ("{", "json:text"), (None, "json:text"),
    ],
)
def test_option_types(spark, text, error):
    assert parse(spark, text)["error"] == error


def test_options_go_back_into_a_request(spark):
    df = spark.createDataFrame(
        [('{"stop":[[1,2]],"top_p":0.5}',), ('{"stop":["x"],"stream":false}',), ("{}",)], "params string"
    )
    out = requests.build_requests(
        requests.parse_parameters(df).drop("error"), F.lit("m"), F.lit("p"), params=requests.parameters_struct()
    )
    assert [json.loads(r["body"])["parameters"] for r in out.collect()] == [
        {"stop": [[1, 2]], "top_p": 0.5}, {"stop": ["x"], "stream": False}, {},
    ]


TOOL = "tool string, tool_type string, description string, param string, param_type string, prop_type string, prop_description string, pos int"


def test_tools_last_parameter_wins(spark):
    df = spark.createDataFrame(
        [
            ("t", "function", "d", "b", "object", "string", "old", 0), ("t", "function", "d", "a", "object", "int", "A", 1),
            ("t", "function", "d2", "b", "object", "string", "new", 2), ("empty", "function", "e", None, None, None, None, 0),
        ],
        TOOL,
    )
    specs = {r["tool"]: json.loads(r["spec"]) for r in requests.build_tool_specs(df, part_params=1024).collect()}
    assert specs["t"]["function"] == {
        "description": "d2", "name": "t",
        "parameters": {
            "a": {"properties": {"description": "A", "type": "int"}, "type": "object"},
            "b": {"properties": {"description": "new", "type": "string"}, "type": "object"},
        },
    }
    assert specs["t"]["type"] == "function" and specs["empty"]["function"]["parameters"] == {}


def test_a_large_tool_comes_in_parts(spark):
    df = spark.range(500).selectExpr(
        "'big' tool", "'function' tool_type", "'d' description", "concat('p', id % 100) param",
        "'object' param_type", "'string' prop_type", "cast(id as string) prop_description", "cast(id as int) pos",
    )
    rows = requests.build_tool_specs(df, part_params=10).collect()
    names = [n for r in rows for n in json.loads(r["spec"])["function"]["parameters"]]
    assert len(rows) > 5 and len(names) == len(set(names)) == 100
