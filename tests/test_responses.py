import json

import pytest

from tablewire.operators import responses
from tablewire.operators.quality import split_errors


def answer(content="", reasoning=None, finish="null", **over):
    message = {"content": content, "role": "assistant"}
    if reasoning is not None:
        message["reasoning_content"] = reasoning
    doc = {
        "request_id": "r",
        "output": {"choices": [{"finish_reason": finish, "index": 0, "message": message}]},
        "usage": {
            "input_tokens": 1, "output_tokens": 2, "total_tokens": 3,
            "output_tokens_details": {}, "prompt_tokens_details": {"cached_tokens": 4},
        },
    }
    doc.update(over)
    return doc


def lines(spark, *docs):
    rows = [("q", i, 0, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "request_id string, chunk_seq long, line_no long, json string")


def errors(spark, *docs):
    return [r["error"] for r in responses.parse_responses(lines(spark, *docs)).orderBy("chunk_seq").collect()]


def test_lines(spark):
    body = "id:1\r\ndata: {\"a\":1} \t\r\n data:no\nDATA:no\ndata:　{\"b\":2} \n\ndata:last"
    df = spark.createDataFrame([("q", 5, body)], "request_id string, chunk_seq long, body string")
    rows = responses.sse_data_lines(df).orderBy("line_no").collect()
    assert [(r["line_no"], r["json"]) for r in rows] == [(1, '{"a":1}'), (4, '{"b":2}'), (6, "last")]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_reassembly_at_any_cut(spark, size):
    texts = {"q": "id:1\r\ndata: one\r\n\r\ndata:two\n" * 5, "w": "data:" + "x" * 120, "e": "\n\n\ndata:é\n"}
    rows = [
        (key, i, text[at : at + size]) for key, text in texts.items() for i, at in enumerate(range(0, len(text), size))
    ]
    df = spark.createDataFrame(rows, "request_id string, chunk_seq long, body string").repartition(3)
    got = {
        (r["request_id"], r["line_no"]): r["json"] for r in responses.sse_data_lines(df, reassemble=True, slice_chunks=4).collect()
    }
    expected = {
        (key, n): line[5:].strip()
        for key, text in texts.items()
        for n, line in enumerate(text.split("\n"))
        if line.startswith("data:")
    }
    assert got == expected


def test_good_and_optional(spark):
    extra = answer("x", None, unknown={"z": 1})
    extra["output"]["choices"][0]["message"]["tool_calls"] = None
    assert errors(spark, answer("x"), answer("x", ""), extra) == [None, None, None]


def broken(path, value="delete"):
    doc = answer("x")
    at = doc
    for key in path[:-1]:
        at = at[key]
    if value == "delete":
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return doc


CHOICE = ("output", "choices", 0)


@pytest.mark.parametrize(
    "doc,error",
    [
        ("{bad", "json:text"), ("", "json:text"), ("5", "json:request_id"),
        (broken(["request_id"]), "json:request_id"), (broken(["request_id"], 5), "json:request_id"),
        (broken(["output"]), "json:choices"), (broken(["output", "choices"], []), "json:choices"),
        (broken([*CHOICE, "finish_reason"], None), "json:choice"), (broken([*CHOICE, "index"], 1.5), "json:choice"),
        (broken([*CHOICE, "index"], 2**31), "json:choice"), (broken([*CHOICE, "message", "content"], 1), "json:choice"),
        (broken([*CHOICE, "message", "role"]), "json:choice"), (broken([*CHOICE, "message", "reasoning_content"], 1), "json:choice"),
        (broken([*CHOICE, "message", "tool_calls"], [{"id": "a"}]), "json:choice"),
        (broken(["usage", "total_tokens"]), "json:usage"), (broken(["usage", "input_tokens"], "1"), "json:usage"),
        (broken(["usage", "output_tokens_details"]), "json:usage"),
        (broken(["usage", "prompt_tokens_details"], {"cached_tokens": "x"}), "json:usage"),
    ],
)
def test_strict(spark, doc, error):
    assert errors(spark, doc) == [error]


def test_a_bad_line_does_not_take_the_others(spark):
    good, bad = split_errors(responses.parse_responses(lines(spark, answer("a"), "{", answer("b"))))
    assert good.count() == 2 and bad.count() == 1
    assert responses.assemble_answers(good).first()["answer"] == "ab"


def assembled(spark, docs, **how):
    good, _ = split_errors(responses.parse_responses(lines(spark, *docs).repartition(3)))
    parts = responses.assemble_answers(good, **how).orderBy("part").collect()
    return "".join(p["answer"] for p in parts), "".join(p["reasoning"] for p in parts)


def test_reasoning_first_models_keep_their_answer(spark):
    docs = [answer("", "think "), answer("", "more"), answer("the "), answer("answer", finish="stop")]
    assert assembled(spark, docs) == ("the answer", "think more")
    assert assembled(spark, docs, compat=True) == ("", "think more")


@pytest.mark.parametrize("size", [1, 2, 1024])
def test_the_gate_keeps_the_line_that_has_both(spark, size):
    docs = [answer("a"), answer("b", ""), answer("c", "why"), answer("d"), answer("e", "so")]
    assert assembled(spark, docs, part_chunks=size) == ("abcde", "whyso")
    assert assembled(spark, docs, compat=True, part_chunks=size, slice_chunks=size) == ("abc", "whyso")


def test_usage_of_the_last_finished_chunk(spark):
    second = answer("", finish="length")
    second["usage"]["output_tokens"] = 9
    docs = [answer("a"), answer("", finish="stop"), second, answer("tail")]
    good, _ = split_errors(responses.parse_responses(lines(spark, *docs)))
    row = responses.final_usage(good).first()
    assert (row["output_tokens"], row["cached_tokens"], row["reasoning_tokens"]) == (9, 4, None)


def test_unfinished_answers_have_no_usage(spark):
    good, _ = split_errors(responses.parse_responses(lines(spark, answer("a"))))
    assert responses.final_usage(good).isEmpty()


def test_tool_calls(spark):
    doc = answer("")
    doc["output"]["choices"][0]["message"]["tool_calls"] = [
        {"function": {"arguments": {"a": "1", "b": "2"}, "name": "f"}, "id": "c0", "index": 0, "type": "function"},
        {"function": {"arguments": {}, "name": "g"}, "id": "c1", "index": 1, "type": "function"},
    ]
    good, _ = split_errors(responses.parse_responses(lines(spark, doc, answer("none"))))
    rows = [tuple(r)[1:] for r in responses.explode_tool_calls(good).orderBy("call_index", "arg").collect()]
    assert rows == [
        (0, "c0", "function", "f", "a", "1"), (0, "c0", "function", "f", "b", "2"), (1, "c1", "function", "g", None, None),
    ]


def test_the_text_is_parsed_once(spark, plan):
    good, _ = split_errors(responses.parse_responses(lines(spark, answer("a"))))
    assert plan(responses.assemble_answers(good)).count("parse_json") <= 1
