"""Streamed model responses: lines, strict parsing, answers, usage, tool calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewire.functions import strict_json as sj
from tablewire.functions.once import with_once
from tablewire.functions.ordering import (
    PART_ROWS,
    SLICE_COLUMN,
    SLICE_ROWS,
    parts_within_slices,
    placed,
    running_before,
    slice_of,
)
from tablewire.operators.quality import first_error

PART = "part"
PREFIX = "data:"
# The characters that count as white space around a JSON text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: the finish reason of a chunk that is not the last one.
UNFINISHED = "null"

# The shape of a response.
CHOICES_TYPE = (
    "array<struct<finish_reason:string,index:int,message:struct<content:string,"
    "reasoning_content:string,role:string,tool_calls:array<struct<function:struct<"
    "arguments:map<string,string>,name:string>,id:string,index:int,type:string>>>>>"
)
USAGE_TYPE = (
    "struct<input_tokens:int,output_tokens:int,"
    "output_tokens_details:struct<reasoning_tokens:int,cached_tokens:int>,"
    "prompt_tokens_details:struct<reasoning_tokens:int,cached_tokens:int>,total_tokens:int>"
)


def sse_data_lines(
    df: DataFrame,
    id_col: str = "request_id",
    chunk_seq: str = "chunk_seq",
    body: str = "body",
    reassemble: bool = False,
    slice_chunks: int = SLICE_ROWS,
) -> DataFrame:
    """``(id, chunk_seq, line_no, json)`` of the lines that start with ``data:``.

    Without ``reassemble`` each chunk is split on its own and ``line_no`` counts
    within the chunk.  With it a line may run over chunk borders; ``line_no``
    counts within the request and ``chunk_seq`` is where the line starts.  Only
    the pieces of one line meet in a group, never a whole request.  Chunks that
    share a number are joined in the order of their text.  Chunks without a request
    or a number cannot be joined: ``reassemble`` leaves them out, else their lines
    are kept like all others.
    """
    pieces = F.split(F.col(body), "\n")
    if reassemble:
        counted = running_before(
            placed(df, id_col, chunk_seq).select(id_col, chunk_seq, body),
            [id_col],
            chunk_seq,
            {"_lines_before": F.size(pieces) - 1},
            slice_chunks,
            then_by=[body],
        )
        exploded = counted.select(
            id_col, chunk_seq, body, "_lines_before", F.posexplode(pieces).alias("_at", "_piece")
        )
        lines = exploded.groupBy(
            id_col, (F.col("_lines_before") + F.col("_at")).alias("line_no")
        ).agg(
            F.min(chunk_seq).alias(chunk_seq),
            F.expr(f"listagg(_piece, '') WITHIN GROUP (ORDER BY `{chunk_seq}`, `{body}`)").alias("_line"),
        )
    else:
        lines = df.select(id_col, chunk_seq, F.posexplode(pieces).alias("line_no", "_line"))
    text = F.substring(F.col("_line"), F.lit(len(PREFIX) + 1), F.length("_line"))
    return lines.where(F.col("_line").startswith(PREFIX)).select(
        id_col,
        chunk_seq,
        F.col("line_no").cast("long").alias("line_no"),
        F.btrim(text, F.lit(WHITE_SPACE)).alias("json"),
    )


def _all(items: Column, check) -> Column:
    return F.coalesce(F.forall(items, check), F.lit(False))


def _is_tool_call(call: Column) -> Column:
    return (
        sj.is_string(call, "$.function.name")
        & _all(F.map_values(sj.entries(call, "$.function.arguments")), lambda v: sj.is_string(v, "$"))
        & sj.is_string(call, "$.id")
        & sj.is_int32(call, "$.index")
        & sj.is_string(call, "$.type")
    )


def _is_choice(choice: Column) -> Column:
    calls = "$.message.tool_calls"
    return (
        sj.is_string(choice, "$.finish_reason")
        & sj.is_int32(choice, "$.index")
        & sj.is_string(choice, "$.message.content")
        & sj.is_string_or_absent(choice, "$.message.reasoning_content")
        & sj.is_string(choice, "$.message.role")
        & (sj.absent(choice, calls) | _all(sj.elements(choice, calls), _is_tool_call))
    )


def _is_usage(doc: Column) -> Column:
    good = F.lit(True)
    for name in ("input_tokens", "output_tokens", "total_tokens"):
        good = good & sj.is_int32(doc, f"$.usage.{name}")
    for details in ("output_tokens_details", "prompt_tokens_details"):
        good = good & sj.is_object(doc, f"$.usage.{details}")
        for name in ("reasoning_tokens", "cached_tokens"):
            good = good & sj.optional(sj.is_int32, doc, f"$.usage.{details}.{name}")
    return good


def _object(*fields: str) -> str:
    return "OBJECT<" + ", ".join(fields) + ">"


# The shape of a plain response as ``schema_of_variant`` writes it, fields in alphabetical order.
_CALL_SHAPE = _object(
    "function: " + _object(r"arguments: OBJECT<(\w+: STRING(, )?)*>", "name: STRING"), "id: STRING", "index: BIGINT", "type: STRING"
)
_MESSAGE_SHAPE = (
    "OBJECT<content: STRING(, reasoning_content: (STRING|VOID))?, role: STRING"
    f"(, tool_calls: (VOID|ARRAY<(VOID|{_CALL_SHAPE})>))?>"
)
_DETAILS_SHAPE = "OBJECT<((cached|reasoning)_tokens: (BIGINT|VOID)(, )?)*>"
_SHAPE = "^" + _object(
    "output: " + _object("choices: ARRAY<" + _object("finish_reason: STRING", "index: BIGINT", f"message: {_MESSAGE_SHAPE}") + ">"),
    "request_id: STRING",
    "usage: " + _object(
        "input_tokens: BIGINT", "output_tokens: BIGINT", f"output_tokens_details: {_DETAILS_SHAPE}",
        f"prompt_tokens_details: {_DETAILS_SHAPE}", "total_tokens: BIGINT",
    ),
) + "$"


def _is_plain(doc: Column, choices: Column, usage: Column) -> Column:
    """True for responses whose shape alone shows that every check holds.

    The shape of an array is that of all its elements together, so a type that
    does not fit shows in it, and a field that one element lacks is null in the
    typed value.
    """

    def call(c: Column) -> Column:
        function = c["function"]
        return (
            c["id"].isNotNull() & c["index"].isNotNull() & c["type"].isNotNull() & function["name"].isNotNull()
            & _all(F.map_values(function["arguments"]), lambda v: v.isNotNull())
        )

    def choice(c: Column) -> Column:
        message = c["message"]
        return (
            c["finish_reason"].isNotNull() & c["index"].isNotNull() & message["content"].isNotNull()
            & message["role"].isNotNull() & (message["tool_calls"].isNull() | _all(message["tool_calls"], call))
        )

    counts = [usage[name].isNotNull() for name in ("input_tokens", "output_tokens", "total_tokens")]
    shaped = F.schema_of_variant(doc).rlike(_SHAPE) & (F.size(choices) > 0)
    return F.coalesce(shaped & counts[0] & counts[1] & counts[2] & F.forall(choices, choice), F.lit(False))


def parse_responses(
    df: DataFrame, json_col: str = "json", id_col: str = "request_id", chunk_seq: str = "chunk_seq"
) -> DataFrame:
    """Add ``response_id, choices, usage`` and ``error``; ``split_errors`` parts them.

    The check is strict: a missing required field, a null there or a value of
    another JSON type is an error, named ``json:<part>``.  The checks, which read
    each field with its type, run only where the shape of the text leaves a doubt.
    A row without a request or a chunk number, where ``df`` has those columns, gets
    the error ``place``, for it belongs to no answer.
    """
    doc = F.col("_doc")
    choices = sj.elements(doc, "$.output.choices")
    place = F.lit(True)
    for c in (id_col, chunk_seq):
        if c in df.columns:
            place = place & F.col(c).isNotNull()
    checks = {
        "place": place,
        "json:text": doc.isNotNull(),
        "json:request_id": sj.is_string(doc, "$.request_id"),
        "json:choices": F.size(choices) > 0,
        "json:choice": F.forall(choices, _is_choice),
        "json:usage": _is_usage(doc),
    }
    parsed = with_once(df, "_doc", sj.parse(F.col(json_col)))
    typed = F.struct(
        F.try_variant_get(doc, "$.output.choices", CHOICES_TYPE).alias("choices"),
        F.try_variant_get(doc, "$.usage", USAGE_TYPE).alias("usage"),
    )
    read = with_once(parsed, "_typed", typed)
    plain = _is_plain(doc, F.col("_typed.choices"), F.col("_typed.usage"))
    checked = with_once(read, "error", F.when(~(plain & place), first_error(checks)))
    good = F.col("error").isNull()
    return checked.select(
        *df.columns,
        F.try_variant_get(doc, "$.request_id", "string").alias("response_id"),
        F.when(good, F.col("_typed.choices")).alias("choices"),
        F.when(good, F.col("_typed.usage")).alias("usage"),
        "error",
    )


def assemble_answers(
    good: DataFrame,
    id_col: str = "request_id",
    chunk_seq: str = "chunk_seq",
    compat: bool = False,
    part_chunks: int = PART_ROWS,
    slice_chunks: int = SLICE_ROWS,
) -> DataFrame:
    """``(id, part, answer, reasoning)``: deltas of the first choice in order.

    A part covers ``part_chunks`` chunk numbers; the texts of a request are its
    parts in order, and a request within that length is one row, part 0.  With
    ``compat`` content counts only up to the line that first has reasoning.
    """
    message = F.col("choices")[0]["message"]
    lines = placed(good, id_col, chunk_seq, "line_no").select(
        id_col,
        chunk_seq,
        "line_no",
        message["content"].alias("_content"),
        F.coalesce(message["reasoning_content"], F.lit("")).alias("_reasoning"),
    )
    keys = [id_col, slice_of(chunk_seq, part_chunks).alias(PART)]
    if compat:
        parts_within_slices(part_chunks, slice_chunks)
        keys.append(SLICE_COLUMN)
        lines = running_before(
            lines,
            [id_col],
            chunk_seq,
            {"_reasoned": F.when(F.col("_reasoning") != "", 1).otherwise(0)},
            slice_chunks,
            then_by=["line_no", "_content", "_reasoning"],
        ).withColumn("_content", F.when(F.col("_reasoned") == 0, F.col("_content")).otherwise(""))
    order = f"WITHIN GROUP (ORDER BY `{chunk_seq}`, line_no"
    texts = lines.groupBy(*keys).agg(
        F.expr(f"listagg(_content, '') {order}, _content)").alias("answer"),
        F.expr(f"listagg(_reasoning, '') {order}, _reasoning)").alias("reasoning"),
    )
    return texts.select(id_col, PART, "answer", "reasoning")


def final_usage(good: DataFrame, id_col: str = "request_id", chunk_seq: str = "chunk_seq") -> DataFrame:
    """Token counts of the last chunk that carries a finish reason, per request."""
    finished = good.where(F.col("choices")[0]["finish_reason"] != UNFINISHED)
    usage = finished.groupBy(id_col).agg(
        F.max_by("usage", F.struct(chunk_seq, "line_no")).alias("usage")
    )
    return usage.select(
        id_col,
        F.col("usage.input_tokens").alias("input_tokens"),
        F.col("usage.output_tokens").alias("output_tokens"),
        F.col("usage.total_tokens").alias("total_tokens"),
        F.col("usage.output_tokens_details.reasoning_tokens").alias("reasoning_tokens"),
        F.col("usage.prompt_tokens_details.cached_tokens").alias("cached_tokens"),
    )


def explode_tool_calls(good: DataFrame, id_col: str = "request_id") -> DataFrame:
    """One row per argument of every tool call; a call without arguments has one row."""
    choices = good.select(id_col, F.explode("choices").alias("_choice"))
    calls = choices.select(id_col, F.explode("_choice.message.tool_calls").alias("_call"))
    return calls.select(
        id_col,
        F.col("_call.index").alias("call_index"),
        F.col("_call.id").alias("call_id"),
        F.col("_call.type").alias("type"),
        F.col("_call.function.name").alias("name"),
        F.explode_outer("_call.function.arguments").alias("arg", "value"),
    )
