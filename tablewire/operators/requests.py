"""Model requests from conversation tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewire.functions import strict_json as sj
from tablewire.functions.once import with_once
from tablewire.functions.ordering import SLICE_ROWS, placed, slice_of, with_next
from tablewire.operators.quality import first_error

PART = "part"
NO_INPUT = "json:prompt_and_messages_missing"
PARTIAL = "json:partial_conversation"


def collect_messages(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tool_call_id: str | None = None,
    *,
    part_turns: int,
) -> DataFrame:
    """``(conv, part, messages, is_first, is_last)``: the ordered messages of each conversation.

    A part holds the turns of one range of ``part_turns`` turn numbers, so no row
    grows without bound; the caller chooses the length.  A row is a whole conversation
    where it is both first and last.  Turns that share a number are ordered by their
    text; turns without a conversation or a number are left out.
    """
    df = placed(df, conv, turn)
    call = F.lit(None).cast("string") if tool_call_id is None else F.col(tool_call_id)
    message = F.struct(
        F.col(text).alias("content"), F.col(role).alias("role"), call.alias("tool_call_id")
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("at"), message.alias("message"))))
    part = slice_of(turn, part_turns)
    parts = df.groupBy(conv, part.alias(PART)).agg(ordered.alias("_ordered"))
    ends = df.groupBy(conv).agg(F.min(part).alias("_first"), F.max(part).alias("_last"))
    # The ends come back under the key of the part, not under the conversation,
    # which keeps the rows of a long conversation spread.
    edges = ends.select(
        conv,
        F.inline(F.array_distinct(F.array(*[
            F.struct(F.col(at).alias(PART), (F.col(at) == F.col("_first")).alias("_opens"), (F.col(at) == F.col("_last")).alias("_closes"))
            for at in ("_first", "_last")
        ]))),
    )
    return parts.join(edges, [conv, PART], "left").select(
        conv,
        PART,
        F.transform("_ordered", lambda m: m["message"]).alias("messages"),
        F.coalesce("_opens", F.lit(False)).alias("is_first"),
        F.coalesce("_closes", F.lit(False)).alias("is_last"),
    )


def history_pairs(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    slice_turns: int = SLICE_ROWS,
) -> DataFrame:
    """``(conv, turn, user, bot)``: each user turn followed by an assistant turn.

    Turns that share a number are ordered by role and text; turns without a
    conversation or a number are left out.
    """
    following = F.struct(F.col(role).alias("role"), F.col(text).alias("text"))
    paired = with_next(df.select(conv, turn, role, text), [conv], turn, following, "_next", slice_turns, then_by=[role, text])
    return paired.where((F.col(role) == "user") & (F.col("_next.role") == "assistant")).select(
        conv, turn, F.col(text).alias("user"), F.col("_next.text").alias("bot")
    )


# -- options --------------------------------------------------------------

# The request options and their JSON types.
OPTIONS = {
    "stream": ("boolean", sj.is_boolean),
    "temperature": ("double", sj.is_number),
    "top_p": ("double", sj.is_number),
    "top_k": ("bigint", sj.is_uint32),
    "enable_search": ("boolean", sj.is_boolean),
    "customized_model_id": ("string", sj.is_string),
    "result_format": ("string", sj.is_string),
    "incremental_output": ("boolean", sj.is_boolean),
    "max_tokens": ("bigint", sj.is_uint32),
    "repetition_penalty": ("double", sj.is_number),
}


def _stop_lists(doc: Column) -> tuple[Column, Column]:
    """``stop`` as strings and as id sequences; an empty list counts as strings."""
    path = "$.stop"
    items = sj.elements(doc, path)
    strings = F.forall(items, lambda i: sj.is_string(i, "$"))
    sequences = F.forall(
        items,
        lambda i: F.coalesce(
            F.forall(sj.elements(i, "$"), lambda n: sj.is_int32(n, "$")), F.lit(False)
        ),
    )
    return (
        F.when(strings, F.try_variant_get(doc, path, "array<string>")),
        F.when(~strings & sequences, F.try_variant_get(doc, path, "array<array<int>>")),
    )


def parse_parameters(df: DataFrame, json_col: str = "params") -> DataFrame:
    """Add the eleven options of ``json_col`` and ``error``.

    ``stop`` becomes ``stop_strings`` or ``stop_ids``.  Missing and null options
    are null, unknown keys are ignored.  A value of another JSON type, or outside
    the unsigned 32-bit range where one is required, is null and gives
    ``json:<option>``.
    """
    parsed = with_once(df, "_doc", sj.parse(F.col(json_col)))
    doc = F.col("_doc")
    strings, sequences = _stop_lists(doc)
    values = {
        name: F.when(check(doc, f"$.{name}"), F.try_variant_get(doc, f"$.{name}", kind))
        for name, (kind, check) in OPTIONS.items()
    }
    checks = {"json:text": sj.is_object(doc, "$")}
    for name, (_, check) in OPTIONS.items():
        checks[f"json:{name}"] = sj.optional(check, doc, f"$.{name}")
    out = parsed.withColumns({**values, "stop_strings": strings, "stop_ids": sequences})
    checks["json:stop"] = (
        sj.absent(doc, "$.stop") | F.col("stop_strings").isNotNull() | F.col("stop_ids").isNotNull()
    )
    return with_once(out, "error", first_error(checks)).drop("_doc")


def parameters_struct() -> Column:
    """The parsed options as one struct with alphabetical fields, for a request."""
    stop = F.coalesce(
        F.to_variant_object(F.col("stop_strings")), F.to_variant_object(F.col("stop_ids"))
    )
    fields = {name: F.col(name) for name in OPTIONS} | {"stop": stop}
    return F.struct(*[fields[name].alias(name) for name in sorted(fields)])


# -- request bodies -------------------------------------------------------


def _no_parameters() -> Column:
    return F.struct(F.lit(None).cast("boolean").alias("stream"))


def build_requests(
    df: DataFrame,
    model: Column,
    prompt: Column | None = None,
    history: Column | None = None,
    messages: Column | None = None,
    params: Column | None = None,
    whole: Column | None = None,
) -> DataFrame:
    """Add ``body`` (JSON text) and ``error``.

    Keys are in alphabetical order and absent parts are left out.  A row with
    neither prompt nor messages has no body but an error.  One row is one request:
    with messages, ``whole`` must tell whether the row holds all of them (of the
    result of ``collect_messages``: ``is_first`` and ``is_last``), and a row that
    does not has an error instead of a truncated body.  Longer conversations go
    through ``conversation_requests``.
    """
    if messages is not None and whole is None:
        raise ValueError("messages need whole: whether a row holds the whole conversation")
    parts = {"history": history, "messages": messages, "prompt": prompt}
    given = {name: part for name, part in parts.items() if part is not None}
    inputs = (
        F.struct(*[part.alias(name) for name, part in given.items()])
        if given
        else F.struct(F.lit(None).cast("string").alias("prompt"))
    )
    body = F.to_json(
        F.struct(
            inputs.alias("input"),
            model.alias("model"),
            (_no_parameters() if params is None else params).alias("parameters"),
        )
    )
    needed = [part for part in (prompt, messages) if part is not None]
    has_input = reduce(lambda a, b: a | b, [p.isNotNull() for p in needed], F.lit(False))
    partial = F.lit(False) if messages is None else messages.isNotNull() & ~whole
    return df.withColumns(
        {
            "body": F.when(has_input & ~partial, body),
            "error": F.when(~has_input, F.lit(NO_INPUT)).when(partial, F.lit(PARTIAL)),
        }
    )


def conversation_requests(
    turns: DataFrame,
    model: Column,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tool_call_id: str | None = None,
    params: Column | None = None,
    extras: DataFrame | None = None,
    *,
    part_turns: int,
) -> DataFrame:
    """``(conv, part, body)``: one request per conversation, from its turns.

    ``model`` and ``params`` are constants or columns made of constants.  What differs
    from one conversation to the next comes from ``extras``: one row per conversation
    with any of ``prompt``, ``history`` and ``parameters``, which replace the constants
    where they are there.

    The pieces of a conversation, joined in the order of ``part``, are the JSON
    text.  A conversation within ``part_turns`` turn numbers is a single piece; a
    longer one is spread over pieces, so that no task has to hold all of it.
    """
    parts = collect_messages(turns, conv, turn, role, text, tool_call_id, part_turns=part_turns)
    fixed = _no_parameters() if params is None else params
    given: list[str] = []
    if extras is not None:
        given = [c for c in ("history", "prompt", "parameters") if c in extras.columns]
        edges = parts.where("is_first OR is_last").select(conv, PART)
        own = edges.join(extras.select(conv, *[F.col(c).alias(f"_{c}") for c in given]), conv)
        parts = parts.join(own, [conv, PART], "left")

    def fields(column: str) -> Column:
        """The inside of a JSON object with one key, empty where the value is null."""
        whole = F.to_json(F.struct(F.col(f"_{column}").alias(column)))
        return F.substring(whole, F.lit(2), F.length(whole) - 2)

    none = F.lit("")
    history = F.when(F.col("_history").isNotNull(), F.concat(fields("history"), F.lit(","))).otherwise(none) if "history" in given else none
    prompt = F.when(F.col("_prompt").isNotNull(), F.concat(F.lit(","), fields("prompt"))).otherwise(none) if "prompt" in given else none
    options = F.to_json(fixed)
    if "parameters" in given:
        options = F.coalesce(F.to_json("_parameters"), options)
    named = F.to_json(F.struct(model.alias("model")))
    tail = F.concat(
        F.lit("]"), prompt, F.lit("},"), F.substring(named, F.lit(2), F.length(named) - 2), F.lit(',"parameters":'), options, F.lit("}")
    )
    listed = F.to_json("messages")
    return parts.select(
        conv,
        PART,
        F.concat(
            F.when(F.col("is_first"), F.concat(F.lit('{"input":{'), history, F.lit('"messages":['))).otherwise(F.lit(",")),
            F.substring(listed, F.lit(2), F.length(listed) - 2),
            F.when(F.col("is_last"), tail).otherwise(none),
        ).alias("body"),
    )


# -- tools ----------------------------------------------------------------


def build_tool_specs(df: DataFrame, part_params: int) -> DataFrame:
    """``(tool, part, spec)`` from one row per parameter of a tool.

    Input columns: ``tool, tool_type, description, param, param_type, prop_type,
    prop_description, pos``.  A parameter given twice keeps its last value by
    ``pos``, of equal ones the greatest by its content.  A tool with more than ``part_params`` names comes as several rows,
    whose ``parameters`` objects together are the whole; others are one row, part 0.
    """
    value = F.struct(
        F.struct(
            F.col("prop_description").alias("description"), F.col("prop_type").alias("type")
        ).alias("properties"),
        F.col("param_type").alias("type"),
    )
    # Repeats collapse before anything is collected, whatever their number.
    head = F.struct("tool_type", "description")
    params = df.groupBy("tool", "param").agg(
        F.max(F.struct("pos", value.alias("value")))["value"].alias("value"),
        F.max(F.struct("pos", head.alias("head"))).alias("_head"),
    )
    stats = params.groupBy("tool").agg(
        F.max("_head")["head"].alias("head"),
        F.ceil(F.count(F.lit(1)) / F.lit(part_params)).alias("_parts"),
    )
    # A tool with very many names is a skewed key of this join only; adaptive
    # execution splits it, the side of the tools has one row each.
    tools = (
        params.join(stats, "tool")
        .withColumn(PART, F.pmod(F.xxhash64("param"), F.col("_parts")))
        .groupBy("tool", PART)
        .agg(
            F.array_sort(F.collect_list(F.struct("param", "value"))).alias("params"),
            F.first("head").alias("head"),
        )
    )
    named = F.filter("params", lambda p: p["param"].isNotNull())
    function = F.struct(
        F.col("head.description").alias("description"),
        F.col("tool").alias("name"),
        F.map_from_entries(named).alias("parameters"),
    )
    spec = F.to_json(F.struct(function.alias("function"), F.col("head.tool_type").alias("type")))
    return tools.select("tool", PART, spec.alias("spec"))
