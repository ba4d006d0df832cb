"""Logs, events and requests derived from the given tables.

The tables hold conversations, pages, events and orders; the operators read
response logs, session messages, log lines and option texts.  These functions
express the second in terms of the first, row by row, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewire.operators.quality import ERROR_MESSAGES, NAMED_SERVICE

DELTA_CHARS = 40
PIECE_CHARS = (20, 180)
EVENTS_PER_TURN = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base64_text(data: Column) -> Column:
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))


def messy_urls(pages: DataFrame) -> DataFrame:
    """Every page URL with a repeated, empty, encoded and unordered query."""
    bare = F.substring_index("url", "#", 1)
    joint = F.when(F.contains(bare, F.lit("?")), "&").otherwise("?")
    extra = F.concat(
        F.lit("b=2&a=1&b=&page="), F.col("page_id").cast("string"), F.lit("&x=a+b%2Fc&&z#part")
    )
    return pages.select("page_id", F.concat(bare, joint, extra).alias("url"))


def rough_urls(pages: DataFrame) -> DataFrame:
    """Every page URL in capitals, with a port, segments to resolve, and white space around it."""
    shape = r"^([a-z]+)://([^/?#]*)(.*)$"
    ports = F.array(*[F.lit(p) for p in ("", ":443", ":80", ":8080")])
    more = F.array(*[F.lit(p) for p in ("", "/x/..", "/./%2e", "/y/%2E%2e/z/.", "/%7e%C3%a9", "/a/../..")])
    origin = F.upper(F.concat(F.regexp_extract("url", shape, 1), F.lit("://"), F.regexp_extract("url", shape, 2)))
    port, extra = (F.element_at(a, (F.col("page_id") % n + 1).cast("int")) for a, n in ((ports, 4), (more, 6)))
    return pages.select("page_id", F.concat(F.lit("  "), origin, port, extra, F.regexp_extract("url", shape, 3), F.lit("\t")).alias("url"))


def without_places(df: DataFrame, key: str, position: str) -> DataFrame:
    """``df`` with the key, the position, or both missing in three of eleven rows."""
    kind = (F.col(key) * 7 + F.col(position)) % 11
    holed = {key: F.when(~kind.isin(3, 8), F.col(key)), position: F.when(~kind.isin(5, 8), F.col(position))}
    return df.select(*[holed[c].alias(c) if c in holed else F.col(c) for c in df.columns])


# -- response logs --------------------------------------------------------


def _response_json(index: Column, last: Column) -> Column:
    conv, turn = F.col("conv_id"), F.col("turn")
    content = F.substring(F.col("text"), index * DELTA_CHARS + 1, F.lit(DELTA_CHARS))
    reasons = conv % 3 == 0
    call = F.struct(
        F.struct(
            F.create_map(
                F.lit("city"), F.concat(F.lit("c"), conv.cast("string")),
                F.lit("day"), F.concat(F.lit("d"), turn.cast("string")),
            ).alias("arguments"),
            F.lit("lookup").alias("name"),
        ).alias("function"),
        F.concat(F.lit("call-"), turn.cast("string")).alias("id"),
        F.lit(0).alias("index"),
        F.lit("function").alias("type"),
    )
    message = F.struct(
        content.alias("content"),
        F.when(reasons & (index == 1), F.concat(F.lit("thinking "), turn.cast("string")))
        .otherwise("")
        .alias("reasoning_content"),
        F.lit("assistant").alias("role"),
        F.when((conv % 4 == 1) & (index == last), F.array(call)).alias("tool_calls"),
    )
    choice = F.struct(
        F.when(index == last, "stop").otherwise("null").alias("finish_reason"),
        F.lit(0).alias("index"),
        message.alias("message"),
    )
    usage = F.struct(
        (turn + 10).alias("input_tokens"),
        (index + 1).alias("output_tokens"),
        F.struct(F.when(reasons, index + 1).alias("reasoning_tokens")).alias("output_tokens_details"),
        F.struct(turn.alias("cached_tokens")).alias("prompt_tokens_details"),
        (turn + index + 11).alias("total_tokens"),
    )
    return F.to_json(
        F.struct(
            F.struct(F.array(choice).alias("choices")).alias("output"),
            F.col("request_id"),
            usage.alias("usage"),
        )
    )


def _sse(index: Column, json: Column) -> Column:
    number = (index + 1).cast("string")
    return F.concat(F.lit("id:"), number, F.lit("\nevent:result\ndata: "), json, F.lit("\n\n"))


def _answered(conversations: DataFrame) -> DataFrame:
    last = F.greatest(F.lit(0), F.ceil(F.length("text") / F.lit(DELTA_CHARS)).cast("int") - 1)
    request = F.concat(
        F.lit("r"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")
    )
    return conversations.where("role = 'assistant'").select(
        "conv_id", "turn", "text", request.alias("request_id"), last.alias("last")
    )


def response_chunks(conversations: DataFrame, damaged: bool = False) -> DataFrame:
    """``(request_id, chunk_seq, body)``: each assistant turn as a streamed answer.

    With ``damaged`` the first chunk of some answers breaks the response shape.
    """
    rows = _answered(conversations).select("*", F.explode(F.sequence(F.lit(0), "last")).alias("chunk_seq"))
    json = _response_json(F.col("chunk_seq"), F.col("last"))
    if damaged:
        kind = F.when(F.col("chunk_seq") == 0, F.col("conv_id") % 10)
        json = (
            F.when(kind == 7, F.replace(json, F.lit('"usage"'), F.lit('"used"')))
            .when(kind == 3, F.substring(json, F.lit(1), F.length(json) - 1))
            .when(kind == 5, F.replace(json, F.lit('"finish_reason":"null"'), F.lit('"finish_reason":5')))
            .when(kind == 9, F.replace(json, F.lit('"index":0,"message"'), F.lit('"index":0.5,"message"')))
            .otherwise(json)
        )
    return rows.select("request_id", F.col("chunk_seq").cast("long"), _sse(F.col("chunk_seq"), json).alias("body"))


def response_pieces(conversations: DataFrame) -> DataFrame:
    """The same text in pieces that are cut inside its lines."""
    first, second = PIECE_CHARS
    body = F.col("body")

    def piece(at: int, text: Column) -> Column:
        return F.struct((F.col("chunk_seq") * 3 + at).alias("chunk_seq"), text.alias("body"))

    pieces = F.array(
        piece(0, F.substring(body, 1, first)),
        piece(1, F.substring(body, first + 1, second)),
        piece(2, F.substring(body, F.lit(first + second + 1), F.length(body))),
    )
    return response_chunks(conversations).select("request_id", F.inline(pieces))


# -- sessions -------------------------------------------------------------


def session_events(conversations: DataFrame) -> DataFrame:
    """``(session_id, seq, ts, payload, frame)``: ten messages per turn.

    Two hold text of the turn as audio; some sessions end with a finish, a close
    or an error, some not at all, and messages go on after the end.
    """
    conv, turn = F.col("conv_id"), F.col("turn")

    def event(kind: str, **more: Column) -> Column:
        fields = [F.lit(kind).alias("type")] + [c.alias(n) for n, c in more.items()]
        return F.to_json(F.struct(*fields))

    def message(at: int, payload: Column, frame: Column | None = None) -> Column:
        return F.struct(
            (turn * EVENTS_PER_TURN + at).alias("seq"),
            payload.alias("payload"),
            (F.lit("text") if frame is None else frame).alias("frame"),
        )

    def audio(text: Column) -> Column:
        return event("response.audio.delta", delta=base64_text(F.encode(text, "UTF-8")))

    nothing = F.lit(None).cast("string")
    messages = [
        message(0, F.when(turn == 0, event("session.created")).otherwise(event("session.updated"))),
        message(1, audio(F.col("text"))),
        message(2, audio(turn.cast("string"))),
        message(3, event("response.created")),
        message(
            4,
            F.when((conv % 13 == 5) & (turn == 1), event("response.audio.delta", delta=F.lit("@@@@")))
            .otherwise(event("response.audio.delta", delta=F.lit(""))),
        ),
        message(
            5,
            F.when((turn == 3) & (conv % 2 == 0), event("session.finished")).otherwise(event("response.done")),
        ),
        message(
            6,
            nothing,
            F.when((turn == 2) & (conv % 7 == 0), "close")
            .when((turn == 1) & (conv % 11 == 0), "error")
            .otherwise("other"),
        ),
        message(7, F.when(turn == 1, "not json").otherwise(event("input.committed"))),
        message(8, F.lit('{"no_type":1}')),
        message(9, F.lit('{"type":5}')),
    ]
    start = F.timestamp_seconds(F.lit(1_700_000_000) + conv * 60 + turn)
    exploded = conversations.select(conv.alias("session_id"), start.alias("ts"), F.inline(F.array(*messages)))
    return exploded.select("session_id", "seq", "ts", "payload", "frame")


# -- options, tools, logs -------------------------------------------------


def option_texts(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, params)``: option texts of six kinds."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    kind = F.col("conv_id") % 6
    text = (
        F.when(kind == 0, F.concat(F.lit('{"temperature":0.7,"top_k":'), turn, F.lit(',"stop":["a","b"],"stream":true}')))
        .when(kind == 1, F.concat(F.lit('{"stop":[[1,2],['), turn, F.lit(']],"max_tokens":'), conv, F.lit("}")))
        .when(kind == 2, F.lit('{"stop":[],"top_p":1}'))
        .when(kind == 3, F.lit('{"top_k":-1}'))
        .when(kind == 4, F.lit('{"stream":"true"}'))
        .otherwise(F.lit('{"unknown":1,"result_format":"message","enable_search":false,"customized_model_id":null}'))
    )
    return conversations.select("conv_id", "turn", text.alias("params"))


def tool_params(part: DataFrame) -> DataFrame:
    """Brands as tools and part names as parameters; names repeat within a brand."""
    return part.select(
        F.col("p_brand").alias("tool"),
        F.lit("function").alias("tool_type"),
        F.concat(F.lit("tool of "), "p_brand").alias("description"),
        F.col("p_name").alias("param"),
        F.lit("object").alias("param_type"),
        F.lower("p_type").alias("prop_type"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("prop_description"),
        F.col("p_partkey").alias("pos"),
    )


def log_lines(events: DataFrame, *more: str) -> DataFrame:
    """``(event_id, [more,] value)``: every event as a log line, every tenth one broken."""
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"),
        F.lit(" [ThreadId("),
        (F.col("user_id") % 8).cast("string"),
        F.lit(")] "),
        level,
        F.lit(" [app::"),
        F.col("event_type"),
        F.lit("] "),
        F.col("props"),
    )
    broken = F.concat(F.lit("    at "), F.col("props"))
    return events.select("event_id", *more, F.when(F.col("event_id") % 10 == 3, broken).otherwise(line).alias("value"))


def log_files(events: DataFrame) -> DataFrame:
    """``(file, line_no, value)``: the log lines in six files, one of them with four ninths of all, three of ten lines broken."""
    broken = F.concat(F.lit("    at "), "props")
    return log_lines(events, "user_id", "props").select(
        F.concat(F.lit("log-"), F.least(F.col("user_id") % 9, F.lit(5)).cast("string")).alias("file"),
        F.col("event_id").alias("line_no"),
        F.when((F.col("event_id") % 10).isin(4, 7), broken).otherwise(F.col("value")).alias("value"),
    )


def error_messages(events: DataFrame) -> DataFrame:
    """``(event_id, message)``: the ten message openings in turn, and two others."""
    texts = [
        F.lit(f"some service {words}" if name in NAMED_SERVICE else words)
        for name, words in ERROR_MESSAGES.items()
    ]
    opening = F.element_at(
        F.array(*texts, F.lit("all good: "), F.lit("note 网络错误: ")), (F.col("event_id") % 12 + 1).cast("int")
    )
    return events.select("event_id", F.concat(opening, "props").alias("message"))
