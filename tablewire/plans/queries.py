"""One query per operator, over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewire.functions import ordering
from tablewire.operators import blocks, logs, quality, requests, responses, sessions, urls
from tablewire.plans import derived, publish
from tablewire.plans.derived import table
from tablewire.scratch import shared_dir
from tablewire.sources import frames, scan
from tablewire.sources.catalog import BAD_COLUMNS, CatalogColumn, conform_to_catalog, declared_columns
from tablewire.streaming import block_sink, slices

N_BLOCKS = 8

# -- A: reading -----------------------------------------------------------


def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    code = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey").cast("string")).otherwise(
        F.col("o_orderpriority")
    )
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        code.alias("code"),
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
    )
    declared = [
        CatalogColumn("o_orderkey", "bigint", nullable=False),
        CatalogColumn("o_totalprice", "double"),
        CatalogColumn("o_orderdate", "timestamp_ntz"),
        CatalogColumn("code", "int"),
        CatalogColumn("status", "string", nullable=False),
    ]
    good = conform_to_catalog(text, declared)
    return good.withColumn("bad_columns", F.array_join(BAD_COLUMNS, ",")).drop(BAD_COLUMNS)


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = scan.snapshot_session(
        table(spark, sf_dir, "lineitem"), "lineitem", "l_returnflag=R", ["l_returnflag"]
    )
    return session.select(
        "table",
        "partition",
        "record_count",
        F.json_array_length(F.get_json_object("columns", "$.columns")).cast("long").alias("n_columns"),
        F.json_array_length(F.get_json_object("columns", "$.partitionKeys")).cast("long").alias("n_keys"),
        "status",
    )


def published_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a published table, at its first version, from the manifest."""
    orders, path = table(spark, sf_dir, "orders"), shared_dir(spark, "session")
    _write(spark, path, orders, partition_by=("o_orderstatus",))
    _write(spark, path, orders, partition_by=("o_orderstatus",))
    rows = publish.read_session(spark, path, "o_orderstatus=O", version=1)
    return rows.select("version", "partition", "record_count", "raw_size", "status")


def partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan.read_partition(table(spark, sf_dir, "lineitem"), "l_returnflag=R,l_linestatus='F'")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag", "l_linestatus")


def row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    n = orders.count()
    return scan.read_row_range(orders, ["o_orderkey"], n // 3, n // 5, top_rows=1000)


def row_range_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    n = orders.count()
    return scan.read_row_range(orders, ["o_orderpriority", "o_orderkey"], n // 10, n // 2, top_rows=1000)


def row_range_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.read_row_range(table(spark, sf_dir, "events"), ["event_id"], 100, 500)


def decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    columns = declared_columns(orders.schema)
    framed = frames.frame_payloads(orders, columns, batches_per_payload=2)
    return frames.decode_frames(framed, columns).drop("payload_id")


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = scan.batch_sizes(table(spark, sf_dir, "orders"))
    return sizes.agg(F.sum("n_rows").alias("n_rows"), (F.min("n_bytes") > 0).alias("sized"))


# -- B: writing -----------------------------------------------------------


def block_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = blocks.assign_blocks(table(spark, sf_dir, "lineitem"), ["l_orderkey"], N_BLOCKS, hashed=False)
    return lines.groupBy("block_id").agg(F.count(F.lit(1)).alias("n"))


def copy_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk copy of a partition: prune, cut into blocks, count rows and bytes."""
    lines = scan.read_partition(table(spark, sf_dir, "lineitem"), "l_returnflag=R")
    cut = blocks.assign_blocks(lines, ["l_orderkey"], N_BLOCKS, hashed=False)
    return blocks.block_ledger(cut)


def _schema_with_block(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(blocks.BLOCK, T.LongType())])


def _write(spark, path, df, overwrite=False, partition=None, partition_by=()):
    upload = publish.create_upload(path, overwrite, partition, partition_by)
    cut = blocks.assign_blocks(df, ["o_orderkey"], N_BLOCKS, hashed=False)
    publish.stage_blocks(cut, upload)
    return publish.commit_upload(spark, upload, _schema_with_block(df))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    upload = publish.create_upload(shared_dir(spark, "stage"))
    cut = blocks.assign_blocks(orders, ["o_orderkey"], N_BLOCKS, hashed=False)
    rows = publish.stage_blocks(cut, upload)
    return rows.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate", "block_id")


def committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _write(spark, shared_dir(spark, "commit"), table(spark, sf_dir, "orders"))
    return files.groupBy("block_id", "version").agg(
        F.sum("record_count").alias("record_count"), F.sum("raw_size").alias("raw_size")
    )


def resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks 0 to 3 are sent a second time with other prices before the commit."""
    orders = table(spark, sf_dir, "orders")
    path = shared_dir(spark, "resent")
    upload = publish.create_upload(path)
    cut = blocks.assign_blocks(orders, ["o_orderkey"], N_BLOCKS, hashed=False)
    publish.stage_blocks(cut, upload, attempt=0)
    again = cut.where("block_id < 4").withColumn("o_totalprice", F.lit(0.0))
    publish.stage_blocks(again, upload, attempt=1)
    publish.commit_upload(spark, upload, _schema_with_block(orders))
    return publish.published_table(spark, path).select("o_orderkey", "o_totalprice")


def _odd(orders: DataFrame, odd: bool) -> DataFrame:
    """One of two parts that together are all orders."""
    return orders.where((F.col("o_orderkey") % 2 == 1) == F.lit(odd))


def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), shared_dir(spark, "append")
    _write(spark, path, _odd(orders, True))
    _write(spark, path, _odd(orders, False))
    return publish.published_table(spark, path)


def overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), shared_dir(spark, "overwrite")
    _write(spark, path, _odd(orders, True))
    _write(spark, path, _odd(orders, False), overwrite=True)
    return publish.published_table(spark, path)


def overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = table(spark, sf_dir, "orders"), shared_dir(spark, "partition")
    key = ("o_orderstatus",)
    _write(spark, path, orders, partition_by=key)
    newer = orders.where("o_orderstatus = 'F' AND o_totalprice > 200000").withColumn("o_custkey", F.lit(-1).cast("long"))
    _write(spark, path, newer, True, "o_orderstatus=F", key)
    return publish.published_table(spark, path)


def earlier_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot stays readable after the table was overwritten."""
    orders, path = table(spark, sf_dir, "orders"), shared_dir(spark, "version")
    _write(spark, path, _odd(orders, True))
    _write(spark, path, _odd(orders, False), overwrite=True)
    return publish.published_table(spark, path, version=1)


def newest_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("upload_id"), F.col("event_type").alias("block_id"), "event_id", "ts", "value"
    )
    return blocks.latest_blocks(events, version=F.struct("ts", "event_id"))


def oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    good, rejected = blocks.oversize_guard(documents, 4096)
    shown = good.select("doc_id", F.lit(None).cast("string").alias("oversize_field"))
    return shown.unionByName(rejected.select("doc_id", "oversize_field"))


def oversize_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("doc_id") % 2 == 0
    nested = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.struct("lang", F.array("source", F.when(even, F.col("text"))).alias("parts")).alias("body"),
        F.create_map(F.lit("note"), F.struct(F.when(~even, F.col("text")).alias("text"))).alias("tags"),
    )
    good, rejected = blocks.oversize_guard(nested, 4096)
    shown = good.select("doc_id", F.lit(None).cast("string").alias("oversize_field"))
    return shown.unionByName(rejected.select("doc_id", "oversize_field"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = blocks.chunk_ledger(table(spark, sf_dir, "documents"), ["doc_id"], "text", 4096, "md5")
    return ledger.select("doc_id", "chunk_index", "n_bytes", "checksum")


def payload_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.payload_checksum(table(spark, sf_dir, "documents"), ["doc_id"], "text", "md5")


def verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole payloads pass; with one byte of data changed, exactly one chunk fails."""
    orders = table(spark, sf_dir, "orders")
    framed = frames.frame_payloads(orders, declared_columns(orders.schema), chunk_size=4096)
    # The byte after the chunk size is 0xff, the first one of the batch marker.
    changed = framed.withColumn(
        "payload",
        F.concat(
            F.substring("payload", 1, 4),
            F.lit(b"\x00"),
            F.substring(F.col("payload"), F.lit(6), F.octet_length("payload")),
        ),
    )

    def summary(state: str, payloads: DataFrame) -> DataFrame:
        return frames.verify_frames(payloads).agg(
            F.lit(state).alias("state"),
            F.min("bad_chunks").alias("min_bad_chunks"),
            F.max("bad_chunks").alias("max_bad_chunks"),
            F.avg(F.col("total_ok").cast("double")).alias("share_ok"),
        )

    return summary("whole", framed).unionByName(summary("changed", changed))


def streamed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file stream into blocks; a second run on the checkpoint adds nothing."""
    path, checkpoint = shared_dir(spark, "sink"), shared_dir(spark, "checkpoint")
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        query = block_sink.stream_to_blocks(stream, path, checkpoint)
        query.awaitTermination()
    return publish.published_table(spark, path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event")
    )


# -- C: URLs --------------------------------------------------------------


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derived.messy_urls(table(spark, sf_dir, "pages"))
    return urls.canonical_url(pages, "url").drop("url")


def normal_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derived.rough_urls(table(spark, sf_dir, "pages"))
    return urls.canonical_url(pages, "url", upper_escapes=True).drop("url")


def canonical_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_replace("url", r"/\d+", "/n").alias("url")
    )
    return urls.canonical_url(pages, "url", dedupe_by="page_id").select("page_id", "site", "canonical")


def host_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.label_counts(table(spark, sf_dir, "pages"), "url", r"^https?://(www|blog|m)\.")


# -- D: requests ----------------------------------------------------------

MODEL = "model-a"
PART_TURNS = 1024


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = requests.collect_messages(table(spark, sf_dir, "conversations"), part_turns=4)
    return parts.select("conv_id", "part", F.to_json("messages").alias("messages"))


def turns_without_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = derived.without_places(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    return ordering.unplaced(turns, "conv_id", "turn")


def turn_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = derived.without_places(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    return ordering.place_counts(turns, "conv_id", "turn")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.history_pairs(table(spark, sf_dir, "conversations"), slice_turns=4)


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt only, messages only, prompt with history, and neither of them."""
    parts = requests.collect_messages(table(spark, sf_dir, "conversations"), part_turns=PART_TURNS)
    kind = F.col("conv_id") % 4
    prompt = F.when(kind.isin(0, 2), F.concat(F.lit("p"), F.col("conv_id").cast("string")))
    said = F.transform(
        F.col("messages"), lambda m: F.struct(F.lit("").alias("bot"), m["content"].alias("user"))
    )
    bodies = requests.build_requests(
        parts,
        F.lit(MODEL),
        prompt,
        F.when(kind == 2, said),
        F.when(kind == 1, F.col("messages")),
        F.struct(F.lit(True).alias("stream"), F.lit(0.7).alias("temperature")),
        whole=F.col("is_first") & F.col("is_last"),
    )
    return bodies.select("conv_id", "part", "body", "error")


def request_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.conversation_requests(
        table(spark, sf_dir, "conversations"), F.lit(MODEL), part_turns=4
    )


def requests_with_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options are parsed per conversation and go into its request, with a prompt and ids of tool calls."""
    turns = table(spark, sf_dir, "conversations")
    first = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("said"), F.count("*").alias("n"))
    texts = first.select(
        "conv_id",
        F.when(F.col("n") > 2, F.col("said")).alias("prompt"),
        F.concat(F.lit('{"top_k":'), F.length("said").cast("string"), F.lit(',"max_tokens":'), F.col("n").cast("string"), F.lit("}")).alias("params"),
    )
    parsed = requests.parse_parameters(texts).select("conv_id", "prompt", requests.parameters_struct().alias("parameters"))
    called = turns.withColumn("call", F.when(F.col("role") == "assistant", F.concat(F.lit("c"), F.col("turn").cast("string"))))
    return requests.conversation_requests(called, F.lit(MODEL), tool_call_id="call", extras=parsed, part_turns=PART_TURNS)


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = requests.parse_parameters(derived.option_texts(table(spark, sf_dir, "conversations")))
    return parsed.select(
        "conv_id",
        "turn",
        *requests.OPTIONS,
        F.to_json("stop_strings").alias("stop_strings"),
        F.to_json("stop_ids").alias("stop_ids"),
        "error",
    )


def tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.build_tool_specs(derived.tool_params(table(spark, sf_dir, "part")), part_params=1024)


# -- E: responses ---------------------------------------------------------


def _good(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = derived.response_chunks(table(spark, sf_dir, "conversations"))
    good, _ = quality.split_errors(responses.parse_responses(responses.sse_data_lines(logged)))
    return good


def data_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = derived.response_chunks(table(spark, sf_dir, "conversations"))
    return responses.sse_data_lines(logged).select(
        "request_id", "chunk_seq", "line_no", F.get_json_object("json", "$.output.choices[0].message.content").alias("content")
    )


def data_lines_reassembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = derived.response_pieces(table(spark, sf_dir, "conversations"))
    return responses.sse_data_lines(logged, reassemble=True, slice_chunks=16).select(
        "request_id", "line_no", F.get_json_object("json", "$.output.choices[0].message.content").alias("content")
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = derived.response_chunks(table(spark, sf_dir, "conversations"), damaged=True)
    rows = responses.parse_responses(responses.sse_data_lines(logged))
    return rows.select(
        "request_id", "chunk_seq", "error", F.col("choices")[0]["message"]["content"].alias("content"),
        F.col("usage.total_tokens").cast("long").alias("total_tokens"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.assemble_answers(_good(spark, sf_dir)).select("request_id", "part", "answer", "reasoning")


def answers_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.assemble_answers(_good(spark, sf_dir), part_chunks=4).select(
        "request_id", "part", "answer", "reasoning"
    )


def answers_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.assemble_answers(_good(spark, sf_dir), compat=True, slice_chunks=2048).select(
        "request_id", "part", "answer", "reasoning"
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.final_usage(_good(spark, sf_dir))


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.explode_tool_calls(_good(spark, sf_dir))


# -- F: sessions ----------------------------------------------------------

SLICE = 16
STREAM_SLICE = 32


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("session_id"), F.col("turn").alias("seq"), "text"
    )
    return sessions.session_commands(segments, voice="voice-a", slice_rows=4)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derived.session_events(table(spark, sf_dir, "conversations"))
    return sessions.route_events(events, frame="frame")


def event_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).groupBy("event_class").agg(
        F.count(F.lit(1)).alias("n"), F.count("delta").alias("n_deltas")
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sessions.until_finished(_routed(spark, sf_dir), slice_rows=SLICE)
    return kept.select("session_id", "seq", "event_class")


def read_events_without_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = derived.without_places(_routed(spark, sf_dir), "session_id", "seq")
    return sessions.until_finished(routed, slice_rows=SLICE).select("session_id", "seq", "event_class")


def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sessions.until_finished(_routed(spark, sf_dir), slice_rows=SLICE)
    parts = sessions.assemble_audio(kept, part_events=SLICE)
    return parts.select("session_id", "part", "n_bytes", "seconds", "n_bad", F.md5("audio").alias("audio_md5"))


def audio_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = sessions.session_audio(_routed(spark, sf_dir), part_events=SLICE, slice_rows=2 * SLICE)
    return parts.select("session_id", "part", "n_bytes", "seconds", "n_bad", F.md5("audio").alias("audio_md5"))


def audio_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.audio_sizes(sessions.until_finished(_routed(spark, sf_dir)))


def lifecycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_lifecycle(_routed(spark, sf_dir))


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.late_events(_routed(spark, sf_dir), slice_rows=SLICE)


def _streamed_slices(spark: SparkSession, sf_dir: str, belated: bool = False) -> DataFrame:
    """Session messages written as files, replayed as a stream, collected as slices."""
    source, sink = shared_dir(spark, "messages"), shared_dir(spark, "slices")
    checkpoint = shared_dir(spark, "checkpoint")
    events = derived.session_events(table(spark, sf_dir, "conversations"))

    def clock(second: int) -> DataFrame:
        """One message of a far time moves the watermark on, so that timers run out."""
        return spark.range(1).select(
            F.lit(-1).cast("long").alias("session_id"),
            F.lit(0).cast("long").alias("seq"),
            F.timestamp_seconds(F.lit(second)).alias("ts"),
            F.lit('{"type":"clock"}').alias("payload"),
            F.lit("text").alias("frame"),
        )

    arrivals = [events.unionByName(clock(4_000_000_000))]
    if belated:  # a third of the events arrive when the slices of the others were given out
        is_late = F.col("seq") % 3 == 1
        last = events.where(is_late).withColumn("ts", F.timestamp_seconds(F.lit(4_000_000_100)))
        arrivals = [events.where(~is_late).unionByName(clock(4_000_000_000)), last, clock(4_100_000_000)]
    before = spark.conf.get(slices.STATE_STORE)
    spark.conf.set(slices.STATE_STORE, slices.ROCKSDB)
    try:
        for arrived in arrivals:
            arrived.write.mode("append").parquet(source)
            stream = spark.readStream.schema(events.schema).parquet(source)
            query = (
                slices.stream_sessions(stream, timeout_ms=60_000, slice_events=STREAM_SLICE, frame="frame")
                .writeStream.format("parquet")
                .option("checkpointLocation", checkpoint)
                .option("path", sink)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
    finally:
        spark.conf.set(slices.STATE_STORE, before)
    return spark.read.schema(slices.SLICE_SCHEMA).parquet(sink).where("session_id >= 0")


def streamed_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = slices.audio_parts(_streamed_slices(spark, sf_dir))
    return parts.select("session_id", "part", "n_bytes", "seconds", "n_bad", F.md5("audio").alias("audio_md5"))


def streamed_lifecycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.lifecycle(_streamed_slices(spark, sf_dir))


def streamed_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.late_counts(_streamed_slices(spark, sf_dir))


def streamed_belated_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = slices.audio_parts(_streamed_slices(spark, sf_dir, belated=True))
    return parts.select("session_id", "part", "n_bytes", "seconds", "n_bad", F.md5("audio").alias("audio_md5"))


# -- G: logs --------------------------------------------------------------


def log_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_log_lines(derived.log_lines(table(spark, sf_dir, "events"))).drop("value")


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = derived.log_files(table(spark, sf_dir, "events"))
    return logs.log_records(files, part_lines=4, slice_rows=64)


def days_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    undated = events.withColumn("ts", F.when(F.col("event_id") % 7 != 2, F.col("ts")))
    return logs.day_counts(undated, "ts", 7)


def retained_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    undated = events.withColumn("ts", F.when(F.col("event_id") % 7 != 2, F.col("ts")))
    return logs.retain_days(undated, "ts", 7).select("event_id", "ts")


def retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.retain_days(table(spark, sf_dir, "events"), "ts", 7).select("event_id", "ts")


def retained_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "days")
    logs.write_by_day(table(spark, sf_dir, "events"), "ts", path)
    stored = spark.read.parquet(path)
    return logs.retain_partitions(stored, 7).select("event_id", "ts")


def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_errors(derived.error_messages(table(spark, sf_dir, "events")), "message")


QUERIES = {
    "a1_conform_to_catalog": conform,
    "a2_snapshot_session": snapshot,
    "a2_read_session": published_session,
    "a3_read_partition": partition,
    "a4_read_row_range": row_range,
    "a4_read_row_range_two_keys": row_range_two_keys,
    "a4_read_row_range_top": row_range_top,
    "a5_decode_frames": decode,
    "a6_map_batches": batches,
    "b1_assign_blocks": block_counts,
    "b2_stage_blocks": staged,
    "b3_copy_partition": copy_partition,
    "b3_commit_upload": committed,
    "b3_commit_resent_blocks": resent,
    "b4_append": append,
    "b4_overwrite": overwrite,
    "b4_overwrite_partition": overwrite_partition,
    "b4_earlier_version": earlier_version,
    "b5_latest_blocks": newest_blocks,
    "b6_oversize_guard": oversize,
    "b6_oversize_guard_nested": oversize_nested,
    "b7_chunk_ledger": chunks,
    "b7_payload_checksum": payload_sums,
    "b8_verify_frames": verify,
    "b9_stream_to_blocks": streamed_blocks,
    "c1_canonical_url": canonical,
    "c1_canonical_url_dedupe": canonical_kept,
    "c1_normal_urls": normal_urls,
    "c2_label_counts": host_labels,
    "d1_collect_messages": messages,
    "d1_turns_without_place": turns_without_place,
    "d1_turn_places": turn_places,
    "d2_history_pairs": history,
    "d3_build_requests": request_bodies,
    "d3_conversation_requests": request_pieces,
    "d3_requests_with_options": requests_with_options,
    "d4_parse_parameters": options,
    "d5_build_tool_specs": tools,
    "e1_sse_data_lines": data_lines,
    "e1_sse_data_lines_reassembled": data_lines_reassembled,
    "e2_parse_responses": parsed,
    "e3_assemble_answers": answers,
    "e3_assemble_answers_parts": answers_in_parts,
    "e3_assemble_answers_compat": answers_compat,
    "e4_final_usage": usage,
    "e5_explode_tool_calls": tool_calls,
    "f1_session_commands": commands,
    "f2_route_events": event_classes,
    "f3_until_finished": read_events,
    "f3_until_finished_without_place": read_events_without_place,
    "f4_assemble_audio": audio,
    "f4_session_audio": audio_at_once,
    "f4_audio_sizes": audio_bytes,
    "f5_session_lifecycle": lifecycles,
    "f5_late_events": late,
    "f6_stream_sessions_audio": streamed_audio,
    "f6_stream_sessions_belated_audio": streamed_belated_audio,
    "f6_stream_sessions_lifecycle": streamed_lifecycles,
    "f6_stream_sessions_late": streamed_late,
    "g1_parse_log_lines": log_fields,
    "g1_log_records": log_records,
    "g2_retain_days": retained,
    "g2_retain_days_undated": retained_undated,
    "g2_day_counts": days_kept,
    "g2_retain_partitions": retained_folders,
    "g3_classify_errors": error_counts,
}
