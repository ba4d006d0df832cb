"""Realtime sessions: commands out, events in, ordered payloads."""

from __future__ import annotations

from dataclasses import dataclass

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
    unplaced,
    with_first,
)

PART = "part"


@dataclass(frozen=True)
class AudioFormat:
    """Raw audio; the defaults are fixed values of the speech output."""

    format: str = "pcm"
    sample_rate: int = 24_000
    channels: int = 1
    sample_bytes: int = 2

    def seconds(self, n_bytes: Column) -> Column:
        return n_bytes / F.lit(self.sample_rate * self.channels * self.sample_bytes)


PCM_24000HZ_MONO_16BIT = AudioFormat()

# Event type -> class.
EVENT_CLASSES = {
    "session.created": "created",
    "response.audio.delta": "audio",
    "response.done": "done",
    "session.finished": "finished",
}


# -- commands -------------------------------------------------------------


def _event_id(session: str, cmd_seq: Column) -> Column:
    """Equal for every attempt of a task, unlike a random id."""
    text = F.concat_ws(":", F.col(session).cast("string"), cmd_seq.cast("string"))
    return F.concat(F.lit("event_"), F.sha2(text, 256))


def session_commands(
    df: DataFrame,
    voice: str,
    mode: str = "server_commit",
    audio: AudioFormat = PCM_24000HZ_MONO_16BIT,
    session: str = "session_id",
    seq: str = "seq",
    text: str = "text",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``(session, cmd_seq, event_id, type, payload)``.

    Per session: one update (0), one append per segment in order (1 .. n), one
    finish (n + 1).  Segments that share a position are ordered by their text;
    those without a session or a position are left out.
    """
    df = placed(df, session, seq)
    numbered = running_before(
        df.select(session, seq, text), [session], seq, {"_before": F.lit(1)}, slice_rows, then_by=[text]
    )
    appends = numbered.select(
        session,
        (F.col("_before") + 1).alias("cmd_seq"),
        F.lit("input_text_buffer.append").alias("type"),
        F.col(text).alias("_text"),
        F.lit(False).alias("_updates"),
    )
    ends = df.groupBy(session).agg(F.count(F.lit(1)).alias("_n"))
    frame = F.inline(
        F.array(
            F.struct(F.lit(0).cast("long").alias("cmd_seq"), F.lit("session.update").alias("type")),
            F.struct((F.col("_n") + 1).alias("cmd_seq"), F.lit("session.finish").alias("type")),
        )
    )
    edges = ends.select(session, frame).select(
        session,
        "cmd_seq",
        "type",
        F.lit(None).cast("string").alias("_text"),
        (F.col("type") == "session.update").alias("_updates"),
    )
    config = F.struct(
        F.lit(mode).alias("mode"),
        F.lit(audio.format).alias("response_format"),
        F.lit(audio.sample_rate).alias("sample_rate"),
        F.lit(voice).alias("voice"),
    )
    event_id = _event_id(session, F.col("cmd_seq"))
    payload = F.to_json(
        F.struct(
            event_id.alias("event_id"),
            F.when(F.col("_updates"), config).alias("session"),
            F.col("_text").alias("text"),
            F.col("type").alias("type"),
        )
    )
    return appends.unionByName(edges).select(
        session, "cmd_seq", event_id.alias("event_id"), "type", payload.alias("payload")
    )


# -- events ---------------------------------------------------------------


def route_events(df: DataFrame, payload: str = "payload", frame: str | None = None) -> DataFrame:
    """Add ``event_class`` and, for audio events, ``delta``.

    Classes: created, audio, done, finished, unknown (another type), ignored (no
    type, or one that is no text) and invalid (no JSON).  ``frame`` names a
    column with the kind of message: ``text`` (or null), ``close``, ``error`` or
    another one; only text messages are events, the rest keep their kind.
    """
    doc = F.col("_doc")
    kind = F.when(sj.is_string(doc, "$.type"), F.try_variant_get(doc, "$.type", "string"))
    known = F.when(doc.isNull(), "invalid").when(kind.isNull(), "ignored")
    for event_type, name in EVENT_CLASSES.items():
        known = known.when(kind == event_type, name)
    known = known.otherwise("unknown")
    if frame is not None:
        is_text = F.coalesce(F.col(frame) == "text", F.lit(True))
        known = F.when(is_text, known).otherwise(F.col(frame))
    delta = F.when(
        (F.col("event_class") == "audio") & sj.is_string(doc, "$.delta"),
        F.try_variant_get(doc, "$.delta", "string"),
    )
    classed = with_once(with_once(df, "_doc", sj.parse(F.col(payload))), "event_class", known)
    return with_once(classed, "delta", delta).drop("_doc")


def is_terminal() -> Column:
    """The reader of a session stops after such a message."""
    return F.col("event_class").isin("finished", "close", "error")


def _with_end(routed: DataFrame, session: str, seq: str, slice_rows: int) -> DataFrame:
    return with_first(routed, [session], seq, is_terminal(), "_end", slice_rows)


def _is_read(seq: str) -> Column:
    return F.col("_end").isNull() | (F.col(seq) <= F.col("_end"))


def until_finished(
    routed: DataFrame, session: str = "session_id", seq: str = "seq", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Events up to and including the first one that ends their session.

    Sessions without such an event keep everything, and events that share the
    position of the end are kept.  Nothing tells that an event without a session or
    a position came after an end, so all of these are kept too; they go round the
    exchange.
    """
    ended = _with_end(routed, session, seq, slice_rows)
    read = ended.where(_is_read(seq)).select(*routed.columns)
    return read.unionByName(unplaced(routed, session, seq).select(*routed.columns))


def late_events(
    routed: DataFrame, session: str = "session_id", seq: str = "seq", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """``(session, n_late)``: messages after the first one that ends their session."""
    ended = _with_end(routed.select(session, seq, "event_class"), session, seq, slice_rows)
    return ended.where(~_is_read(seq)).groupBy(session).agg(F.count(F.lit(1)).alias("n_late"))


def decoded_audio(delta: Column) -> Column:
    """Strict base64: only the canonical text of some bytes decodes, else null."""
    raw = F.try_to_binary(delta, F.lit("base64"))
    canonical = F.replace(F.base64(raw), F.lit("\r\n"), F.lit(""))
    return F.when(canonical == delta, raw)


def assemble_audio(
    kept: DataFrame,
    audio: AudioFormat = PCM_24000HZ_MONO_16BIT,
    session: str = "session_id",
    seq: str = "seq",
    part_events: int = PART_ROWS,
) -> DataFrame:
    """``(session, part, audio, n_bytes, seconds, n_bad)`` from routed events.

    Deltas are decoded and appended in order, those of one position by their bytes.  A part covers ``part_events``
    event numbers; the audio of a session is its parts in order.  ``n_bad``
    counts the deltas that are not base64.
    """
    return _audio_by(kept, audio, session, seq, part_events, [])


def session_audio(
    routed: DataFrame,
    audio: AudioFormat = PCM_24000HZ_MONO_16BIT,
    session: str = "session_id",
    seq: str = "seq",
    part_events: int = PART_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``until_finished`` and ``assemble_audio`` in one, with one exchange of the payload."""
    parts_within_slices(part_events, slice_rows)
    ended = _with_end(routed.select(session, seq, "event_class", "delta"), session, seq, slice_rows)
    return _audio_by(ended.where(_is_read(seq)), audio, session, seq, part_events, [SLICE_COLUMN])


def _audio_by(kept, audio, session, seq, part_events, more_keys):
    deltas = placed(kept, session, seq, "delta").select(
        session,
        seq,
        slice_of(seq, part_events).alias(PART),
        *more_keys,
        decoded_audio(F.col("delta")).alias("_audio"),
    )
    whole = F.expr(f"listagg(_audio, X'') WITHIN GROUP (ORDER BY `{seq}`, _audio)")
    n_bytes = F.coalesce(F.sum(F.octet_length("_audio")), F.lit(0))
    return (
        deltas.groupBy(session, PART, *more_keys)
        .agg(
            F.coalesce(whole, F.lit(b"")).alias("audio"),
            n_bytes.alias("n_bytes"),
            F.count_if(F.col("_audio").isNull()).alias("n_bad"),
        )
        .select(session, PART, "audio", "n_bytes", audio.seconds(F.col("n_bytes")).alias("seconds"), "n_bad")
    )


def audio_sizes(
    kept: DataFrame, audio: AudioFormat = PCM_24000HZ_MONO_16BIT, session: str = "session_id"
) -> DataFrame:
    """``(session, n_bytes, seconds, n_bad)`` without carrying any payload."""
    deltas = kept.where(F.col("delta").isNotNull()).select(
        session, F.octet_length(decoded_audio(F.col("delta"))).alias("_n")
    )
    sized = deltas.groupBy(session).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_bytes"),
        F.count_if(F.col("_n").isNull()).alias("n_bad"),
    )
    return sized.select(session, "n_bytes", audio.seconds(F.col("n_bytes")).alias("seconds"), "n_bad")


def session_lifecycle(
    routed: DataFrame, session: str = "session_id", seq: str = "seq"
) -> DataFrame:
    """``(session, opened, finished, closed_by_server, error, last_seq)``.

    All from minima and maxima of positions, so one pass with partial sums: the
    first ending message decides, later ones were never read.
    """

    def first(*classes: str) -> Column:
        return F.min(F.when(F.col("event_class").isin(*classes), F.col(seq)))

    seen = placed(routed, session, seq).groupBy(session).agg(
        first("created").alias("_created"),
        first("finished").alias("_finished"),
        first("close").alias("_closed"),
        first("error").alias("_error"),
        F.max(seq).alias("_max"),
    )
    return lifecycle_of(seen, session)


def lifecycle_of(seen: DataFrame, session: str) -> DataFrame:
    """From first positions (``_created, _finished, _closed, _error``) and ``_max``."""
    end = F.least("_finished", "_closed", "_error")

    def ended_by(column: str) -> Column:
        return F.coalesce(F.col(column) == end, F.lit(False))

    last = F.coalesce(end, F.col("_max"))
    return seen.select(
        session,
        F.coalesce(F.col("_created") <= last, F.lit(False)).alias("opened"),
        ended_by("_finished").alias("finished"),
        ended_by("_closed").alias("closed_by_server"),
        ended_by("_error").alias("error"),
        last.alias("last_seq"),
    )
