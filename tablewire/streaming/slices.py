"""Sessions online (F6): bounded state per slice of a session.

A session is cut into slices of consecutive event numbers, and the state is kept
per slice: a long session is spread over tasks and no state grows with it.  A
slice is given out when it is complete, when its session ends inside it and
everything before the end has come, or when its timer runs out.  Events that come
after that are given out as further revisions of their slice, each with the positions
of its own events.  So no payload has to stay in the state for them, and they count
even when the slice has been forgotten.  What belongs to the whole slice (all its
revisions) or to the whole session (is there an earlier end?) is settled when the
slices are read, by ``lifecycle``, ``audio_parts`` and ``late_counts``: on the same
events they give what the batch operators give, in whatever order events arrive.

A call of the state store, a key and a table that comes out cost far more than an event.
So slices are dealt out by their hash to a number of groups, and a group is a key of the
operator: its slices are read, written and given out together, in a few calls whatever
their number.  The rules are those of one slice, over what the group keeps for it.  Every
column of a row costs on its way in and out of Python too, so an event goes in as few
columns and a slice comes out as two.  A user function gets its slices one by one instead.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo

from tablewire.functions.ordering import PART_ROWS, placed, running_before, slice_of
from tablewire.operators.sessions import (
    PART,
    PCM_24000HZ_MONO_16BIT,
    AudioFormat,
    decoded_audio,
    lifecycle_of,
    route_events,
)

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ENDINGS = ("finished", "close", "error")
# What came of a slice in one micro-batch, as one entry: a value per event in each array.
EVENT_STATE = "seqs array<bigint>, event_classes array<string>, audio array<binary>, are_deltas array<boolean>"
# Of each slice of a group that holds events or a number of revisions: ``progress``, its timer, and the entries that
# hold its events; and the timer of the group, not after the first one of its slices.
GROUP_STATE = (
    "slices array<string>, ns array<bigint>, ends array<bigint>, timers array<bigint>, givens array<bigint>, "
    "dues array<bigint>, entries array<array<bigint>>, due bigint"
)
# What came of some slices of a group in one micro-batch; never written again, removed with the last of these slices.
ENTRY_STATE = (
    "slices array<string>, seqs array<array<bigint>>, event_classes array<array<string>>, "
    "audio array<array<binary>>, are_deltas array<array<boolean>>"
)
ENTRY_SLICES = 256
GROUPS = 4096
SLICE_COLUMNS = [
    "session_id", "part", "reason", "n_events", "created_seq", "finished_seq",
    "closed_seq", "error_seq", "max_seq", "audio", "n_bytes", "n_bad", "n_deltas", "n_late",
    "revision", "seqs", "delta_seqs", "delta_ends",
]
SLICE_SCHEMA = (
    "session_id bigint, part bigint, reason string, n_events bigint, created_seq bigint, "
    "finished_seq bigint, closed_seq bigint, error_seq bigint, max_seq bigint, "
    "audio binary, n_bytes bigint, n_bad bigint, n_deltas bigint, n_late bigint, "
    # the revision, the positions of all events, and those of the deltas read, with the place in ``audio`` where
    # each ends (null for one that is no base64)
    "revision int, seqs array<bigint>, delta_seqs array<bigint>, delta_ends array<bigint>"
)


# A slice on its way out of Python: all columns but the audio as one JSON text.
PACKED_SCHEMA = "slice string, audio binary"
SLICE_JSON_SCHEMA = SLICE_SCHEMA.replace("audio binary, ", "")
OnSlice = Callable[[pd.DataFrame], pd.DataFrame]
SliceRow = Row(*SLICE_COLUMNS)
PackedRow = Row("slice", "audio")


class SliceProcessor(StatefulProcessor):
    """Collects one slice, at most ``slice_events`` events, and gives it out.

    What stays of a slice that was given out is the number of its revisions, which
    is forgotten ``forget_ms`` after the first one; until then further events are
    given out at once, as the next revision, and later ones as a slice anew.
    """

    def __init__(self, slice_events: int, timeout_ms: int, forget_ms: int, by_event_time: bool):
        self.slice_events = slice_events
        self.timeout_ms = timeout_ms
        self.forget_ms = forget_ms
        self.by_event_time = by_event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", EVENT_STATE)
        self.progress = handle.getValueState("progress", "n bigint, end_seq bigint, timer bigint, given bigint")

    def arrivals(self, rows: Iterator) -> tuple[list[tuple], int]:
        """The events ``(seq, event_class, audio, is_delta)``, and the newest time in ms."""
        arrived, newest = [], None
        for _, _, seq, ts, kind, audio, is_delta in rows:
            arrived.append((seq, kind, audio, is_delta))
            newest = ts if newest is None else max(newest, ts)
        return arrived, max(0, in_ms(newest))

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        n, end, timer, given = self.progress.get() or (0, None, None, 0)
        arrived, newest = self.arrivals(rows)
        if given:
            self.progress.update((0, None, None, given + 1))
            yield self.slice_row(key, arrived, "late", given + 1)
            return
        now = newest if self.by_event_time else timerValues.getCurrentProcessingTimeInMs()
        ends = [seq for seq, kind, _, _ in arrived if kind in ENDINGS]
        end = min([*ends, end] if end is not None else ends, default=None)
        first = key[1] * self.slice_events
        wanted = self.slice_events if end is None else end - first + 1
        if n + len(arrived) >= wanted:
            events = [*self.kept_events(), *arrived] if n else arrived
            if len({seq for seq, _, _, _ in events if seq < first + wanted}) == wanted:
                yield self.slice_row(key, events, "complete" if end is None else "ended")
                if n:
                    self.events.clear()
                    self.handle.deleteTimer(timer)
                self.given_out(now)
                return
        # Still incomplete: only now the events go to the state store.
        self.events.appendValue(tuple(map(list, zip(*arrived))))
        expiry = now + self.timeout_ms
        if timer is None or expiry > timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(expiry)
            timer = expiry
        self.progress.update((n + len(arrived), end, timer, 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        events = self.kept_events()
        if not events:  # given out before: nothing but the number of its revisions is kept
            self.progress.clear()
            return
        yield self.slice_row(key, events, "timeout")
        self.events.clear()
        self.given_out(expiredTimerInfo.getExpiryTimeInMs())

    def kept_events(self) -> list[tuple]:
        return [event for entry in self.events.get() for event in zip(*entry)]

    def given_out(self, now: int) -> None:
        self.handle.registerTimer(now + self.forget_ms)
        self.progress.update((0, None, None, 1))

    def slice_values(self, key, events: list, reason: str, revision: int) -> list:
        events = sorted(events, key=lambda e: (e[0], e[2] or b""))
        firsts = {}
        for seq, kind, _, _ in events:
            firsts.setdefault(kind, seq)
        end = min((firsts[k] for k in ENDINGS if k in firsts), default=None)
        read = [e for e in events if end is None or e[0] <= end]
        deltas = [(e[0], e[2]) for e in read if e[3]]
        audio = b"".join(data for _, data in deltas if data is not None)
        ends, at = [], 0
        for _, data in deltas:
            at += len(data or b"")
            ends.append(None if data is None else at)
        return [
            key[0], key[1], reason, len(events), firsts.get("created"), firsts.get("finished"),
            firsts.get("close"), firsts.get("error"), events[-1][0], audio, len(audio),
            ends.count(None), len(deltas), len(events) - len(read),
            revision, [e[0] for e in events], [seq for seq, _ in deltas], ends,
        ]

    def slice_row(self, key, events: list, reason: str, revision: int = 1):
        # Spark holds the rows of a task's expired timers together, so positions are plain numbers.
        values = self.slice_values(key, events, reason, revision)
        return SliceRow(*[np.array(v, "int64") if isinstance(v, list) and None not in v else v for v in values])

    def close(self) -> None:
        pass


class PackedSliceProcessor(SliceProcessor):
    """The same over rows of ``packed_events``, as ``PACKED_SCHEMA``."""

    def arrivals(self, rows: Iterator) -> tuple[list[tuple], int]:
        arrived, newest = [], None
        for _, time, event in rows:
            arrived.append(self.unpacked(event))
            newest = time if newest is None else max(newest, time)
        return arrived, max(0, in_ms(newest))

    def unpacked(self, event: bytes) -> tuple:
        seq, n_audio, rest = event.split(b" ", 2)
        n = int(n_audio or 0)
        audio = rest[:n] if n_audio and n >= 0 else None
        return int(seq), rest[max(n, 0):].decode(), audio, n_audio != b""

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        return super().handleInputRows(self.slice_key(key), rows, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        return super().handleExpiredTimer(self.slice_key(key), timerValues, expiredTimerInfo)

    def slice_key(self, key) -> tuple[int, int]:
        session, part = key[0].split(" ")
        return int(session), int(part)

    def slice_row(self, key, events: list, reason: str, revision: int = 1) -> Row:
        values = dict(zip(SLICE_COLUMNS, self.slice_values(key, events, reason, revision)))
        audio = values.pop("audio")
        return PackedRow(json.dumps(values), audio)


class SliceGroup:
    """The state of a group of slices, and in place of the state store for one slice of it, ``at``, after the other."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.store = handle
        self.group = handle.getValueState("group", GROUP_STATE)
        self.entries = handle.getMapState("entries", "entry bigint", ENTRY_STATE)
        self.at = None

    def load(self) -> None:
        *columns, self.due = self.group.get() or (*[()] * 7, None)
        slices, ns, ends, timers, givens, dues, entries = columns
        self.progress = dict(zip(slices, zip(ns, ends, timers, givens)))
        self.dues = dict(zip(slices, dues))
        self.places = {at: list(numbers) for at, numbers in zip(slices, entries) if numbers}
        self.stored = {number for numbers in self.places.values() for number in numbers}
        self.fetched, self.added, self.fired = {}, {}, None

    def save(self) -> None:
        first = max(self.stored, default=-1) + 1
        for number, some in enumerate(batched(self.added.items(), ENTRY_SLICES), first):
            slices, events = zip(*some)
            self.entries.updateValue((number,), (list(slices), *map(list, zip(*events))))
            for at in slices:
                self.places.setdefault(at, []).append(number)
        for number in self.stored.difference(*self.places.values()):
            self.entries.removeKey((number,))
        if self.progress:
            kept = [(at, *progress, self.dues[at], self.places.get(at, [])) for at, progress in self.progress.items()]
            due = min(self.dues.values())
            if due == self.fired:  # Spark is about to delete that one
                due += 1
            if self.due is None or due < self.due:
                if self.due is not None:
                    self.store.deleteTimer(self.due)
                self.store.registerTimer(due)
                self.due = due
            self.group.update((*map(list, zip(*kept)), self.due))
        else:
            self.group.clear()

    def expired(self, fired: int, now: int) -> Iterator[tuple[int, str]]:
        """The slices whose timers have run out by ``now``, the oldest first; the timer of the group has ``fired``."""
        self.due, self.fired = None, fired
        for due, self.at in sorted((due, at) for at, due in self.dues.items() if due <= fired or due < now):
            del self.dues[self.at]
            yield due, self.at

    def registerTimer(self, due: int) -> None:
        self.dues[self.at] = due

    def deleteTimer(self, due: int) -> None:
        del self.dues[self.at]


class GroupedProgress:
    """``progress`` of one slice of a group."""

    def __init__(self, group: SliceGroup):
        self.group = group

    def get(self) -> tuple | None:
        return self.group.progress.get(self.group.at)

    def update(self, progress: tuple) -> None:
        self.group.progress[self.group.at] = progress

    def clear(self) -> None:
        del self.group.progress[self.group.at]


class GroupedEvents:
    """``events`` of one slice of a group."""

    def __init__(self, group: SliceGroup):
        self.group = group

    def get(self) -> Iterator[tuple]:
        for number in self.group.places.get(self.group.at, ()):
            if number not in self.group.fetched:
                slices, *events = self.group.entries.getValue((number,))
                self.group.fetched[number] = dict(zip(slices, zip(*events)))
            yield self.group.fetched[number][self.group.at]

    def appendValue(self, entry: tuple) -> None:
        self.group.added[self.group.at] = entry

    def clear(self) -> None:
        self.group.places.pop(self.group.at, None)


class SliceGroupProcessor(PackedSliceProcessor):
    """The same over rows of ``grouped_events``: groups of slices, each slice by the rules of one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = SliceGroup(handle)
        self.events, self.progress = GroupedEvents(self.handle), GroupedProgress(self.handle)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator[Row]:
        arrived = {}
        for _, time, row in rows:
            session, part, event = row.split(b" ", 2)
            arrived.setdefault((session, part), []).append((None, time, event))
        self.handle.load()
        for of_slice, events in arrived.items():
            self.handle.at = b" ".join(of_slice).decode()
            yield from super().handleInputRows((self.handle.at,), events, timerValues)
        self.handle.save()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        clock = timerValues.getCurrentWatermarkInMs if self.by_event_time else timerValues.getCurrentProcessingTimeInMs
        self.handle.load()
        for due, at in self.handle.expired(expiredTimerInfo.getExpiryTimeInMs(), clock()):
            yield from super().handleExpiredTimer((at,), timerValues, ExpiredTimerInfo(due))
        self.handle.save()


class HookedSliceProcessor(SliceProcessor):
    """The same over pandas tables; every slice goes through a user function."""

    def __init__(
        self, slice_events: int, timeout_ms: int, forget_ms: int, by_event_time: bool, on_slice: OnSlice
    ):
        super().__init__(slice_events, timeout_ms, forget_ms, by_event_time)
        self.on_slice = on_slice

    def arrivals(self, rows: Iterator[pd.DataFrame]) -> tuple[list[tuple], int]:
        arrived, newest = [], 0
        for batch in rows:
            arrived += zip(
                batch["seq"].tolist(),
                batch["event_class"].tolist(),
                [None if a is None else bytes(a) for a in batch["audio"].tolist()],
                batch["is_delta"].tolist(),
            )
            newest = max(newest, int(batch["ts"].max().timestamp() * 1000))
        return arrived, newest

    def slice_row(self, key, events: list, reason: str, revision: int = 1) -> pd.DataFrame:
        values = self.slice_values(key, events, reason, revision)
        return self.on_slice(pd.DataFrame([values], columns=SLICE_COLUMNS, dtype="object"))


def packed_events(routed: DataFrame) -> DataFrame:
    """``(key, ts, event)`` for each event, in few columns that are cheap to read one by one in Python.

    ``key`` names session and slice.  ``event`` is the position, the number of bytes of audio (-1 for a delta that
    is no base64, nothing where there is no delta), the audio and the class.
    """
    n_audio = F.when(F.col("is_delta"), F.coalesce(F.octet_length("audio"), F.lit(-1)).cast("string")).otherwise("")
    head = F.concat(F.col("seq").cast("string"), F.lit(" "), n_audio, F.lit(" "))
    event = F.concat(
        F.encode(head, "UTF-8"), F.coalesce("audio", F.lit(b"")), F.encode("event_class", "UTF-8")
    )
    return routed.select(F.concat_ws(" ", "session_id", PART).alias("key"), "ts", event.alias("event"))


def grouped_events(packed: DataFrame, groups: int) -> DataFrame:
    """``(slices, ts, event)``: the group of the slice, and session and slice in front of each event."""
    group = F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int")
    event = F.concat(F.encode(F.concat("key", F.lit(" ")), "UTF-8"), "event")
    return packed.select(group.alias("slices"), "ts", event.alias("event"))


def unpacked_slices(packed: DataFrame, schema: str | T.StructType) -> DataFrame:
    """The columns of ``schema`` from rows of ``PACKED_SCHEMA``; each text is parsed once."""
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = packed.select("audio", F.inline(F.array(F.from_json("slice", SLICE_JSON_SCHEMA))))
    return rows.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in columns])


def in_ms(time: datetime) -> int:
    """Milliseconds since the epoch; a time without a zone counts as UTC."""
    return int((time if time.tzinfo else time.replace(tzinfo=timezone.utc)).timestamp() * 1000)


def stream_sessions(
    events: DataFrame,
    watermark: str | None = "10 minutes",
    timeout_ms: int = 3_600_000,
    slice_events: int = PART_ROWS,
    frame: str | None = None,
    forget_ms: int = 86_400_000,
    on_slice: OnSlice | None = None,
    schema: str = SLICE_SCHEMA,
    groups: int = GROUPS,
) -> DataFrame:
    """Slices of sessions, as a streaming DataFrame in append mode.

    ``events`` has ``session_id, seq, ts, payload`` (and ``frame``).  The state
    store must be the RocksDB one (``STATE_STORE`` / ``ROCKSDB``).  Events of a
    slice that was given out already come as rows with reason ``late`` and the next
    ``revision``, for ``forget_ms`` afterwards, and then as a slice of their own;
    the readers below put all rows of a slice together.

    The state is kept for ``groups`` groups of slices.  What a group keeps is read
    when anything comes for it, its numbers whole and of its events those that came
    together with the ones wanted: more slices at a time want more groups.  A
    checkpoint can be continued with the same number only.

    ``on_slice`` is called in the task with each slice that is given out, as a
    DataFrame of one row; what it returns, in the shape of ``schema``, is the
    output instead.

    With a ``watermark`` timers follow event time, and Spark leaves out events
    that are older than the watermark.  With None timers follow the clock and
    every event is kept; such a query waits for its timers, so it runs with a
    periodic trigger and not until "available now" is done.
    """
    # Events without a session, a number or a time have no place and would stop the state for good;
    # ``ordering.unplaced`` gives a second stream of them.
    events = placed(events, "session_id", "seq", "ts")
    timed = events if watermark is None else events.withWatermark("ts", watermark)
    routed = route_events(timed, "payload", frame).select(
        "session_id",
        slice_of("seq", slice_events).alias(PART),
        "seq",
        "ts",
        "event_class",
        decoded_audio(F.col("delta")).alias("audio"),
        F.col("delta").isNotNull().alias("is_delta"),
    )
    settings = (slice_events, timeout_ms, forget_ms, watermark is not None)
    how = {"outputMode": "append", "timeMode": "ProcessingTime" if watermark is None else "EventTime"}
    if on_slice is not None:
        hooked = HookedSliceProcessor(*settings, on_slice)
        return routed.groupBy("session_id", PART).transformWithStateInPandas(hooked, schema, **how)
    grouped = grouped_events(packed_events(routed), groups).groupBy("slices")
    return unpacked_slices(grouped.transformWithState(SliceGroupProcessor(*settings), PACKED_SCHEMA, **how), schema)


def lifecycle(slices: DataFrame) -> DataFrame:
    """The rows of ``session_lifecycle``, from slices and their revisions."""
    seen = slices.groupBy("session_id").agg(
        F.min("created_seq").alias("_created"),
        F.min("finished_seq").alias("_finished"),
        F.min("closed_seq").alias("_closed"),
        F.min("error_seq").alias("_error"),
        F.max("max_seq").alias("_max"),
    )
    return lifecycle_of(seen, "session_id")


def _whole_slices(slices: DataFrame) -> DataFrame:
    """``(session_id, part, _rows, _end, _ended)``: rows of each slice, its first end, and slices before it that hold an end.

    One narrow row per slice; no audio is read.
    """
    end = F.least(F.min("finished_seq"), F.min("closed_seq"), F.min("error_seq"))
    whole = slices.groupBy("session_id", PART).agg(F.count(F.lit(1)).alias("_rows"), end.alias("_end"))
    ended = F.when(F.col("_end").isNotNull(), 1).otherwise(0)
    return running_before(whole, ["session_id"], PART, {"_ended": ended}).select("session_id", PART, "_rows", "_end", "_ended")


def audio_parts(slices: DataFrame, audio: AudioFormat = PCM_24000HZ_MONO_16BIT) -> DataFrame:
    """The rows of ``assemble_audio`` over ``until_finished`` events, from slices.

    A slice of one row is taken as it is; the deltas of several revisions are put in
    order, up to the first end that any of them holds.
    """
    read = slices.where("n_deltas > 0").join(_whole_slices(slices), ["session_id", PART]).where("_ended = 0")
    once = read.where("_rows = 1").select("session_id", PART, "audio", "n_bytes", "n_bad")
    several = read.where("_rows > 1").select(
        "session_id", PART, "_end", "audio", F.posexplode(F.arrays_zip("delta_seqs", "delta_ends")).alias("_at", "_delta"), "delta_ends"
    )
    before = F.array_max(F.slice("delta_ends", 1, F.col("_at")))
    start = F.coalesce(F.when(F.col("_at") > 0, before), F.lit(0).cast("long"))
    stop = F.col("_delta.delta_ends")
    piece = F.when(stop.isNotNull(), F.substring("audio", (start + 1).cast("int"), (stop - start).cast("int")))
    deltas = several.select("session_id", PART, "_end", F.col("_delta.delta_seqs").alias("_seq"), piece.alias("_piece"))
    merged = (
        deltas.where("_end IS NULL OR _seq <= _end")
        .groupBy("session_id", PART)
        .agg(
            F.coalesce(F.expr("listagg(_piece, X'') WITHIN GROUP (ORDER BY _seq, _piece)"), F.lit(b"")).alias("audio"),
            F.coalesce(F.sum(F.octet_length("_piece")), F.lit(0)).cast("long").alias("n_bytes"),
            F.count_if(F.col("_piece").isNull()).alias("n_bad"),
        )
    )
    parts = once.unionByName(merged)
    return parts.select("session_id", PART, "audio", "n_bytes", audio.seconds(F.col("n_bytes")).alias("seconds"), "n_bad")


def late_counts(slices: DataFrame) -> DataFrame:
    """``(session_id, n_late)``: events after the end of their session, in their slice or a later one."""
    events = slices.select("session_id", PART, "n_events", "n_late", "seqs").join(_whole_slices(slices), ["session_id", PART])
    beyond = F.when(F.col("_rows") == 1, F.col("n_late")).otherwise(F.size(F.filter("seqs", lambda s: s > F.col("_end"))))
    n = F.when(F.col("_ended") > 0, F.col("n_events")).when(F.col("_end").isNull(), 0).otherwise(beyond)
    counted = events.groupBy("session_id").agg(F.sum(n).alias("n_late"))
    return counted.where(F.col("n_late") > 0)
