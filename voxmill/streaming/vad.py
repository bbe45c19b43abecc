"""Voice activity as a keyed stateful operator: one kernel for streams and for tables.

Input rows are frames: stream_id STRING, frame INT (from 0, in order), speech BOOLEAN, is_final BOOLEAN. Output rows are
boundaries in milliseconds: a begin when speech is confirmed, an end when it stops; -1 stands for the half not known yet.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FRAME_MS, WINDOW, VOTES, LOOK_BACK_MS, LEAVE_MS, SWITCH_MS = 10, 20, 15, 200, 100, 150
BOUNDS = "stream_id string, start_ms int, end_ms int"


@dataclass
class SpeechState:
    """What one stream needs between frames; all of it is small and goes through JSON."""

    votes: list = field(default_factory=list)
    speaking: bool = False  # by majority of the last frames
    start: int = -1  # frame of the open segment
    silence: int = 0
    free: int = 0  # first frame that no segment or dropped silence holds
    next: int = 0
    half: bool = False  # the begin was sent without an end
    waiting: dict = field(default_factory=dict)  # frames that came before an earlier one: [speech, final] by number
    total: int = 0  # of the votes

    def feed(self, speech: bool, final: bool, tail_ms: int, longest_ms: int) -> tuple[int, int] | None:
        """A closed segment (first frame, frame after the last), if this frame closes one."""
        t = self.next
        self.next += 1
        self.votes.append(int(speech))
        self.total += self.votes[-1] - (self.votes.pop(0) if len(self.votes) > WINDOW else 0)
        total, was = self.total, self.speaking
        if not was and total >= VOTES:
            self.speaking = True
        elif was and total <= VOTES:
            self.speaking = False
        quiet = not was and not self.speaking
        self.silence = self.silence + 1 if quiet else 0
        latency = WINDOW + LOOK_BACK_MS // FRAME_MS
        if self.start < 0:
            if not was and self.speaking:
                self.start = max(self.free, t - latency)
            elif quiet:
                self.free = max(self.free, t - latency)
            return None
        end = None
        tail = max(0, tail_ms - SWITCH_MS)
        if quiet and self.silence * FRAME_MS >= tail:
            end = t - max(0, tail // FRAME_MS - LEAVE_MS // FRAME_MS - 1)
        elif t - self.start + 1 > longest_ms // FRAME_MS or final:
            end = t
        if end is None:
            return None
        out = (self.start, max(end, self.start) + 1)
        self.start, self.silence, self.speaking, self.votes, self.total, self.free = -1, 0, False, [], 0, out[1]
        return out


def boundaries(state: SpeechState, frames: list[tuple[bool, bool]], tail_ms: int, longest_ms: int) -> list[tuple[int, int]]:
    """STR4: [begin, -1] when a segment opens, [-1, end] when it closes, [begin, end] if both fall into these frames."""
    out: list[tuple[int, int]] = []
    for speech, final in frames:
        closed = state.feed(speech, final, tail_ms, longest_ms)
        if closed:
            out.append((-1 if state.half else closed[0] * FRAME_MS, closed[1] * FRAME_MS))
            state.half = False
    if state.start >= 0 and not state.half:
        out.append((state.start * FRAME_MS, -1))
        state.half = True
    return out


def segments_of_table(frames: DataFrame, tail_ms: int = 800, longest_ms: int = 15_000) -> DataFrame:
    """STR3: (stream_id, start_ms, end_ms) of each segment of a table of frames. A stream's last frame closes what is open.

    Streams are sorted within their partition and passed through frame by frame; only one stream's state is held. A frame
    given twice is speech if either row says so; a null flag is silence.
    """
    clean = frames.select("stream_id", F.col("frame").cast("int").alias("frame"), F.coalesce("speech", F.lit(False)).alias("speech")).groupBy("stream_id", "frame").agg(F.max("speech").alias("speech"))
    ordered = clean.repartition("stream_id").sortWithinPartitions("stream_id", "frame")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state, held = None, SpeechState(), None

        def flush() -> list:
            closed = state.feed(held, True, tail_ms, longest_ms) if held is not None else None
            return [(name, closed[0] * FRAME_MS, closed[1] * FRAME_MS)] if closed else []

        for pdf in batches:
            out = []
            for s, speech in zip(pdf["stream_id"], pdf["speech"]):
                if s != name:
                    out += flush()
                    name, state, held = s, SpeechState(), None
                if held is not None:
                    closed = state.feed(held, False, tail_ms, longest_ms)
                    if closed:
                        out.append((name, closed[0] * FRAME_MS, closed[1] * FRAME_MS))
                held = bool(speech)
            yield pd.DataFrame(out, columns=["stream_id", "start_ms", "end_ms"])
        yield pd.DataFrame(flush(), columns=["stream_id", "start_ms", "end_ms"])

    return ordered.mapInPandas(run, BOUNDS)


def segment_stream(frames: DataFrame, tail_ms: int = 800, longest_ms: int = 15_000, idle_ms: int | None = 60_000) -> DataFrame:
    """STR1, STR3, STR4, STR9: the same over a stream of frames, as boundaries in order of detection.

    The key's state is its SpeechState alone. A final frame frees it, as does ``idle_ms`` without input (processing time; None: never, for
    streams that end).
    Frames are taken in order of their numbers: one that comes early waits in the state for those before it, and a final
    frame closes the stream once all have come. A frame given twice within a micro-batch or while it waits is speech if
    either row says so; a number already passed was taken before.
    """
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame(columns=["stream_id", "start_ms", "end_ms"])
            return
        s = SpeechState(**json.loads(state.get[0])) if state.exists else SpeechState()
        waiting = {int(k): v for k, v in s.waiting.items()}
        pdf = pd.concat(list(batches))
        for t, a, f in zip(pdf["frame"], pdf["speech"].fillna(False), pdf["is_final"].fillna(False)):
            if t >= s.next:
                had = waiting.get(int(t), [False, False])
                waiting[int(t)] = [bool(a) or had[0], bool(f) or had[1]]
        rows, t = [], s.next
        while t in waiting:
            rows.append(tuple(waiting.pop(t)))
            t += 1
        s.waiting = waiting
        out = boundaries(s, rows, tail_ms, longest_ms)
        if any(f for _, f in rows):
            state.remove()
        else:
            state.update((json.dumps(asdict(s)),))
            if idle_ms:
                state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame([(key[0], a, b) for a, b in out], columns=["stream_id", "start_ms", "end_ms"])

    return frames.groupBy("stream_id").applyInPandasWithState(update, BOUNDS, "state string", "append", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def closed_segments(bounds: DataFrame, order: str) -> DataFrame:
    """STR5: pairs of -1 halves as whole segments: an end takes the last begin before it in the stream's order."""
    before = Window.partitionBy("stream_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    begun = bounds.withColumn("_begin", F.last(F.when(F.col("start_ms") >= 0, F.col("start_ms")), ignorenulls=True).over(before))
    return begun.where("end_ms >= 0").select("stream_id", F.col("_begin").alias("start_ms"), "end_ms")


def gap_sessions(df: DataFrame, key: str, at: str, gap_s: float, tie: str) -> DataFrame:
    """STR3's fixed part over event times: df with ``session`` from 0 within the key; a pause of ``gap_s`` or more begins the next."""
    w = Window.partitionBy(key).orderBy(at, tie)
    pause = F.col(at).cast("timestamp").cast("double") - F.lag(F.col(at).cast("timestamp").cast("double")).over(w) >= gap_s
    return df.withColumn("_new", F.coalesce(pause, F.lit(False)).cast("int")).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def session_windows(events: DataFrame, key: str, at: str, gap: str, late: str | None = None) -> DataFrame:
    """Sessions of a stream or table by a gap; in a stream, rows later than ``late`` are dropped by the watermark."""
    marked = events.withWatermark(at, late) if late else events
    w = F.session_window(at, gap)
    return marked.groupBy(F.col(key), w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
