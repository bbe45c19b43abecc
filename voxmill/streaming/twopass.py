"""Two recognition passes over one stream: quick partial results, corrected by the final ones; with the buffering before them."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STEP_BYTES = 1600
KEEP_MS = 2000


def whole_steps(kept: bytes, data: bytes, final: bool, step: int = STEP_BYTES) -> tuple[list[bytes], bytes]:
    """STR2: (steps of ``step`` bytes, what is kept for the next call); a final call gives the rest as a short step."""
    data = kept + data
    cut = len(data) - len(data) % step
    steps = [data[a : a + step] for a in range(0, cut, step)]
    if final and cut < len(data):
        steps.append(data[cut:])
        cut = len(data)
    return steps, data[cut:]


def trimmed_from(open_start_ms: int | None, now_ms: int, kept_from_ms: int) -> int:
    """STR7: from where samples are kept: ``KEEP_MS`` before the open segment, or before now when none is open."""
    return max(kept_from_ms, (now_ms if open_start_ms is None else open_start_ms) - KEEP_MS)


def chunk_plan(length: int, chunk: int, ahead: int) -> list[tuple[int, int, bool]]:
    """STR10: (begin, end, last) of the chunks of an open segment; a last chunk that leaves no room for the look-ahead is split in two."""
    out = [(a, min(a + chunk, length)) for a in range(0, length, chunk)]
    if out and out[-1][1] - out[-1][0] > chunk - ahead > 0:
        a, b = out.pop()
        out += [(a, a + chunk - ahead), (a + chunk - ahead, b)]
    return [(a, b, k == len(out) - 1) for k, (a, b) in enumerate(out)]


class FrameStacker:
    """STR11: WN11 over chunks: frames that do not fill a window wait for the next chunk; the first call pads on the left."""

    def __init__(self, m: int = 7, n: int = 6):
        self.m, self.n, self.kept, self.begun = m, n, None, False

    def feed(self, frames: np.ndarray, final: bool = False) -> np.ndarray:
        if not self.begun and len(frames):
            frames = np.concatenate([np.repeat(frames[:1], (self.m - 1) // 2, axis=0), frames])
            self.begun = True
        data = frames if self.kept is None else np.concatenate([self.kept, frames])
        rows, at = [], 0
        while at < len(data) and (at + self.m <= len(data) or final and at + (self.m - 1) // 2 < len(data)):
            part = data[at : at + self.m]
            rows.append(np.concatenate([part, np.repeat(data[-1:], self.m - len(part), axis=0)]).reshape(-1))
            at += self.n
        self.kept = data[at:]
        return np.array(rows) if rows else np.zeros((0, self.m * data.shape[1] if data.ndim > 1 else 0))


def route(mode: Column) -> Column:
    """STR6: ARRAY<STRING> of the passes that a mode runs."""
    return F.when(mode == "offline", F.array(F.lit("offline"))).when(mode == "online", F.array(F.lit("online"))).otherwise(F.array(F.lit("2pass-online"), F.lit("2pass-offline")))


def fan_out(segments: DataFrame, chunk_ms: int = 600) -> DataFrame:
    """STR6: (stream_id, pass, start_ms, end_ms, is_final): the online chunks of each closed segment and the segment itself."""
    rows = segments.select("stream_id", "start_ms", "end_ms", F.explode(route(F.col("mode"))).alias("pass"))
    online = F.col("pass").isin("online", "2pass-online")
    steps = F.sequence(F.lit(0), F.floor((F.col("end_ms") - F.col("start_ms") - 1) / chunk_ms).cast("int"))
    chunks = F.transform(steps, lambda k: F.struct((F.col("start_ms") + k * chunk_ms).alias("start_ms"), F.least(F.col("start_ms") + (k + 1) * chunk_ms, F.col("end_ms")).alias("end_ms"), ((k + 1) * chunk_ms >= F.col("end_ms") - F.col("start_ms")).alias("is_final")))
    whole = F.array(F.struct(F.col("start_ms"), F.col("end_ms"), F.lit(True).alias("is_final")))
    return rows.where("end_ms > start_ms").select("stream_id", "pass", F.explode(F.when(online, chunks).otherwise(whole)).alias("c")).select("stream_id", "pass", "c.*")


def unique_messages(messages: DataFrame) -> DataFrame:
    """One row for each (conn_id, seq_no), the first received (then the lower msg_id); null keys are kept apart."""
    keyed = messages.where(F.col("conn_id").isNotNull() & F.col("seq_no").isNotNull())
    rest = [c for c in messages.columns if c not in ("conn_id", "seq_no")]
    first = keyed.groupBy("conn_id", "seq_no").agg(F.min_by(F.struct(*rest), F.struct(F.coalesce("recv_at", F.lit("9999-12-31").cast("timestamp")), "msg_id")).alias("r"))
    return first.select("conn_id", "seq_no", "r.*").select(*messages.columns)


def merged_text(messages: DataFrame) -> DataFrame:
    """WN9, STR8: (conn_id, text, finals, partials) in the order of seq_no: final results are kept, partial ones stand only until the
    next final one, and what is still open at the end follows.

    Partials after the last final are the open part. Repeated deliveries count once; null texts count as empty.
    """
    rows = unique_messages(messages).select("conn_id", "seq_no", F.coalesce("text", F.lit("")).alias("text"), F.col("mode").isin("2pass-offline", "offline").alias("final"))
    last = F.max(F.when(F.col("final"), F.col("seq_no"))).over(Window.partitionBy("conn_id"))
    kept = rows.withColumn("_last", last).withColumn("keep", F.col("final") | F.col("_last").isNull() | (F.col("seq_no") > F.col("_last")))
    ordered = F.transform(F.sort_array(F.collect_list(F.when(F.col("keep"), F.struct("seq_no", "text")))), lambda x: x["text"])
    return kept.groupBy("conn_id").agg(F.array_join(ordered, "").alias("text"), F.sum(F.col("final").cast("int")).alias("finals"), F.sum((~F.col("final")).cast("int")).alias("partials"))


def merge_stream(messages: DataFrame, idle_ms: int | None = 60_000, most_waiting: int | None = None) -> DataFrame:
    """STR8, STR9 over a stream of (conn_id, seq_no, mode, text, is_final): (conn_id, seq_no, text) after each micro-batch.

    The text is merged_text()'s whatever order the numbers come in, late ones included; of repeated deliveries the first
    received counts (``recv_at``, ``msg_id``, where the stream has them). State: the final texts by number, and the partial
    ones after the last final. ``most_waiting`` bounds it for connections that never end: once more numbers are held, the
    oldest finals become one fixed text, and numbers up to them that come later are dropped. A connection without input
    for ``idle_ms`` frees its state (None: never, for streams that end).
    """
    order = [c for c in ("recv_at", "msg_id") if c in messages.columns]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame(columns=["conn_id", "seq_no", "text"])
            return
        s = json.loads(state.get[0]) if state.exists else {"fixed": "", "upto": None, "seq": -1, "held": {}}
        held = {int(k): v for k, v in s["held"].items()}  # number -> [order of delivery, whether final, text]
        for row in pd.concat(list(batches)).to_dict("records"):
            seq = int(row["seq_no"])
            at = [str(row[c]) if row[c] == row[c] and row[c] is not None else "~" for c in order[:1]] + [int(row[c]) for c in order[1:]]
            if (s["upto"] is None or seq > s["upto"]) and (seq not in held or order and at < held[seq][0]):
                held[seq] = [at, row["mode"] in ("2pass-offline", "offline"), row["text"] if isinstance(row["text"], str) else ""]
        last = max((k for k, (_, final, _) in held.items() if final), default=None)
        numbers = sorted(held)
        text = s["fixed"] + "".join(held[k][2] for k in numbers if held[k][1] or last is None or k > last)
        s["seq"] = max([s["seq"], *numbers])
        while most_waiting is not None and len(numbers) > most_waiting and numbers[0] != last and last is not None:
            k = numbers.pop(0)
            s["fixed"], s["upto"] = s["fixed"] + (held[k][2] if held[k][1] else ""), k
            del held[k]
        state.update((json.dumps(s | {"held": held}),))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame([(key[0], s["seq"], text)], columns=["conn_id", "seq_no", "text"])

    return messages.groupBy("conn_id").applyInPandasWithState(update, "conn_id bigint, seq_no int, text string", "state string", "update", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def latest_settings(config: DataFrame, defaults: dict) -> DataFrame:
    """JS3, STR1: (conn_id, settings...): each setting's last value given by a connection, else the default.

    One aggregation with map-side combine; a setting is "given" where it is not null.
    """
    at = F.struct(F.coalesce(F.col("sent_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), "cfg_id")
    last = [F.coalesce(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)), F.lit(v)).alias(c) for c, v in defaults.items()]
    return config.groupBy("conn_id").agg(*last)


def paced(spark, path: str, schema: str, files_per_step: int = 1) -> DataFrame:
    """STR12, SRC14: a folder of files as a stream, so many files a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_step).parquet(path)
