"""Cutting items that are too long into pieces under a limit, at natural boundaries where there are any."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the service: limits by mode and the look-back.
OFFLINE_LIMIT_MS, LIVE_LIMIT_MS, LOOK_BACK_UNITS, UNIT_MS = 60000, 20000, 5, 60
PAUSE_MS = 300
#: Penalties of a cut at a token's edge and inside a token; any number of cuts at pauses costs less than one of them.
EDGE, INSIDE = 1e6, 1e9
#: A space of more pieces than this is filled evenly in one step.
FEW = 16

#: A JSON array of one or more two-integer arrays; possessive, so that long lists cost no stack.
_INT = r"-?+(?:0|[1-9][0-9]*+)"
_PAIR = rf"\[[ \t\r\n]*+{_INT}[ \t\r\n]*+,[ \t\r\n]*+{_INT}[ \t\r\n]*+\]"
READABLE = rf"^[ \t\r\n]*+\[[ \t\r\n]*+{_PAIR}(?:[ \t\r\n]*+,[ \t\r\n]*+{_PAIR})*+[ \t\r\n]*+\][ \t\r\n]*+\z"


def read_spans(text: Column) -> Column:
    """ARRAY<ARRAY<BIGINT>> of a wholly readable timestamp list, else null."""
    return F.when(text.rlike(READABLE), F.from_json(text, "array<array<bigint>>"))


def session_limits(config: DataFrame) -> DataFrame:
    """(conn_id, max_len, look_back): of each connection's latest row that gives a usable value; later id on ties.

    A null sent_at counts as the earliest. Values of 0 or below and null or empty lists give nothing.
    """
    at = F.struct(F.coalesce(F.col("sent_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), "cfg_id")
    given = F.col("vad_max_len") > 0
    chunk = F.element_at("chunk_size", 1)
    return config.groupBy("conn_id").agg(
        F.max_by(F.when(given, F.col("vad_max_len")), F.when(given, at)).alias("max_len"),
        F.max_by(chunk, F.when(F.col("chunk_size").isNotNull() & (F.size("chunk_size") > 0), at)).alias("look_back"),
    )


def stretches(spans: list, pause: int = PAUSE_MS) -> list[list[tuple[int, int]]]:
    """The spans in time order, parted wherever a pause lies between the end of one and the begin of the next."""
    out: list[list[tuple[int, int]]] = []
    for b, e in sorted(map(tuple, spans)):
        if out and b - out[-1][-1][1] < pause:
            out[-1].append((b, e))
        else:
            out.append([(b, e)])
    return out


def _boundaries(parts: list, step: int) -> tuple[dict[int, float], dict[int, tuple[int, int, float]]]:
    """(penalty of a cut by place; wide spaces by their end: (begin, even pieces, penalty of a cut in it)), from the begin to the end of the item.

    Cuts may stand at the edges of pauses and, in a stretch that must be cut, at the edges of its spans. A space between
    two such places that is wider than a piece gets places of its own: those of even pieces, and whole pieces counted
    from either side. A space of over ``FEW`` pieces is filled evenly from edge to edge instead, in one step.
    """
    place: dict[int, float] = {}

    def offer(t: int, penalty: float) -> None:
        place[t] = min(penalty, place.get(t, penalty))

    tokens = [x for part in parts for x in part]
    begin, end = tokens[0][0], max(e for _, e in tokens)
    for part in parts:
        offer(part[0][0], 0.0)
        offer(part[-1][1], 0.0)
        if max(e for _, e in part) - part[0][0] > step:
            for b, e in part:
                offer(b, EDGE)
                offer(e, EDGE)
    offer(begin, 0.0)
    offer(end, 0.0)
    pauses = {a[-1][1]: b[0][0] for a, b in zip(parts, parts[1:])}
    starts, wide = sorted(pauses), {}
    at = sorted(t for t in place if begin <= t <= end)
    for x, y in zip(at, at[1:]):
        n = -(-(y - x) // step)
        if n < 2:
            continue
        k = bisect_right(starts, x)
        quiet = k and y <= pauses[starts[k - 1]]
        penalty = 0.0 if quiet else INSIDE if any(b <= x and e >= y for b, e in tokens) else EDGE
        if n > FEW:
            wide[y] = (x, n, penalty)
            continue
        for i in range(1, n):
            offer(x + i * (y - x) // n, penalty)
            offer(x + i * step, penalty)
            offer(y - i * step, penalty)
    return {t: w for t, w in place.items() if begin <= t <= end}, wide


def cut_runs(spans: list, limit: int, overlap: int, pause: int = PAUSE_MS) -> tuple[list[tuple[int, int, int]], bool]:
    """(runs (from, to, pieces) of even pieces that fill the item in order, whether a stretch without a pause had to be cut).

    Dynamic programming over the boundary positions minimises the penalties of the cuts, then the imbalance of the pieces
    (squared unused room), with no piece longer than the limit once the overlap before it is added. A stretch has to be cut
    if it lasts longer than limit minus overlap. An overlap of the limit or more leaves no room for pieces: for the
    cuts it is then lowered to half the limit.
    """
    parts = stretches(spans, pause)
    forced = any(max(e for _, e in part) - part[0][0] > limit - overlap for part in parts)
    step = limit - overlap if overlap < limit else max(1, limit - limit // 2)
    place, wide = _boundaries(parts, step)
    at = np.array(sorted(place), dtype=np.int64)
    n, node = len(at), {t: i for i, t in enumerate(at.tolist())}
    cost, back, pieces = np.full(n, np.inf), np.zeros(n, dtype=np.int64), [1] * n
    cost[0] = 0.0
    low = np.searchsorted(at, at - step)
    for j in range(1, n):
        i0, t = int(low[j]), int(at[j])
        if i0 < j:
            unused = (step - (at[j] - at[i0:j])) / step
            total = cost[i0:j] + unused * unused
            k = int(total.argmin())
            cost[j], back[j] = total[k], i0 + k
        if t in wide:
            x, m, penalty = wide[t]
            whole = cost[node[x]] + m * (1 - (t - x) / m / step) ** 2 + (m - 1) * penalty
            if whole < cost[j]:
                cost[j], back[j], pieces[j] = whole, node[x], m
        cost[j] += place[t]
    runs, j = [], n - 1
    while j > 0:
        i = int(back[j])
        runs.append((int(at[i]), int(at[j]), pieces[j]))
        j = i
    return runs[::-1] or [(int(at[0]), int(at[0]), 1)], bool(forced)


def cut_item(spans: list, limit: int, overlap: int, pause: int = PAUSE_MS) -> tuple[list[int], bool]:
    """cut_runs() with the cuts one by one."""
    runs, forced = cut_runs(spans, limit, overlap, pause)
    return [a + i * (b - a) // n for a, b, n in runs for i in range(n)][1:], forced


_RUNS = "array<struct<from_ms:bigint,to_ms:bigint,pieces:bigint>>"


def _cut_batches(pause: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [cut_runs(s, int(m), int(o), pause) for s, m, o in zip(pdf["spans"], pdf["limit_ms"], pdf["overlap_ms"])]
            runs = [[{"from_ms": a, "to_ms": b, "pieces": n} for a, b, n in r] for r, _ in out]
            yield pd.DataFrame({"item": pdf["item"], "begin_ms": pdf["begin_ms"], "end_ms": pdf["end_ms"], "limit_ms": pdf["limit_ms"], "overlap_ms": pdf["overlap_ms"], "runs": runs, "forced": [f for _, f in out]})

    return run


def split_oversized(items: DataFrame, pause: int = PAUSE_MS) -> DataFrame:
    """(item, begin_ms, end_ms, limit_ms, overlap_ms, runs, forced BOOLEAN) of the items longer than their limit.

    ``runs`` ARRAY<STRUCT<from_ms, to_ms, pieces>> are the pieces in order, even ones that follow each other as one entry:
    a silence of years between two readings is one, whatever the number of its pieces. ``items`` has item, spans
    ARRAY<ARRAY<BIGINT>>, limit_ms, overlap_ms; one row an item, repeated items give repeated rows. Length, limit and the
    selection of long items are worked out in the JVM; only those reach the Arrow worker. Null or empty spans and items
    within the limit give no row.
    """
    spanned = items.where(F.size("spans") > 0).select(
        "item", "spans", F.col("limit_ms").cast("bigint"), F.col("overlap_ms").cast("bigint"),
        F.array_min(F.transform("spans", lambda p: p[0])).alias("begin_ms"), F.array_max(F.transform("spans", lambda p: p[1])).alias("end_ms"),
    )
    long = spanned.where(F.col("end_ms") - F.col("begin_ms") > F.col("limit_ms"))
    return long.mapInPandas(_cut_batches(pause), f"item bigint, begin_ms bigint, end_ms bigint, limit_ms bigint, overlap_ms bigint, runs {_RUNS}, forced boolean")


def pieces(split: DataFrame, at_once: int = 10_000) -> DataFrame:
    """(item, piece, begin_ms, end_ms): the pieces of each split item, each but the first begun by its overlap earlier.

    Runs of many pieces are listed in two steps, so that no row holds more than ``at_once`` of a run's pieces.
    """
    before = F.transform(F.sequence(F.lit(1), F.size("runs")), lambda k: F.aggregate(F.slice("runs", F.lit(1), k - 1), F.lit(0).cast("bigint"), lambda a, r: a + r["pieces"]))
    overlap = F.when(F.col("overlap_ms") < F.col("limit_ms"), F.col("overlap_ms")).otherwise(F.floor(F.col("limit_ms") / 2))
    rows = split.select("item", F.col("begin_ms").alias("first"), overlap.alias("overlap"), F.explode(F.arrays_zip("runs", before.alias("before"))).alias("r"))
    rows = rows.select("item", "first", "overlap", F.col("r.runs.from_ms").alias("a"), F.col("r.runs.to_ms").alias("b"), F.col("r.runs.pieces").alias("n"), F.col("r.before").alias("before"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / at_once))).alias("block"))
    last = F.least(F.col("n"), (F.col("block") + 1) * at_once) - 1
    rows = rows.select("*", F.explode(F.sequence(F.col("block") * at_once, last)).alias("i"))
    # i * (b - a) div n without running over 64 bits.
    width, rest = F.expr("(b - a) div n"), F.expr("(b - a) % n")
    edge = lambda i: F.col("a") + i * width + F.floor((i * rest).cast("decimal(38,0)") / F.col("n")).cast("bigint")
    begin, piece = edge(F.col("i")), F.col("before") + F.col("i")
    return rows.select("item", piece.alias("piece"), F.when(piece == 0, begin).otherwise(F.greatest(F.col("first"), begin - F.col("overlap"))).alias("begin_ms"), edge(F.col("i") + 1).alias("end_ms"))


def piece_faults(split: DataFrame) -> DataFrame:
    """(item, begin_ms, end_ms, too_long, wrong_overlap, gaps) of each split item: from where to where its pieces reach, and how many
    of them are longer than the limit, overlap the one before otherwise than given, or leave a place number out. For items
    whose ids are unique."""
    rows = pieces(split).join(split.select(F.col("item").alias("_i"), "limit_ms", "overlap_ms", F.col("begin_ms").alias("_from")), F.col("item") == F.col("_i"))
    before = Window.partitionBy("item").orderBy("piece")
    wanted = F.greatest(F.col("_from"), F.lag("end_ms").over(before) - F.when(F.col("overlap_ms") < F.col("limit_ms"), F.col("overlap_ms")).otherwise(F.floor(F.col("limit_ms") / 2)))
    rows = rows.withColumn("_wrong", (F.col("piece") > 0) & (F.col("begin_ms") != wanted)).withColumn("_gap", F.col("piece") != F.row_number().over(before) - 1)
    count = lambda c: F.sum(c.cast("int"))
    return rows.groupBy("item").agg(F.min("begin_ms").alias("begin_ms"), F.max("end_ms").alias("end_ms"), count(F.col("end_ms") - F.col("begin_ms") > F.col("limit_ms")).alias("too_long"), count(F.col("_wrong")).alias("wrong_overlap"), count(F.col("_gap")).alias("gaps"))


def long_messages(messages: DataFrame, config: DataFrame) -> DataFrame:
    """split_oversized() of the result messages, each under its connection's limit and look-back.

    Unreadable, null and empty lists are not items. Lists shorter than every limit in force cannot be long, so they
    leave before the join; the least limit is one number of the whole configuration. The configuration's side has one row
    a connection, so a connection with a great share of the messages is split by the planner's skew join.
    """
    limits = session_limits(config)
    least = limits.agg(F.least(F.coalesce(F.min("max_len"), F.lit(LIVE_LIMIT_MS)), F.lit(LIVE_LIMIT_MS)).alias("least"))
    spans = messages.select("msg_id", "conn_id", "mode", read_spans(F.col("timestamp")).alias("spans")).where(F.col("spans").isNotNull())
    reach = F.array_max(F.transform("spans", lambda p: p[1])) - F.array_min(F.transform("spans", lambda p: p[0]))
    spans = spans.where(reach > least.scalar())
    known = spans.join(limits, "conn_id", "left")
    default = F.when(F.col("mode") == "offline", OFFLINE_LIMIT_MS).otherwise(LIVE_LIMIT_MS)
    return split_oversized(known.select(F.col("msg_id").alias("item"), "spans", F.coalesce("max_len", default).alias("limit_ms"), (F.coalesce("look_back", F.lit(LOOK_BACK_UNITS)) * UNIT_MS).alias("overlap_ms")))
