"""Segments of recordings: numbering, islands of sentences, joins in time, batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType


def numbered_segments(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """WN4: df with ``segment_idx``, the place from 0 within its keys."""
    return df.withColumn("segment_idx", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def segment_ids(file: Column, speaker: Column, idx: Column) -> Column:
    """PRJ1: <file>-<speaker>_%04d."""
    return F.format_string("%s-%s_%04d", file, speaker, idx)


def utt_of_path(path: Column, root: str) -> Column:
    """SRC1, PRJ1: the path below the root with '/' made '_'."""
    rest = F.when(path.startswith(root), F.substring(path, F.lit(len(root) + 1), F.char_length(path))).otherwise(path)
    return F.replace(F.regexp_replace(rest, "^/+", ""), F.lit("/"), F.lit("_"))


def basename(path: Column) -> Column:
    """PRJ2."""
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    """PRJ2: what follows the last dot of the name, or nothing."""
    return F.regexp_extract(basename(path), r"\.([^.]*)$", 1)


def parent(path: Column) -> Column:
    """PRJ2, SRC2: the name of the folder that holds the file."""
    return F.coalesce(F.get(F.reverse(F.split(path, "/")), F.lit(1)), F.lit(""))


def paragraph_islands(df: DataFrame, keys: list[str], order: list[Column], ends: Column) -> DataFrame:
    """WN10: df with ``island``: rows up to and with one that ends belong together; places from 0 within the keys."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("island", F.coalesce(F.sum(F.when(ends, 1).otherwise(0)).over(before), F.lit(0)))


def gather_paragraphs(sentences: list, length_ms: float, shift_ms: int = 1200) -> list[dict]:
    """WN10, TM9 with their time guards: sentences (start, end, text_seg, punc) gathered up to a full stop.

    An end lies ``shift_ms`` before the sentence's own end. A paragraph closes at a full stop if it has positive length
    and begins within the recording; the next one begins where it ended. A rest without a full stop closes alike.
    """
    out, begin, end, text, punc = [], 0.0, 0.0, "", "。"

    def fits() -> bool:
        return begin < end and begin < length_ms

    for s in sentences:
        begin = begin or float(s["start"])
        end, punc = float(s["end"]) - shift_ms, s["punc"]
        text += f"{s['text_seg']} {punc}"
        if punc == "。" and fits():
            out.append({"begin": begin, "end": end, "text": text})
            begin, text = end, ""
    if punc != "。" and fits():
        out.append({"begin": begin, "end": end, "text": text})
    return out


_PARAGRAPHS = ArrayType(StructType([StructField("begin", DoubleType()), StructField("end", DoubleType()), StructField("text", StringType())]))


@F.pandas_udf(_PARAGRAPHS)
def paragraphs(sentences: pd.Series, length_ms: pd.Series) -> pd.Series:
    """gather_paragraphs() over columns; null sentences give none."""
    return pd.Series([gather_paragraphs(s, n) if s is not None else [] for s, n in zip(sentences, length_ms)])


def tolerance_join(tests: DataFrame, data: DataFrame, key: str, begin: str = "start", end: str = "end", within: float = 3, order: str = "ord") -> DataFrame:
    """JN6: each test row with the first data row, in data order, of its key whose begin and end both lie closer than ``within``.

    Columns of the data row get the prefix ``d_``; tests without a match are left out. Times are cut into cells of the
    tolerance's width and each data row is offered to its own and the two neighbouring cells, so a key with many rows
    is spread over its cells instead of joined all against all.
    """
    d = data.select(*[F.col(c).alias(f"d_{c}") for c in data.columns])
    cell = F.floor(F.col(f"d_{begin}") / F.lit(within)).cast("bigint")
    d = d.withColumn("_cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    t = tests.withColumn("_cell", F.floor(F.col(begin) / F.lit(within)).cast("bigint")).withColumn("_id", F.monotonically_increasing_id())
    near = t.join(d, (F.col(key) == F.col(f"d_{key}")) & (t["_cell"] == d["_cell"]) & (F.abs(F.col(begin) - F.col(f"d_{begin}")) < within) & (F.abs(F.col(end) - F.col(f"d_{end}")) < within))
    wanted = [c for c in tests.columns] + list(d.columns[:-1])
    first = near.groupBy("_id").agg(F.min_by(F.struct(*[F.col(c) for c in wanted]), F.col(f"d_{order}")).alias("r"))
    return first.select("r.*")


def speaker_of_segments(segments: DataFrame, turns: DataFrame, key: str, cell_ms: int = 10_000) -> DataFrame:
    """JN9: segments (key, seg, start, end) with the speaker of the turns (key, speaker, start, end) that overlap them longest.

    Equal overlaps go to the speaker first in the alphabet; segments without overlap are left out. The reference leaves
    this to an outside library, so the rule is assumed. Both sides are cut into time cells, so a long recording's
    segments only meet turns of their own cells.
    """
    def cells(df: DataFrame) -> DataFrame:
        return df.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / cell_ms), F.floor((F.greatest("end", "start")) / cell_ms))))

    s, t = cells(segments), cells(turns.select(F.col(key).alias("_k"), "speaker", F.col("start").alias("ts"), F.col("end").alias("te")).withColumnsRenamed({"ts": "start", "te": "end"})).withColumnsRenamed({"start": "ts", "end": "te", "_cell": "_tcell"})
    shared = F.least("end", "te", (F.col("_cell") + 1) * cell_ms) - F.greatest("start", "ts", F.col("_cell") * cell_ms)
    met = s.join(t, (F.col(key) == F.col("_k")) & (F.col("_cell") == F.col("_tcell")) & (F.col("start") < F.col("te")) & (F.col("ts") < F.col("end")))
    per = met.groupBy(key, "seg", "start", "end", "speaker").agg(F.sum(F.greatest(shared, F.lit(0))).alias("ms"))
    return per.where("ms > 0").groupBy(key, "seg", "start", "end").agg(F.min_by("speaker", F.struct(-F.col("ms"), "speaker")).alias("speaker"), F.max("ms").alias("overlap_ms"))


def pack_batches(segments: DataFrame, key: str, length: str, most_ms: float = 300_000, alone_ms: float = 60_000) -> DataFrame:
    """SRT6, SRT7: segments with ``batch``, filled greedily from the shortest: a batch's longest times its count stays within
    ``most_ms``; one of ``alone_ms`` or more goes alone. Batches are numbered within the key (a worker's share)."""
    out = StructType([*segments.schema.fields, StructField("batch", IntegerType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(length, kind="stable")
        batch, count, ids = 0, 0, []
        for x in pdf[length]:
            if count and (x >= alone_ms or x * (count + 1) > most_ms):
                batch, count = batch + 1, 0
            ids.append(batch)
            count += 1
            if x >= alone_ms:
                batch, count = batch + 1, 0
        return pdf.assign(batch=np.array(ids, dtype=np.int32))

    return segments.groupBy(key).applyInPandas(run, out)


def majority_state(frames: DataFrame, keys: list[str], order: str, flag: str, window: int = 20, begin: int = 15) -> DataFrame:
    """WN12: df with ``votes``, the speech frames among the last ``window``, and ``speaking``: it begins with ``begin`` votes and ends
    with as many or less. So ``begin`` votes flip the state, more make it speech, fewer silence: it is that of the last
    frame with another number of votes, turned over once for each frame since."""
    w = Window.partitionBy(*keys).orderBy(order)
    voted = frames.withColumn("votes", F.sum(F.col(flag).cast("int")).over(w.rowsBetween(-(window - 1), 0)))
    last = F.last(F.when(F.col("votes") != begin, F.struct((F.col("votes") > begin).alias("on"), F.col("_k").alias("k"))), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    placed = voted.withColumn("_k", F.row_number().over(w)).withColumn("_last", last)
    turned = (F.col("_k") - F.coalesce(F.col("_last.k"), F.lit(0))) % 2 == 1
    return placed.withColumn("speaking", F.coalesce(F.col("_last.on"), F.lit(False)) != turned).drop("_k", "_last")


def top_n_by(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """WN8: rank within keys, the first n."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def rtf(df: DataFrame, thread: str = "thread", seconds: str = "compute_s", audio: str = "audio_s") -> DataFrame:
    """AG14: (length, total_time, rtf, speedup): the slowest thread's time over all audio."""
    per = df.groupBy(thread).agg(F.sum(seconds).alias("t"), F.sum(audio).alias("a"))
    return per.agg(F.sum("a").alias("length"), F.max("t").alias("total_time")).select("length", "total_time", (F.col("total_time") / F.col("length")).alias("rtf"), (F.col("length") / F.col("total_time")).alias("speedup"))


def joined_text(df: DataFrame, keys: list[str], order: Column, text: str = "text", blank: bool = False) -> DataFrame:
    """AG17: each key's texts in order, with blanks between them for languages that set them."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), F.col(text).alias("t")))), lambda x: x["t"])
    return df.where(F.col(text).isNotNull()).groupBy(*keys).agg(F.array_join(ordered, " " if blank else "").alias(text))
