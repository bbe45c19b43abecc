"""Writers of the formats that speech tools read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.functions import numeric
from voxmill.sources.readers import encode_wav


def key_value_lines(df: DataFrame, key: str, value: str, sep: str = "\t") -> DataFrame:
    """SNK1: one line a row; a null value is empty."""
    return df.select(F.concat(F.col(key), F.lit(sep), F.coalesce(F.col(value).cast("string"), F.lit(""))).alias("value"))


def segment_lines(df: DataFrame) -> DataFrame:
    """SNK2: (value) lines ``start, end, text, speaker`` of segments in seconds; half milliseconds go to the even one, TABs in the text
    become blanks, rows without a speaker are dropped."""
    ms = lambda c: F.bround(F.col(c) * 1000).cast("bigint").cast("string")
    rows = df.where(F.col("speaker").isNotNull())
    return rows.select(F.concat_ws("\t", ms("start"), ms("end"), F.trim(F.replace(F.col("text"), F.lit("\t"), F.lit(" "))), "speaker").alias("value"))


def write_lines(lines: DataFrame, path: str, files: int | None = None) -> None:
    """SNK3: text files; ``files`` = 1 only for results known to be small."""
    (lines.coalesce(files) if files else lines).write.mode("overwrite").text(path)


def write_by_recording(df: DataFrame, path: str, recording: str = "wav_name", value: str = "value") -> None:
    """SNK4: a folder of lines for each recording."""
    df.select(recording, value).write.mode("append").partitionBy(recording).text(path)


def dialogue_files(df: DataFrame) -> dict[str, DataFrame]:
    """SNK9, FLT7: the lines of a dataset folder's files, all from one table (utt, text, clean, start, end, path, spk, gender, idx).

    Rows are left out whose cleaned text without noise is empty or that last one unit or less.
    """
    quiet = F.trim(F.regexp_replace("clean", "<noise>", ""))
    kept = df.where((quiet != "") & (F.col("end") - F.col("start") > 1))

    def line(*cols: str | Column) -> DataFrame:
        return kept.select(F.concat_ws(" ", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols]).alias("value"))

    return {
        "text.ori": line("utt", "text"), "text.clean": line("utt", "clean"), "text.rm.noise": line("utt", quiet),
        "segments": line("utt", "idx", (F.col("start") / 100.0), (F.col("end") / 100.0)), "wav.scp": kept.select(F.concat_ws(" ", "idx", "path").alias("value")).distinct(),
        "utt2spk": line("utt", "spk"), "spk2gender": kept.select(F.concat_ws(" ", "spk", "gender").alias("value")).distinct(), "list": line("utt"),
    }


def token_list(df: DataFrame, column: str = "word") -> DataFrame:
    """SNK13: lines of a YAML list."""
    return df.select(F.format_string("- %s", F.col(column)).alias("value"))


def speaker_path(path: Column, root: str = "wav") -> Column:
    """SNK8: where a file is copied to: <root>/<parent folder>/<name>."""
    parts = F.reverse(F.split(path, "/"))
    return F.concat_ws("/", F.lit(root), F.get(parts, F.lit(1)), parts[0])


def cut_audio(recordings: DataFrame, cuts: DataFrame, key: str = "utt", rate: int = 16000) -> DataFrame:
    """SNK5: (key, seg, wav BINARY) of segments [start_ms, end_ms) of recordings (key, samples); those beyond the end are cut short."""
    kind = dict(recordings.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            wav = [encode_wav(np.asarray(s, dtype=np.float64)[int(a) * rate // 1000 : int(b) * rate // 1000], rate) for s, a, b in zip(pdf["samples"], pdf["start_ms"], pdf["end_ms"])]
            yield pd.DataFrame({key: pdf[key], "seg": pdf["seg"], "wav": wav})

    return recordings.select(key, "samples").join(cuts.select(key, "seg", "start_ms", "end_ms"), key).mapInPandas(run, f"{key} {kind}, seg int, wav binary")


def fixed_pieces(df: DataFrame, key: str, length: str, piece: int) -> DataFrame:
    """SNK6: (key, name, begin, end) of pieces of ``piece`` up to the length, named <key>_%02d."""
    rows = df.select(key, F.explode(numeric.chunk_bounds(F.col(length), F.lit(piece))).alias("c"))
    return rows.select(key, F.format_string("%s_%02d", F.col(key).cast("string"), F.col("c.k")).alias("name"), "c.begin", "c.end")


def short_name(name: Column) -> Column:
    """SNK6: at most 20 characters of an English name, else 15."""
    from voxmill.functions.text import is_english_string

    return F.when(is_english_string(name), F.substring(name, 1, 20)).otherwise(F.substring(name, 1, 15))
