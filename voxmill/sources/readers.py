"""Readers of the text and binary formats that speech corpora come in. Rows keep (file, line_no) where order matters."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.functions import decode
from voxmill.functions.timing import SENTENCES, hotword_line
from voxmill.operators import segments

TARGET_RATE = 16000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): lines of text files with their place in the file, whatever partition they are read in.

    Whole files are read as one value each and cut in the worker, so manifests, not corpora, should be read this way.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n")
    return whole.where("value <> ''").select("file", F.posexplode(lines).alias("line_no", "value"))


def parse_manifest(lines: DataFrame, dialect: str = "tab", value: str = "value") -> DataFrame:
    """SRC3: lines to (utt, path). ``tab``: exactly two columns; ``first``: the first blank parts, a lone column is a path of
    utterance 'demo'; ``blanks``: any blanks part, the first two columns count. Others, and blank paths, are dropped."""
    v = F.col(value)
    if dialect == "tab":
        parts = F.split(v, "\t")
        rows = lines.where(F.size(parts) == 2).withColumns({"utt": parts[0], "path": parts[1]})
    elif dialect == "first":
        both = v.rlike(r"^\s*\S+\s+\S")
        rows = lines.withColumns({"utt": F.when(both, F.regexp_extract(v, r"^\s*(\S+)", 1)).otherwise("demo"), "path": F.when(both, F.regexp_extract(v, r"^\s*\S+\s+(.*?)\s*$", 1)).otherwise(F.trim(v))})
    else:
        parts = F.filter(F.split(v, r"\s+"), lambda p: p != "")
        rows = lines.where(F.size(parts) >= 2).withColumns({"utt": parts[0], "path": parts[1]})
    return rows.where(F.trim("path") != "").drop(value)


def parse_transcripts(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC4: lines to (utt, text); lines with fewer than two fields are dropped."""
    v = F.col(value)
    return lines.where(v.rlike(r"^\s*\S+\s+\S")).withColumns({"utt": F.regexp_extract(v, r"^\s*(\S+)", 1), "text": F.regexp_extract(v, r"^\s*\S+\s+(.*?)\s*$", 1)}).drop(value)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: (file, line_no, start_ms, end_ms, text, speaker) of TSV files with a header; rows of other than four columns are dropped."""
    parts = F.split("value", "\t")
    rows = numbered_lines(spark, path).where((F.col("line_no") > 0) & (F.size(parts) == 4))
    return rows.select("file", "line_no", parts[0].try_cast("bigint").alias("start_ms"), parts[1].try_cast("bigint").alias("end_ms"), parts[2].alias("text"), parts[3].alias("speaker"))


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: (file, sentences) of JSON files that hold one array each."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", SENTENCES).alias("sentences"))


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """SRC1, SRC2: (utt, path, name, speaker) of files below a folder; the content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select(F.regexp_replace("path", "^file:(//)?", "").alias("path"))
    return found.select(segments.utt_of_path(F.col("path"), root).alias("utt"), "path", segments.stem(F.col("path")).alias("name"), segments.parent(F.col("path")).alias("speaker"))


def read_vocabulary(spark: SparkSession, path: str, kind: str = "lines") -> DataFrame:
    """SRC11: (id, token) of a list, one token a line (``lines``), a JSON array (``json``) or a YAML list of '- token' (``yaml``)."""
    if kind == "json":
        return spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<string>")).alias("id", "token"))
    rows = numbered_lines(spark, path)
    if kind == "yaml":
        rows = rows.where(F.col("value").rlike(r"^\s*- ")).withColumn("value", F.regexp_replace(F.regexp_replace("value", r"^\s*- ", ""), r"^(['\"])(.*)\1$", "$2"))
        from voxmill.operators.keyed import row_numbers

        return row_numbers(rows, [F.col("file"), F.col("line_no")], "id").select("id", F.col("value").alias("token"))
    return rows.select(F.col("line_no").alias("id"), F.col("value").alias("token"))


def parse_lexicon(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC11: lines ``word<TAB>units`` to (word, pron)."""
    parts = F.split(value, "\t", 2)
    return lines.where(F.size(parts) == 2).select(*[c for c in lines.columns if c != value], parts[0].alias("word"), F.trim(parts[1]).alias("pron"))


def parse_cmvn(text: Column, tag: str) -> Column:
    """SRC11: the ARRAY<DOUBLE> in brackets after <AddShift> or <Rescale>."""
    body = F.regexp_extract(text, rf"(?s)<{tag}>.*?\[\s*([^\]]*?)\s*\]", 1)
    return F.transform(F.filter(F.split(body, r"\s+"), lambda x: x != ""), lambda x: x.cast("double"))


def parse_hotwords(lines: DataFrame, single_field: bool = False, value: str = "value") -> DataFrame:
    """SRC12: (word, weight) of usable lines."""
    return lines.withColumn("_h", hotword_line(F.col(value), single_field)).where("_h is not null").select(*[c for c in lines.columns if c != value], "_h.word", "_h.weight")


def parse_dialogues(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC13: (idx, start, end, lang, text) of lines with four columns (no language) or five; others are dropped."""
    p = F.split(value, "\t")
    n = F.size(p)
    return lines.where(n.isin(4, 5)).select(p[0].alias("idx"), p[1].alias("start"), p[2].alias("end"), F.when(n == 5, F.get(p, F.lit(3))).alias("lang"), F.element_at(p, -1).alias("text"))


# ---- sound -----------------------------------------------------------------------------------------------------------
class BadWav(ValueError):
    """The bytes are no 16-bit mono PCM WAV file."""


def decode_wav(data: bytes, strict: bool = True) -> tuple[np.ndarray, int]:
    """SRC7, SRC8: (samples in [-1, 1), rate). Strict: header fields are checked and unknown chunks passed over; lenient: 44 bytes are
    a header, whatever they hold, and what follows are samples."""
    if not strict:
        rate = struct.unpack_from("<I", data, 24)[0] if len(data) >= 28 else TARGET_RATE
        return pcm_samples(data[44:]), rate
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise BadWav("no RIFF/WAVE header")
    at, rate = 12, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        at += 8
        if name == b"fmt ":
            if size < 16:
                raise BadWav("short format chunk")
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at)
            if (kind, channels, bits) != (1, 1, 16):
                raise BadWav("not mono 16-bit PCM")
        elif name == b"data":
            if rate is None:
                raise BadWav("data before format")
            return pcm_samples(data[at : at + size]), rate
        at += size + size % 2
    raise BadWav("no data chunk")


def pcm_samples(data: bytes) -> np.ndarray:
    """SRC9: little-endian 16-bit samples over 32768; an odd last byte is dropped."""
    return np.frombuffer(data[: len(data) // 2 * 2], dtype="<i2").astype(np.float32) / 32768.0


def encode_wav(samples: np.ndarray, rate: int = TARGET_RATE, bits: int = 16) -> bytes:
    """SNK12: a WAV file with a 44-byte header, 8 or 16 bits."""
    scaled = np.clip(np.asarray(samples, dtype=np.float64), -1, 1 - 1 / 32768)
    body = np.round(scaled * 32768).astype("<i2").tobytes() if bits == 16 else (np.round(scaled * 128) + 128).clip(0, 255).astype(np.uint8).tobytes()
    width = bits // 8
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate * width, width, bits) + b"data" + struct.pack("<I", len(body)) + body


def read_audio(spark: SparkSession, root: str, glob: str = "*.wav", rate: int = TARGET_RATE, strict: bool = True) -> DataFrame:
    """SRC7-9: (path, rate, samples ARRAY<FLOAT>, error) of sound files, resampled to ``rate``; unreadable ones give the reason.

    Files with the extension pcm are headerless. Other formats need a decoder, which is a plug point.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, data in zip(pdf["path"], pdf["content"]):
                try:
                    samples, r = (pcm_samples(data), rate) if path.endswith(".pcm") else decode_wav(data, strict)
                    rows.append((path, rate, decode.resample(samples, r, rate).astype(np.float32), None))
                except BadWav as e:
                    rows.append((path, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "rate", "samples", "error"]).astype({"rate": "Int32"})

    return files.mapInPandas(run, "path string, rate int, samples array<float>, error string")
