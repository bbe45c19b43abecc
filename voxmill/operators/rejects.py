"""Loading the conforming lines of a manifest, and the others with the reason why they fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The extensions of recordings.
EXTENSIONS = ("wav", "flac", "pcm", "mp3", "mp4")
#: One column: quoted, with "" for a quote, or plain without any quote. Possessive, so long lines cost no stack.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_COLUMN = rf'(?:{_QUOTED}|(?!")[^"\t]*+)'
WELL_QUOTED = rf"\A{_COLUMN}(?:\t{_COLUMN})*+\z"
TWO_COLUMNS = rf"\A({_COLUMN})\t({_COLUMN})\z"
UTT = r"\A[A-Za-z0-9_.-]{1,100}\z"
PATH = rf"\A(?:/(?!\.\.(?:/|\z))[^/\x00-\x1f\x7f\x{{FFFD}}]++)++(?<=(?i:\.(?:{'|'.join(EXTENSIONS)})))\z"


def without_cr(line: Column) -> Column:
    """One CR at the end of the line is dropped."""
    return F.regexp_replace(line, r"\r\z", "")


def _value(line: Column, column: int) -> Column:
    raw = F.regexp_extract(line, TWO_COLUMNS, column)
    return F.when(raw.startswith('"'), F.regexp_replace(F.substring(raw, F.lit(2), F.char_length(raw) - 2), '""', '"')).otherwise(raw)


def strict_load(lines: DataFrame, id_col: str = "line_id", line_col: str = "audio_in") -> DataFrame:
    """(id, utt, path) of the lines that follow the format; any other line is left out.

    The format: two columns parted by one TAB, each quoted or without quotes; an utterance of 1 to 100 characters out of
    ASCII letters, digits, '_', '-', '.'; an absolute path without empty or '..' steps or control characters that ends in
    the extension of a recording. Null and empty lines do not conform. Narrow: no shuffle.
    """
    rows = lines.select(F.col(id_col), without_cr(F.col(line_col)).alias("_line")).where(F.col("_line").rlike(TWO_COLUMNS))
    rows = rows.select(id_col, _value(F.col("_line"), 1).alias("utt"), _value(F.col("_line"), 2).alias("path"))
    return rows.where(F.col("utt").rlike(UTT) & F.col("path").rlike(PATH))


def reason(line: Column) -> Column:
    """Why a line fails, the first of quoting, columns, utt, path that applies; null for a line that conforms."""
    line = without_cr(line)
    return (
        F.when(line.isNull(), "columns")
        .when(~line.rlike(WELL_QUOTED), "quoting")
        .when(~line.rlike(TWO_COLUMNS), "columns")
        .when(~_value(line, 1).rlike(UTT), "utt")
        .when(~_value(line, 2).rlike(PATH), "path")
    )


def failing_lines(lines: DataFrame, id_col: str = "line_id", line_col: str = "audio_in") -> DataFrame:
    """(id, reason): the lines that strict_load() does not load, each once, with the first reason that applies.

    The strict load is subtracted from the offsets by an anti-join, which carries ids alone on its loaded side, and only
    the remainder is diagnosed. Ids are unique offsets; a repeated id fails only if none of its rows loads. A line without
    an id cannot be subtracted: it fails if it has a reason. Other columns of the input are ignored.
    """
    loaded = strict_load(lines, id_col, line_col).select(F.col(id_col).alias("_loaded"))
    rest = lines.select(F.col(id_col), F.col(line_col)).join(loaded, F.col(id_col) == F.col("_loaded"), "left_anti")
    why = reason(F.col(line_col))
    # The planner moves this condition below the join, where only a line without an id is read for it.
    return rest.where(F.col(id_col).isNotNull() | why.isNotNull()).select(id_col, why.alias("reason"))
