"""Times in recordings, timestamp lists and the messages that carry them."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from voxmill.functions import text as T

SENTENCES = "array<struct<text_seg:string,punc:string,start:int,end:int,ts_list:array<array<int>>>>"
DEFAULT_WEIGHT = 20
# Fixed values of the service: a session's settings where a message gives none.
SESSION_DEFAULTS = {
    "2pass": {"wav_format": "pcm", "audio_fs": 16000, "itn": True, "vad_tail_sil": 350, "vad_max_len": 20000, "svs_lang": "auto", "svs_itn": True, "chunk_size": [5, 10, 5]},
    "offline": {"wav_format": "pcm", "audio_fs": 16000, "itn": True, "vad_tail_sil": 800, "vad_max_len": 60000, "svs_lang": "auto", "svs_itn": True, "chunk_size": [5, 10, 5]},
}


def parse_timestamps(text: Column) -> Column:
    """TM1: ARRAY<ARRAY<INT>>; a list with anything but pairs, or unreadable, is empty."""
    got = F.from_json(text, "array<array<int>>")
    whole = F.forall(got, lambda p: (F.size(p) == 2) & F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull())
    return F.when(got.isNotNull() & whole, got).otherwise(F.array().cast("array<array<int>>"))


def format_timestamps(pairs: Column, empty: str = "") -> Column:
    """TM1: the text of a list; an empty or null one gives ``empty``."""
    body = F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("["), F.get(p, F.lit(0)).cast("string"), F.lit(","), F.get(p, F.lit(1)).cast("string"), F.lit("]"))), ",")
    return F.when(F.size(pairs) > 0, F.concat(F.lit("["), body, F.lit("]"))).otherwise(empty)


def shift_times(pairs: Column, offset_ms: Column) -> Column:
    """TM4: every time later by the offset."""
    return F.transform(pairs, lambda p: F.transform(p, lambda t: (t + offset_ms).cast("int")))


def seconds_to_ms(seconds: Column) -> Column:
    """TM4: whole milliseconds, the fraction cut off."""
    return (seconds * 1000).cast("int")


def ms_to_samples(ms: Column, rate: int = 16000) -> Column:
    """TM8."""
    return (ms * (rate // 1000)).cast("bigint")


def samples_to_ms(samples: Column, rate: int = 16000) -> Column:
    return F.floor(samples / (rate // 1000)).cast("bigint")


#: TM2: tokens that end a sentence. The service tests bytes, so the full-width exclamation mark ends one as well.
TERMINATORS = frozenset("，。？、,?！")
_PAIRS = Y.ArrayType(Y.ArrayType(Y.IntegerType()))
_SENTENCES = Y.ArrayType(Y.StructType([Y.StructField("text_seg", Y.StringType()), Y.StructField("punc", Y.StringType()), Y.StructField("start", Y.IntegerType()), Y.StructField("end", Y.IntegerType()), Y.StructField("ts_list", _PAIRS)]))
_LINES = Y.ArrayType(Y.StructType([Y.StructField("text", Y.StringType()), Y.StructField("begin_s", Y.DoubleType()), Y.StructField("end_s", Y.DoubleType())]))


def cut_sentences(tokens: list[str], pairs: list) -> list[dict]:
    """TM2: sentences of timed tokens; each token that ends none takes one pair, those beyond the list are dropped.

    An empty sentence has start and end -1 if it is the first, else 0. What follows the last terminator is a sentence
    with punc "".
    """
    done, words, begun, used = [], [], 0, 0

    def close(punc: str) -> None:
        nonlocal words, begun
        mine = [list(p) for p in pairs[begun:used]]
        none = 0 if done else -1
        done.append({"text_seg": " ".join(words), "punc": punc, "start": int(mine[0][0]) if mine else none, "end": int(mine[-1][1]) if mine else none, "ts_list": mine})
        words, begun = [], used

    for t in tokens:
        if t in TERMINATORS:
            close(t)
        elif used < len(pairs):
            words.append(t)
            used += 1
    if words:
        close("")
    return done


@F.pandas_udf(_SENTENCES)
def _cut_sentences(tokens: pd.Series, pairs: pd.Series) -> pd.Series:
    return pd.Series([cut_sentences(list(t), list(p)) if t is not None and p is not None else [] for t, p in zip(tokens, pairs)])


def sentences(text: Column, pairs: Column) -> Column:
    """TM2 over columns: ARRAY<STRUCT<text_seg, punc, start, end, ts_list>>. The tokens are cut in the JVM, the sentences in one
    linear pass of an Arrow worker; as a fold over arrays each step would copy what is done. Null gives none."""
    return _cut_sentences(T.split_timed(text), pairs)


_ENGLISH = re.compile(r"[A-Za-z']+\Z")


def time_lines(pieces: list[str], pairs: list) -> list[dict]:
    """TM5: an English word takes one pair, any other piece one for each character; pieces beyond the list are dropped."""
    out, used = [], 0
    for p in pieces:
        if used >= len(pairs):
            break
        n = 1 if _ENGLISH.match(p) else len(p)
        out.append({"text": p, "begin_s": pairs[used][0] / 1000, "end_s": pairs[min(used + n, len(pairs)) - 1][1] / 1000})
        used += n
    return out


@F.pandas_udf(_LINES)
def _time_lines(pieces: pd.Series, pairs: pd.Series) -> pd.Series:
    return pd.Series([time_lines(list(t), list(p)) if t is not None and p is not None else [] for t, p in zip(pieces, pairs)])


def timed_lines(text: Column, pairs: Column) -> Column:
    """TM5 over columns: ARRAY<STRUCT<text, begin_s, end_s>> of the pieces between punctuation and blanks."""
    return _time_lines(F.filter(F.split(text, r"[\s，。？、,.?!！]+"), lambda p: p != ""), pairs)


def corpus_time(ms: Column) -> Column:
    """TM6: milliseconds as ten-millisecond units of at least five digits; short ones are rounded as their file names were."""
    n = ms.cast("bigint")
    fitted = F.when(n % 10 >= 5, n + 1).otherwise(n)
    units = F.when(F.char_length(ms.cast("string")) < 5, F.bround(fitted / 10.0)).otherwise(F.bround(n / 10.0)).cast("bigint").cast("string")
    return F.when(F.char_length(units) < 5, F.lpad(units, 5, "0")).otherwise(units)


def speaker_of(idx: Column) -> Column:
    """TM7: the speaker in a dialogue id, before the first underscore; the place depends on whether it begins with a digit."""
    head = F.substring_index(idx, "_", 1)
    return F.lower(F.when(head.rlike("^[0-9]"), F.regexp_extract(head, "^..(.*)..$", 1)).otherwise(F.substring(head, 1, 5)))


def gender_of(speaker: Column) -> Column:
    """TM7: the last m or f of a speaker id."""
    return F.regexp_extract(F.lower(speaker), "([mf])[^mf]*$", 1)


def hotwords_of(text: Column) -> Column:
    """JS1: MAP<STRING, INT> from an object, an array or a string in JSON, or from plain words; words without a weight get 20.

    Of a word given twice the last weight stands. Null gives null, nothing an empty map.
    """
    trimmed = F.trim(text)
    # try_* and pattern tests decide first; a reader is only asked about its own kind of value.
    obj = F.from_json(F.when(trimmed.startswith("{"), trimmed), "map<string,int>")
    arr = F.from_json(F.when(trimmed.startswith("["), trimmed), "array<string>")
    quoted = F.get_json_object(F.concat(F.lit('{"s":'), F.when(trimmed.rlike(r'^".*"$'), trimmed), F.lit("}")), "$.s")
    words = F.coalesce(arr, F.split(F.coalesce(quoted, trimmed), r"\s+"))
    plain = F.map_from_entries(F.transform(F.array_distinct(F.filter(words, lambda w: w.isNotNull() & (w != ""))), lambda w: F.struct(w, F.lit(DEFAULT_WEIGHT))))
    return F.when(text.isNull(), F.lit(None)).when(obj.isNotNull(), F.map_filter(obj, lambda k, v: v.isNotNull())).otherwise(plain)


def hotwords_json(area: Column) -> Column:
    """JS2: a text area of lines ``word... weight`` as a JSON object; lines without a whole number at the end are dropped."""
    lines = F.filter(F.split(area, r"\r?\n"), lambda line: line.rlike(r"^\s*\S.*\s[0-9]+\s*$"))
    pairs = F.transform(lines, lambda line: F.struct(F.trim(F.regexp_extract(line, r"^(.*)\s[0-9]+\s*$", 1)).alias("k"), F.regexp_extract(line, r"([0-9]+)\s*$", 1).cast("int").alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0))), lambda q: q["k"] == p["k"]))
    return F.to_json(F.map_from_entries(last))


def hotword_line(line: Column, single_field: bool = False) -> Column:
    """SRC12: STRUCT<word, weight> of ``word... weight``, null if the last field is no number; variant B also takes a lone word."""
    trimmed = F.trim(line)
    several = trimmed.rlike(r"\s")
    weight = F.regexp_extract(trimmed, r"(\S+)$", 1).try_cast("float")
    both = F.when(several & weight.isNotNull(), F.struct(F.trim(F.regexp_extract(trimmed, r"^(.*)\s\S+$", 1)).alias("word"), weight.cast("int").alias("weight")))
    if not single_field:
        return both
    return F.when(~several & (trimmed != ""), F.struct(trimmed.alias("word"), F.lit(DEFAULT_WEIGHT).alias("weight"))).otherwise(both)


def session_settings(message: Column, mode: str = "2pass") -> Column:
    """JS3: STRUCT of a session's settings from its JSON message; what the message lacks has the mode's default."""
    d = SESSION_DEFAULTS[mode]
    kinds = {"wav_format": "string", "audio_fs": "int", "itn": "boolean", "vad_tail_sil": "int", "vad_max_len": "int", "svs_lang": "string", "svs_itn": "boolean"}
    plain = [F.coalesce(F.get_json_object(message, f"$.{k}").try_cast(t), F.lit(d[k])).alias(k) for k, t in kinds.items()]
    chunk = F.coalesce(F.from_json(F.get_json_object(message, "$.chunk_size"), "array<int>"), F.array(*[F.lit(x) for x in d["chunk_size"]]))
    return F.struct(*plain, chunk.alias("chunk_size"))


def result_json(mode: Column, wav_name: Column, text: Column, is_final: Column, timestamp: Column | None = None) -> Column:
    """JS4, SNK11: the message of one result; a partial without text gives null, as none is sent."""
    fields = [mode.alias("mode"), wav_name.alias("wav_name"), text.alias("text"), is_final.alias("is_final")]
    if timestamp is not None:
        fields.append(timestamp.alias("timestamp"))
    return F.when(is_final | (text != ""), F.to_json(F.struct(*fields)))


def parse_result(message: Column) -> Column:
    """JS4."""
    return F.from_json(message, f"mode string, wav_name string, text string, is_final boolean, timestamp string, stamp_sents {SENTENCES}")
