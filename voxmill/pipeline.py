"""The curation pipeline in stages, each a function of tables; files between the stages are Parquet and make it restartable.

-1 convert and 1 transcribe and 4a re-decode are models' or media tools' work: functions given by the caller.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.functions import text as T
from voxmill.operators import align, keyed


def parse_options(argv: list[str], defaults: dict) -> tuple[dict, list[str]]:
    """(options, what is left): ``--name value`` pairs up to the first other word; '-' in names reads as '_'.

    An unknown name is an error, as is a value other than true or false for an option whose default is a boolean.
    Numbers take the type of their default.
    """
    out, rest = dict(defaults), list(argv)
    while rest and rest[0].startswith("--"):
        name = rest[0][2:].replace("-", "_")
        if name not in defaults:
            raise ValueError(f"invalid option {rest[0]}")
        if len(rest) < 2:
            raise ValueError(f"option {rest[0]} needs a value")
        value, kind = rest[1], type(defaults[name])
        if kind is bool:
            if value not in ("true", "false"):
                raise ValueError(f"expected true or false for {rest[0]}: {value}")
            out[name] = value == "true"
        else:
            out[name] = kind(value) if kind in (int, float) else value
        rest = rest[2:]
    return out, rest


@dataclass
class ErrorOptions:
    """Flags of the error-rate tool: case sensitivity, ignored words, tokens as characters, tags, padding, width."""

    cs: bool = False
    ig: tuple[str, ...] = ()
    char: bool = False
    rt: bool = True
    maxw: int = 0
    padding_symbol: str = "space"
    splits: dict[str, list[str]] = field(default_factory=dict)

    @staticmethod
    def parse(flags: list[str]) -> ErrorOptions:
        """From ``--name=value`` words; unknown flags are passed over."""
        o = ErrorOptions()
        for f in flags:
            name, _, value = f.lstrip("-").partition("=")
            if name in ("cs", "char", "rt"):
                setattr(o, name, value.lower() not in ("", "0", "false"))
            elif name == "maxw":
                o.maxw = int(value)
            elif name == "padding-symbol":
                o.padding_symbol = value
        return o

    @property
    def pad(self) -> str:
        return "_" if self.padding_symbol == "underline" else " "


def assemble(segments: DataFrame, least: float = 0.5, most: float = 40.0) -> dict[str, DataFrame]:
    """Stage 3: segments (utt, path, text, spk, dur) as the tables of a corpus, only utterances within the duration band."""
    kept = keyed.duration_band(segments, "dur", least, most)
    tables = {"wav_scp": kept.select("utt", "path"), "text": kept.select("utt", "text"), "utt2spk": kept.select("utt", "spk"), "wav2dur": kept.select("utt", "dur")}
    tables["spk2utt"] = keyed.group_to_list(kept.withColumn("line_no", F.col("utt")), "spk", "utt", "line_no").select("spk", "members")
    return tables


def normalised(text: DataFrame, language: str = "zh") -> DataFrame:
    """Stage 4b: Chinese references are normalised (case, fillers, retroflex endings, punctuation); others stay."""
    if language != "zh":
        return text
    return text.withColumn("text", T.collapse_blanks(T.blank_punctuation(T.remove_erhua(T.remove_fillers(T.fold_case(F.col("text"), to_upper=True))))))


def published(tables: dict[str, DataFrame], hyp: DataFrame, language: str = "zh", most_wer: float = 30.0, most_del_ins: int = 2) -> dict[str, DataFrame]:
    """Stage 4c, 4d: the tables of the utterances that pass the quality gate. The published text is the recogniser's, with blanks
    between ideographs taken out."""
    good = align.quality_gate(align.align_pairs(normalised(tables["text"], language), hyp), most_wer, most_del_ins).select("utt").distinct()
    out = {n: keyed.filter_by_keys(tables[n], good, "utt") for n in ("wav_scp", "utt2spk", "wav2dur")}
    out["text"] = keyed.filter_by_keys(hyp.select("utt", T.join_mandarin(F.col("text")).alias("text")), good, "utt")
    out["spk2utt"] = keyed.group_to_list(out["utt2spk"].withColumn("line_no", F.col("utt")), "spk", "utt", "line_no").select("spk", "members")
    return out


def run(spark: SparkSession, folder: str, steps: dict[int, Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]], stage: int = -1, stop_stage: int = 4) -> dict[str, DataFrame]:
    """Runs the steps from ``stage`` to ``stop_stage``; each gets all tables so far and its own are written below ``folder``.

    Tables of stages before ``stage`` are read back, so a run goes on where another stopped.
    """
    have: dict[str, DataFrame] = {}
    for k in sorted(steps):
        if k > stop_stage:
            break
        path = f"{folder.rstrip('/')}/stage={k}"
        if k >= stage:
            for name, df in steps[k](spark, have).items():
                df.write.mode("overwrite").parquet(f"{path}/{name}")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(hadoop):
            for s in fs.listStatus(hadoop):
                name = s.getPath().getName()
                have[name] = spark.read.parquet(f"{path}/{name}")
    return have
