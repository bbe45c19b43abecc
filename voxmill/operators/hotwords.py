"""Hotwords: checked lists, their units, and their occurrences in text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.functions.decode import WordGraph, longest_match


def usable(df: DataFrame, word: str = "hotword", most_bytes: int = 100) -> DataFrame:
    """FLT11: words of 1 to ``most_bytes`` bytes."""
    return df.where((F.octet_length(word) <= most_bytes) & (F.col(word) != ""))


def first_contexts(df: DataFrame, key: str, order: str, most: int = 5000) -> DataFrame:
    """FLT11: the first ``most`` of each list, which is what the recogniser's graph takes."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_k") <= most).drop("_k")


def in_vocabulary(df: DataFrame, units: Column, vocabulary: DataFrame, unit: str = "unit") -> DataFrame:
    """FLT10: rows all of whose units the vocabulary knows; rows without units pass. By an anti-join of their unknown units.

    Rows are told apart by their columns; a row given twice passes or fails twice.
    """
    rows = df.select(F.struct(*df.columns).alias("_row"), units.alias("_units"))
    unknown = rows.select("_row", F.explode(F.array_distinct("_units")).alias("_u")).join(vocabulary.select(F.col(unit).alias("_u")), "_u", "left_anti").select(F.col("_row").alias("_bad")).distinct()
    return rows.join(unknown, F.col("_row").eqNullSafe(F.col("_bad")), "left_anti").select("_row.*")


def occurrences(texts: DataFrame, words: list[str], id_col: str, text_col: str) -> DataFrame:
    """NM15: (id, word, n): how often each of a given list of words occurs in each text, overlaps included.

    The automaton is built once from the list, which is a request's size, and sent to the workers; texts stay where they are.
    """
    wanted = sorted({w for w in words if w})
    held = texts.sparkSession.sparkContext.broadcast(wanted)
    kind = dict(texts.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph = WordGraph.build([[ord(c) for c in w] for w in held.value])
        for pdf in batches:
            rows = []
            for i, text in zip(pdf["_id"], pdf["_t"]):
                found: dict[str, int] = {}
                for a, b in graph.matches([ord(c) for c in text]) if text else ():
                    found[text[a:b]] = found.get(text[a:b], 0) + 1
                rows += [(i, w, n) for w, n in found.items()]
            yield pd.DataFrame(rows, columns=[id_col, "word", "n"])

    return texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).mapInPandas(run, f"{id_col} {kind}, word string, n int")


def units_of(vocabulary: dict[str, int]):
    """TK16 as a function of a text column: STRUCT<ids, known>."""
    @F.pandas_udf("ids array<int>, known boolean")
    def split(text: pd.Series) -> pd.DataFrame:
        got = [longest_match(t, vocabulary) if t is not None else ([], False) for t in text]
        return pd.DataFrame({"ids": [g[0] for g in got], "known": [g[1] for g in got]})

    return split
