"""Plug points for models: anything that turns batches of rows into scores runs under one contract."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def score_with(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str, columns: list[str] | None = None) -> DataFrame:
    """Rows scored by a model: ``load`` is called once in each Python worker and gives a function from a batch to its result.

    Only the named columns travel. An empty partition loads nothing.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for pdf in batches:
            model = model or load()
            yield model(pdf)

    return (df.select(*columns) if columns else df).mapInPandas(run, schema)
