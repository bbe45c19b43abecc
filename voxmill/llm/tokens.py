"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.session import spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def sizer(tokenizer: str):
    """A function from a list of texts to their sizes in tokens, null for null. Marks that the tokenizer reserves are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer)
    model.encode_special_tokens = True

    def sizes(texts: list[str | None]) -> list[int | None]:
        out: list[int | None] = []
        for a in range(0, len(texts), 64):
            part = texts[a : a + 64]
            got = iter(model.encode_batch_fast([t for t in part if t is not None], add_special_tokens=False))
            out += [None if t is None else len(next(got).ids) for t in part]
        return out

    return sizes


def token_sizes(documents: DataFrame, keep: list[str], text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(keep..., tokens): each row's whole text counted by the tokenizer file at ``tokenizer``, a path every executor has.

    Marks that the tokenizer reserves are ordinary text here. A null text has null tokens, an empty one 0.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema) + ", tokens int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = sizer(tokenizer)
        for pdf in batches:
            texts = pdf.pop("_text")
            yield pdf.assign(tokens=pd.array(sizes(texts.tolist()), dtype="Int32"))

    return spread(documents.select(*keep, F.col(text_col).alias("_text"))).mapInPandas(run, schema)
