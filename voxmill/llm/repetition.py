"""The share of each document that was already said in it, behind a cascade of cheap rejecting rules."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.sentences import cleaned
from voxmill.session import spread

_UNIT = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+(?:['’-][^\W_㐀-鿿]+)*")
#: Half words: a word weighs two, a Chinese character one, so five words and ten characters are one measure.
WORD, CHAR, STRETCH = 2, 1, 10


class Said:
    """One document's units, made once and shared by the rules that see it."""

    __slots__ = ("text", "_units", "_weights", "_total")

    def __init__(self, text: str):
        self.text, self._units = text, None

    def _read(self) -> None:
        self._units = _UNIT.findall(cleaned(self.text).lower().replace("’", "'"))
        self._weights = [CHAR if "㐀" <= u <= "鿿" else WORD for u in self._units]
        self._total = sum(self._weights)

    @property
    def units(self) -> list[str]:
        if self._units is None:
            self._read()
        return self._units

    @property
    def weights(self) -> list[int]:
        if self._units is None:
            self._read()
        return self._weights

    @property
    def total(self) -> int:
        if self._units is None:
            self._read()
        return self._total


def too_short(doc: Said, least: float) -> bool:
    """A repeated stretch and what it repeats begin at two places, so they need more than one stretch's length."""
    return len(doc.text) <= STRETCH or doc.total <= STRETCH


def few_repeated_units(doc: Said, least: float) -> bool:
    """No unit's first occurrence can be a repetition."""
    seen, first = set(), 0
    for u, w in zip(doc.units, doc.weights):
        if u not in seen:
            seen.add(u)
            first += w
    return doc.total - first < least * doc.total


def _bounded_by_runs(doc: Said, least: float, k: int) -> bool:
    """Units in no run of k that stood before can be in no longer stretch that did. k runs of a word each fit any stretch."""
    u, w, n = doc.units, doc.weights, len(doc.units)
    seen, covered, upto = set(), 0, 0
    for i in range(n - k + 1):
        key = tuple(u[i : i + k])
        if key in seen:
            a = max(i, upto)
            if a < i + k:
                covered += sum(w[a : i + k])
                upto = i + k
        else:
            seen.add(key)
    return covered < least * doc.total


def few_repeated_pairs(doc: Said, least: float) -> bool:
    return _bounded_by_runs(doc, least, 2)


def few_repeated_fours(doc: Said, least: float) -> bool:
    return _bounded_by_runs(doc, least, 4)


def repeated_share(doc: Said) -> float:
    """Exact: the weight lying in stretches of at least five words (ten characters) that stood earlier, over all weight.

    For each place the shortest run that is long enough; it counts if the same run began earlier. Longer stretches are
    unions of such runs. 0 for a text without words.
    """
    u, w, n = doc.units, doc.weights, len(doc.units)
    if not n:
        return 0.0
    seen, covered, upto, j, weight = set(), 0, 0, 0, 0
    for i in range(n):
        while j < n and weight < STRETCH:
            weight += w[j]
            j += 1
        if weight < STRETCH:
            break
        key = tuple(u[i:j])
        if key in seen:
            a = max(i, upto)
            if a < j:
                covered += sum(w[a:j])
                upto = j
        else:
            seen.add(key)
        weight -= w[i]
    return covered / doc.total


#: Each rejects a document only if its share is surely below the wanted one.
RULES: dict[str, Callable[[Said, float], bool]] = {"too_short": too_short, "few_repeated_units": few_repeated_units, "few_repeated_pairs": few_repeated_pairs, "few_repeated_fours": few_repeated_fours}


def order_rules(texts: list[str], least: float, rules: dict[str, Callable[[Said, float], bool]] = RULES) -> list[str]:
    """Rules by rejections per second on sample texts, each judged on what the ones before it let pass.

    The first rule to read a text pays for its units, so one that looks at the raw text alone gets credit for that. A rule
    that costs more than the exact measure it would save is left out. Any order gives the same result.
    """
    left, order, docs = dict(rules), [], [Said(t) for t in texts if t]
    read = False  # whether a rule chosen already made the units, which all later ones share

    def cost(f: Callable[[Said], object]) -> float:
        fresh = docs if read else [Said(d.text) for d in docs]
        began = time.perf_counter()
        for d in fresh:
            f(d)
        return (time.perf_counter() - began) / max(1, len(docs))

    while left and docs:
        exact = cost(repeated_share)
        rated = {}
        for name, rule in left.items():
            c = cost(lambda d, rule=rule: rule(d, least))
            share = sum(rule(d, least) for d in docs) / len(docs)
            if share * exact > c or not read and share:
                rated[name] = share / max(c, 1e-9)
        if not rated:
            break
        best = max(rated, key=rated.get)
        order.append(best)
        rule = left.pop(best)
        docs = [Said(d.text) for d in docs if not rule(d, least)] if not read else [d for d in docs if not rule(d, least)]
        if not read and docs:
            rule(docs[0], least)
            read = docs[0]._units is not None
            if read:
                for d in docs:
                    d.units
    return order


def sampled_order(documents: DataFrame, least: float, sample: int = 400, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """The order from the documents with the least hashes of their id. The sample steers cost only, never the result."""
    rows = documents.where(F.col(text_col).isNotNull()).orderBy(F.xxhash64(id_col), id_col).limit(sample).select(text_col).collect()
    return order_rules([r[0] for r in rows], least)


def repetition(documents: DataFrame, least: float = 0.0, order: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, share, rule): the exact share of repeated content of the documents that reach ``least``; ``rule`` names what
    rejected a document below it (its share is then null) or is null.

    ``least`` 0 measures every document. One narrow pass over whole texts. A null text gives a null share and no rule;
    an empty or wordless one has share 0. Repeated ids give repeated rows.
    """
    names = [] if least <= 0 else (sampled_order(documents, least, id_col=id_col, text_col=text_col) if order is None else order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen = [(n, RULES[n]) for n in names]
        for pdf in batches:
            shares, rules = [], []
            for text in pdf["_text"]:
                share, by = None, None
                if text is not None:
                    doc = Said(text)
                    by = next((n for n, rule in chosen if rule(doc, least)), None)
                    if by is None:
                        share = repeated_share(doc)
                        if share < least - 1e-12:
                            share, by = None, "exact"
                shares.append(share)
                rules.append(by)
            yield pd.DataFrame({"_id": pdf["_id"], "share": pd.array(shares, dtype="Float64"), "rule": rules})

    out = spread(documents.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))).mapInPandas(run, "_id bigint, share double, rule string")
    return out.withColumnRenamed("_id", id_col)
