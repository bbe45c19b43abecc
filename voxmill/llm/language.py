"""Languages of documents, and of runs of sentences inside them, by rank-order n-gram profiles."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm.sentences import LANGUAGES, BoundaryModel, boundaries_of, draw_texts, label_code, punctuated_language, split_texts
from voxmill.session import spread

PROFILE_SIZE = 2000
_WORD = re.compile(r"[^\W\d_]+|\n")
_ASIDE = re.compile(r"\([^()\n]*\)")
#: A sentence of more n-grams is measured alone, so that the tables of counts stay small.
_LONG, _BLOCK = 2000, 100_000


def word_ngrams(word: str) -> list[str]:
    """1- to 4-grams of a word with its edges marked."""
    w = f"_{word}_"
    return [*word, *(w[i : i + k] for k in (2, 3, 4) for i in range(len(w) - k + 1))]


def words_of(sentences: list[str]) -> list[str]:
    """The lower-cased words of all sentences in order, a line feed after each; digits, punctuation and asides in brackets are left out."""
    text = "\n".join(s.replace("\n", " ") if "\n" in s else s for s in sentences) + "\n"
    return _WORD.findall(_ASIDE.sub(" ", text).lower())


def ngram_counts(words: Counter) -> Counter:
    out: Counter = Counter()
    for w, n in words.items():
        for g in word_ngrams(w):
            out[g] += n
    return out


def ranked(counts: Counter, size: int = PROFILE_SIZE) -> dict[str, float]:
    """n-gram -> rank by falling frequency; equal frequencies share their mean rank."""
    rank, order = {}, counts.most_common(size)
    i = 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][1] == order[i][1]:
            j += 1
        for g, _ in order[i:j]:
            rank[g] = (i + j - 1) / 2
        i = j
    return rank


class _WordIds(dict):
    """Words to their place in a table of n-gram ids."""

    def __init__(self, profiles: RankProfiles, remember: int = 200_000):
        super().__init__()
        self.grams, self.none, self.remember = profiles.grams, profiles.none, remember
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat, self.begin, self.fresh = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64), []
        self["\n"]

    def __missing__(self, word: str) -> int:
        k = self[word] = len(self)
        self.fresh.append([] if word == "\n" else [self.grams.get(g, self.none) for g in word_ngrams(word)])
        return k

    def of(self, words: list[str]) -> np.ndarray:
        """The words' places; ``flat`` from ``begin[place]`` up to ``begin[place + 1]`` holds the ids of a word's n-grams."""
        if len(self) > self.remember:
            self.forget()
        out = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self.fresh:
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(x) for x in self.fresh])])
            self.flat = np.concatenate([self.flat, np.array([i for x in self.fresh for i in x], dtype=np.int32)])
            self.fresh = []
        return out


class RankProfiles:
    """The profile of each language, for measuring how far a text's n-gram ranks lie out of place."""

    def __init__(self, counts: dict[str, Counter], size: int = PROFILE_SIZE):
        self.languages, self.size = tuple(counts), size
        rank = {lang: ranked(c, size) for lang, c in counts.items()}
        grams = {g: i for i, g in enumerate(sorted({g for r in rank.values() for g in r}))}
        self.rows = np.full((len(rank), len(grams) + 1), 1e9, dtype=np.float32)
        for c, r in enumerate(rank.values()):
            for g, x in r.items():
                self.rows[c, grams[g]] = x
        self.grams, self.none, self._words = grams, len(grams), None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_words": None}

    def distances(self, sentences: list[str]) -> np.ndarray:
        """Of each sentence the mean out-of-place distance to each language in [0, 1]; an n-gram that a profile lacks counts as its size.

        A sentence's own ranks (equal frequencies share their mean rank) are stretched over at most 300 places, as a
        short text has few distinct n-grams. N-grams that no profile has count one by one, as often as they occur.
        """
        if self._words is None:
            self._words = _WordIds(self)
        out = np.ones((len(sentences), len(self.languages)), dtype=np.float32)
        place = self._words.of(words_of(sentences))
        begin, flat = self._words.begin, self._words.flat
        size = begin[place + 1] - begin[place]
        ends = np.flatnonzero(place == 0)  # the line feeds
        upto = np.concatenate([[0], np.cumsum(size)])[ends]
        grams = np.diff(upto, prepend=0)
        a = 0
        while a < len(sentences):
            b = a + 1
            if grams[a] <= _LONG:
                before = upto[a] - grams[a]
                b = min(a + 10_000, max(b, int(np.searchsorted(upto, before + _BLOCK, side="right"))))
                if (long := np.flatnonzero(grams[a:b] > _LONG)).size:
                    b = a + int(long[0])
            w0, w1 = (ends[a - 1] + 1 if a else 0), ends[b - 1] + 1
            n = size[w0:w1]
            ids = flat[np.repeat(begin[place[w0:w1]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            self._measure(out[a:b], np.repeat(np.arange(b - a, dtype=np.int32), grams[a:b]), ids)
            a = b
        return out

    def _measure(self, out: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        """Distances of some sentences, whose n-grams are given one by one, into ``out``."""
        rows, width = len(out), self.none + 1
        key = row * width + ids  # sentences of a block are few enough for 32 bits
        key.sort()
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        key, n = key[begin], np.diff(begin, append=len(key))
        row = key // width
        ids = key - row * width
        new = ids == self.none
        unknown = np.zeros(rows, dtype=np.int64)
        unknown[row[new]] = n[new]
        row, ids, n = row[~new], ids[~new], n[~new]
        most = int(n.max(initial=1)) + 1
        of = row * most + n
        sizes = np.bincount(of, minlength=rows * most).reshape(rows, most)
        known = sizes.sum(1)
        sizes[:, 1] += unknown
        total = known + unknown
        before = np.cumsum(sizes[:, ::-1], axis=1)[:, ::-1] - sizes
        mean = ((before + (sizes - 1) / 2) * np.minimum(1.0, 300 / np.maximum(total, 1))[:, None]).astype(np.float32)
        own, first = mean.ravel()[of], np.flatnonzero(np.diff(row, prepend=-1))
        if not len(first):
            return
        met = row[first]
        for c, place in enumerate(self.rows):
            away = place[ids]
            away -= own
            np.abs(away, out=away)
            # Own ranks stay below 300 and a profile's below its size, so only what it lacks lies as far away as that.
            np.minimum(away, np.float32(self.size), out=away)
            out[met, c] = (np.add.reduceat(away, first) + unknown[met] * self.size) / total[met] / self.size

    def lead(self, sentences: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, confidence in [0, 1], distances) of each: the lead of the nearest over the second nearest profile."""
        d = self.distances(sentences)
        two = np.sort(d, axis=1)[:, :2]
        return d.argmin(1), np.minimum(1.0, (two[:, 1] - two[:, 0]) / np.maximum(two[:, 1], 1e-6) * 2), d

    def best(self, sentence: str) -> tuple[int, float, np.ndarray]:
        """lead() of one sentence."""
        lang, sure, d = self.lead([sentence])
        return int(lang[0]), float(sure[0]), d[0]


def train_profiles(documents: DataFrame, most: int = 3000) -> RankProfiles:
    """profiles_of() a sample of documents whose label and folder name the same language: of each language as many, ``most`` in
    all, of distinct texts. A language without labelled documents gets an empty profile."""
    return profiles_of(draw_texts(documents, {"agreed": (agreed_language(), most)})["agreed"])


def learn_languages(documents: DataFrame, most_labelled: int = 3000, most_punctuated: int = 4000) -> tuple[RankProfiles, BoundaryModel]:
    """train_profiles() and learn_boundaries() from one draw."""
    drawn = draw_texts(documents, {"agreed": (agreed_language(), most_labelled), "punctuated": (punctuated_language(), most_punctuated)})
    return profiles_of(drawn["agreed"]), boundaries_of(drawn)


def agreed_language() -> Column:
    """The language that a document's label and folder both name, else null."""
    code, folder = label_code(F.col("lang")), F.lower(F.substring_index("wav_name", "/", 1))
    return F.when((code == folder) & code.isin(*LANGUAGES), code)


def profiles_of(labelled: list[tuple[int, str, str]]) -> RankProfiles:
    """Profiles from (id, text, language). The labels are unsure, so each sentence is given to the nearest of the first profiles, and
    the profiles are counted again from the sentences."""
    split = split_texts([text for _, text, _ in labelled])
    words = {lang: Counter() for lang in LANGUAGES}
    for (_, _, code), sentences in zip(labelled, split):
        words[code].update(words_of(sentences))
    flat = [s for x in split for s in x]
    first, again = RankProfiles({x: _profile(c) for x, c in words.items()}), {lang: Counter() for lang in LANGUAGES}
    lang, sure, _ = first.lead(flat)
    for c, name in enumerate(LANGUAGES):
        again[name].update(words_of([flat[i] for i in np.flatnonzero((lang == c) & (sure > 0.1))]))
    return RankProfiles({x: _profile(c) for x, c in again.items()})


def _profile(words: Counter) -> Counter:
    return ngram_counts(Counter({w: n for w, n in words.items() if w != "\n"}))


#: A sentence whose lead is below this takes its neighbours' language unless the two of them differ.
UNSURE = 0.12


def languages_of(sentences: list[list[str]], profiles: RankProfiles, hints: list[str | None] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(language index, confidence) of every sentence of every document, in order.

    A sentence with a slim lead is judged together with its neighbours; the hint decides only for a text whose first
    two languages are equally near.
    """
    size = np.array([len(x) for x in sentences], dtype=np.int64)
    doc = np.repeat(np.arange(len(size)), size)
    lang, sure, d = profiles.lead([s for x in sentences for s in x])
    slim = np.flatnonzero(sure < UNSURE)
    together = d[slim].astype(np.float64) * 2
    for step in (-1, 1):
        j = slim + step
        there = (j >= 0) & (j < len(doc))
        there[there] = doc[j[there]] == doc[slim[there]]
        together[there] += d[j[there]]
    if hints is not None:
        known = np.array([LANGUAGES.index(h) if h in LANGUAGES else -1 for h in hints], dtype=np.int64)[doc[slim]]
        together[known >= 0, known[known >= 0]] -= 1e-3
    if len(slim):
        lang[slim] = together.argmin(1)
    return lang, sure


def segments_of(sentences: list[list[str]], profiles: RankProfiles, hints: list[str | None] | None = None) -> list[list[dict]]:
    """Of each document the runs of sentences of one language, in order: lang, confidence, first (sentence, from 0), sentences."""
    lang, sure = languages_of(sentences, profiles, hints)
    out, at = [], 0
    for x in sentences:
        mine, runs = lang[at : at + len(x)], []
        edges = [0, *(np.flatnonzero(np.diff(mine)) + 1).tolist(), len(x)] if len(x) else []
        for a, b in zip(edges, edges[1:]):
            runs.append({"lang": LANGUAGES[mine[a]], "confidence": float(sure[at + a : at + b].mean()), "first": a, "sentences": b - a})
        out.append(runs)
        at += len(x)
    return out


SEGMENTS = "array<struct<lang:string,confidence:double,first:int,sentences:int>>"


def language_segments(documents: DataFrame, profiles: RankProfiles, boundaries: BoundaryModel) -> DataFrame:
    """(doc_id, code, segments): each document's runs of sentences with language, confidence and length.

    ``code`` is the language its label names. One narrow pass over the whole texts, no shuffle. A null, empty or
    wordless text has no segments; a null label gives a null code; repeated ids give repeated rows.
    """
    sc = documents.sparkSession.sparkContext
    held = sc.broadcast((profiles, boundaries))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, b = held.value
        for pdf in batches:
            out = segments_of(split_texts(pdf["text"].tolist(), b), p, pdf["code"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "code": pdf["code"], "segments": out})

    return spread(documents.select("doc_id", "text", label_code(F.col("lang")).alias("code"))).mapInPandas(run, f"doc_id bigint, code string, segments {SEGMENTS}")


def placed_segments(segments: DataFrame) -> DataFrame:
    """(doc_id, segment, first_sentence, last_sentence, lang, confidence): each run of sentences of one language with its place,
    segments and sentences numbered from 0 within the document."""
    rows = segments.select("doc_id", F.posexplode("segments").alias("segment", "s"))
    return rows.select("doc_id", "segment", F.col("s.first").alias("first_sentence"), (F.col("s.first") + F.col("s.sentences") - 1).alias("last_sentence"), "s.lang", "s.confidence")


def document_languages(segments: DataFrame) -> DataFrame:
    """(doc_id, code, lang, sentences, share, confidence): one row per language of a document, from its segments."""
    total = F.aggregate("segments", F.lit(0), lambda a, s: a + s["sentences"])
    per = F.transform(
        F.array(*[F.lit(x) for x in LANGUAGES]),
        lambda x: F.struct(
            x.alias("lang"),
            F.aggregate("segments", F.lit(0), lambda a, s: a + F.when(s["lang"] == x, s["sentences"]).otherwise(0)).alias("n"),
            F.aggregate("segments", F.lit(0.0), lambda a, s: a + F.when(s["lang"] == x, s["confidence"] * s["sentences"]).otherwise(0.0)).alias("c"),
        ),
    )
    rows = segments.select("doc_id", "code", total.alias("total"), F.explode(F.filter(per, lambda p: p["n"] > 0)).alias("p"))
    return rows.select("doc_id", "code", F.col("p.lang").alias("lang"), F.col("p.n").alias("sentences"), (F.col("p.n") / F.col("total")).alias("share"), (F.col("p.c") / F.col("p.n")).alias("confidence"))


def wrong_labels(documents: DataFrame, share: float = 0.2, most_labelled: int = 3000) -> DataFrame:
    """(doc_id, found_lang): the languages with at least ``share`` of a document's sentences, of the documents whose label is
    missing, wrong or names only one of several. Documents without sentences are not reported."""
    segments = language_segments(documents, *learn_languages(documents, most_labelled))
    total = F.aggregate("segments", F.lit(0), lambda a, s: a + s["sentences"])

    def of(x: str) -> Column:
        n = F.aggregate("segments", F.lit(0), lambda a, s: a + F.when(s["lang"] == x, s["sentences"]).otherwise(0))
        return F.struct(F.lit(x).alias("lang"), n.alias("n"))

    per = F.array(*[of(x) for x in LANGUAGES])
    found = F.transform(F.filter(per, lambda p: (p["n"] > 0) & (p["n"] >= total * share - 1e-9)), lambda p: p["lang"])
    rows = segments.select("doc_id", "code", found.alias("found"))
    right = (F.size("found") == 1) & (F.coalesce(F.col("code"), F.lit("")) == F.element_at("found", 1))
    return rows.where((F.size("found") > 0) & ~right).select("doc_id", F.explode("found").alias("found_lang"))
