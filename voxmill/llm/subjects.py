"""Subject areas of documents, sentence by sentence, by one-versus-rest linear classifiers on hashed word n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm import linear
from voxmill.llm.language import RankProfiles, agreed_language, profiles_of
from voxmill.llm.sentences import BoundaryModel, boundaries_of, draw_texts, punctuated_language, split_texts
from voxmill.session import checkpoint_dir, spread

BITS = 18
#: How likely a sentence is about no subject before its words are read, in weak labelling.
NONE = 0.55
#: A sentence that this share of all distinct texts say, and so many at least, is no example of a subject.
COMMON_SHARE, COMMON = 0.001, 6
#: Shorter sentences, in letters, are never taken as common.
SHORT = 8


#: A Chinese character, a word (an elided article such as "l'" is one of its own), a number, or a sentence's end.
_TOKEN = re.compile(r"[㐀-鿿]|[^\W\d_㐀-鿿]+|\d+|\n")
END, WORD, HAN, NUMBER = range(4)


class _Tokens(linear.Hashes):
    """Tokens to their hash and, in the two lowest bits, their kind."""

    def __missing__(self, token: str) -> int:
        kind = END if token == "\n" else HAN if "㐀" <= token <= "鿿" else NUMBER if token[0].isdigit() else WORD
        h = self[token] = (crc32(token.encode("utf-8", "surrogatepass")) << 2) | kind
        return h


class Features:
    """Sentences to hashed features: words and word pairs; of Chinese, which sets no blanks between words, runs of two, three and
    four characters. Numbers are no words, but end a run."""

    def __init__(self) -> None:
        self.tokens = _Tokens()

    def _read(self, sentences: list[str]) -> tuple[list[tuple[int, np.ndarray, tuple[np.ndarray, ...]]], int]:
        text = "\n".join(s.replace("\n", " ") if "\n" in s else s for s in sentences) + "\n" if sentences else ""
        h = self.tokens.of(_TOKEN.findall(text.lower()))
        kind = (h & np.uint64(3)).astype(np.int8)
        row = np.cumsum(kind == END) - (kind == END)
        h = h >> np.uint64(2)
        word, runs, out = np.flatnonzero(kind == WORD), np.flatnonzero(kind == HAN), []
        out.append((1, row[word], (h[word],)))
        pair = np.flatnonzero(row[word[1:]] == row[word[:-1]])
        out.append((2, row[word[pair]], (h[word[pair]], h[word[pair + 1]])))
        for k in (2, 3, 4):
            # Places in one sentence with nothing but Chinese between them.
            first, last = runs[: len(runs) - k + 1], runs[k - 1 :]
            first = first[last - first == k - 1]
            out.append((k + 1, row[first], tuple(h[first + i] for i in range(k))))
        return out, len(sentences)

    def __call__(self, sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(indptr, columns) of all features."""
        parts, n = self._read(sentences)
        return linear.gathered(np.concatenate([r for _, r, _ in parts]), np.concatenate([linear.columns(BITS, k, *x) for k, _, x in parts]), n)

    def topic_words(self, sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(indptr, ids from 0) of the features that weak labelling counts: single words, and pairs of Chinese characters."""
        parts, n = self._read(sentences)
        parts = [parts[0], parts[2]]
        wide = [linear.columns(31, k, *x) for k, _, x in parts]
        ptr, ids = linear.gathered(np.concatenate([r for _, r, _ in parts]), np.concatenate(wide), n)
        return ptr, np.unique(ids, return_inverse=True)[1]


_NO_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """A text's letters in lower case, by which texts and sentences count as the same."""
    return _NO_LETTER.sub("", text).lower()


def digest(key: str) -> int:
    return int.from_bytes(blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def least_common(texts: int) -> float:
    """How many of so many distinct texts say a common sentence."""
    return max(COMMON, COMMON_SHARE * texts)


def parted(sentence: str, common: Collection[str]) -> list[tuple[str, bool]]:
    """(part, whether it is the sentence's own) in order: whole common sentences at the end are cut off.

    Where no mark parts an announcement from the sentence before it, that sentence still is an example of its own.
    """
    sizes, out = sorted({len(c) for c in common}, reverse=True), []
    key = letters(sentence)
    while n := next((n for n in sizes if key[-n:] in common and len(key) >= n), 0):
        at, seen = len(sentence), 0
        while seen < n:
            at -= 1
            seen += len(letters(sentence[at]))
        # Not inside a word; Chinese sets no blanks.
        if at and sentence[at - 1].isalpha() and not "㐀" <= sentence[at] <= "鿿":
            break
        out.append((sentence[at:], False))
        sentence = sentence[:at]
        key = letters(sentence)
    return ([(sentence, True)] if key else []) + out[::-1]


def ending(sentence: str) -> str:
    """The last 25 letters, by which sentences count as the same in training; loops vary by a filler or number."""
    return letters(sentence)[-25:]


def said_once(sentences: list[str]) -> list[str]:
    """Sentences without later repetitions. A stuck recogniser's loop would else count as forty examples of its document's
    label. For training only."""
    return list({ending(s): s for s in reversed(sentences)}.values())[::-1]


class SubjectModel:
    """Classifiers and thresholds of each subject, with the boundary model that cuts text into sentences."""

    #: How much the rest of the document weighs in the reading of a sentence, and the least share it counts as.
    CONTEXT, FLOOR = 0.5, 0.05

    def __init__(self, subjects: list[str], model: linear.OneVersusRest, thresholds: np.ndarray, boundaries: BoundaryModel | None):
        self.subjects, self.model, self.thresholds, self.boundaries = subjects, model, thresholds, boundaries
        self.features, self.languages = Features(), None

    def sentence_scores(self, sentences: list[str]) -> np.ndarray:
        return self.model.probabilities(*self.features(sentences))

    def about(self, p: np.ndarray, doc: np.ndarray, docs: int, thresholds: np.ndarray | None = None) -> np.ndarray:
        """Index of each sentence's subject, or -1 where its score is below the threshold. Between subjects the document's other sentences help to decide; that
        the sentence is about any at all is decided by its own score."""
        if not len(p):
            return np.zeros(0, dtype=np.int64)
        mean = np.zeros((docs, p.shape[1]))
        np.add.at(mean, doc, p)
        mean /= np.maximum(np.bincount(doc, minlength=docs), 1)[:, None]
        best = (np.log(p + 1e-9) + self.CONTEXT * np.log(mean[doc] + self.FLOOR)).argmax(1)
        return np.where(p[np.arange(len(p)), best] >= (self.thresholds if thresholds is None else thresholds)[best], best, -1)

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(share of each text's sentences that each subject has, number of sentences)."""
        return self.shares_of(split_texts(texts, self.boundaries))

    def shares_of(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """shares() of texts cut already."""
        counts = np.array([len(s) for s in split], dtype=np.int64)
        out = np.zeros((len(split), len(self.subjects)))
        if counts.sum():
            doc = np.repeat(np.arange(len(split)), counts)
            best = self.about(self.sentence_scores([s for x in split for s in x]), doc, len(split))
            np.add.at(out, (doc[best >= 0], best[best >= 0]), 1)
        return out / np.maximum(counts, 1)[:, None], counts


def weak_labels(sentences: list[str], doc: np.ndarray, label: np.ndarray, group: np.ndarray, k: int, rounds: int = 12, smooth: float = 300.0) -> np.ndarray:
    """Posterior of each sentence's subject (k columns, then none), spread from few unsure document labels.

    Within each group (language) every sentence has one subject or none; its words follow the subject, its subject the
    document. Word frequencies and the documents' mixtures are estimated in turn, beginning with the labelled documents
    (label >= 0). Words that no subject prefers cancel out, as all frequencies are smoothed towards the group's.
    """
    out, features = np.zeros((len(sentences), k + 1), dtype=np.float32), Features()
    for g in np.unique(group):
        mine = np.flatnonzero(group == g)
        ptr, idx = features.topic_words([sentences[i] for i in mine])
        length, size = np.diff(ptr), int(idx.max(initial=0)) + 1
        docs, d = np.unique(doc[mine], return_inverse=True)
        known = np.full(len(docs), -1)
        known[d] = label[mine]
        background = np.bincount(idx, minlength=size) / len(idx)
        prior = np.full((len(docs), k), 0.3)
        prior[known >= 0, known[known >= 0]] = 4.0
        seeded = known[d] >= 0
        post = np.zeros((len(mine), k + 1), dtype=np.float32)
        post[seeded, known[d][seeded]] = 0.6
        post[:, k] = 1 - post[:, :k].sum(1)
        post[~seeded, k] = 0.3
        for _ in range(rounds):
            counts = np.stack([np.bincount(idx, weights=np.repeat(post[:, z], length), minlength=size) for z in range(k + 1)], axis=1)
            like = np.log((counts + smooth * background[:, None]) / (counts.sum(0) + smooth)) - np.log(background)[:, None]
            # Without evidence a sentence is as likely about none in any document; only which subject follows the document.
            # Were the share of none the document's own too, small talk would drift to the subject it stands beside.
            mass = prior.copy()
            np.add.at(mass, d, post[:, :k])
            mix = np.concatenate([(1 - NONE) * mass / mass.sum(1, keepdims=True), np.full((len(docs), 1), NONE)], axis=1)
            logits = linear.OneVersusRest(like.astype(np.float32), np.zeros(k + 1, dtype=np.float32)).logits(ptr, idx) + np.log(mix)[d]
            logits -= logits.max(1, keepdims=True)
            post = np.exp(logits).astype(np.float32)
            post /= post.sum(1, keepdims=True)
        out[mine] = post
    return out


def train(
    sample: list[tuple[int, str, str | None]], subjects: list[str], boundaries: BoundaryModel | None, language=None, common: Collection[int] | None = None, paths: list[tuple[int, str, str]] = ()
) -> SubjectModel:
    """A model from (doc_id, text, subject or None); ``paths`` are documents whose path or section names a subject.

    A document's label says little of one sentence: it may be small talk, about a second subject, or the label may be
    wrong. weak_labels() spreads the labels to the sentences, of documents without a label too; on these the
    one-versus-rest classifiers are trained. A fifth of the hand-labelled documents is kept out of both, and the
    thresholds are chosen on their hand labels. ``language`` gives the languages of sentences; without it all form one
    group. ``common`` holds the digests of sentences that many documents say; without it they are counted in the sample.
    Copies of a text train once a label; a hand label counts before a path's.
    """
    k, index = len(subjects), {s: i for i, s in enumerate(subjects)}
    given = [(i, t, s, bool(s)) for i, t, s in sorted(sample, key=lambda x: (x[0], x[2] or ""))]
    given = [x for x in given if x[3]] + [(i, t, s, False) for i, t, s in sorted(paths)] + [x for x in given if not x[3]]
    texts: dict[tuple[str, int], tuple[list[str], bool]] = {}
    by_hand: set[str] = set()
    for (_, _, s, hand), ss in zip(given, split_texts([t for _, t, _, _ in given], boundaries)):
        if ss:
            key = "".join(map(letters, ss))
            if hand or key not in by_hand:
                texts.setdefault((key, index.get(s, -1)), (ss, hand))
            by_hand |= {key} if hand else set()
    labelled = {key for key, c in texts if c >= 0}
    docs = [(ss, c, hand) for (key, c), (ss, hand) in texts.items() if c >= 0 or key not in labelled]
    turn = np.cumsum([hand for _, _, hand in docs])
    kept = [x for x, t in zip(docs, turn) if x[2] and t % 5 == 4]
    docs = [x for x, t in zip(docs, turn) if not (x[2] and t % 5 == 4)]
    if not any(c >= 0 for _, c, _ in docs):
        return SubjectModel(subjects, linear.OneVersusRest(np.zeros((1 << BITS, k), dtype=np.float32), np.full(k, -9, dtype=np.float32)), np.full(k, 0.5), boundaries)
    # What many documents say word for word (announcements, greetings) tells no document's subject: examples of none.
    if common is None:
        distinct = {tuple(ss) for ss, _, _ in docs}
        said = Counter(digest(x) for ss in distinct for x in set(map(letters, ss)))
        common = {x for x, n in said.items() if n >= least_common(len(distinct))}
    announced = {x for ss, _, _ in docs for x in map(letters, ss) if len(x) >= SHORT and digest(x) in common}
    parts = [[p for s in said_once(ss) for p in parted(s, announced)] for ss, _, _ in docs]
    sentences, own = [s for ps in parts for s, _ in ps], np.array([o for ps in parts for _, o in ps])
    doc = np.repeat(np.arange(len(docs)), [len(ps) for ps in parts])
    label = np.array([c for _, c, _ in docs])[doc]
    y = np.zeros((len(sentences), k), dtype=np.float32)
    if own.any():
        mine = [s for s, o in zip(sentences, own) if o]
        y[own] = weak_labels(mine, doc[own], label[own], language(mine) if language else np.zeros(len(mine), dtype=np.int64), k)[:, :k]
    model = SubjectModel(subjects, linear.fit(*Features()(sentences), y, BITS, rounds=30), np.full(k, 0.5), boundaries)
    if kept:
        model.thresholds = calibrated(model, [ss for ss, _, _ in kept], np.array([c for _, c, _ in kept]))
    return model


def calibrated(model: SubjectModel, split: list[list[str]], label: np.ndarray, least: float = 0.25) -> np.ndarray:
    """Each subject's threshold on sentences, by the best F1 of documents against hand labels (of equally good ones the middle).

    A document has one label though it may be about two subjects. So naming a subject besides the labelled one is no
    error; naming it instead is, and so is missing the labelled one.
    """
    size = np.array([len(x) for x in split])
    doc = np.repeat(np.arange(len(split)), size)
    p = model.sentence_scores([s for x in split for s in x])
    best = model.about(p, doc, len(split), np.zeros(len(model.subjects)))
    score, grid = p[np.arange(len(p)), best], np.arange(0.2, 0.81, 0.05)

    def named(c: int, t: float) -> np.ndarray:
        return np.bincount(doc, weights=(best == c) & (score >= t), minlength=len(split)) >= least * size - 1e-9

    right = np.array([named(c, 0.5) for c in range(len(model.subjects))])[label, np.arange(len(split))]
    out = np.full(len(model.subjects), 0.5)
    for c in range(len(out)):
        mine = label == c
        if mine.any():
            f1 = []
            for t in grid:
                n = named(c, t)
                hit, instead = (n & mine).sum(), (n & ~mine & ~right).sum()
                f1.append(2 * hit / max(1, mine.sum() + hit + instead))
            good = np.flatnonzero(np.array(f1) >= max(f1) - 1e-9)
            out[c] = grid[good[len(good) // 2]]
    return out


def common_sentences(documents: DataFrame, boundaries: BoundaryModel | None) -> set[int]:
    """Digests of the sentences that many distinct texts of all documents say; copies of a text count once.

    One pass over the whole texts; only pairs of digests are shuffled. Those collected are few, as a text has few sentences.
    """
    held = documents.sparkSession.sparkContext.broadcast(boundaries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = []
            for ss in split_texts(pdf["text"].tolist(), held.value):
                keys = [letters(s) for s in ss]
                if keys:
                    copy = digest("".join(keys))
                    got += [(copy, None), *((copy, digest(x)) for x in {x for x in keys if len(x) >= SHORT})]
            yield pd.DataFrame({"copy": pd.array([a for a, _ in got], dtype="Int64"), "said": pd.array([b for _, b in got], dtype="Int64")})

    pairs = spread(documents.where("text is not null").select("text")).mapInPandas(run, "copy bigint, said bigint")
    checkpoint_dir(documents.sparkSession)
    # The row of no sentence counts the texts.
    counts = pairs.distinct().groupBy("said").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON).checkpoint()
    texts = counts.where("said is null").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    return {r[0] for r in counts.where(F.col("said").isNotNull() & (F.col("n") >= least_common(texts))).select("said").collect()}


def named_subject(columns: list[str], areas: list[tuple[str, str | None]]) -> Column:
    """The subject that a step of a path or section names, by its code or a word that only its title has; null if none or several."""
    words: dict[str, set[str]] = {}
    for subject, title in areas:
        for w in {subject.lower(), *re.findall(r"[^\W\d_]{4,}", (title or "").lower())}:
            words.setdefault(w, set()).add(subject)
    only = {w: next(iter(x)) for w, x in words.items() if len(x) == 1} | {s.lower(): s for s, _ in areas}
    steps = F.split(F.lower(F.concat_ws("/", *columns)), r"[^\p{L}]+")
    table = F.create_map(*[F.lit(x) for kv in sorted(only.items()) for x in kv])
    found = F.array_distinct(F.filter(F.transform(steps, lambda w: F.element_at(table, w)), lambda x: x.isNotNull()))
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def learn_subjects(documents: DataFrame, seed: DataFrame, areas: DataFrame, most: int = 6000, most_labelled: int = 4000, sections: list[str] = ()) -> SubjectModel:
    """A model from about ``most_labelled`` hand-labelled documents and others to make up ``most`` (least hashes), of distinct texts.

    ``sections`` are columns of ``documents`` that hold an address, path or section: where such a value names a subject,
    it is one more weak label, of at most ``most_labelled`` documents. Sentences are grouped by language, read by
    profiles from the same draw, which the model keeps as ``languages``.
    """
    named = [(r["subject"], r["title"] if "title" in areas.columns else None) for r in areas.where("subject is not null").select(*[c for c in ("subject", "title") if c in areas.columns]).distinct().collect()]
    subjects = sorted({s for s, _ in named})
    known = seed.where(F.col("subject").isin(*subjects)).select("doc_id", "subject").distinct() if subjects else seed.select("doc_id", "subject").where("false")
    held = known.count()
    share = min(1.0, most_labelled / max(1, held))
    if share < 1:
        known = known.where(F.xxhash64("doc_id", "subject") <= int(share * (1 << 64)) - (1 << 63))
    # About most_labelled rows: bounded.
    hand = F.broadcast(known.groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("_hand")))
    kinds = {"agreed": (agreed_language(), 3000), "punctuated": (punctuated_language(), 4000), "any": (F.lit(""), most)}
    if sections and named:
        kinds["paths"] = (named_subject(list(sections), named), most_labelled)
    drawn = draw_texts(documents.join(hand, "doc_id", "left"), kinds, "_hand")
    rows = [(i, text, s) for i, text, found in drawn["extra"] for s in found]
    taken = {text for _, text, _ in rows}
    rows += [(i, text, None) for i, text, _ in drawn["any"] if text not in taken][: max(0, most - len(rows))]
    profiles, boundaries = profiles_of(drawn["agreed"]), boundaries_of(drawn)
    model = train(rows, subjects, boundaries, lambda x: profiles.lead(x)[0], common_sentences(documents, boundaries), drawn.get("paths", []))
    model.languages = profiles
    return model


def subject_shares(documents: DataFrame, model: SubjectModel) -> DataFrame:
    """(doc_id, sentences, shares MAP<STRING, DOUBLE>): each document's sentences and its subjects' shares of them.

    One narrow pass over the whole texts. Null, empty and wordless texts have 0 sentences and an empty map.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = held.value
        for pdf in batches:
            share, n = m.shares(pdf["text"].tolist())
            maps = [{m.subjects[c]: float(row[c]) for c in np.flatnonzero(row)} for row in share]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "sentences": n.astype("int32"), "shares": maps})

    return spread(documents.select("doc_id", "text")).mapInPandas(run, "doc_id bigint, sentences int, shares map<string,double>")


def subjects_found(shares: DataFrame, least: float = 0.25) -> DataFrame:
    """(doc_id, subject): the subjects that at least ``least`` of a document's sentences are about."""
    rows = shares.select("doc_id", F.explode("shares").alias("subject", "share"))
    return rows.where(F.col("share") >= least - 1e-9).select("doc_id", "subject")
