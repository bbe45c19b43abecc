"""Sentences of transcripts, with or without punctuation."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm import linear
from voxmill.llm.unicode_tables import folded

LANGUAGES = ("en", "zh", "de", "fr", "es")
TURN = re.compile(r"[sS](?<!\w[sS])[pP][kK]\d+\b[ \t]*:?")
TAG = re.compile(r"<[A-Za-z]+>|\[[A-Za-z]+\]")
#: What ends a sentence: a mark or a line's end, but no full stop between digits or before a lower-case letter.
_CUT = re.compile(r"[.!?。\n](?:(?<![.])|(?!(?<=\d\.)\d)(?![a-z]))")
_ENDS = re.compile(r"[.!?。]")
_HAS_LETTER = re.compile(r"[^\W\d_]")
UNIT = re.compile(r"[㐀-鿿]|[^\W\d_㐀-鿿]+(?:['’-][^\W\d_㐀-鿿]+)*|\d+")
BITS = 18


def cleaned(text: str) -> str:
    """In its visible form, turn marks made line breaks, tags made blanks."""
    text = TURN.sub("\n", folded(text))
    return TAG.sub(" ", text) if "<" in text or "[" in text else text


def _units(text: str) -> tuple[list[str], list[int]]:
    """(units in lower case, any number as 0; where each begins)."""
    found = [(m[0], m.start()) for m in UNIT.finditer(text)]
    return ["0" if u[0].isdigit() else u.lower() for u, _ in found], [a for _, a in found]


def gap_rows(lines: list[list[str]], hashes: linear.Hashes) -> np.ndarray:
    """For each gap between two units of each line, in order, the columns of its features: what stands on either side."""
    flat, at, base = [], [], 3
    for u in lines:
        flat += ["^", "^", "^", *u, "$", "$", "$"]
        at.append(np.arange(base + 1, base + len(u)))
        base += len(u) + 6
    h, g = hashes.of(flat), np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
    x, y, z = h[g - 1], h[g - 2], h[g - 3]
    a, b, c, d = h[g], h[g + 1], h[g + 2], h[g + 3]
    parts = ((x,), (y, x), (z, y, x), (a,), (a, b), (a, b, c), (a, b, c, d), (x, a))
    return np.stack([linear.columns(BITS, k, *p) for k, p in enumerate(parts)], axis=1)


class BoundaryModel:
    """Where sentences end in text without punctuation, learnt from text with it."""

    def __init__(self, model: linear.OneVersusRest):
        self.model, self.hashes = model, linear.Hashes()

    @staticmethod
    def train(texts: list[str]) -> BoundaryModel:
        lines, labels = [], []
        for text in texts:
            for line in cleaned(text).split("\n"):
                if not _ENDS.search(line):
                    continue
                units, last = [], []
                for s in _CUT.split(line):
                    got = _units(s)[0]
                    if got and _HAS_LETTER.search(s):
                        units += got
                        last.append(len(units))
                if len(last) >= 2:
                    is_end = np.zeros(len(units) + 1, dtype=np.float32)
                    is_end[last] = 1
                    lines.append(units)
                    labels.append(is_end[1 : len(units)])
        if not lines:
            return BoundaryModel(linear.OneVersusRest(np.zeros((1 << BITS, 1), dtype=np.float32), np.full(1, -9, dtype=np.float32)))
        rows = gap_rows(lines, linear.Hashes())
        ptr = np.arange(len(rows) + 1, dtype=np.int64) * rows.shape[1]
        return BoundaryModel(linear.fit(ptr, rows.ravel(), np.concatenate(labels)[:, None], BITS, rounds=40, rate=1.0))

    def cut(self, lines: list[str]) -> list[list[str]]:
        """The sentences of each line; a line without units has none."""
        units = [_units(line) for line in lines]
        rows = gap_rows([u for u, _ in units], self.hashes)
        ptr = np.arange(len(rows) + 1, dtype=np.int64) * rows.shape[1]
        ends = self.model.logits(ptr, rows.ravel())[:, 0] > -0.5
        out, g = [], 0
        for line, (u, begins) in zip(lines, units):
            n = max(0, len(u) - 1)
            at = [0, *(begins[i + 1] for i in np.flatnonzero(ends[g : g + n])), len(line)]
            out.append([line[a:b] for a, b in zip(at, at[1:])] if u else [])
            g += n
        return out


def split_texts(texts: list[str | None], boundaries: BoundaryModel | None = None) -> list[list[str]]:
    """The sentences of each text in its visible form. Null, empty and wordless texts have none.

    A text with no sentence mark at all is cut by the boundary model, if one is given, else at its lines.
    """
    clean = [cleaned(t) if t else "" for t in texts]
    parts = [_CUT.split(t) for t in clean]
    if boundaries is not None:
        bare = [i for i, t in enumerate(clean) if t and not _ENDS.search(t)]
        lines = [clean[i].split("\n") for i in bare]
        cut = iter(boundaries.cut([line for x in lines for line in x]))
        for i, x in zip(bare, lines):
            parts[i] = [s for _ in x for s in next(cut)]
    return [[s for p in x if (s := p.strip()) and _HAS_LETTER.search(s)] for x in parts]


def split_sentences(text: str | None, boundaries: BoundaryModel | None = None) -> list[str]:
    """split_texts() of one text."""
    return split_texts([text], boundaries)[0]


def even_shares(held: dict, most: int) -> dict:
    """How many of each part to take, ``most`` in all: as many of each, as far as it has them."""
    out, left = {}, most
    for k, (part, n) in enumerate(sorted(held.items(), key=lambda x: (x[1], str(x[0])))):
        out[part] = min(n, left // (len(held) - k))
        left -= out[part]
    return out


def draw_texts(documents: DataFrame, kinds: dict[str, tuple[Column, int]], extra: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> dict[str, list[tuple]]:
    """Samples of (id, text, part) by kind, all in one pass: at most so many of each kind, of distinct texts, with the least hash.

    A kind is a column of a few values, its parts, and a number; each part gives the same number of texts, as far as it
    has them, and rows of no part (null) are left out. Of copies of a text only the first of a part counts. ``extra``, a
    column, adds a sample "extra" of all rows where it is not null; the caller bounds their number.

    A first pass estimates the distinct texts of each part, from which follows the hash below which a part's sample
    lies; only rows below it are shuffled or leave for the driver. If the estimate was too high, the border is raised.
    """
    names = list(kinds)
    rows = documents.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("at"), (F.col(extra) if extra else F.lit(None)).alias("extra"), *[kinds[n][0].alias(f"k{i}") for i, n in enumerate(names)]
    )
    parts = [f"k{i}" for i in range(len(names))]
    counts = [r.asDict() for r in rows.groupBy(*parts).agg(F.approx_count_distinct("at", 0.02).alias("n")).collect()]
    held: list[dict] = [{} for _ in names]
    for r in counts:
        for i, k in enumerate(parts):
            if r[k] is not None:
                held[i][r[k]] = held[i].get(r[k], 0) + r["n"]
    share = [{x: min(1.0, (1.2 * want + 50) / max(1, held[i][x])) for x, want in even_shares(held[i], kinds[n][1]).items()} for i, n in enumerate(names)]
    while True:
        below = F.col("extra").isNotNull()
        for k, s in zip(parts, share):
            for x, f in s.items():
                below = below | ((F.col(k) == F.lit(x)) & (F.col("at") <= F.lit(min((1 << 63) - 1, int(f * (1 << 64)) - (1 << 63)))))
        first = F.min_by(F.struct("id", "text", "extra"), F.struct("id", "text"))
        got = rows.where(below).groupBy("at", F.when(F.col("extra").isNotNull(), F.col("id")).alias("own"), *parts).agg(first.alias("r")).select("at", "r.*", *parts).collect()
        out: dict[str, list[tuple]] = {n: [] for n in names}
        lacking = False
        for i, n in enumerate(names):
            texts: dict = {x: {} for x in held[i]}
            for r in sorted(got, key=lambda r: (r["at"], r["id"])):
                if r[parts[i]] is not None and r["at"] <= int(share[i][r[parts[i]]] * (1 << 64)) - (1 << 63):
                    texts[r[parts[i]]].setdefault(r["text"], r["id"])
            for x, want in even_shares({x: len(t) if share[i][x] >= 1 else held[i][x] for x, t in texts.items()}, kinds[n][1]).items():
                out[n] += [(k, t, x) for t, k in list(texts[x].items())[:want]]
                if len(texts[x]) < want and share[i][x] < 1:
                    share[i][x], lacking = min(1.0, share[i][x] * 2), True
        if not lacking:
            if extra:
                out["extra"] = [(r["id"], r["text"], r["extra"]) for r in sorted((r for r in got if r["extra"] is not None), key=lambda r: r["id"])]
            return out


def label_code(label: Column) -> Column:
    """The language that a label names: its part before any '-' or '_', without outer blanks, in lower case."""
    return F.lower(F.trim(F.regexp_extract(label, r"^([^-_]*)", 1)))


def punctuated_language(text_col: str = "text", lang_col: str = "lang") -> Column:
    """Of a punctuated document the language that its label names, or '' where it names none; else null."""
    code = label_code(F.col(lang_col))
    return F.when(F.col(text_col).rlike("[.!?。！？].*[.!?。！？]"), F.when(code.isin(*LANGUAGES), code).otherwise(""))


def learn_boundaries(documents: DataFrame, most: int = 4000) -> BoundaryModel:
    """A boundary model from at most ``most`` punctuated documents of distinct texts, those with the least hash.

    Each language that a label names gets the same number of texts; documents without such a label count as one more.
    """
    return boundaries_of(draw_texts(documents, {"punctuated": (punctuated_language(), most)}))


def boundaries_of(drawn: dict[str, list[tuple]]) -> BoundaryModel:
    return BoundaryModel.train([text for _, text, _ in drawn["punctuated"]])
