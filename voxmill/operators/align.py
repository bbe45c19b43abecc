"""Alignment of reference and recognised token sequences, and the error measures made from it."""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from voxmill.functions import text as T

ALIGNMENT = Y.StructType([Y.StructField(x, Y.IntegerType()) for x in "ncsdi"] + [Y.StructField(x, Y.ArrayType(Y.StringType())) for x in ("lab", "rec")])


class _Distances:
    """Unit-cost edit distances of all prefixes, each row made in one vectorised sweep.

    Only every k-th row is kept, k about the root of their number; the rows between two of them are made again when the
    way back passes through. So two texts of n tokens take memory of n * sqrt(n), and every tie is decided as in the
    whole matrix.
    """

    def __init__(self, lab: np.ndarray, rec: np.ndarray):
        self.lab, self.rec, self.steps = lab, rec, np.arange(len(rec) + 1, dtype=np.int32)
        self.size = max(1, math.isqrt(len(lab)))
        self.kept, row = [self.steps], self.steps
        for k in range(1, len(lab) + 1):
            row = self._next(row, k)
            if k % self.size == 0:
                self.kept.append(row)
        self.block, self.rows = -1, []

    def _next(self, row: np.ndarray, k: int) -> np.ndarray:
        best = row + 1
        np.minimum(best[1:], row[:-1] + (self.rec != self.lab[k - 1]), out=best[1:])
        return np.minimum.accumulate(best - self.steps) + self.steps

    def __getitem__(self, at: tuple[int, int]) -> int:
        x, y = at
        block, k = divmod(x, self.size)
        if k == 0:
            return self.kept[block][y]
        if block != self.block:
            self.block, self.rows = block, [self.kept[block]]
            for j in range(block * self.size + 1, min(len(self.lab), (block + 1) * self.size - 1) + 1):
                self.rows.append(self._next(self.rows[-1], j))
        return self.rows[k][y]


def _ids(*sides: list[str]) -> list[np.ndarray]:
    ids: dict[str, int] = {}
    return [np.fromiter((ids.setdefault(t, len(ids)) for t in x), dtype=np.int64, count=len(x)) for x in sides]


def align_tokens(lab: list[str], rec: list[str]) -> tuple[int, int, int, int, int, list[str], list[str]]:
    """(N, C, S, D, I, padded lab, padded rec) of the cheapest alignment; of equal ways a deletion comes first, then an insertion.

    Both lists empty give zeros; an empty side makes every token of the other an insertion or deletion.
    """
    a, b = _ids(lab, rec)
    if len(a) == len(b) and (a == b).all():
        return len(lab), len(lab), 0, 0, 0, list(lab), list(rec)
    d = _Distances(a, b)
    x, y = len(a), len(b)
    c = s = dels = ins = 0
    left, right = [], []
    while x or y:
        here = d[x, y]
        if x and d[x - 1, y] + 1 == here:
            x -= 1
            dels += 1
            left.append(lab[x])
            right.append("")
        elif y and d[x, y - 1] + 1 == here:
            y -= 1
            ins += 1
            left.append("")
            right.append(rec[y])
        else:
            x, y = x - 1, y - 1
            same = a[x] == b[y]
            c, s = c + same, s + (not same)
            left.append(lab[x])
            right.append(rec[y])
    return len(lab), int(c), int(s), dels, ins, left[::-1], right[::-1]


@F.pandas_udf(ALIGNMENT)
def align(lab: pd.Series, rec: pd.Series) -> pd.DataFrame:
    """ED5 over ARRAY<STRING> columns; a null side counts as empty."""
    rows = [align_tokens(list(a) if a is not None else [], list(b) if b is not None else []) for a, b in zip(lab, rec)]
    return pd.DataFrame(rows, columns=["n", "c", "s", "d", "i", "lab", "rec"])


def align_declared(lab: Column, rec: Column) -> Column:
    """ED5's counters as Catalyst expressions only, carried through the same sweep: the definition, for short sequences.

    STRUCT<dist, n, c, s, d, i>. Quadratic and interpreted; align() is the production path.
    """
    def cell(dist, c, s, d, i):
        return F.struct(dist.cast("int").alias("dist"), c.cast("int").alias("c"), s.cast("int").alias("s"), d.cast("int").alias("d"), i.cast("int").alias("i"))

    zero = F.lit(0)
    start = F.transform(F.concat(F.array(F.lit("")), rec), lambda t, k: cell(k, zero, zero, zero, k))

    def next_row(row: Column, token: Column) -> Column:
        first = row[0]
        seed = F.array(cell(first["dist"] + 1, first["c"], first["s"], first["d"] + 1, first["i"]))
        over = F.zip_with(F.slice(row, F.lit(1), F.size(rec)), F.slice(row, F.lit(2), F.size(rec)), lambda g, u: F.struct(g.alias("g"), u.alias("u")))
        cells = F.zip_with(over, rec, lambda o, t: F.struct(o["g"].alias("g"), o["u"].alias("u"), (t == token).alias("same")))

        def add(acc: Column, e: Column) -> Column:
            left, up, diag = F.element_at(acc, -1), e["u"], e["g"]
            through = diag["dist"] + F.when(e["same"], 0).otherwise(1)
            hit = F.when(e["same"], 1).otherwise(0)
            least = F.least(up["dist"] + 1, left["dist"] + 1, through)
            new = (
                F.when(up["dist"] + 1 == least, cell(least, up["c"], up["s"], up["d"] + 1, up["i"]))
                .when(left["dist"] + 1 == least, cell(least, left["c"], left["s"], left["d"], left["i"] + 1))
                .otherwise(cell(least, diag["c"] + hit, diag["s"] + 1 - hit, diag["d"], diag["i"]))
            )
            return F.concat(acc, F.array(new))

        return F.aggregate(cells, seed, add)

    end = F.element_at(F.aggregate(lab, start, next_row), -1)
    return F.struct(end["dist"].alias("dist"), F.size(lab).alias("n"), end["c"].alias("c"), end["s"].alias("s"), end["d"].alias("d"), end["i"].alias("i"))


def error_rate(n: Column, errors: Column) -> Column:
    """ED6: 100 * errors / N, 0 where N is 0."""
    return F.when(n > 0, errors * 100.0 / n).otherwise(0.0)


def align_pairs(ref: DataFrame, hyp: DataFrame, ignore: tuple[str, ...] = (), case_sensitive: bool = False, variant: str = "A") -> DataFrame:
    """JN3, ED1-6: (utt, n, c, s, d, i, lab, rec, wer) of each reference row with a recognised text of its utterance.

    ``ref`` has utt, text; ``hyp`` utt, text and, for repeated utterances, ``ord``: the last in that order counts.
    References without a recognised text are left out, repeated references are scored one by one. Identical token lists
    are settled in the worker without a matrix. Texts are shuffled once by utterance, then aligned where they are.
    """
    order = F.col("ord") if "ord" in hyp.columns else F.lit(0)
    last = hyp.groupBy("utt").agg(F.max_by("text", order).alias("hyp_text"))
    pairs = ref.select("utt", F.col("text").alias("ref_text")).join(last, "utt")
    lab = T.normal_tokens(T.tokens(F.col("ref_text"), variant), ignore, case_sensitive)
    rec = T.normal_tokens(T.tokens(F.coalesce("hyp_text", F.lit("")), variant), ignore, case_sensitive)
    scored = pairs.where(F.col("ref_text").isNotNull()).select("utt", align(lab, rec).alias("a")).select("utt", "a.*")
    return scored.withColumn("wer", error_rate(F.col("n"), F.col("s") + F.col("d") + F.col("i")))


def quality_gate(scored: DataFrame, most_wer: float = 30.0, most_del_ins: int = 2) -> DataFrame:
    """FLT2, FLT3, SET2: rows with a WER, as printed with two decimals, and deletions + insertions within the limits."""
    return scored.where((F.round("wer", 2) <= most_wer) & (F.col("d") + F.col("i") <= most_del_ins))


def corpus_error(scored: DataFrame) -> DataFrame:
    """AG4: one row (n, c, s, d, i, wer), the errors of all utterances over all reference tokens."""
    sums = scored.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("n", "c", "s", "d", "i")])
    return sums.withColumn("wer", error_rate(F.col("n"), F.col("s") + F.col("d") + F.col("i")))


def token_errors(scored: DataFrame) -> DataFrame:
    """AG5: (token, n, cor, sub, del, ins); insertions count for the recognised token, all else for the reference's."""
    pairs = scored.select(F.explode(F.arrays_zip("lab", "rec")).alias("p"))
    token = F.when(F.col("p.lab") == "", F.col("p.rec")).otherwise(F.col("p.lab"))
    op = F.when(F.col("p.lab") == "", "ins").when(F.col("p.rec") == "", "del").when(F.col("p.lab") == F.col("p.rec"), "cor").otherwise("sub")
    each = pairs.select(token.alias("token"), op.alias("op"))
    return each.groupBy("token").agg(
        F.sum(F.when(F.col("op") != "ins", 1).otherwise(0)).alias("n"), *[F.sum(F.when(F.col("op") == x, 1).otherwise(0)).alias(x) for x in ("cor", "sub", "del", "ins")]
    )


def cluster_errors(scored: DataFrame) -> DataFrame:
    """AG6: token_errors() summed by script class, with the rate of each."""
    per = token_errors(scored).withColumn("cluster", T.script_class(F.col("token")))
    sums = per.groupBy("cluster").agg(*[F.sum(x).alias(x) for x in ("n", "cor", "sub", "del", "ins")])
    return sums.withColumn("wer", error_rate(F.col("n"), F.col("sub") + F.col("del") + F.col("ins")))


def keyword_errors(scored: DataFrame, clusters: DataFrame) -> DataFrame:
    """AG7: token_errors() summed by given clusters (cluster, token)."""
    per = token_errors(scored).join(clusters.select("cluster", "token").distinct(), "token")
    sums = per.groupBy("cluster").agg(*[F.sum(x).alias(x) for x in ("n", "cor", "sub", "del", "ins")])
    return sums.withColumn("wer", error_rate(F.col("n"), F.col("sub") + F.col("del") + F.col("ins")))


def distance(a: Column, b: Column) -> Column:
    """Distance of two token arrays only, in the JVM: tokens become single characters, then the built-in measure applies.

    The characters are 20,000 ideographs; a pair with more distinct tokens is measured by align(), row by row.
    """
    words = F.array_distinct(F.concat(a, b))
    alphabet = "".join(chr(0x4E00 + k) for k in range(20_000))

    def spell(x: Column) -> Column:
        return F.array_join(F.transform(x, lambda t: F.substring(F.lit(alphabet), F.array_position(words, t), F.lit(1))), "")

    few, none = F.size(words) <= len(alphabet), F.array().cast("array<string>")
    far = align(F.when(few, none).otherwise(a), F.when(few, none).otherwise(b))
    return F.when(few, F.levenshtein(spell(a), spell(b))).otherwise(far["s"] + far["d"] + far["i"])


def _width(s: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "AFW" else 1 for c in s)


def printed(lab: list[str], rec: list[str], most_width: int = 0, pad: str = " ") -> list[tuple[str, str]]:
    """ED7: the two lines of an alignment in columns of equal display width, wrapped to ``most_width`` columns (0: never)."""
    rows, a, b, used = [], [], [], 0
    for x, y in zip(lab, rec):
        w = max(_width(x), _width(y))
        if most_width and a and used + w + 1 > most_width:
            rows.append((" ".join(a), " ".join(b)))
            a, b, used = [], [], 0
        a.append(x + pad * (w - _width(x)))
        b.append(y + pad * (w - _width(y)))
        used += w + 1
    return [*rows, (" ".join(a), " ".join(b))]


def print_alignment(most_width: int = 0, pad: str = " "):
    """ED7 as a function of (lab, rec) columns giving one text of paired lines."""
    @F.pandas_udf("string")
    def show(lab: pd.Series, rec: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(f"lab: {x}\nrec: {y}" for x, y in printed(list(a), list(b), most_width, pad)) for a, b in zip(lab, rec)])

    return show


def smooth_times(old: list[str], new: list[str], times: list[list[int]]) -> list[list[int]]:
    """ED8: times for the tokens of a rewritten text. ``times`` has a pair for each old token, else the result is empty.

    Matching tokens keep their times. The old tokens of each stretch that changed give their whole span, shared out
    evenly (whole milliseconds, the last token up to the end). New tokens with no old one beside them share the span of
    the matching token that follows, or, at the end, that of the token before.
    """
    if len(old) != len(times) or not times:
        return []
    pairs = [(i, j) for i, j in _matched(old, new) if old[i] == new[j]]
    out: list[list[int]] = []

    def share(begin: int, end: int, n: int) -> None:
        each = (end - begin) // n
        out.extend([begin + k * each, end if k == n - 1 else begin + (k + 1) * each] for k in range(n))

    for (i0, j0), (i1, j1) in zip([(-1, -1), *pairs], [*pairs, (len(old), len(new))]):
        fresh, gone, more = j1 - j0 - 1, i1 - i0 - 1, i1 < len(old)
        if fresh and gone:
            share(times[i0 + 1][0], times[i1 - 1][1], fresh)
        elif fresh and more:
            share(*times[i1], fresh + 1)
            continue
        elif fresh and out:
            share(*out.pop(), fresh + 1)
        elif fresh:
            return []
        if more:
            out.append(list(times[i1]))
    return out


def _matched(old: list[str], new: list[str]) -> list[tuple[int, int]]:
    """Places set against each other by the cheapest alignment; of equal ways the diagonal comes first, then a deletion."""
    a, b = _ids(old, new)
    d, x, y, out = _Distances(a, b), len(a), len(b), []
    while x and y:
        here, up, left, cross = d[x, y], d[x - 1, y], d[x, y - 1], d[x - 1, y - 1]
        if a[x - 1] != b[y - 1] and here != cross and here == up + 1:
            x -= 1
        elif a[x - 1] != b[y - 1] and here != cross and here == left + 1:
            y -= 1
        else:
            x, y = x - 1, y - 1
            out.append((x, y))
    return out[::-1]


@F.pandas_udf(Y.ArrayType(Y.ArrayType(Y.IntegerType())))
def realign_times(old: pd.Series, new: pd.Series, times: pd.Series) -> pd.Series:
    """ED8 over columns."""
    return pd.Series([smooth_times(list(o), list(n), [list(p) for p in t]) if o is not None and n is not None and t is not None else [] for o, n, t in zip(old, new, times)])
