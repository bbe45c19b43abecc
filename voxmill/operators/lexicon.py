"""Vocabularies, n-gram counts, lexicons and the arc tables of graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxmill.operators.keyed import row_numbers
from voxmill.session import checkpoint_dir

EPSILON, DISAMBIGUATION, BEGIN, END, UNKNOWN = "<eps>", "#0", "<s>", "</s>", "<unk>"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def char_vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """AG9, GEN1: (ch, n) of characters that are no ASCII letters, digits, blanks, brackets or apostrophes."""
    from voxmill.functions.text import NON_LATIN

    chars = df.select(F.explode(F.regexp_extract_all(text, F.lit(f"({NON_LATIN})"), F.lit(1))).alias("ch"))
    return chars.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


def word_vocabulary(df: DataFrame, text: str = "text", specials: tuple[str, ...] = (UNKNOWN, BEGIN, END)) -> DataFrame:
    """AG10: (word, n) of lower-cased words (ASCII letters only are folded), the specials once each."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = df.select(F.explode(words_of(F.translate(text, upper, upper.lower()))).alias("word"))
    extra = df.sparkSession.createDataFrame([(s,) for s in specials], "word string")
    return words.unionByName(extra).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def ngram_counts(df: DataFrame, orders: tuple[int, ...] = (1, 2, 3), text: str = "text", padded: bool = True) -> DataFrame:
    """AG11: (ord, ngram, n): counted with map-side partial sums; a sentence is padded with one begin and one end mark."""
    w = words_of(F.col(text))
    toks = F.concat(F.array(F.lit(BEGIN)), w, F.array(F.lit(END))) if padded else w
    lines = df.where(F.size(w) > 0).select(toks.alias("w"))
    grams = F.flatten(F.array(*[
        F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), _gram(k))).otherwise(F.array().cast("array<struct<ord:int,ngram:string>>")) for k in orders
    ]))
    return lines.select(F.explode(grams).alias("g")).groupBy("g.ord", "g.ngram").agg(F.count(F.lit(1)).alias("n"))


def _gram(k: int):
    return lambda i: F.struct(F.lit(k).alias("ord"), F.array_join(F.slice(F.col("w"), i, F.lit(k)), " ").alias("ngram"))


def kneser_ney_bigrams(counts: DataFrame, discount: float = 0.75) -> DataFrame:
    """AG12: (ngram, logprob) of bigrams from ngram_counts(), interpolated Kneser-Ney with one discount."""
    bi = counts.where("ord = 2").select(F.substring_index("ngram", " ", 1).alias("h"), F.substring_index("ngram", " ", -1).alias("w"), "n")
    history = bi.groupBy("h").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    cont = bi.groupBy("w").agg(F.count(F.lit(1)).alias("before")).withColumn("pairs", bi.agg(F.count(F.lit(1))).scalar())
    out = bi.join(history, "h").join(cont, "w")
    p = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total") + discount * F.col("kinds") / F.col("total") * F.col("before") / F.col("pairs")
    return out.select(F.concat_ws(" ", "h", "w").alias("ngram"), F.log10(p).alias("logprob"))


def best_mixture(scores: DataFrame, rounds: int = 50) -> float:
    """AG12: the weight of the first of two models (columns p1, p2: probabilities of held-out words) by expectation
    maximisation; each round is one distributed sum over the scores, which are written once; the loop is the driver's."""
    lam = 0.5
    checkpoint_dir(scores.sparkSession)
    held = scores.select("p1", "p2").where("p1 + p2 > 0").checkpoint()
    for _ in range(rounds):
        share = F.col("p1") * lam / (F.col("p1") * lam + F.col("p2") * (1 - lam))
        new = held.agg(F.avg(share)).collect()[0][0]
        if new is None or abs(new - lam) < 1e-6:
            return lam if new is None else new
        lam = new
    return lam


def perplexity(logprobs: DataFrame, column: str = "logprob") -> DataFrame:
    """AG12: 10 to the negative mean log10 probability."""
    return logprobs.agg(F.count(F.lit(1)).alias("n"), F.pow(F.lit(10.0), -F.avg(column)).alias("perplexity"))


def drop_bad_grams(lines: DataFrame, column: str = "value") -> DataFrame:
    """SRC16: model lines without those that chain sentence marks or hold the unknown word, whatever the case."""
    return lines.where(~F.col(column).rlike(r"(?i)<s> <s>|</s> <s>|</s> </s>|<unk>"))


def dense_ids(words: DataFrame, column: str = "word") -> DataFrame:
    """WN5: (word, id): distinct words in byte order from 1, the empty word 0, then #0, <s>, </s>."""
    ranked = row_numbers(words.select(F.col(column).alias("word")).distinct(), [F.col("word")], "k").select("word", (F.col("k") + 1).cast("bigint").alias("id"))
    last = words.agg(F.countDistinct(column).alias("n"))
    extra = last.select(F.explode(F.array(*[F.struct(F.lit(w).alias("word"), i.cast("bigint").alias("id")) for w, i in ((EPSILON, F.lit(0)), (DISAMBIGUATION, F.col("n") + 1), (BEGIN, F.col("n") + 2), (END, F.col("n") + 3))])).alias("e")).select("e.*")
    return ranked.unionByName(extra)


def lexicon_with_fallback(words: DataFrame, lexicon: DataFrame, units: DataFrame) -> DataFrame:
    """JN8, TK21: (word, units): the lexicon's pronunciation, else the word's characters, unknown ones as <unk>.

    ``lexicon`` has word, pron; ``units`` has unit. Of several pronunciations all are kept.
    """
    w = words.select("word").where("word is not null and word <> ''").distinct()
    known = w.join(lexicon.select("word", "pron"), "word")
    rest = w.join(lexicon.select("word"), "word", "left_anti").select("word", F.posexplode(F.filter(F.split("word", ""), lambda c: c != "")).alias("k", "unit"))
    spelt = rest.join(units.select("unit", F.lit(True).alias("known")).distinct(), "unit", "left").select("word", "k", F.when(F.col("known"), F.col("unit")).otherwise(UNKNOWN).alias("unit"))
    built = spelt.groupBy("word").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "unit"))), lambda x: x["unit"]), " ").alias("pron"))
    return known.unionByName(built).select("word", F.col("pron").alias("units"))


def disambiguated(lexicon: DataFrame, order: str = "line_no") -> DataFrame:
    """AG13, JN10, WN6: lexicon (word, pron, line_no) with ``mark``: '#k' where a pronunciation is another's prefix or stands several
    times, k counting the lines of that pronunciation in order; an empty pronunciation always has one. '' elsewhere."""
    seqs = lexicon.groupBy("pron").agg(F.count(F.lit(1)).alias("times"))
    parts = F.split("pron", " ")
    prefixes = seqs.where(F.size(parts) > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), " "))).alias("_prefix")).distinct()
    flagged = seqs.join(prefixes, F.col("pron") == F.col("_prefix"), "left").select("pron", ((F.col("times") > 1) | F.col("_prefix").isNotNull() | (F.col("pron") == "")).alias("needs"))
    k = F.row_number().over(Window.partitionBy("pron").orderBy(order))
    return lexicon.join(flagged, "pron").withColumn("mark", F.when(F.col("needs"), F.concat(F.lit("#"), k.cast("string"))).otherwise("")).drop("needs")


def lexicon_arcs(lexicon: DataFrame, order: str = "line_no") -> DataFrame:
    """WN7, GEN2: (line_no, k, src, dst, ilabel, olabel): each word's units from and back to state 0, the word on the first arc.

    States are given in line order: a word of n units takes n - 1 of them, after those of the words before it.
    """
    units = F.split("pron", " ")
    placed = row_numbers(lexicon.select("word", "pron", order), [F.col(order)], "_row")
    sized = placed.withColumn("_need", F.greatest(F.size(units) - 1, F.lit(0))).withColumn("_block", F.floor(F.col("_row") / 10_000))
    inner = Window.partitionBy("_block").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    totals = sized.groupBy("_block").agg(F.sum("_need").alias("_sum"))  # a row each 10,000 words
    offsets = totals.select("_block", F.coalesce(F.sum("_sum").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    first = F.coalesce(F.sum("_need").over(inner), F.lit(0)) + F.col("_off") + 1
    states = sized.join(F.broadcast(offsets), "_block").withColumn("_first", first)
    arcs = states.select(order, "word", "_first", F.size(units).alias("_n"), F.posexplode(units).alias("k", "ilabel"))
    src = F.when(F.col("k") == 0, F.lit(0)).otherwise(F.col("_first") + F.col("k") - 1)
    dst = F.when(F.col("k") == F.col("_n") - 1, F.lit(0)).otherwise(F.col("_first") + F.col("k"))
    return arcs.select(order, "k", src.cast("bigint").alias("src"), dst.cast("bigint").alias("dst"), "ilabel", F.when(F.col("k") == 0, F.col("word")).otherwise(EPSILON).alias("olabel"))


def ctc_arcs(tokens: DataFrame, token: str = "token", ident: str = "id") -> DataFrame:
    """GEN3: (src, dst, ilabel, olabel): the blank stays at 0; a token (ids from 1) goes to its state, repeats there, and comes back;
    '#' symbols pass at 0 and take up a number all the same."""
    t, n = F.col(token), F.col(ident).cast("bigint")
    zero = F.lit(0).cast("bigint")

    def arc(a: Column, b: Column, i: Column, o: Column) -> Column:
        return F.struct(a.alias("src"), b.alias("dst"), i.alias("ilabel"), o.alias("olabel"))

    eps, blank = F.lit(EPSILON), F.lit("<blank>")
    arcs = F.when(t.startswith("#"), F.array(arc(zero, zero, eps, t))).otherwise(F.array(arc(zero, n, t, t), arc(n, n, t, eps), arc(n, zero, eps, eps)))
    loop = tokens.sparkSession.createDataFrame([(0, 0, "<blank>", EPSILON)], "src bigint, dst bigint, ilabel string, olabel string")
    return loop.unionByName(tokens.select(F.explode(arcs).alias("a")).select("a.*"))


def ctc_arcs_corrected(tokens: DataFrame, token: str = "token", ident: str = "id") -> DataFrame:
    """GEN4: as ctc_arcs(), without the way over 0 between unlike tokens: an arc from every token's state to every other's.

    The number of arcs is the square of the tokens by definition of the graph; the token list is a recogniser's
    inventory of a fixed size, so the pairs are made by a join on one constant.
    """
    plain = tokens.where(~F.col(token).startswith("#")).select(F.col(token).alias("t"), F.col(ident).cast("bigint").alias("n"))
    left, right = plain.select(F.col("n").alias("src"), F.lit(1).alias("one")), plain.select(F.col("n").alias("dst"), F.col("t").alias("ilabel"), F.lit(1).alias("one"))
    across = left.join(right, "one").where("src <> dst").select("src", "dst", "ilabel", F.col("ilabel").alias("olabel"))
    zero = F.lit(0).cast("bigint")
    own = plain.select(F.explode(F.array(
        F.struct(zero.alias("src"), F.col("n").alias("dst"), F.col("t").alias("ilabel"), F.col("t").alias("olabel")),
        F.struct(F.col("n").alias("src"), F.col("n").alias("dst"), F.col("t").alias("ilabel"), F.lit(EPSILON).alias("olabel")),
        F.struct(F.col("n").alias("src"), zero.alias("dst"), F.lit("<blank>").alias("ilabel"), F.lit(EPSILON).alias("olabel")),
    )).alias("a")).select("a.*")
    loops = tokens.where(F.col(token).startswith("#")).select(zero.alias("src"), zero.alias("dst"), F.lit(EPSILON).alias("ilabel"), F.col(token).alias("olabel"))
    start = tokens.sparkSession.createDataFrame([(0, 0, "<blank>", EPSILON)], "src bigint, dst bigint, ilabel string, olabel string")
    return start.unionByName(own).unionByName(across).unionByName(loops)


def grammar_arcs(arcs: DataFrame) -> DataFrame:
    """GEN7: empty inputs become #0, sentence marks become empty on both sides."""
    def silent(c: str) -> Column:
        return F.when(F.col(c).isin(BEGIN, END), EPSILON).otherwise(F.col(c))

    return arcs.withColumn("ilabel", F.when(F.col("ilabel") == EPSILON, DISAMBIGUATION).otherwise(silent("ilabel"))).withColumn("olabel", silent("olabel"))
