"""Queries of alignment and error measures, with the SQL that checks what SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.functions import text as T
from voxmill.operators import align as A
from voxmill.operators import keyed as K
from voxmill.plans.registry import Registry
from voxmill.session import spread

_R = Registry()
queries, oracle_sql = _R.queries, _R.oracle_sql
_add = _R.add


def _ref_hyp(t) -> tuple[DataFrame, DataFrame]:
    """One transcript of an utterance as reference (the last in byte order) and the other as recognised text (the first)."""
    rows = t("transcripts").where("text is not null")
    return rows.groupBy("utt").agg(F.max("text").alias("text")), rows.groupBy("utt").agg(F.min("text").alias("text"))


def _scored(t) -> DataFrame:
    ref, hyp = _ref_hyp(t)
    return A.align_pairs(ref, hyp, ignore=("uh", "um"), case_sensitive=True)




def _normal(text: str) -> str:
    tokens = f"regexp_extract_all({text}, '" + T.TOKEN_A.replace("'", "''") + "', 1)"
    return f"list_filter(list_transform(list_filter({tokens}, lambda x: x NOT IN ('uh', 'um')), lambda x: regexp_replace(x, '<[^>]*(>|$)', '', 'g')), lambda x: x <> '')"


# Tokens of a pair become single ASCII characters, so that DuckDB's byte-wise distance is the distance of tokens.
_PAIRS = f"""
WITH p AS (SELECT utt, {_normal('max(text)')} AS lab, {_normal('min(text)')} AS rec FROM transcripts WHERE text IS NOT NULL GROUP BY utt),
w AS (SELECT utt, lab, rec, list_distinct(list_concat(lab, rec)) AS words FROM p),
d AS (SELECT utt, len(lab) AS n, len(rec) AS m, levenshtein(array_to_string(list_transform(lab, lambda x: chr(CAST(33 + list_position(words, x) AS INT))), ''), array_to_string(list_transform(rec, lambda x: chr(CAST(33 + list_position(words, x) AS INT))), '')) AS dist FROM w)
"""


def align_filter(t) -> DataFrame:
    """The core curation query: align two transcripts of an utterance, gate on the error rate, keep the passing utterances'
    speakers and durations within the band, and sum up the hours by speaker."""
    passed = A.quality_gate(_scored(t))
    durations = K.duration_band(t("wav2dur")).groupBy("utt").agg(F.max("dur").alias("dur"))
    speakers = t("utt2spk").where("spk is not null").groupBy("utt").agg(F.min("spk").alias("spk"))
    kept = durations.join(passed.select("utt", "wer"), "utt").join(speakers, "utt")
    return kept.groupBy("spk").agg(F.count(F.lit(1)).alias("utts"), F.round(F.sum("dur") / 3600, 6).alias("hours"), F.round(F.avg("wer"), 4).alias("mean_wer"))


_add("align_filter", align_filter)
_add("ed5_ed6_wer", lambda t: _scored(t).select("utt", "n", (F.col("s") + F.col("d") + F.col("i")).alias("dist"), (F.col("c") + F.col("s") + F.col("i")).alias("m"), F.round("wer", 4).alias("wer")), _PAIRS + "SELECT utt, n, dist, m, round(CASE WHEN n > 0 THEN dist * 100.0 / n ELSE 0.0 END, 4) AS wer FROM d")
_add("ed5_invariants", lambda t: _scored(t).where("n = c + s + d").select("utt", (F.col("d") - F.col("i")).alias("surplus"), F.size("lab").alias("columns"), (F.col("c") + F.col("s") + F.col("d") + F.col("i")).alias("ops")).where("columns = ops").select("utt", "surplus"), _PAIRS + "SELECT utt, n - m AS surplus FROM d")
_add("ed5_declared", lambda t: _declared(t), _PAIRS + "SELECT utt, dist, n - m AS surplus FROM d WHERE n <= 12 AND m <= 12 AND n > 0")
_add("ed5_declared_all", lambda t: _declared_all(t), _PAIRS + "SELECT utt, dist, n - m AS surplus FROM d")
_add("ed5_distance", lambda t: _distances(t), _PAIRS + "SELECT utt, dist FROM d")
_add("ed7_printed", lambda t: _scored(t).where("wer > 0").select("utt", A.print_alignment(60)("lab", "rec").alias("shown")))
_add("flt2_wer_gate", lambda t: _scored(t).where(F.round("wer", 2) <= 30).select("utt"), _PAIRS + "SELECT utt FROM d WHERE round(CASE WHEN n > 0 THEN dist * 100.0 / n ELSE 0.0 END, 2) <= 30")
_add("flt3_del_ins_gate", lambda t: A.quality_gate(_scored(t)).select("utt"))
_add("flt4_ratio", lambda t: _scored(t).select("utt", (F.col("wer") / 100 < 0.3).alias("good")), _PAIRS + "SELECT utt, CASE WHEN n > 0 THEN dist * 1.0 / n ELSE 0.0 END < 0.3 AS good FROM d")
_add("jn3_ref_hyp", lambda t: K.last_per_key(t("transcripts"), ["utt"], [F.coalesce("text", F.lit(""))]), "SELECT utt, arg_max(text, coalesce(text, '')) AS text FROM transcripts WHERE text IS NOT NULL OR utt NOT IN (SELECT utt FROM transcripts WHERE text IS NOT NULL) GROUP BY utt")
_add("ag4_corpus_error", lambda t: A.corpus_error(_scored(t)).select(F.col("n"), (F.col("s") + F.col("d") + F.col("i")).alias("dist"), F.round("wer", 6).alias("wer")), _PAIRS + "SELECT sum(n) AS n, sum(dist) AS dist, round(sum(dist) * 100.0 / sum(n), 6) AS wer FROM d")
_add("ag5_token_errors", lambda t: A.token_errors(_scored(t)))
_add("ag6_cluster_errors", lambda t: A.cluster_errors(_scored(t)))
_add("ag7_keyword_errors", lambda t: A.keyword_errors(_scored(t), t("hotwords").select((F.col("list_id") % 5).alias("cluster"), F.trim("hotword").alias("token")).where("token <> ''")))
_add("ed5_totals_by_token", lambda t: A.token_errors(_scored(t)).select("token", "n").where("n > 0"), _PAIRS + "SELECT token, count(*) AS n FROM (SELECT unnest(lab) AS token FROM w) GROUP BY token")


def _tokens_of_pairs(t) -> DataFrame:
    ref, hyp = _ref_hyp(t)
    pairs = ref.withColumnRenamed("text", "a").join(hyp.withColumnRenamed("text", "b"), "utt")
    norm = lambda c: T.normal_tokens(T.tokens(F.col(c)), ("uh", "um"), True)
    return pairs.select("utt", norm("a").alias("lab"), norm("b").alias("rec"))


def _declared(t) -> DataFrame:
    short = _tokens_of_pairs(t).where((F.size("lab") <= 12) & (F.size("rec") <= 12) & (F.size("lab") > 0))
    return _declared_counters(short)


def _declared_all(t) -> DataFrame:
    """ed5_declared over every pair, the long and the empty too."""
    return _declared_counters(spread(_tokens_of_pairs(t)))


def _declared_counters(pairs: DataFrame) -> DataFrame:
    return pairs.select("utt", A.align_declared(F.col("lab"), F.col("rec")).alias("x")).select("utt", "x.dist", (F.col("x.d") - F.col("x.i")).alias("surplus"))


def _distances(t) -> DataFrame:
    return _tokens_of_pairs(t).select("utt", A.distance(F.col("lab"), F.col("rec")).alias("dist"))
