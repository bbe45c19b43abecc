"""Queries of vocabularies, n-grams, lexicons and graphs, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.functions import decode
from voxmill.operators import hotwords as H
from voxmill.operators import lexicon as L
from voxmill.plans.registry import Registry

_R = Registry()
queries, oracle_sql = _R.queries, _R.oracle_sql
_add = _R.add
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = f"string_split_regex(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '\\s+')"


def _lexicon(t):
    """Each distinct hotword in lower case with its characters as pronunciation, and a second, shorter one for some."""
    words = t("hotwords").select(F.lower(F.trim("hotword")).alias("word")).where("word <> ''").distinct()
    spelt = words.select("word", F.array_join(F.filter(F.split(F.replace("word", F.lit(" ")), ""), lambda c: c != ""), " ").alias("pron"))
    short = spelt.where("char_length(word) > 4").select("word", F.substring("pron", 1, 5).alias("pron"))
    both = spelt.unionByName(short)
    from voxmill.operators.keyed import row_numbers

    return row_numbers(both, [F.col("word"), F.col("pron")], "line_no")


_LEX = """
WITH w AS (SELECT DISTINCT lower(trim(hotword, ' ')) AS word FROM hotwords WHERE trim(hotword, ' ') <> ''),
s AS (SELECT word, array_to_string(regexp_extract_all(replace(word, ' ', ''), '.'), ' ') AS pron FROM w),
lex AS (SELECT word, pron, row_number() OVER (ORDER BY word, pron) - 1 AS line_no FROM (SELECT * FROM s UNION ALL SELECT word, substr(pron, 1, 5) FROM s WHERE length(word) > 4))
"""


def _known(t):
    return t("transcripts").select(F.explode(L.words_of(F.col("text"))).alias("word")).distinct()


_add("ag9_char_vocabulary", lambda t: L.char_vocabulary(t("documents")), r"SELECT ch, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '([^A-Za-z\p{Nd} <>''])', 1)) AS ch FROM documents) GROUP BY ch")
_add("ag10_word_vocabulary", lambda t: L.word_vocabulary(t("transcripts")), f"SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM transcripts UNION ALL SELECT * FROM (VALUES ('<unk>'), ('<s>'), ('</s>')) v(word)) WHERE word <> '' GROUP BY word")
_GRAMS = r"""
WITH l AS (SELECT list_concat(['<s>'], list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''), ['</s>']) AS w FROM transcripts WHERE len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) > 0),
g AS (SELECT ord, unnest(list_transform(generate_series(1, len(w) - ord + 1), lambda i: array_to_string(w[i:i + ord - 1], ' '))) AS ngram FROM l, (VALUES (1), (2), (3)) o(ord) WHERE len(w) >= ord),
c AS (SELECT ord, ngram, count(*) AS n FROM g GROUP BY ALL)
"""
_add("ag11_ngram_counts", lambda t: L.ngram_counts(t("transcripts")), _GRAMS + "SELECT * FROM c")
_add(
    "ag12_kneser_ney", lambda t: L.kneser_ney_bigrams(L.ngram_counts(t("transcripts"), (2,))).select("ngram", F.round("logprob", 6).alias("logprob")),
    _GRAMS + ", b AS (SELECT string_split(ngram, ' ')[1] AS h, string_split(ngram, ' ')[2] AS w, n FROM c WHERE ord = 2), h AS (SELECT h, sum(n) AS total, count(*) AS kinds FROM b GROUP BY h), k AS (SELECT w, count(*) AS before, sum(count(*)) OVER () AS pairs FROM b GROUP BY w) SELECT h || ' ' || w AS ngram, round(log10(greatest(n - 0.75, 0) / total + 0.75 * kinds / total * before / pairs), 6) AS logprob FROM b JOIN h USING (h) JOIN k USING (w)",
)
_add("ag12_perplexity", lambda t: L.perplexity(L.kneser_ney_bigrams(L.ngram_counts(t("transcripts"), (2,)))).select("n", F.round("perplexity", 4).alias("perplexity")))
_add("src16_drop_bad_grams", lambda t: L.drop_bad_grams(L.ngram_counts(t("transcripts")).select(F.col("ngram").alias("value"))), _GRAMS + "SELECT ngram AS value FROM c WHERE NOT regexp_matches(ngram, '(?i)<s> <s>|</s> <s>|</s> </s>|<unk>')")
_add("wn5_dense_ids", lambda t: L.dense_ids(_known(t)), r"WITH w AS (SELECT DISTINCT unnest(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS word FROM transcripts) SELECT word, row_number() OVER (ORDER BY word) AS id FROM w UNION ALL SELECT '<eps>', 0 UNION ALL SELECT '#0', count(*) + 1 FROM w UNION ALL SELECT '<s>', count(*) + 2 FROM w UNION ALL SELECT '</s>', count(*) + 3 FROM w")
_add(
    "jn8_lexicon_fallback", lambda t: L.lexicon_with_fallback(_known(t), _lexicon(t), t("hotwords").select(F.explode(F.split(F.lower("hotword"), "")).alias("unit")).where("unit <> ''").distinct()),
    _LEX + r", kw AS (SELECT DISTINCT unnest(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS word FROM transcripts), u AS (SELECT DISTINCT unnest(regexp_extract_all(lower(hotword), '(?s).')) AS unit FROM hotwords), r AS (SELECT word, unnest(regexp_extract_all(word, '(?s).')) AS c, generate_subscripts(regexp_extract_all(word, '(?s).'), 1) AS k FROM kw WHERE word NOT IN (SELECT word FROM lex)) SELECT word, pron AS units FROM kw JOIN lex USING (word) UNION ALL SELECT word, string_agg(coalesce(u.unit, '<unk>'), ' ' ORDER BY k) FROM r LEFT JOIN u ON r.c = u.unit GROUP BY word",
)
_add(
    "jn10_wn6_ag13_disambiguated", lambda t: L.disambiguated(_lexicon(t)).select("word", "pron", "line_no", "mark"),
    _LEX + ", q AS (SELECT pron, count(*) AS times FROM lex GROUP BY pron), m AS (SELECT pron, times > 1 OR EXISTS (SELECT 1 FROM q o WHERE starts_with(o.pron, q.pron || ' ')) AS needs FROM q) SELECT word, pron, line_no, CASE WHEN needs THEN '#' || row_number() OVER (PARTITION BY pron ORDER BY line_no) ELSE '' END AS mark FROM lex JOIN m USING (pron)",
)
_add(
    "wn7_gen2_lexicon_arcs", lambda t: L.lexicon_arcs(_lexicon(t)),
    _LEX + ", z AS (SELECT *, string_split(pron, ' ') AS u FROM lex), f AS (SELECT *, 1 + coalesce(sum(len(u) - 1) OVER (ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM z), a AS (SELECT line_no, word, first, len(u) AS n, unnest(u) AS ilabel, generate_subscripts(u, 1) - 1 AS k FROM f) SELECT line_no, CAST(k AS INT) AS k, CAST(CASE WHEN k = 0 THEN 0 ELSE first + k - 1 END AS BIGINT) AS src, CAST(CASE WHEN k = n - 1 THEN 0 ELSE first + k END AS BIGINT) AS dst, ilabel, CASE WHEN k = 0 THEN word ELSE '<eps>' END AS olabel FROM a",
)


def _tokens(t):
    from voxmill.operators.keyed import row_numbers

    units = t("subject_area").select(F.col("subject").alias("token")).unionByName(t("pack_size").select(F.concat(F.lit("#"), "pack_name").alias("token")))
    return row_numbers(units, [F.col("token")], "k").select("token", (F.col("k") + 1).alias("id"))


_TOK = "WITH t AS (SELECT token, row_number() OVER (ORDER BY token) AS id FROM (SELECT subject AS token FROM subject_area UNION ALL SELECT '#' || pack_name FROM pack_size)) "
_BLANK = "SELECT 0 AS src, 0 AS dst, '<blank>' AS ilabel, '<eps>' AS olabel"
_add("gen3_ctc_arcs", lambda t: L.ctc_arcs(_tokens(t)), _TOK + _BLANK + " UNION ALL SELECT 0, 0, '<eps>', token FROM t WHERE token LIKE '#%' UNION ALL SELECT 0, id, token, token FROM t WHERE token NOT LIKE '#%' UNION ALL SELECT id, id, token, '<eps>' FROM t WHERE token NOT LIKE '#%' UNION ALL SELECT id, 0, '<eps>', '<eps>' FROM t WHERE token NOT LIKE '#%'")
_add("gen4_ctc_arcs_corrected", lambda t: L.ctc_arcs_corrected(_tokens(t)), _TOK + ", p AS (SELECT * FROM t WHERE token NOT LIKE '#%') " + _BLANK + " UNION ALL SELECT 0, 0, '<eps>', token FROM t WHERE token LIKE '#%' UNION ALL SELECT 0, id, token, token FROM p UNION ALL SELECT id, id, token, '<eps>' FROM p UNION ALL SELECT id, 0, '<blank>', '<eps>' FROM p UNION ALL SELECT a.id, b.id, b.token, b.token FROM p a JOIN p b ON a.id <> b.id")
_add("gen7_grammar_arcs", lambda t: L.grammar_arcs(L.ctc_arcs(_tokens(t)).unionByName(L.ctc_arcs(_tokens(t)).withColumn("olabel", F.lit("<s>")).withColumn("ilabel", F.lit("</s>")))), _TOK + ", a AS (" + _BLANK + " UNION ALL SELECT 0, 0, '<eps>', token FROM t WHERE token LIKE '#%' UNION ALL SELECT 0, id, token, token FROM t WHERE token NOT LIKE '#%' UNION ALL SELECT id, id, token, '<eps>' FROM t WHERE token NOT LIKE '#%' UNION ALL SELECT id, 0, '<eps>', '<eps>' FROM t WHERE token NOT LIKE '#%') SELECT src, dst, CASE WHEN ilabel = '<eps>' THEN '#0' ELSE ilabel END AS ilabel, olabel FROM a UNION ALL SELECT src, dst, '<eps>', '<eps>' FROM a")
_add("gen1_words", lambda t: t("transcripts").select("utt", F.posexplode(L.words_of(F.col("text"))).alias("place", "word")), r"SELECT utt, CAST(i - 1 AS INT) AS place, w AS word FROM (SELECT utt, unnest(x) AS w, generate_subscripts(x, 1) AS i FROM (SELECT utt, list_filter(string_split_regex(text, '\s+'), lambda y: y <> '') AS x FROM transcripts))")
_add("tk16_longest_match", lambda t: t("transcripts").where("text is not null").select("utt", H.units_of({w: i for i, w in enumerate(["▁the", "▁t", "he", "▁ta", "ble", "▁a", "能够", "能", "代替", "▁room", "是"])})(F.lower("text")).alias("u")).select("utt", F.array_join(F.transform("u.ids", lambda x: x.cast("string")), " ").alias("ids"), "u.known"))
_add("tk17_join_pieces", lambda t: t("hotwords").where("hotword is not null").select("list_id", "line_no", F.replace(_join_udf()(F.split(F.regexp_replace("hotword", "([a-z]{3})", "$1@@ "), " ")), F.lit(" ")).alias("letters")), "SELECT list_id, line_no, replace(hotword, ' ', '') AS letters FROM hotwords WHERE hotword IS NOT NULL")


def _join_udf():
    import pandas as pd

    return F.pandas_udf(lambda s: pd.Series([decode.join_pieces([p for p in x if p])[0] if x is not None else None for x in s]), "string")
