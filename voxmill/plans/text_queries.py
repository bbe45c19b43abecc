"""Queries of the text functions, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxmill.functions import text as T
from voxmill.plans.registry import Registry

_R = Registry()
queries, oracle_sql = _R.queries, _R.oracle_sql


def _sql(s: str) -> str:
    return s.replace("'", "''")


def _joined(a: Column) -> Column:
    return F.array_join(a, "|")


def _first(t: Column) -> Column:
    return F.element_at(F.split(F.trim(t), " "), 1)


def _words(t: Column) -> Column:
    return F.split(t, " ")


def _over(name: str, source: str, key: str, columns: Callable[[Column], dict[str, Column]], sql: str | None) -> None:
    """A query of named columns beside a table's key; ``sql`` is a select list, with FROM only if it is not the table itself."""
    def build(t):
        return t(source).select(key, *[c.alias(n) for n, c in columns(F.col("text")).items()])

    _R.add(name, build, None if sql is None else f"SELECT {key}, {sql}" + ("" if " FROM (" in sql else f" FROM {source}"))


_A, _B = _sql(T.TOKEN_A), _sql(T.TOKEN_B)
_TRIM = r"regexp_replace(regexp_replace({}, ' +', ' ', 'g'), '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"


doc, utt = "documents", "transcripts"
_over("ed1_tokens", doc, "doc_id", lambda t: {"toks": _joined(T.tokens(t))}, f"array_to_string(regexp_extract_all(text, '{_A}', 1), '|') AS toks")
_over("ed2_tokens", doc, "doc_id", lambda t: {"toks": _joined(T.tokens(t, "B"))}, f"array_to_string(regexp_extract_all(text, '{_B}', 1), '|') AS toks")
_over("ed3_strip_tags", doc, "doc_id", lambda t: {"bare": T.strip_tags(t)}, "regexp_replace(text, '<[^>]*(>|$)', '', 'g') AS bare")
_over(
    "ed4_normal_tokens", utt, "utt", lambda t: {"toks": _joined(T.normal_tokens(T.tokens(t), ("the", "la", "die"), True, {"don't": ["do", "not"], "is": ["be", "s"]}))},
    f"array_to_string(flatten(list_transform(list_filter(list_transform(list_filter(regexp_extract_all(text, '{_A}', 1), lambda x: x NOT IN ('the', 'la', 'die')), lambda x: regexp_replace(x, '<[^>]*(>|$)', '', 'g')), lambda x: x <> ''), lambda x: CASE x WHEN 'don''t' THEN ['do', 'not'] WHEN 'is' THEN ['be', 's'] ELSE [x] END)), '|') AS toks",
)
_over("tk3_mandarin_only", doc, "doc_id", lambda t: {"zh": T.mandarin_only(t)}, r"regexp_replace(text, '[A-Za-z\p{Nd} <>'']+', '', 'g') AS zh")
_over("tk4_non_mandarin", doc, "doc_id", lambda t: {"words": T.non_mandarin_words(t)}, r"array_to_string(list_filter(string_split(text, ' '), lambda w: NOT regexp_matches(w, '[^A-Za-z\p{Nd} <>'']')), ' ') AS words")
pair = r"'([A-Za-z]) ([A-Za-z])', '\1' || chr(1) || '\2', 'g'"
collapsed = _TRIM.format(r"regexp_replace(text, '\s+', ' ', 'g')")
_over("tk5_join_mandarin", doc, "doc_id", lambda t: {"joined": T.join_mandarin(t)}, f"replace(replace(regexp_replace(regexp_replace({collapsed}, {pair}), {pair}), ' ', ''), chr(1), ' ') AS joined")
_over("tk6_space_mandarin", doc, "doc_id", lambda t: {"spaced": T.space_mandarin(t)}, _TRIM.format(r"regexp_replace(text, '([^A-Za-z\p{Nd} <>''])', ' \1 ', 'g')") + " AS spaced")
_over("tk7_split_script", doc, "doc_id", lambda t: {"toks": _joined(T.split_script(t))}, "array_to_string(regexp_extract_all(text, '([㐀-鿿]|[^㐀-鿿 ]+)', 1), '|') AS toks")
_over("tk8_collapse", utt, "utt", lambda t: {"one": T.collapse_blanks(t)}, _TRIM.format("text") + " AS one")
single = _sql(T._SINGLE)
_over("tk9_split_timed", doc, "doc_id", lambda t: {"toks": _joined(T.split_timed(t))}, f"array_to_string(regexp_extract_all(text, '([㐀-鿿]|[{single}]|[^㐀-鿿 {single}]+)', 1), '|') AS toks")
_over("tk10_ideographs", doc, "doc_id", lambda t: {"toks": _joined(T.ideographs(t)), "n": F.size(T.ideographs(t))}, "array_to_string(regexp_extract_all(text, '([㐀-鿿])', 1), '|') AS toks, len(regexp_extract_all(text, '([㐀-鿿])', 1)) AS n")
_over("tk11_lengths", doc, "doc_id", lambda t: {"chars": F.size(T.characters(t)), "bytes": T.byte_length(t), "n": F.char_length(t)}, "length(text) AS chars, strlen(text) AS bytes, length(text) AS n")
_over("tk12_utf16", doc, "doc_id", lambda t: {"back": T.from_utf16(T.to_utf16(t))}, "text AS back")
_over(
    "tk13_predicates", utt, "utt", lambda t: {"zh": T.is_all_chinese(_first(t)), "alpha": T.has_alpha(_first(t)), "all_alpha": T.is_all_alpha(_first(t)), "punct": T.is_alpha_or_punct(_first(t)), "digit": T.is_alpha_or_digit(_first(t)), "blank": T.is_alpha_digit_blank(t), "tail": T.needs_tail_blank(_first(t))},
    "regexp_matches(w, '^[一-鿿]+$') AS zh, regexp_matches(w, '[A-Za-z]') AS alpha, regexp_matches(w, '^[A-Za-z]+$') AS all_alpha, regexp_matches(w, '^[A-Za-z!-/:-@\\[-`{-~]+$') AS punct, regexp_matches(w, '^[A-Za-z0-9]+$') AS digit, regexp_matches(text, '^[A-Za-z0-9 ]+$') AS blank, regexp_matches(w, '[A-Za-z0-9]$') AS tail FROM (SELECT utt, text, string_split(trim(text, ' '), ' ')[1] AS w FROM transcripts)",
)
_over(
    "tk14_merge_words", utt, "utt", lambda t: {"merged": F.array_join(T.merge_words(_words(t), F.transform(_words(t), lambda x: F.when(F.char_length(x) == 1, 1).otherwise(0))), "|")},
    "substr(array_to_string(list_transform(string_split(text, ' '), lambda x, i: CASE WHEN length(x) = 1 AND i > 1 THEN x ELSE '|' || x END), ''), 2) AS merged",
)
_over("tk15_punct_tokens", utt, "utt", lambda t: {"toks": _joined(T.punct_model_tokens(F.translate(t, "İ", "i")))}, r"array_to_string(regexp_extract_all(lower(translate(text, 'İ', 'i')), '([!-\x7F]+|[^\x00-\x7F])', 1), '|') AS toks")
_R.add(
    "tk19_script_class",
    lambda t: t(doc).select(F.explode(T.tokens(F.col("text"))).alias("token")).select(T.script_class(F.col("token")).alias("cluster")).groupBy("cluster").agg(F.count(F.lit(1)).alias("n")),
    f"""SELECT cluster, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(b, '^[0-9]+$') THEN 'Number' WHEN regexp_matches(b, '^[㐀-䶿一-鿿豈-﫿]+$') THEN 'Mandarin'
    WHEN regexp_matches(b, '^[A-Za-zÀ-ÖØ-öø-ʯ]+$') THEN 'English' WHEN regexp_matches(b, '^[ぁ-ゖ]+$') THEN 'Japanese' ELSE 'Other' END AS cluster
    FROM (SELECT regexp_replace(unnest(regexp_extract_all(text, '{_A}', 1)), '[&''@℃=.\\-_#+;]', '', 'g') AS b FROM documents)) GROUP BY ALL""",
)
_over("tk20_zh_or_en", utt, "utt", lambda t: {"lang": T.zh_or_en(t)}, "CASE WHEN text = '' THEN 'zh' WHEN regexp_matches(text, '[一-鿿]') THEN 'zh' WHEN text IS NOT NULL THEN 'en' END AS lang")
_over("tk21_oov", utt, "utt", lambda t: {"units": _joined(F.flatten(F.transform(_words(t), T.oov_characters)))}, "array_to_string(flatten(list_transform(string_split(text, ' '), lambda w: CASE WHEN regexp_matches(w, '[一-鿿]') THEN regexp_extract_all(w, '.') ELSE [w] END)), '|') AS units")
_over("tk22_english_string", doc, "doc_id", lambda t: {"english": T.is_english_string(t)}, r"regexp_matches(text, '^[\p{L}!-/:-@\[-`{-~\s]*$') AS english")
_over(
    "tk23_language_code", "session_config", "cfg_id", lambda t: {"code": T.language_code(F.col("svs_lang")), "itn_code": T.itn_code(F.col("svs_itn"))},
    "CASE svs_lang WHEN 'auto' THEN 0 WHEN 'zh' THEN 3 WHEN 'en' THEN 4 WHEN 'yue' THEN 7 WHEN 'ja' THEN 11 WHEN 'ko' THEN 12 WHEN 'nospeech' THEN 13 ELSE 0 END AS code, CASE WHEN svs_itn THEN 14 ELSE 15 END AS itn_code",
)
_over("tk24_trailer", "session_config", "cfg_id", lambda t: {"name": F.concat(T.tag_trailer(F.coalesce("wav_name", F.lit("")), F.coalesce("svs_lang", F.lit("")), F.coalesce("itn", F.lit(False))), F.lit("."))}, "coalesce(wav_name, '') || CASE WHEN NOT coalesce(itn, false) OR coalesce(svs_lang, '') = 'en' THEN ' ' ELSE '' END || '.' AS name")
marks = T.ZH_PUNCT + T.ASCII_PUNCT
_over("tn1_blank_punct", doc, "doc_id", lambda t: {"plain": T.blank_punctuation(t)}, f"translate(text, '{_sql(marks)}', repeat(' ', {len(marks)})) AS plain")
_over("tn2_case", utt, "utt", lambda t: {"low": T.fold_case(F.translate(t, "ßİ", "si"), to_lower=True), "up": T.fold_case(F.translate(t, "ßİ", "si"), to_upper=True)}, "lower(translate(text, 'ßİ', 'si')) AS low, upper(translate(text, 'ßİ', 'si')) AS up")
_over("tn3_fillers", doc, "doc_id", lambda t: {"plain": T.remove_fillers(t)}, "regexp_replace(text, '[呃啊]', '', 'g') AS plain")
_over("tn4_erhua", doc, "doc_id", lambda t: {"plain": T.remove_erhua(F.concat(t, F.lit("女儿花儿儿童")))}, f"regexp_replace(text || '女儿花儿儿童', '({'|'.join(T.ER_WORDS)})|儿', '\\1', 'g') AS plain")
_over("tn6_symbols", doc, "doc_id", lambda t: {"plain": T.remove_symbols(F.translate(t, "İ", "i"))}, f"regexp_replace(regexp_replace(lower(translate(text, 'İ', 'i')), '[{_sql(T.in_class(T.SYMBOLS))}]', '', 'g'), '<[a-zA-Z]+>', '', 'g') AS plain")
_over("tn7_dialog", utt, "utt", lambda t: {"plain": T.normalize_dialog(t)}, None)
_over("tn10_latin_punct", doc, "doc_id", lambda t: {"plain": T.latin_punctuation(t)}, "translate(text, '，。、？', ',.,?') AS plain")
_over(
    "tn13_safe_name", "result_message", "msg_id", lambda t: {"safe": T.safe_name(F.replace(F.col("wav_name"), F.lit("_"), F.lit(" ")))},
    r"""CASE WHEN contains(p, ' ') THEN replace(regexp_extract(p, '^(.*/)?[^/]*$', 1), ' ', '-') || substr(translate(regexp_extract(regexp_extract(p, '([^/]*)$', 1), '^(.+?)(\.[^.]*)?$', 1), ' .', '--'), 1, 15) || replace(regexp_extract(p, '(\.[^./]*)$', 1), ' ', '-') ELSE p END AS safe FROM (SELECT msg_id, replace(wav_name, '_', ' ') AS p FROM result_message)""",
)
_over(
    "tn14_split", utt, "utt", lambda t: {"all_n": F.size(T.split_fields(t)), "full_n": F.size(T.split_fields(t, keep_empty=False)), "tail_n": F.size(T.split_fields(t, keep_tail=False))},
    "len(string_split(text, ' ')) AS all_n, len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS full_n, len(string_split(rtrim(text, ' '), ' ')) AS tail_n",
)
_over(
    "tn9_reorder", "orders", "o_orderkey",
    lambda t: {"written": T.reorder_tagged(F.concat(F.lit('date { day: "'), F.dayofmonth("o_orderdate"), F.lit('" year: "'), F.year("o_orderdate"), F.lit('" month: "'), F.month("o_orderdate"), F.lit('" }'))),
     "spoken": T.reorder_tagged(F.concat(F.lit('money { currency: "EUR" value: "'), F.col("o_orderkey").cast("string"), F.lit('" }')), written=False)},
    """'date { year: "' || year(o_orderdate) || '" month: "' || month(o_orderdate) || '" day: "' || day(o_orderdate) || '" }' AS written, 'money { value: "' || o_orderkey || '" currency: "EUR" }' AS spoken""",
)



_R.add(
    "tk1_tk2_characters",
    lambda t: t("transcripts").select(F.explode(T.characters(F.col("text"))).alias("ch")).groupBy("ch").agg(F.count(F.lit(1)).alias("n")).select("ch", "n", T.is_english_char(F.col("ch")).alias("english"), F.col("ch").rlike(T.NON_LATIN).alias("mandarin")),
    r"SELECT ch, count(*) AS n, regexp_matches(ch, '^[A-Za-z]$') AS english, regexp_matches(ch, '[^A-Za-z\p{Nd} <>'']') AS mandarin FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM transcripts) GROUP BY ch",
)
