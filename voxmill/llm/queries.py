"""The package's queries over the data folder's tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm import language, mixing, packing, repetition, splitting, subjects, termfreq, visible
from voxmill.session import checkpoint_dir, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return visible.same_looking_pairs(table(spark, d, "documents"), "doc_id")


def p1_visible_form(spark: SparkSession, d: str) -> DataFrame:
    return visible.visible_form(table(spark, d, "documents"), "doc_id")


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    return visible.look_classes(table(spark, d, "documents"), "doc_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return termfreq.term_table(table(spark, d, "transcripts"), table(spark, d, "hotwords")).where("mark is not null").select("field", "term", "mark")


def p3_terms(spark: SparkSession, d: str) -> DataFrame:
    return termfreq.term_table(table(spark, d, "transcripts"), table(spark, d, "hotwords"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    split = splitting.long_messages(table(spark, d, "result_message"), table(spark, d, "session_config"))
    return split.select(F.col("item").alias("msg_id"), F.when(F.col("forced"), "forced").otherwise("pause").alias("cut"))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    split = splitting.long_messages(table(spark, d, "result_message"), table(spark, d, "session_config"))
    return splitting.pieces(split).withColumnRenamed("item", "msg_id")


def p4_faults(spark: SparkSession, d: str) -> DataFrame:
    """Each long message with its pieces' begin and end, and how many pieces break the limit, the overlap, or follow no other."""
    split = splitting.long_messages(table(spark, d, "result_message"), table(spark, d, "session_config"))
    return splitting.piece_faults(split).withColumnRenamed("item", "msg_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return language.wrong_labels(table(spark, d, "documents"))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    return language.language_segments(documents, *language.learn_languages(documents))


def p5_languages(spark: SparkSession, d: str) -> DataFrame:
    return language.document_languages(_segments(spark, d))


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.placed_segments(_segments(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition(table(spark, d, "documents"), 0.4).where("rule is null and share >= 0.4").select("doc_id")


def p6_shares(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition(table(spark, d, "documents")).select("doc_id", F.round("share", 9).alias("share"))


def _packs(spark: SparkSession, d: str) -> list[tuple[str, int]]:
    return [(r[0], r[1]) for r in table(spark, d, "pack_size").collect()]


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), _packs(spark, d))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p7_pack(spark, d), _packs(spark, d))


def p7_faults(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_faults(p7_pack(spark, d), _packs(spark, d)).select("pack_name", "items", "overfull", "torn", "uneven")


def _subject_model(spark: SparkSession, d: str) -> subjects.SubjectModel:
    return subjects.learn_subjects(table(spark, d, "documents"), table(spark, d, "subject_seed"), table(spark, d, "subject_area"), sections=["wav_name", "source"])


def _mix(spark: SparkSession, d: str) -> DataFrame:
    described = mixing.describe(table(spark, d, "documents"), _subject_model(spark, d))
    checkpoint_dir(spark)
    return mixing.mix(described.checkpoint(), table(spark, d, "mix_target"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares_reached(_mix(spark, d), table(spark, d, "mix_target"))


def p8_faults(spark: SparkSession, d: str) -> DataFrame:
    """Each target with whether its documents keep to its repeats, and the uses of documents of no target, which must be 0."""
    targets = table(spark, d, "mix_target")
    mixed = _mix(spark, d)
    used = mixed.where("uses > 0").groupBy("source").agg(F.max("uses").alias("most"))
    foreign = used.join(targets, "source", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return targets.join(used, "source", "left").select("source", (F.coalesce("most", F.lit(0)) <= F.col("max_repeat")).alias("within"), foreign.scalar().alias("foreign_sources"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.subjects_found(subjects.subject_shares(table(spark, d, "documents"), _subject_model(spark, d)))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_visible_form, p1_classes, p3_found, p3_terms, p4_found, p4_pieces, p4_faults, p5_found, p5_languages, p5_segments, p6_found, p6_shares, p7_pack, p7_fill, p7_faults, p8_mix, p8_shares, p8_faults, p9_found)}


_TERMS = """
WITH tokens AS (
  SELECT 'text' AS field, unnest(string_split(lower(text), ' ')) AS term, utt AS record FROM transcripts
  UNION ALL SELECT 'hotword', lower(trim(hotword, ' ')), CAST(list_id AS VARCHAR) FROM hotwords),
counts AS (SELECT field, term, count(*) AS occurrences, count(DISTINCT record) AS records FROM tokens WHERE term <> '' GROUP BY ALL),
totals AS (SELECT 'text' AS field, count(DISTINCT utt) AS total FROM transcripts UNION ALL SELECT 'hotword', count(DISTINCT list_id) FROM hotwords),
marked AS (SELECT field, term, occurrences, records, CASE WHEN records < 3 THEN 'rare' WHEN records > total * 0.1 THEN 'common' END AS mark FROM counts JOIN totals USING (field))
"""

_LONG = r"""
WITH readable AS (
  SELECT msg_id, conn_id, mode, CAST(timestamp AS BIGINT[][]) AS spans FROM result_message
  WHERE regexp_full_match(timestamp, '[ \t\r\n]*\[[ \t\r\n]*\[[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*,[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*\]([ \t\r\n]*,[ \t\r\n]*\[[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*,[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*\])*[ \t\r\n]*\][ \t\r\n]*')),
len AS (SELECT conn_id, arg_max(vad_max_len, (sent_at, cfg_id)) AS max_len FROM session_config WHERE vad_max_len > 0 GROUP BY conn_id),
look AS (SELECT conn_id, arg_max(chunk_size[1], (sent_at, cfg_id)) AS units FROM session_config WHERE chunk_size IS NOT NULL AND len(chunk_size) > 0 GROUP BY conn_id),
known AS (SELECT msg_id, spans, coalesce(max_len, CASE WHEN mode = 'offline' THEN 60000 ELSE 20000 END) AS lim, coalesce(units, 5) * 60 AS over
  FROM readable LEFT JOIN len USING (conn_id) LEFT JOIN look USING (conn_id)),
pairs AS (SELECT msg_id, lim, over, p[1] AS b, p[2] AS e FROM (SELECT msg_id, lim, over, unnest(spans) AS p FROM known)),
long AS (SELECT msg_id FROM pairs GROUP BY msg_id, lim HAVING max(e) - min(b) > lim),
gaps AS (SELECT *, CASE WHEN b - lag(e) OVER w >= 300 THEN 1 ELSE 0 END AS fresh FROM pairs SEMI JOIN long USING (msg_id) WINDOW w AS (PARTITION BY msg_id ORDER BY b, e)),
stretches AS (SELECT *, sum(fresh) OVER (PARTITION BY msg_id ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS s FROM gaps),
lasting AS (SELECT msg_id, max(e) - min(b) > any_value(lim - over) AS over_long FROM stretches GROUP BY msg_id, s)
SELECT msg_id, CASE WHEN bool_or(over_long) THEN 'forced' ELSE 'pause' END AS cut FROM lasting GROUP BY msg_id
"""


# Fixed values, apart from the operator's own tables: what looks like what among the characters of transcripts.
_GREEK, _AS_GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧορνϳ", "ABEZHIKMNOPTYXopvj"
_CYRILLIC, _AS_CYRILLIC = "АВЕКМНОРСТХҮІЅЈаеорсухіѕјһԁԛԝү", "ABEKMHOPCTXYISJaeopcyxisjhdqwy"
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_BLANKS = "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
_RADICALS = "".join(map(chr, range(0x2F00, 0x2FD6)))


def _visible_sql() -> str:
    """A text's visible form, for the characters that transcripts hold; DuckDB has canonical normalisation only."""
    was = _GREEK + _CYRILLIC + "ɡ" + _WIDE + _BLANKS + _RADICALS
    now = _AS_GREEK + _AS_CYRILLIC + "g" + "".join(chr(ord(c) - 0xFEE0) for c in _WIDE) + " " * len(_BLANKS) + unicodedata.normalize("NFKC", _RADICALS)
    text = "regexp_replace(text, '[\u00ad\u200b-\u200f\u2060-\u2064\ufeff]', '', 'g')"
    for a, b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("…", "...")):
        text = f"replace({text}, '{a}', '{b}')"
    q = lambda x: x.replace("'", "''")
    return f"nfc_normalize(translate({text}, '{q(was)}', '{q(now)}'))"


def _shares_sql() -> str:
    """p6's share by its definition: runs of the shortest sufficient weight, marked where the same run began earlier."""
    text = rf"regexp_replace(regexp_replace({_visible_sql()}, '(?i)\bspk[0-9]+\b[ \t]*:?', chr(10), 'g'), '<[A-Za-z]+>|\[[A-Za-z]+\]', ' ', 'g')"
    return rf"""
WITH c AS (SELECT doc_id, regexp_replace(replace(lower({text}), '’', chr(39)), '([㐀-鿿])', ' \1 ', 'g') AS t FROM documents),
u AS (SELECT doc_id, regexp_extract_all(t, '[㐀-鿿]|[\p{{L}}\p{{N}}]+(?:[''-][\p{{L}}\p{{N}}]+)*') AS units FROM c),
p AS (SELECT doc_id, unnest(units) AS x, generate_subscripts(units, 1) AS i FROM u),
w AS (SELECT *, CASE WHEN x BETWEEN '㐀' AND '鿿' THEN 1 ELSE 2 END AS w FROM p),
s AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM w),
r AS (SELECT a.doc_id, a.i, min(b.i) AS j FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 9 AND b.upto - a.upto + a.w >= 10 GROUP BY ALL),
k AS (SELECT r.doc_id, i, j, row_number() OVER (PARTITION BY r.doc_id, array_to_string(units[i:j], ' ') ORDER BY i) > 1 AS again FROM r JOIN u USING (doc_id)),
m AS (SELECT DISTINCT doc_id, unnest(generate_series(i, j)) AS i, 1 AS hit FROM k WHERE again),
f AS (SELECT doc_id, sum(w.w) AS total, sum(CASE WHEN hit = 1 THEN w.w ELSE 0 END) AS covered FROM w LEFT JOIN m USING (doc_id, i) GROUP BY doc_id),
shares AS (SELECT doc_id, coalesce(covered / total, 0.0) AS share FROM documents LEFT JOIN f USING (doc_id))
"""


def oracle_sql() -> dict[str, str]:
    seen = f"WITH v AS (SELECT doc_id, text, {_visible_sql()} AS visible FROM documents) "
    return {
        "p1_visible_form": seen + "SELECT doc_id, visible FROM v",
        "p1_found": seen + "SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM v a JOIN v b ON a.visible = b.visible AND a.doc_id < b.doc_id AND a.text <> b.text",
        "p1_classes": seen + "SELECT v.doc_id, c.class_id, c.kinds, c.n - t.n AS links FROM v JOIN (SELECT visible, min(doc_id) AS class_id, count(DISTINCT text) AS kinds, count(*) AS n FROM v GROUP BY visible HAVING count(DISTINCT text) > 1) c USING (visible) JOIN (SELECT text, count(*) AS n FROM v GROUP BY text) t ON t.text = v.text",
        "p3_found": _TERMS + "SELECT field, term, mark FROM marked WHERE mark IS NOT NULL",
        "p3_terms": _TERMS + "SELECT field, term, occurrences, records, mark FROM marked",
        "p4_found": _LONG,
        "p4_faults": _LONG.replace("SELECT msg_id, CASE WHEN bool_or(over_long) THEN 'forced' ELSE 'pause' END AS cut FROM lasting GROUP BY msg_id", "SELECT msg_id, min(b) AS begin_ms, max(e) AS end_ms, 0 AS too_long, 0 AS wrong_overlap, 0 AS gaps FROM pairs SEMI JOIN long USING (msg_id) GROUP BY msg_id"),
        "p6_shares": _shares_sql() + "SELECT doc_id, round(share, 9) AS share FROM shares",
        "p6_found": _shares_sql() + "SELECT doc_id FROM shares WHERE share >= 0.4",
        "p7_faults": "SELECT pack_name, (SELECT count(*) FROM documents) AS items, 0 AS overfull, 0 AS torn, 0 AS uneven FROM pack_size",
        "p8_faults": "SELECT source, true AS within, 0 AS foreign_sources FROM mix_target",
    }
