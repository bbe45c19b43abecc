"""Queries of keyed joins, sets, splits, filters and sorts, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.operators import keyed as K
from voxmill.operators import segments as S
from voxmill.plans.registry import Registry

_R = Registry()
queries, oracle_sql = _R.queries, _R.oracle_sql
_add = _R.add

_add("jn1_filter_by_keys", lambda t: K.filter_by_keys(t("transcripts"), t("wav2dur").where("dur > 5"), "utt"), "SELECT * FROM transcripts WHERE utt IN (SELECT utt FROM wav2dur WHERE dur > 5)")
_add("jn2_exclude_keys", lambda t: K.filter_by_keys(t("transcripts"), t("wav2dur").where("dur > 5"), "utt", exclude=True), "SELECT * FROM transcripts WHERE utt NOT IN (SELECT utt FROM wav2dur WHERE dur > 5)")
_add("jn4_existing_files", lambda t: t("utt2spk").join(t("wav2dur"), "utt"), "SELECT * FROM utt2spk JOIN wav2dur USING (utt)")
_add(
    "jn5_lookup_strict",
    lambda t: K.lookup_strict(K.filter_by_keys(t("wav2dur"), t("utt2spk"), "utt"), t("utt2spk").where("spk is not null").groupBy("utt").agg(F.min("spk").alias("spk")).unionByName(t("utt2spk").groupBy("utt").agg(F.max("spk").alias("spk")).where("spk is null").withColumn("spk", F.lit("unknown"))), "utt", "spk"),
    "SELECT utt, dur, coalesce(s.spk, 'unknown') AS spk FROM wav2dur JOIN (SELECT utt, min(spk) AS spk FROM utt2spk GROUP BY utt) s USING (utt)",
)
_add("jn7_semi_on_prefix", lambda t: K.semi_on_prefix(t("transcripts"), t("utt2spk").where("spk like '%SPEAKER_01'").select(F.substring_index("utt", "-", 1).alias("rec")), "utt", "rec"), "SELECT * FROM transcripts WHERE string_split(utt, '-')[1] IN (SELECT string_split(utt, '-')[1] FROM utt2spk WHERE spk LIKE '%SPEAKER\\_01' ESCAPE '\\')")
_add("jn11_lookup_default", lambda t: K.lookup_with_default(t("subject_seed").withColumnRenamed("subject", "code"), t("subject_area").where("subject <> 'law'").select(F.col("subject").alias("code"), "title"), "code", "title", "?"), "SELECT s.doc_id, s.subject AS code, coalesce(a.title, '?') AS title FROM subject_seed s LEFT JOIN (SELECT * FROM subject_area WHERE subject <> 'law') a USING (subject)")
_HOT = "SELECT lower(trim(hotword, ' ')) AS word, max(weight) AS weight FROM hotwords WHERE list_id % 2 = {} AND trim(hotword, ' ') <> '' GROUP BY 1"


def _hot(t, odd: int):
    return t("hotwords").where(F.col("list_id") % 2 == odd).select(F.lower(F.trim("hotword")).alias("word"), "weight").where("word <> ''").groupBy("word").agg(F.max("weight").alias("weight"))


_add("jn12_merge_hotwords", lambda t: K.merge_hotwords(_hot(t, 0), _hot(t, 1)), f"SELECT word, coalesce(c.weight, s.weight) AS weight FROM ({_HOT.format(0)}) c FULL JOIN ({_HOT.format(1)}) s USING (word)")
_add("set1_union_all", lambda t: K.union_all(t("utt2spk").select("utt"), t("wav2dur").select("utt")), "SELECT utt FROM utt2spk UNION ALL SELECT utt FROM wav2dur")
_add("set2_key_intersect", lambda t: K.intersect_on_key(t("wav2dur").where("dur >= 0.5"), t("utt2spk").where("spk is not null"), "utt"), "SELECT * FROM utt2spk WHERE spk IS NOT NULL AND utt IN (SELECT utt FROM wav2dur WHERE dur >= 0.5)")
_add("set3_distinct_first", lambda t: K.first_per_key(t("wav_scp_raw").where("audio_in is not null"), ["audio_in"], [F.col("line_id")]), "SELECT * FROM wav_scp_raw WHERE audio_in IS NOT NULL QUALIFY row_number() OVER (PARTITION BY audio_in ORDER BY line_id) = 1")
_add("set4_except", lambda t: K.filter_by_keys(t("utt2spk").select("utt"), t("wav2dur"), "utt", exclude=True), "SELECT utt FROM utt2spk WHERE utt NOT IN (SELECT utt FROM wav2dur)")
_add("set5_with_specials", lambda t: K.with_specials(t("subject_area"), "subject", ["<unk>", "<s>", "</s>"]), "SELECT subject FROM subject_area UNION ALL SELECT * FROM (VALUES ('<unk>'), ('<s>'), ('</s>')) v(subject)")
_add("flt1_duration_band", lambda t: K.duration_band(t("wav2dur")), "SELECT * FROM wav2dur WHERE dur BETWEEN 0.5 AND 40")
_add("flt5_language_list", lambda t: t("documents").where(F.col("lang").isin("zh", "en")).select("doc_id", "lang"), "SELECT doc_id, lang FROM documents WHERE lang IN ('zh', 'en')")
_add("flt6_not_done", lambda t: K.filter_by_keys(t("wav2dur"), t("transcripts").where("text <> ''"), "utt", exclude=True), "SELECT * FROM wav2dur WHERE utt NOT IN (SELECT utt FROM transcripts WHERE text <> '')")
_add("flt8_mean_of_known", lambda t: K.mean_of_known(t("wav2dur").where("dur is not null").withColumn("dur", F.when(F.col("dur") > 60, F.lit(float("nan"))).otherwise(F.greatest("dur", F.lit(0.0)))), "dur").select("n", F.round("mean", 6).alias("mean")), "SELECT count(*) AS n, round(avg(greatest(dur, 0.0)), 6) AS mean FROM wav2dur WHERE dur IS NOT NULL AND dur <= 60")
_add("ag1_spk2utt", lambda t: K.group_to_list(t("utt2spk").join(K.first_per_key(t("wav_scp_raw").select(F.substring_index("audio_in", "\t", 1).alias("utt"), "line_id"), ["utt"], [F.col("line_id")]), "utt"), "spk", "utt", "line_id").select("spk", "members", "first_line"), "SELECT spk, string_agg(utt, ' ' ORDER BY line_id, utt) AS members, min(line_id) AS first_line FROM utt2spk JOIN (SELECT string_split(audio_in, chr(9))[1] AS utt, min(line_id) AS line_id FROM wav_scp_raw GROUP BY 1) USING (utt) WHERE spk IS NOT NULL GROUP BY spk")
_add("ag2_ag3_hours", lambda t: K.hours(t("wav2dur")).withColumn("hours", F.round("hours", 6)), "SELECT count(*) AS utterances, sum(CASE WHEN dur > 0 THEN 1 ELSE 0 END) AS measured, round(sum(CASE WHEN dur > 0 THEN dur END) / 3600, 6) AS hours FROM wav2dur")
_add(
    "ag8_speakers_by_split",
    lambda t: K.speakers_by_split(t("utt2spk").join(t("wav2dur"), "utt").withColumn("split", F.when(F.col("utt").rlike("7-SPEAKER"), "valid").otherwise("train")), ["train", "valid", "test"]).withColumn("hours", F.round("hours", 6)),
    "SELECT split, coalesce(speakers, 0) AS speakers, coalesce(hours, 0.0) AS hours FROM (VALUES ('train'), ('valid'), ('test')) v(split) LEFT JOIN (SELECT CASE WHEN regexp_matches(utt, '7-SPEAKER') THEN 'valid' ELSE 'train' END AS split, count(DISTINCT spk) AS speakers, round(sum(dur) / 3600, 6) AS hours FROM utt2spk JOIN wav2dur USING (utt) GROUP BY 1) USING (split)",
)
_add("ag14_rtf", lambda t: S.rtf(t("events").select((F.col("user_id") % 8).alias("thread"), (F.col("value") / 100).alias("compute_s"), F.col("value").alias("audio_s"))).select(*[F.round(c, 6).alias(c) for c in ("length", "total_time", "rtf", "speedup")]), "SELECT round(sum(a), 6) AS length, round(max(t), 6) AS total_time, round(max(t) / sum(a), 6) AS rtf, round(sum(a) / max(t), 6) AS speedup FROM (SELECT user_id % 8 AS k, sum(value / 100) AS t, sum(value) AS a FROM events GROUP BY 1)")
_add("ag17_joined_text", lambda t: S.joined_text(t("result_message").where("mode = 'offline'"), ["conn_id"], F.struct("seq_no", "msg_id"), blank=True), "SELECT conn_id, string_agg(text, ' ' ORDER BY seq_no, msg_id) AS text FROM result_message WHERE mode = 'offline' AND text IS NOT NULL GROUP BY conn_id")
_add("ag18_validation_split", lambda t: K.validation_split(t("utt2spk"), "utt", 0.05))
_add("wn1_equal_split", lambda t: K.equal_split(t("orders").select("o_orderkey"), 7, [F.col("o_orderkey")]), "SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderkey) AS part FROM orders")
_add("wn1_equal_split_wide", lambda t: K.equal_split(t("lineitem"), 7, [F.col(c) for c in t("lineitem").columns]), "SELECT *, ntile(7) OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS part FROM lineitem")
_add("wn2_split_part", lambda t: K.equal_split(t("wav_scp_raw").select("line_id"), 5, [F.col("line_id")]).where("part = 3").select("line_id"), "SELECT line_id FROM (SELECT line_id, ntile(5) OVER (ORDER BY line_id) AS part FROM wav_scp_raw) WHERE part = 3")
_add("wn3_speaker_split", lambda t: K.speaker_split(t("utt2spk").where("spk is not null").withColumn("line_no", F.col("utt")), 4).groupBy("part").agg(F.count(F.lit(1)).alias("utts"), F.countDistinct("spk").alias("speakers")))
_add("wn4_segment_numbers", lambda t: S.numbered_segments(t("result_message").where("mode = 'offline'").select("msg_id", "conn_id", "wav_name", "seq_no"), ["conn_id", "wav_name"], [F.col("seq_no"), F.col("msg_id")]), "SELECT msg_id, conn_id, wav_name, seq_no, row_number() OVER (PARTITION BY conn_id, wav_name ORDER BY seq_no NULLS FIRST, msg_id) - 1 AS segment_idx FROM result_message WHERE mode = 'offline'")
_add("wn8_top_n", lambda t: S.top_n_by(t("wav2dur").join(t("utt2spk"), "utt").where("spk is not null and dur is not null").distinct(), ["spk"], [F.desc("dur"), F.col("utt")], 3), "SELECT utt, dur, spk, rank FROM (SELECT *, row_number() OVER (PARTITION BY spk ORDER BY dur DESC, utt) AS rank FROM (SELECT DISTINCT * FROM wav2dur JOIN utt2spk USING (utt) WHERE spk IS NOT NULL AND dur IS NOT NULL)) WHERE rank <= 3")
_add("wn9_latest_wins", lambda t: K.last_per_key(t("events").select("user_id", "event_type", "event_id", "ts", "value"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]), "SELECT user_id, event_type, event_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
_add("srt1_by_bytes", lambda t: K.by_bytes(t("transcripts").where("text is not null"), "text", "utt"), "SELECT * FROM transcripts WHERE text IS NOT NULL ORDER BY text, utt")
_add("srt2_shuffled", lambda t: K.shuffled(t("wav2dur"), "utt"), "SELECT * FROM wav2dur")
_add("srt6_by_length", lambda t: K.row_numbers(t("wav2dur").where("dur is not null").distinct(), [F.col("dur"), F.col("utt")], "place"), "SELECT *, row_number() OVER (ORDER BY dur, utt) - 1 AS place FROM (SELECT DISTINCT * FROM wav2dur WHERE dur IS NOT NULL)")
_add("srt7_pack_batches", lambda t: S.pack_batches(t("wav2dur").where("dur > 0").select((F.ascii(F.right("utt", F.lit(1))) % 16).alias("share"), "utt", (F.col("dur") * 1000).alias("ms")), "share", "ms").groupBy("share", "batch").agg(F.count(F.lit(1)).alias("n"), F.max("ms").alias("longest")).groupBy("share").agg(F.sum("n").alias("n"), F.sum(((F.col("n") > 1) & ((F.col("longest") * F.col("n") > 300_000) | (F.col("longest") >= 60_000))).cast("int")).alias("overfull")), "SELECT ascii(right(utt, 1)) % 16 AS share, count(*) AS n, 0 AS overfull FROM wav2dur WHERE dur > 0 GROUP BY ALL")
_add("srt8_suffix", lambda t: t("documents").select("doc_id", F.right("text", F.lit(10_000)).alias("tail")), "SELECT doc_id, right(text, 10000) AS tail FROM documents")
_add("prj1_utt_ids", lambda t: t("wav_scp_raw").where("audio_in like '%\t/corpus/%'").select("line_id", S.utt_of_path(F.substring_index("audio_in", "\t", -1), "/corpus").alias("utt"), S.segment_ids(F.lit("f"), F.lit("s"), F.col("line_no")).alias("seg")), "SELECT line_id, replace(regexp_replace(CASE WHEN starts_with(p, '/corpus') THEN substr(p, 8) ELSE p END, '^/+', ''), '/', '_') AS utt, printf('f-s_%04d', line_no) AS seg FROM (SELECT *, string_split(audio_in, chr(9))[-1] AS p FROM wav_scp_raw WHERE audio_in LIKE '%' || chr(9) || '/corpus/%')")
_add("prj2_path_pieces", lambda t: t("result_message").select("msg_id", S.basename(F.col("wav_name")).alias("base"), S.extension(F.col("wav_name")).alias("ext"), S.parent(F.col("wav_name")).alias("parent"), S.stem(F.col("wav_name")).alias("stem")), r"SELECT msg_id, string_split(wav_name, '/')[-1] AS base, regexp_extract(string_split(wav_name, '/')[-1], '\.([^.]*)$', 1) AS ext, coalesce(string_split(wav_name, '/')[-2], '') AS parent, regexp_replace(string_split(wav_name, '/')[-1], '\.[^.]*$', '') AS stem FROM result_message")
_add(
    "jn6_tolerance_join",
    lambda t: S.tolerance_join(t("lineitem").where("l_linenumber = 1").select("l_orderkey", F.col("l_partkey").cast("double").alias("start"), F.col("l_suppkey").cast("double").alias("end")).withColumn("rec", F.col("l_orderkey") % 50), t("lineitem").where("l_linenumber = 2").select(F.col("l_orderkey").alias("ord"), F.col("l_partkey").cast("double").alias("start"), F.col("l_suppkey").cast("double").alias("end")).withColumn("rec", F.col("ord") % 50), "rec").select("l_orderkey", "d_ord"),
    "SELECT l_orderkey, d_ord FROM (SELECT a.id, a.l_orderkey, min(b.l_orderkey) AS d_ord FROM (SELECT *, row_number() OVER () AS id FROM lineitem WHERE l_linenumber = 1) a JOIN lineitem b ON b.l_linenumber = 2 AND a.l_orderkey % 50 = b.l_orderkey % 50 AND abs(a.l_partkey - b.l_partkey) < 3 AND abs(a.l_suppkey - b.l_suppkey) < 3 GROUP BY a.id, a.l_orderkey)",
)
_SPANS = "SELECT msg_id, conn_id, CAST(timestamp AS BIGINT[][]) AS p FROM result_message WHERE mode {} AND regexp_full_match(timestamp, '\\[(\\[[0-9]+,[0-9]+\\],?)+\\]')"


def _spans(t, like: str):
    m = t("result_message").where(f"mode {like}").where(F.col("timestamp").rlike(r"^\[(\[[0-9]+,[0-9]+\],?)+\]$"))
    p = F.from_json("timestamp", "array<array<bigint>>")
    return m.select("msg_id", "conn_id", F.array_min(F.transform(p, lambda x: F.get(x, F.lit(0)))).alias("start"), F.array_max(F.transform(p, lambda x: F.get(x, F.lit(1)))).alias("end")).where("start < end")


_add(
    "jn9_speaker_overlap",
    lambda t: S.speaker_of_segments(_spans(t, "= '2pass-offline'").withColumnRenamed("msg_id", "seg"), _spans(t, "= '2pass-offline'").select("conn_id", (F.col("start") - 700).alias("start"), (F.col("end") - 900).alias("end"), F.concat(F.lit("s"), (F.col("msg_id") % 3).cast("string")).alias("speaker")).distinct().where("start < end"), "conn_id").select("conn_id", "seg", "speaker", "overlap_ms"),
    "WITH s AS (SELECT msg_id AS seg, conn_id, list_min(list_transform(p, lambda x: x[1])) AS a, list_max(list_transform(p, lambda x: x[2])) AS b FROM (" + _SPANS.format("= '2pass-offline'") + ")), g AS (SELECT * FROM s WHERE a < b), t AS (SELECT DISTINCT conn_id, a - 700 AS c, b - 900 AS d, 's' || (seg % 3) AS speaker FROM g WHERE a - 700 < b - 900), o AS (SELECT g.conn_id, seg, a, b, speaker, sum(least(b, d) - greatest(a, c)) AS ms FROM g JOIN t ON g.conn_id = t.conn_id AND a < d AND c < b GROUP BY ALL) SELECT conn_id, seg, arg_min(speaker, (-ms, speaker)) AS speaker, max(ms) AS overlap_ms FROM o GROUP BY conn_id, seg, a, b",
)
_add("wn12_majority", lambda t: S.majority_state(t("events").select("user_id", "event_id", (F.col("value") > 20).alias("speech")), ["user_id"], "event_id", "speech"), "WITH RECURSIVE v AS (SELECT user_id, event_id, value > 20 AS speech, sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS votes, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events), s AS (SELECT user_id, event_id, speech, votes, k, votes >= 15 AS speaking FROM v WHERE k = 1 UNION ALL SELECT v.user_id, v.event_id, v.speech, v.votes, v.k, CASE WHEN s.speaking THEN v.votes > 15 ELSE v.votes >= 15 END FROM s JOIN v ON v.user_id = s.user_id AND v.k = s.k + 1) SELECT user_id, event_id, speech, votes, speaking FROM s")
