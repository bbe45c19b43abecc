"""Queries of times, messages, hotword formats and sessions, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxmill.functions import timing as M
from voxmill.operators import hotwords as H
from voxmill.operators import segments as S
from voxmill.plans.registry import Registry
from voxmill.streaming import twopass, vad

_R = Registry()
queries, oracle_sql = _R.queries, _R.oracle_sql
_add = _R.add
_LISTED = r"regexp_full_match(timestamp, '\s*\[\s*(\[\s*-?[0-9]+\s*,\s*-?[0-9]+\s*\]\s*,?\s*)+\]\s*')"


def _pairs():
    return M.parse_timestamps(F.col("timestamp"))


def _map_text(m):
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")


_add("tm1_timestamps", lambda t: t("result_message").select("msg_id", M.format_timestamps(_pairs()).alias("list")), rf"SELECT msg_id, CASE WHEN {_LISTED} THEN regexp_replace(timestamp, '\s', '', 'g') ELSE '' END AS list FROM result_message")
_add("tm2_sentences", lambda t: t("result_message").where("text is not null").select("msg_id", F.explode(M.sentences(F.col("text"), _pairs())).alias("s")).select("msg_id", "s.text_seg", "s.punc", "s.start", "s.end", F.size("s.ts_list").alias("n")))
_add("tm2_ends", lambda t: t("result_message").where("text is not null").select("msg_id", F.size(F.filter(M.sentences(F.col("text"), _pairs()), lambda s: s["punc"] != "")).alias("ends")), "SELECT msg_id, len(regexp_extract_all(text, '[，。？、,?！]')) AS ends FROM result_message WHERE text IS NOT NULL")
_add("tm4_shift", lambda t: t("result_message").where("seq_no is not null").select("msg_id", M.format_timestamps(M.shift_times(_pairs(), F.col("seq_no"))).alias("list")).where("list <> ''"), rf"SELECT msg_id, '[' || array_to_string(list_transform(CAST(timestamp AS BIGINT[][]), lambda p: '[' || (p[1] + seq_no) || ',' || (p[2] + seq_no) || ']'), ',') || ']' AS list FROM result_message WHERE seq_no IS NOT NULL AND {_LISTED}")
_add("tm5_timed_lines", lambda t: t("result_message").where("text is not null").select("msg_id", F.explode(M.timed_lines(F.col("text"), _pairs())).alias("l")).select("msg_id", "l.*"))
_add("tm6_corpus_time", lambda t: t("wav2dur").where("dur > 0").select("utt", M.corpus_time(M.seconds_to_ms(F.col("dur"))).alias("units")))
_add("tm7_speaker", lambda t: t("utt2spk").select("utt", M.speaker_of(F.replace(F.col("utt"), F.lit("-"), F.lit("_"))).alias("who"), M.gender_of(F.col("utt")).alias("gender")), "SELECT utt, lower(substr(string_split(replace(utt, '-', '_'), '_')[1], 1, 5)) AS who, regexp_extract(lower(utt), '([mf])[^mf]*$', 1) AS gender FROM utt2spk")
_add("tm8_samples", lambda t: t("wav2dur").select("utt", M.ms_to_samples(M.seconds_to_ms(F.col("dur"))).alias("samples")), "SELECT utt, CAST(trunc(dur * 1000) AS BIGINT) * 16 AS samples FROM wav2dur")
_add("tm9_wn10_paragraphs", lambda t: t("result_message").where("text is not null").select("msg_id", F.explode(S.paragraphs(M.sentences(F.col("text"), _pairs()), F.lit(3_600_000.0))).alias("p")).select("msg_id", "p.*"))
_add(
    "wn10_islands",
    lambda t: S.paragraph_islands(twopass.unique_messages(t("result_message")).where("mode = 'offline'").select("conn_id", "seq_no", "text"), ["conn_id"], [F.col("seq_no")], F.coalesce(F.col("text").endswith("。"), F.lit(False))).groupBy("conn_id", "island").agg(F.count(F.lit(1)).alias("n")),
    "SELECT conn_id, island, count(*) AS n FROM (SELECT conn_id, coalesce(sum(CASE WHEN text LIKE '%。' THEN 1 ELSE 0 END) OVER (PARTITION BY conn_id ORDER BY seq_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM (SELECT * FROM result_message QUALIFY row_number() OVER (PARTITION BY conn_id, seq_no ORDER BY recv_at, msg_id) = 1) WHERE mode = 'offline') GROUP BY ALL",
)
_add(
    "js1_hotwords_of", lambda t: t("session_config").where("hotwords is not null").select("cfg_id", _map_text(M.hotwords_of(F.col("hotwords"))).alias("words")),
    r"""WITH kv AS (SELECT cfg_id, hotwords AS h, CASE WHEN starts_with(trim(hotwords), '{') AND json_valid(hotwords) THEN list_transform(json_keys(hotwords), lambda k: {'k': k, 'v': CAST(json_extract_string(hotwords, '$."' || k || '"') AS INT)}) ELSE list_transform(list_distinct(list_filter(regexp_split_to_array(trim(hotwords), '\s+'), lambda w: w <> '')), lambda w: {'k': w, 'v': 20}) END AS e FROM session_config WHERE hotwords IS NOT NULL)
    SELECT cfg_id, coalesce(array_to_string(list_transform(list_sort(list_filter(e, lambda x: x.v IS NOT NULL)), lambda x: x.k || '=' || x.v), ','), '') AS words FROM kv""",
)
_add("js2_hotwords_json", lambda t: t("hotwords").where("hotword is not null").groupBy("list_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "hotword", "weight"))), lambda x: F.concat(F.trim(x["hotword"]), F.lit(" "), F.coalesce(x["weight"].cast("string"), F.lit("x")))), "\n").alias("area")).select("list_id", M.hotwords_json(F.col("area")).alias("words")))
_SETTINGS = {"mode": "2pass", "audio_fs": 16000, "itn": True, "vad_tail_sil": 350, "vad_max_len": 20000, "svs_lang": "auto"}
_add("js3_str1_settings", lambda t: twopass.latest_settings(t("session_config"), _SETTINGS), "SELECT conn_id, " + ", ".join(f"coalesce(arg_max({c}, (sent_at, cfg_id)) FILTER ({c} IS NOT NULL), {v!r}) AS {c}" for c, v in _SETTINGS.items()) + " FROM session_config GROUP BY conn_id")
_add("js3_session_settings", lambda t: t("session_config").select("cfg_id", M.session_settings(F.to_json(F.struct("vad_max_len", "svs_lang", "itn", "audio_fs"))).alias("s")).select("cfg_id", "s.vad_max_len", "s.svs_lang", "s.itn", "s.audio_fs", "s.vad_tail_sil"), "SELECT cfg_id, coalesce(vad_max_len, 20000) AS vad_max_len, coalesce(svs_lang, 'auto') AS svs_lang, coalesce(itn, true) AS itn, coalesce(audio_fs, 16000) AS audio_fs, 350 AS vad_tail_sil FROM session_config")
_add("js4_result_json", lambda t: t("result_message").select("msg_id", M.parse_result(M.result_json(F.col("mode"), F.col("wav_name"), F.col("text"), F.coalesce("is_final", F.lit(False)))).alias("r")).select("msg_id", "r.mode", "r.wav_name", "r.text", "r.is_final"), "SELECT msg_id, CASE WHEN s THEN mode END AS mode, CASE WHEN s THEN wav_name END AS wav_name, CASE WHEN s THEN text END AS text, CASE WHEN s THEN coalesce(is_final, false) END AS is_final FROM (SELECT *, coalesce(is_final, false) OR coalesce(text <> '', false) AS s FROM result_message)")
_add("src12_hotword_lines", lambda t: t("hotwords").select("list_id", "line_no", M.hotword_line(F.concat_ws(" ", "hotword", F.col("weight").cast("string"))).alias("h")).where("h is not null").select("list_id", "line_no", "h.word", "h.weight"), r"SELECT list_id, line_no, trim(regexp_extract(l, '^(.*)\s\S+$', 1), ' ') AS word, CAST(trunc(TRY_CAST(regexp_extract(l, '(\S+)$', 1) AS FLOAT)) AS INT) AS weight FROM (SELECT *, trim(concat_ws(' ', hotword, CAST(weight AS VARCHAR)), ' ') AS l FROM hotwords) WHERE regexp_matches(l, '\s') AND TRY_CAST(regexp_extract(l, '(\S+)$', 1) AS FLOAT) IS NOT NULL")
_add("flt10_in_vocabulary", lambda t: H.in_vocabulary(t("hotwords").where("hotword is not null").select("list_id", "line_no", "hotword"), F.filter(F.split(F.lower(F.trim("hotword")), " "), lambda w: w != ""), t("transcripts").select(F.explode(F.split(F.lower("text"), " ")).alias("unit")).distinct()), "WITH v AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS u FROM transcripts), w AS (SELECT list_id, line_no, hotword, unnest(list_filter(string_split(lower(trim(hotword, ' ')), ' '), lambda x: x <> '')) AS u FROM hotwords), bad AS (SELECT DISTINCT list_id, line_no, hotword FROM w WHERE u NOT IN (SELECT u FROM v WHERE u IS NOT NULL)) SELECT list_id, line_no, hotword FROM hotwords ANTI JOIN bad USING (list_id, line_no, hotword) WHERE hotword IS NOT NULL")
_add("flt11_usable", lambda t: H.first_contexts(H.usable(t("hotwords")), "list_id", "line_no"), "SELECT * FROM hotwords WHERE strlen(hotword) <= 100 AND hotword <> '' QUALIFY row_number() OVER (PARTITION BY list_id ORDER BY line_no) <= 5000")
_add("nm15_occurrences", lambda t: H.occurrences(t("transcripts").where("text is not null").groupBy("utt").agg(F.max("text").alias("text")), ["the", "he", "table", "能够", "la"], "utt", "text"), "SELECT utt, word, CAST((length(text) - length(replace(text, word, ''))) / length(word) AS INT) AS n FROM (SELECT utt, max(text) AS text FROM transcripts WHERE text IS NOT NULL GROUP BY utt), (VALUES ('the'), ('he'), ('table'), ('能够'), ('la')) v(word) WHERE contains(text, word)")
_UNIQUE = "(SELECT * FROM result_message QUALIFY row_number() OVER (PARTITION BY conn_id, seq_no ORDER BY recv_at, msg_id) = 1)"
_add("str8_wn9_merged_text", lambda t: twopass.merged_text(t("result_message")), f"WITH u AS (SELECT conn_id, seq_no, coalesce(text, '') AS text, mode IN ('2pass-offline', 'offline') AS f FROM {_UNIQUE}), k AS (SELECT *, max(CASE WHEN f THEN seq_no END) OVER (PARTITION BY conn_id) AS l FROM u) SELECT conn_id, coalesce(string_agg(text, '' ORDER BY seq_no) FILTER (f OR l IS NULL OR seq_no > l), '') AS text, sum(CAST(f AS INT)) AS finals, sum(CAST(NOT f AS INT)) AS partials FROM k GROUP BY conn_id")
_SEGMENTS = rf"SELECT CAST(msg_id AS VARCHAR) AS stream_id, CASE mode WHEN 'offline' THEN 'offline' WHEN 'online' THEN 'online' ELSE '2pass' END AS mode, list_min(list_transform(p, lambda x: x[1])) AS start_ms, list_max(list_transform(p, lambda x: x[2])) AS end_ms FROM (SELECT *, CAST(timestamp AS BIGINT[][]) AS p FROM result_message WHERE {_LISTED})"
_add(
    "str6_fan_out",
    lambda t: twopass.fan_out(t("result_message").select(F.col("msg_id").cast("string").alias("stream_id"), F.when(F.col("mode").isin("offline", "online"), F.col("mode")).otherwise("2pass").alias("mode"), _pairs().alias("p")).where("size(p) > 0").select("stream_id", "mode", F.array_min(F.transform("p", lambda x: F.get(x, F.lit(0)))).alias("start_ms"), F.array_max(F.transform("p", lambda x: F.get(x, F.lit(1)))).alias("end_ms"))),
    f"WITH s AS ({_SEGMENTS}) SELECT stream_id, CASE mode WHEN '2pass' THEN '2pass-offline' ELSE 'offline' END AS pass, start_ms, end_ms, true AS is_final FROM s WHERE mode <> 'online' AND end_ms > start_ms UNION ALL SELECT stream_id, CASE mode WHEN '2pass' THEN '2pass-online' ELSE 'online' END, start_ms + k * 600, least(start_ms + (k + 1) * 600, end_ms), (k + 1) * 600 >= end_ms - start_ms FROM (SELECT *, unnest(generate_series(0, CAST(floor((end_ms - start_ms - 1) / 600) AS BIGINT))) AS k FROM s WHERE mode <> 'offline' AND end_ms > start_ms)",
)
_add("str3_gap_sessions", lambda t: vad.gap_sessions(t("events").select("user_id", "ts", "event_id"), "user_id", "ts", 6 * 3600, "event_id"), "SELECT user_id, ts, event_id, sum(CASE WHEN d >= 21600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT *, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events)")
_add("str3_session_windows", lambda t: vad.session_windows(t("events").select("user_id", F.col("ts").cast("timestamp").alias("ts")), "user_id", "ts", "6 hours").select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n"), "SELECT user_id, min(ts) AS session_start, count(*) AS n FROM (SELECT *, sum(CASE WHEN d >= 21600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events)) GROUP BY user_id, s")


def _frames(t):
    """Frames of speech of a message: those its tokens cover, 10 ms each, from the first token's begin."""
    m = t("result_message").where("mode = 'offline'").select(F.col("msg_id").cast("string").alias("stream_id"), _pairs().alias("p")).where("size(p) > 0")
    begin, end = F.array_min(F.transform("p", lambda x: F.get(x, F.lit(0)))), F.array_max(F.transform("p", lambda x: F.get(x, F.lit(1))))
    m = m.select("stream_id", "p", begin.alias("b"), end.alias("e"))
    spoken = F.transform("p", lambda x: F.sequence(F.ceil((F.get(x, F.lit(0)) - F.col("b")) / 10).cast("int"), F.greatest(F.ceil((F.get(x, F.lit(1)) - F.col("b")) / 10).cast("int") - 1, F.ceil((F.get(x, F.lit(0)) - F.col("b")) / 10).cast("int"))))
    every = m.select("stream_id", F.explode(F.sequence(F.lit(0), F.floor((F.col("e") - F.col("b")) / 10).cast("int") + 100)).alias("frame"), F.lit(False).alias("speech"))
    return every.unionByName(m.select("stream_id", F.explode(F.flatten(spoken)).alias("frame"), F.lit(True).alias("speech")))


_add("str3_vad_segments", lambda t: vad.segments_of_table(_frames(t), tail_ms=350, longest_ms=8000))
