"""Queries that write and read files, and streams over the tables; each returns what went through."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from voxmill.operators import keyed as K
from voxmill.sources import readers as R
from voxmill.sources import sinks as W
from voxmill.session import checkpoint_dir, table
from voxmill.streaming import twopass, vad


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return os.path.join(checkpoint_dir(spark), "voxmill", f"{name}-{uuid.uuid4().hex}")


def _run(stream: DataFrame, spark: SparkSession, name: str, mode: str = "append") -> DataFrame:
    """All of a stream's present input, as the table it wrote (append, or the last state of each micro-batch for update)."""
    out, marks = _folder(spark, name), _folder(spark, name + "-marks")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", marks).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(StructType([*stream.schema.fields, StructField("_batch", IntegerType())])).parquet(f"{out}/batch=*")


def snk1_src3_manifest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "wav_scp_raw").where(F.col("audio_in").rlike(r'^[^\t"\r\n]+\t/[^\t"\r\n]+\z'))
    path = _folder(spark, "manifest")
    W.write_lines(rows.select(F.col("audio_in").alias("value")), path)
    return R.parse_manifest(spark.read.text(path))


def snk1_src4_transcripts(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "text")
    W.write_lines(W.key_value_lines(table(spark, d, "transcripts"), "utt", "text"), path)
    return R.parse_transcripts(spark.read.text(path))


def snk2_src5_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "wav2dur").join(table(spark, d, "utt2spk"), "utt").where("dur > 0")
    path = _folder(spark, "segments")
    W.write_lines(W.segment_lines(rows.select(F.lit(0.0).alias("start"), F.col("dur").alias("end"), F.col("utt").alias("text"), F.col("spk").alias("speaker"))), path)
    parts = F.split("value", "\t")
    return spark.read.text(path).select(parts[0].cast("bigint").alias("start_ms"), parts[1].cast("bigint").alias("end_ms"), parts[2].alias("text"), parts[3].alias("speaker"))


def snk8_speaker_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "result_message").where("wav_name is not null").select("msg_id", W.speaker_path(F.col("wav_name")).alias("target"))


def snk11_messages(spark: SparkSession, d: str) -> DataFrame:
    from voxmill.functions.timing import parse_result, result_json

    path = _folder(spark, "json")
    m = table(spark, d, "result_message").select(result_json(F.col("mode"), F.col("wav_name"), F.col("text"), F.coalesce("is_final", F.lit(False)), F.col("timestamp")).alias("value")).where("value is not null")
    W.write_lines(m, path)
    return spark.read.text(path).select(parse_result(F.col("value")).alias("r")).select("r.mode", "r.wav_name", "r.text", "r.is_final", "r.timestamp")


def snk13_token_list(spark: SparkSession, d: str) -> DataFrame:
    return W.token_list(table(spark, d, "subject_area"), "subject")


def src11_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "vocabulary")
    W.write_lines(W.token_list(table(spark, d, "subject_area"), "subject"), path, 1)
    return R.read_vocabulary(spark, path, "yaml").select("token")


def snk6_fixed_pieces(spark: SparkSession, d: str) -> DataFrame:
    return W.fixed_pieces(table(spark, d, "wav2dur").where("dur > 0").distinct().select("utt", (F.col("dur") * 1000).cast("bigint").alias("ms")), "utt", "ms", 5000)


def str3_stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Session windows over the events as a stream, in complete mode: after its last micro-batch the result holds every session,
    those still open included. The result of the last micro-batch counts."""
    schema = table(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    states = _run(vad.session_windows(events, "user_id", "ts", "6 hours"), spark, "sessions", "complete")
    last = states.agg(F.max("_batch").alias("_last"))
    return states.join(F.broadcast(last), F.col("_batch") == F.col("_last")).select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")


def str8_stream_merge(spark: SparkSession, d: str) -> DataFrame:
    """The two-pass merge as a stream over the messages in no order of arrival, a file a micro-batch; the last state of each connection."""
    path = _folder(spark, "messages")
    m = table(spark, d, "result_message").where("conn_id is not null and seq_no is not null").select("conn_id", "seq_no", "mode", "text", "recv_at", "msg_id")
    m.repartition(4, F.hash("msg_id")).write.parquet(path)
    states = _run(twopass.merge_stream(twopass.paced(spark, path, m.schema), idle_ms=None), spark, "merge", "update")
    return states.groupBy("conn_id").agg(F.max_by("text", F.col("_batch")).alias("text"))


def src1_src2_snk4_by_recording(spark: SparkSession, d: str) -> DataFrame:
    """Lines appended by recording, the folder listed, and the files of each recording read back."""
    path = _folder(spark, "recordings")
    rows = table(spark, d, "result_message").where("mode is not null and text <> ''").select("mode", F.regexp_replace("text", r"[\r\n]", " ").alias("value"))
    W.write_by_recording(rows.where("char_length(value) % 2 = 0"), path, "mode")
    W.write_by_recording(rows.where("char_length(value) % 2 = 1"), path, "mode")  # appended
    listed = R.list_files(spark, path, "*.txt").select(F.col("speaker").alias("folder")).distinct()
    lines = spark.read.text(path).withColumn("folder", F.concat(F.lit("mode="), F.col("mode")))
    return lines.join(F.broadcast(listed), "folder").groupBy("folder").agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("value").alias("kinds"), F.sum(F.char_length("value")).alias("chars"))


def src6_sentence_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Sentence arrays of messages written as JSON, a message a line, and read with the schema of the sentence files."""
    from voxmill.functions import timing as M

    path = _folder(spark, "sentences")
    m = table(spark, d, "result_message").where("text is not null").select("msg_id", F.to_json(M.sentences(F.col("text"), M.parse_timestamps(F.col("timestamp")))).alias("j"))
    W.write_lines(m.select(F.concat_ws("\t", F.col("msg_id").cast("string"), "j").alias("value")), path)
    back = spark.read.text(path).select(F.split("value", "\t", 2).alias("p"))
    return back.select(F.get("p", F.lit(0)).cast("bigint").alias("msg_id"), F.size(F.filter(F.from_json(F.get("p", F.lit(1)), M.SENTENCES), lambda s: s["punc"] != "")).alias("ends"))


def src13_dialogues(spark: SparkSession, d: str) -> DataFrame:
    """Dialogue lines of four and of five columns, written and read."""
    path = _folder(spark, "dialogues")
    t = table(spark, d, "wav2dur").where("dur > 0").select(F.col("utt"), F.lit("0").alias("a"), F.col("dur").cast("bigint").cast("string").alias("b"))
    five = F.concat_ws("\t", "utt", "a", "b", F.lit("zh"), "utt")
    W.write_lines(t.select(F.when(F.char_length("b") > 1, five).otherwise(F.concat_ws("\t", "utt", "a", "b", "utt")).alias("value")), path)
    return R.parse_dialogues(spark.read.text(path))


def snk9_flt7_dataset(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a dataset folder's files, each with its file."""
    t = table(spark, d, "transcripts").where("text is not null").groupBy("utt").agg(F.max("text").alias("text")).join(table(spark, d, "wav2dur").where("dur is not null").groupBy("utt").agg(F.max("dur").alias("dur")), "utt")
    rows = t.select("utt", "text", F.lower("text").alias("clean"), F.lit(0).alias("start"), F.round(F.col("dur") * 100).cast("int").alias("end"), F.concat(F.lit("/w/"), "utt").alias("path"), F.col("utt").alias("spk"), F.lit("f").alias("gender"), F.col("utt").alias("idx"))
    files = W.dialogue_files(rows)
    return K.union_all(*[df.groupBy(F.lit(name).alias("file")).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value")).alias("bytes")) for name, df in files.items() if name in ("list", "utt2spk", "wav.scp", "text.ori", "spk2gender")])


def str2_steps(spark: SparkSession, d: str) -> DataFrame:
    """Whole steps of bytes that each document's text gives, and the length of the rest."""
    from voxmill.functions import numeric as N

    n = F.octet_length("text")
    return table(spark, d, "documents").select("doc_id", F.size(N.chunk_bounds(n, F.lit(twopass.STEP_BYTES))).alias("steps"), (n % twopass.STEP_BYTES).alias("rest"))


def str5_closed_segments(spark: SparkSession, d: str) -> DataFrame:
    """Boundaries with open halves, made from result spans, paired to segments again."""
    m = table(spark, d, "result_message").where("conn_id is not null and seq_no is not null")
    m = m.groupBy("conn_id", "seq_no").agg(F.min("msg_id").alias("msg_id"))
    begin = m.select(F.col("conn_id").cast("string").alias("stream_id"), (F.col("seq_no") * 2).alias("o"), (F.col("seq_no") * 100).alias("start_ms"), F.lit(-1).alias("end_ms"))
    end = m.select(F.col("conn_id").cast("string").alias("stream_id"), (F.col("seq_no") * 2 + 1).alias("o"), F.lit(-1).alias("start_ms"), (F.col("seq_no") * 100 + 70).alias("end_ms"))
    return vad.closed_segments(begin.unionByName(end), "o")


def str1_stream_vad(spark: SparkSession, d: str) -> DataFrame:
    """Boundaries of speech from a stream of frames: one frame an event of a user, speech where its value is above 20."""
    frames = table(spark, d, "events").select(F.col("user_id").cast("string").alias("stream_id"), "event_id", (F.col("value") > 20).alias("speech"))
    from pyspark.sql import Window

    numbered = frames.select("stream_id", (F.row_number().over(Window.partitionBy("stream_id").orderBy("event_id")) - 1).alias("frame"), "speech", F.lit(False).alias("is_final"))
    path = _folder(spark, "frames")
    numbered.write.parquet(path)
    stream = spark.readStream.schema(numbered.schema).parquet(path)
    return _run(vad.segment_stream(stream, tail_ms=250, longest_ms=500, idle_ms=None), spark, "vad").select("stream_id", "start_ms", "end_ms")


_SESSION_SQL = "SELECT user_id, min(ts) AS session_start, count(*) AS n FROM (SELECT *, sum(CASE WHEN d >= 21600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events)) GROUP BY user_id, s"


def queries() -> dict:
    return {f.__name__: f for f in (snk1_src3_manifest, snk1_src4_transcripts, snk2_src5_segments, snk6_fixed_pieces, snk8_speaker_path, snk11_messages, snk13_token_list, src11_vocabulary, str1_stream_vad, str2_steps, str3_stream_sessions, str5_closed_segments, str8_stream_merge, src1_src2_snk4_by_recording, src6_sentence_arrays, src13_dialogues, snk9_flt7_dataset)}


def oracle_sql() -> dict[str, str]:
    return {
        "snk1_src3_manifest": r"SELECT string_split(audio_in, chr(9))[1] AS utt, string_split(audio_in, chr(9))[2] AS path FROM wav_scp_raw WHERE regexp_full_match(audio_in, '[^\t\"\r\n]+\t/[^\t\"\r\n]+')",
        "snk1_src4_transcripts": r"SELECT utt, trim(regexp_replace(text, '^\s+|\s+$', '', 'g'), ' ') AS text FROM transcripts WHERE regexp_matches(text, '\S')",
        "snk2_src5_segments": "SELECT CAST(0 AS BIGINT) AS start_ms, CAST(round_even(dur * 1000, 0) AS BIGINT) AS end_ms, utt AS text, spk AS speaker FROM wav2dur JOIN utt2spk USING (utt) WHERE dur > 0 AND spk IS NOT NULL",
        "snk6_fixed_pieces": "SELECT utt, utt || '_' || printf('%02d', k) AS name, k * 5000 AS begin, least((k + 1) * 5000, ms) AS end FROM (SELECT utt, ms, unnest(generate_series(0, (ms - 1) // 5000)) AS k FROM (SELECT DISTINCT utt, CAST(trunc(dur * 1000) AS BIGINT) AS ms FROM (SELECT DISTINCT * FROM wav2dur) WHERE dur > 0))",
        "snk8_speaker_path": "SELECT msg_id, concat_ws('/', 'wav', string_split(wav_name, '/')[-2], string_split(wav_name, '/')[-1]) AS target FROM result_message WHERE wav_name IS NOT NULL",
        "snk11_messages": "SELECT mode, wav_name, text, coalesce(is_final, false) AS is_final, timestamp FROM result_message WHERE coalesce(is_final, false) OR text <> ''",
        "src1_src2_snk4_by_recording": "SELECT 'mode=' || mode AS folder, count(*) AS lines, count(DISTINCT v) AS kinds, sum(length(v)) AS chars FROM (SELECT mode, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS v FROM result_message WHERE mode IS NOT NULL AND text <> '') GROUP BY mode",
        "src6_sentence_arrays": "SELECT msg_id, len(regexp_extract_all(text, '[，。？、,?！]')) AS ends FROM result_message WHERE text IS NOT NULL",
        "src13_dialogues": "SELECT utt AS idx, '0' AS start, b AS end, CASE WHEN length(b) > 1 THEN 'zh' END AS lang, utt AS text FROM (SELECT utt, CAST(CAST(trunc(dur) AS BIGINT) AS VARCHAR) AS b FROM wav2dur WHERE dur > 0)",
        "snk9_flt7_dataset": "WITH t AS (SELECT utt, max(text) AS text FROM transcripts WHERE text IS NOT NULL GROUP BY utt), w AS (SELECT utt, max(dur) AS dur FROM wav2dur WHERE dur IS NOT NULL GROUP BY utt), k AS (SELECT * FROM t JOIN w USING (utt) WHERE trim(replace(lower(text), '<noise>', ''), ' ') <> '' AND round(dur * 100) > 1), l AS (SELECT 'list' AS file, utt AS v FROM k UNION ALL SELECT 'utt2spk', utt || ' ' || utt FROM k UNION ALL SELECT 'wav.scp', utt || ' /w/' || utt FROM k UNION ALL SELECT 'text.ori', utt || ' ' || text FROM k UNION ALL SELECT 'spk2gender', utt || ' f' FROM k) SELECT file, count(*) AS lines, sum(strlen(v)) AS bytes FROM l GROUP BY file",
        "snk13_token_list": "SELECT '- ' || subject AS value FROM subject_area",
        "src11_vocabulary": "SELECT subject AS token FROM subject_area",
        "str2_steps": "SELECT doc_id, CAST((strlen(text) + 1599) // 1600 AS INT) AS steps, CAST(strlen(text) % 1600 AS INT) AS rest FROM documents",
        "str3_stream_sessions": _SESSION_SQL,
        "str5_closed_segments": "SELECT DISTINCT CAST(conn_id AS VARCHAR) AS stream_id, seq_no * 100 AS start_ms, seq_no * 100 + 70 AS end_ms FROM result_message WHERE conn_id IS NOT NULL AND seq_no IS NOT NULL",
        "str8_stream_merge": "WITH u AS (SELECT conn_id, seq_no, coalesce(text, '') AS text, mode IN ('2pass-offline', 'offline') AS f FROM (SELECT * FROM result_message QUALIFY row_number() OVER (PARTITION BY conn_id, seq_no ORDER BY recv_at, msg_id) = 1)), k AS (SELECT *, max(CASE WHEN f THEN seq_no END) OVER (PARTITION BY conn_id) AS l FROM u) SELECT conn_id, coalesce(string_agg(text, '' ORDER BY seq_no) FILTER (f OR l IS NULL OR seq_no > l), '') AS text FROM k GROUP BY conn_id",
    }
