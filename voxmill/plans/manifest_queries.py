"""Queries over manifest lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxmill.operators import rejects
from voxmill.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.failing_lines(table(spark, d, "wav_scp_raw"))


def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    return rejects.strict_load(table(spark, d, "wav_scp_raw"))


READ = r"""
WITH raw AS (SELECT line_id, regexp_replace(audio_in, '\r\z', '') AS line FROM wav_scp_raw),
cut AS (SELECT *, regexp_full_match(line, '(("[^"]*(""[^"]*)*")|([^"\t][^"\t]*)|())(\t(("[^"]*(""[^"]*)*")|([^"\t]*)))*') AS quoted,
  regexp_full_match(line, '("[^"]*(""[^"]*)*"|[^"\t]*)\t("[^"]*(""[^"]*)*"|[^"\t]*)') AS two,
  regexp_extract(line, '^("[^"]*(?:""[^"]*)*"|[^"\t]*)\t("[^"]*(?:""[^"]*)*"|[^"\t]*)\z', 1) AS a,
  regexp_extract(line, '^("[^"]*(?:""[^"]*)*"|[^"\t]*)\t("[^"]*(?:""[^"]*)*"|[^"\t]*)\z', 2) AS b FROM raw),
vals AS (SELECT *, CASE WHEN starts_with(a, '"') THEN replace(substr(a, 2, length(a) - 2), '""', '"') ELSE a END AS utt,
  CASE WHEN starts_with(b, '"') THEN replace(substr(b, 2, length(b) - 2), '""', '"') ELSE b END AS path FROM cut),
judged AS (SELECT line_id, utt, path, CASE WHEN line IS NULL THEN 'columns' WHEN NOT quoted THEN 'quoting' WHEN NOT two THEN 'columns'
  WHEN NOT regexp_full_match(utt, '[A-Za-z0-9_.-]{1,100}') THEN 'utt'
  WHEN NOT starts_with(path, '/') OR list_contains(string_split(path, '/')[2:], '') OR list_contains(string_split(path, '/')[2:], '..')
    OR regexp_matches(path, '[\x00-\x1f\x7f\x{FFFD}]') OR NOT regexp_matches(lower(path), '\.(wav|flac|pcm|mp3|mp4)\z') THEN 'path' END AS reason FROM vals)
"""


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_loaded)}


def oracle_sql() -> dict[str, str]:
    return {"p2_found": READ + "SELECT line_id, reason FROM judged WHERE reason IS NOT NULL", "p2_loaded": READ + "SELECT line_id, utt, path FROM judged WHERE reason IS NULL"}
