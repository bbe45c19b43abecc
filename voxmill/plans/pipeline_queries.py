"""The curation pipeline's stages over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill import pipeline
from voxmill.operators import keyed, rejects
from voxmill.plans import manifest_queries
from voxmill.plans.registry import Registry

_R = Registry()
queries, oracle_sql = _R.queries, _R.oracle_sql


def _segments(t) -> DataFrame:
    """One row an utterance: loaded manifest lines with transcript, speaker and duration."""
    paths = keyed.first_per_key(rejects.strict_load(t("wav_scp_raw")), ["utt"], [F.col("line_id")]).select("utt", "path")
    texts = t("transcripts").where("text is not null").groupBy("utt").agg(F.max("text").alias("text"))
    speakers = t("utt2spk").where("spk is not null").groupBy("utt").agg(F.min("spk").alias("spk"))
    durations = t("wav2dur").where("dur is not null").groupBy("utt").agg(F.max("dur").alias("dur"))
    return paths.join(texts, "utt").join(speakers, "utt").join(durations, "utt")


_SEGMENTS = manifest_queries.READ + """,
p AS (SELECT DISTINCT utt FROM judged WHERE reason IS NULL),
s AS (SELECT utt, t.text, k.spk, d.dur FROM p JOIN (SELECT utt, max(text) AS text FROM transcripts WHERE text IS NOT NULL GROUP BY utt) t USING (utt)
  JOIN (SELECT utt, min(spk) AS spk FROM utt2spk WHERE spk IS NOT NULL GROUP BY utt) k USING (utt) JOIN (SELECT utt, max(dur) AS dur FROM wav2dur WHERE dur IS NOT NULL GROUP BY utt) d USING (utt))
"""


def _published(t) -> dict[str, DataFrame]:
    hyp = t("transcripts").where("text is not null").groupBy("utt").agg(F.min("text").alias("text"))
    return pipeline.published(pipeline.assemble(_segments(t)), hyp)


_R.add("pipeline_assembled", lambda t: _assembled(t), _SEGMENTS + "SELECT utt, text, spk, dur FROM s WHERE dur BETWEEN 0.5 AND 40")
_R.add("pipeline_speakers", lambda t: pipeline.assemble(_segments(t))["spk2utt"], _SEGMENTS + "SELECT spk, string_agg(utt, ' ' ORDER BY utt) AS members FROM s WHERE dur BETWEEN 0.5 AND 40 GROUP BY spk")
_R.add("pipeline_published", lambda t: _published(t)["wav2dur"].join(_published(t)["text"], "utt"))


def _assembled(t) -> DataFrame:
    tables = pipeline.assemble(_segments(t))
    return tables["text"].join(tables["utt2spk"], "utt").join(tables["wav2dur"], "utt")
