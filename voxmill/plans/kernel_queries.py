"""Queries that run the numerical kernels over table rows, with SQL for what it can tell of their results."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from voxmill.functions import decode
from voxmill.functions import text as T
from voxmill.functions import timing as M
from voxmill.operators import align as A
from voxmill.plans.registry import Registry
from voxmill.sources import readers as R
from voxmill.streaming import twopass

_R = Registry()
queries, oracle_sql = _R.queries, _R.oracle_sql
_add = _R.add
_DOUBLES, _STRINGS = Y.ArrayType(Y.DoubleType()), Y.ArrayType(Y.StringType())


def _udf(f, kind):
    return F.pandas_udf(lambda s: pd.Series([f(x) if x is not None else None for x in s]), kind)


def _vectors(t):
    return t("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


def _timed(t):
    """Messages whose tokens without marks are as many as their pairs."""
    toks = F.filter(T.split_timed(F.col("text")), lambda x: ~x.rlike(r"^[，。？、,.?!！]$"))
    rows = t("result_message").where("text is not null").select("msg_id", toks.alias("old"), M.parse_timestamps(F.col("timestamp")).alias("pairs"))
    return rows.where("size(old) = size(pairs) and size(old) > 0")


_add("ed8_realigned", lambda t: _timed(t).select("msg_id", F.size("old").alias("n"), A.realign_times(F.col("old"), F.transform("old", lambda x, i: F.when(i % 5 == 4, F.concat(x, F.lit("'"))).otherwise(x)), F.col("pairs")).alias("new"), "pairs").select("msg_id", "n", F.size("new").alias("m"), (M.format_timestamps(F.col("new")) == M.format_timestamps(F.col("pairs"))).alias("same")))
_add("tm3_token_times", lambda t: _vectors(t).select("vec_id", F.explode(_udf(lambda v: [e for _, _, e in decode.token_times(np.abs(v), np.abs(v) * 3, ["t"] * 4)], _DOUBLES)("v")).alias("end_s")).select("vec_id", F.round("end_s", 6).alias("end_s")))
_add("nm10_position_code", lambda t: _vectors(t).select("vec_id", F.round(F.aggregate(_udf(lambda v: decode.position_code(len(v), 8).ravel().tolist(), _DOUBLES)("v"), F.lit(0.0), lambda s, x: s + x), 6).alias("total")), "SELECT vec_id, round(list_sum(flatten(list_transform(generate_series(1, len(embedding)), lambda p: list_transform([0, 1, 2, 3], lambda k: sin(p * exp(-k * ln(10000.0) / 3)) + cos(p * exp(-k * ln(10000.0) / 3)))))), 6) AS total FROM embeddings")
_add("nm8_reflect", lambda t: _vectors(t).select("vec_id", F.posexplode(_udf(lambda v: decode.reflect_pad(v, 3, 3).tolist(), _DOUBLES)("v")).alias("k", "x")).select("vec_id", "k", F.round("x", 6).alias("x")), "SELECT vec_id, CAST(generate_subscripts(p, 1) - 1 AS INT) AS k, round(CAST(unnest(p) AS DOUBLE), 6) AS x FROM (SELECT vec_id, list_concat([embedding[4], embedding[3], embedding[2]], embedding, [embedding[-2], embedding[-3], embedding[-4]]) AS p FROM embeddings)")
_add("nm9_mel", lambda t: _vectors(t).select("vec_id", F.size(_udf(lambda v: decode.mel_energies(np.tile(np.asarray(v), 20), bands=20).ravel().tolist(), _DOUBLES)("v")).alias("n")))
_add("nm14_context_score", lambda t: t("transcripts").where("text is not null").select("utt", F.round(_context_udf()("text"), 6).alias("score")))
_add("ag15_hop_windows", lambda t: t("wav2dur").where("dur > 0").select("utt", "dur", _udf(lambda d: len(decode.hop_bounds(int(d * 16000))), Y.IntegerType())("dur").alias("n")))
_add("snk12_src7_src8_wav", lambda t: _vectors(t).select("vec_id", _udf(lambda v: R.encode_wav(np.asarray(v) / 10, 8000), Y.BinaryType())("v").alias("wav")).select("vec_id", F.posexplode(_udf(lambda b: [float(x) for strict in (True, False) for x in R.decode_wav(bytes(b), strict)[0] * 32768], _DOUBLES)("wav")).alias("k", "x")).select("vec_id", "k", F.col("x").cast("int").alias("x")), "SELECT vec_id, CAST(generate_subscripts(p, 1) - 1 AS INT) AS k, CAST(round_even(least(greatest(CAST(unnest(p) AS DOUBLE) / 10, -1), 1 - 1.0 / 32768) * 32768, 0) AS INT) AS x FROM (SELECT vec_id, list_concat(embedding, embedding) AS p FROM embeddings)")
_add("tk18_spaced", lambda t: t("transcripts").where("text is not null").select("utt", _udf(lambda s: decode.spaced([w for w in s.split(" ") if w]), Y.StringType())("text").alias("text")))
_add("tn11_punctuated", lambda t: t("transcripts").where("text is not null").select("utt", _udf(lambda s: decode.punctuate([w for w in s.split(" ") if w], lambda ws: [decode.COMMA if len(w) > 8 else decode.NONE for w in ws])[0], Y.StringType())("text").alias("p")).select("utt", F.regexp_replace("p", "[ ，。]", "").alias("letters"), ((F.col("p") == "") | F.col("p").endswith("。")).alias("ended")), "SELECT utt, regexp_replace(text, '[ ，。]', '', 'g') AS letters, true AS ended FROM transcripts WHERE text IS NOT NULL")
_add("tn12_live_punctuation", lambda t: t("transcripts").where("text is not null").select("utt", _udf(_live, Y.StringType())("text").alias("text")))
_add("str11_stacked", lambda t: _vectors(t).select("vec_id", F.size(_udf(_stacked, _DOUBLES)("v")).alias("n")), "SELECT vec_id, CAST(7 * ceil(len(embedding) / 6.0) AS INT) AS n FROM embeddings")
_add("str2_whole_steps", lambda t: t("documents").select("doc_id", F.ceil(F.octet_length("text") / twopass.STEP_BYTES).cast("int").alias("steps")), "SELECT doc_id, CAST((strlen(text) + 1599) // 1600 AS INT) AS steps FROM documents")
_add("str10_chunk_plan", lambda t: t("wav2dur").where("dur > 0").select("utt", "dur", _udf(lambda d: len(twopass.chunk_plan(int(d * 1000) // 60, 10, 5)), Y.IntegerType())("dur").alias("n")), "SELECT utt, dur, CAST(n // 10 + CASE WHEN n % 10 = 0 THEN 0 WHEN n % 10 > 5 THEN 2 ELSE 1 END + CASE WHEN n % 10 = 0 AND n > 0 THEN 1 ELSE 0 END AS INT) AS n FROM (SELECT utt, dur, CAST(trunc(dur * 1000) AS BIGINT) // 60 AS n FROM wav2dur WHERE dur > 0)")
_add("str7_kept_from", lambda t: t("wav2dur").where("dur > 0").select("utt", "dur", F.greatest((F.col("dur") * 1000).cast("int") - twopass.KEEP_MS, F.lit(0)).alias("kept")), "SELECT utt, dur, greatest(CAST(trunc(dur * 1000) AS INT) - 2000, 0) AS kept FROM wav2dur WHERE dur > 0")


def _context_udf():
    def score(text: str) -> float:
        graph = _graph()
        state, total = 0, 0.0
        for c in text:
            state, s = graph.walk(state, ord(c))
            total += s
        return total + graph.leave(state)

    return _udf(score, Y.DoubleType())


@lru_cache(maxsize=1)
def _graph() -> decode.EscapeGraph:
    return decode.EscapeGraph.build([(w, [(ord(c), c) for c in w]) for w in ("the", "table", "friend", "能够", "大门")])


def _live(text: str) -> str:
    live = decode.LivePunctuation(lambda ws: [decode.STOP if len(w) > 8 else decode.NONE for w in ws])
    words = text.split()
    return "".join(live.feed(words[a : a + 4]) for a in range(0, len(words), 4))


def _stacked(v) -> list[float]:
    s, frames = twopass.FrameStacker(), np.asarray(v)[:, None]
    return np.concatenate([p for a in range(0, len(frames), 10) if len(p := s.feed(frames[a : a + 10], a + 10 >= len(frames)))]).ravel().tolist()
