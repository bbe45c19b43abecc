"""Queries of array maths, frames and chunks, with the SQL that checks them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from voxmill.functions import decode
from voxmill.functions import numeric as N
from voxmill.plans.registry import Registry

_R = Registry()
queries, oracle_sql = _R.queries, _R.oracle_sql
_add = _R.add
_V = "CAST(embedding AS DOUBLE[])"


def _vectors(t):
    return t("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))





def _stat(name: str, build, expr: str) -> None:
    """Arrays are compared by their sum, their greatest value and their third place, rounded."""
    def run(t):
        a = F.col("a")
        return build(_vectors(t)).select("vec_id", F.size(a).alias("n"), F.round(N.array_sum(a), 5).alias("total"), F.round(F.array_max(a), 6).alias("top"), F.round(F.get(a, F.lit(2)), 6).alias("third"))

    _add(name, run, f"SELECT vec_id, len(a) AS n, round(list_sum(a), 5) AS total, round(list_max(a), 6) AS top, round(a[3], 6) AS third FROM (SELECT vec_id, {expr} AS a FROM (SELECT vec_id, label, {_V} AS v FROM embeddings))")


def _as_a(f):
    return lambda df: df.select("vec_id", f(F.col("v")).alias("a"))


_stat("nm2_softmax", _as_a(N.softmax), "list_transform(v, lambda x: exp(x - list_max(v)) / list_sum(list_transform(v, lambda y: exp(y - list_max(v)))))")
_stat("nm2_log_softmax", _as_a(N.log_softmax), "list_transform(v, lambda x: ln(exp(x - list_max(v)) / list_sum(list_transform(v, lambda y: exp(y - list_max(v)))) + 1e-10))")
_stat("nm3_relu", _as_a(N.relu), "list_transform(v, lambda x: greatest(x, 0.0))")
_stat("nm3_swish", _as_a(N.swish), "list_transform(v, lambda x: x / (1 + exp(-x)))")
_stat("nm3_double_swish", _as_a(N.double_swish), "list_transform(v, lambda x: x / (1 + exp(-(x - 1))))")
_stat("nm3_glu", _as_a(N.glu), "list_transform(v[1:CAST(len(v) / 2 AS INT)], lambda x, i: x / (1 + exp(-v[i + CAST(len(v) / 2 AS INT)])))")
_stat("nm3_basic_norm", _as_a(N.basic_norm), "list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)) / len(v) + 0.25))")
_stat("nm4_cmvn", lambda df: df.select("vec_id", N.cmvn(F.col("v"), F.transform("v", lambda x, i: i / F.lit(10.0)), F.transform("v", lambda x, i: 1 / (F.lit(1.0) + i))).alias("a")), "list_transform(v, lambda x, i: (x + (i - 1) / 10.0) * (1 / (1.0 + i - 1)))")
_stat("wn11_stack_frames", lambda df: df.select("vec_id", F.flatten(N.stack_frames(F.transform("v", lambda x: F.array(x)), 7, 6)).alias("a")), "list_transform(range(0, 7 * CAST(ceil(len(v) / 6.0) AS BIGINT)), lambda k: v[CAST(least(greatest((k // 7) * 6 + k % 7 - 3, 0), len(v) - 1) + 1 AS BIGINT)])")
_stat("nm18_hotword_matrix", lambda df: df.select("vec_id", F.transform(N.hotword_matrix(F.transform(F.slice("v", F.lit(1), F.col("label") + 1), lambda x: F.round(x * 100).cast("int"))), lambda x: x.cast("double")).alias("a")), "list_transform(range(1, 11), lambda k: CASE WHEN k <= label + 1 AND k <= len(v) THEN CAST(CAST(round(v[k] * 100) AS INT) AS DOUBLE) ELSE 0.0 END)")
_add("nm1_log_add", lambda t: _vectors(t).select("vec_id", F.round(N.log_add(F.get("v", F.lit(0)), F.get("v", F.lit(1))), 6).alias("x")), f"SELECT vec_id, round(ln(exp(v[1]) + exp(v[2])), 6) AS x FROM (SELECT vec_id, {_V} AS v FROM embeddings)")
_add("nm5_energy", lambda t: _vectors(t).select("vec_id", F.explode(N.frame_energy_db(F.col("v"), 25, 10)).alias("db")).groupBy("vec_id").agg(F.count(F.lit(1)).alias("frames"), F.round(F.sum("db"), 4).alias("db")), f"SELECT vec_id, len(k) AS frames, round(list_sum(list_transform(k, lambda f: 10 * log10(list_sum(list_transform(v[f * 10 + 1:f * 10 + 25], lambda x: x * x)) + 1e-6))), 4) AS db FROM (SELECT vec_id, {_V} AS v, generate_series(0, CAST(floor((len({_V}) - 25) / 10) AS BIGINT)) AS k FROM embeddings)")
_add("nm6_noise_level", lambda t: _vectors(t).select("vec_id", F.round(N.noise_level(F.col("v")), 6).alias("level")), f"SELECT vec_id, round(list_reduce(v, lambda n, d: (d + n * 99) / 100), 6) AS level FROM (SELECT vec_id, {_V} AS v FROM embeddings)")
_add("nm17_dot", lambda t: _vectors(t).select("vec_id", F.round(N.dot(F.col("v"), F.reverse("v")), 6).alias("dot")), f"SELECT vec_id, round(list_sum(list_transform({_V}, lambda x, i: x * {_V}[len(embedding) - i + 1])), 6) AS dot FROM embeddings")
_add("nm17_gcd_lcm", lambda t: t("lineitem").select("l_orderkey", "l_linenumber", N.gcd(F.col("l_partkey"), F.col("l_suppkey")).alias("g"), N.lcm(F.col("l_partkey"), F.col("l_suppkey")).alias("l")), "SELECT l_orderkey, l_linenumber, gcd(l_partkey, l_suppkey) AS g, lcm(l_partkey, l_suppkey) AS l FROM lineitem")
_add("srt5_argmax", lambda t: _vectors(t).select("vec_id", N.argmax(F.col("v")).alias("place")), f"SELECT vec_id, list_position(v, list_max(v)) - 1 AS place FROM (SELECT vec_id, {_V} AS v FROM embeddings)")
_add("srt3_top_k", lambda t: _vectors(t).select("vec_id", F.explode(N.top_k(F.col("v"), 5)).alias("s")).select("vec_id", F.round("s.value", 6).alias("value"), "s.place"), f"SELECT vec_id, round(x, 6) AS value, i - 1 AS place FROM (SELECT vec_id, unnest({_V}) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, i) <= 5")
_IDS = "list_transform({v}, lambda x: CAST(floor(abs(x) * 20) AS INT) % 4)"
_add("nm12_ctc_collapse", lambda t: _vectors(t).select("vec_id", F.array_join(N.ctc_collapse(F.transform("v", lambda x: (F.floor(F.abs(x) * 20) % 4).cast("int"))), ",").alias("units")), f"SELECT vec_id, array_to_string(list_filter(list_transform(b, lambda x, i: CASE WHEN x <> 0 AND (i = 1 OR x <> b[i - 1]) THEN x END), lambda x: x IS NOT NULL), ',') AS units FROM (SELECT vec_id, ({_IDS.format(v=_V)})[5:] AS b FROM embeddings)")
_add("nm12_pieces", lambda t: t("hotwords").where("hotword is not null").select("list_id", "line_no", N.pieces_to_text(F.transform(F.split("hotword", " "), lambda w: F.concat(F.lit("▁"), w))).alias("text")), "SELECT list_id, line_no, trim(array_to_string(list_transform(string_split(hotword, ' '), lambda w: ' ' || w), ''), ' ') AS text FROM hotwords WHERE hotword IS NOT NULL")
_add("ag16_recalibrated", lambda t: t("lineitem").select("l_orderkey", "l_linenumber", *[F.round(N.recalibrated(F.col("l_quantity") / 10, k, p), 6).alias(f"{k}_{'p' if p else 'r'}") for p in (True, False) for k in ("ovr", "sig", "bak")]),
     "SELECT l_orderkey, l_linenumber, " + ", ".join("round(" + " + ".join(f"({c}) * pow(l_quantity / 10, {len(cs) - 1 - i})" for i, c in enumerate(cs)) + f", 6) AS {k}_{'p' if p else 'r'}" for p in (True, False) for k in ("ovr", "sig", "bak") for cs in (N.OPINION_POLYNOMIALS[p][k],)) + " FROM lineitem")
_add("gen5_windows", lambda t: t("wav2dur").where("dur is not null").select("utt", "dur", F.explode(N.windows(F.col("dur"), 9.01, 1.0)).alias("begin")), "SELECT utt, dur, CAST(unnest(CASE WHEN dur >= 9.01 THEN generate_series(0, CAST(floor(dur - 9.01) AS BIGINT)) ELSE [] END) AS DOUBLE) AS begin FROM wav2dur WHERE dur IS NOT NULL")
_add("gen6_snk6_chunks", lambda t: t("documents").select("doc_id", F.explode(N.chunk_bounds(F.octet_length("text"), F.lit(960))).alias("c")).select("doc_id", "c.*"), "SELECT doc_id, CAST(k AS INT) AS k, k * 960 AS begin, least((k + 1) * 960, n) AS end FROM (SELECT doc_id, n, unnest(generate_series(0, (n - 1) // 960)) AS k FROM (SELECT doc_id, strlen(text) AS n FROM documents) WHERE n > 0)")
_add("gen6_stride", lambda t: t("session_config").where("chunk_size is not null and audio_fs is not null").select("cfg_id", N.stride_bytes(F.get("chunk_size", F.lit(1)), F.lit(10), F.col("audio_fs")).alias("stride")), "SELECT cfg_id, CAST(trunc(60.0 * chunk_size[2] / 10 / 1000 * audio_fs * 2) AS INT) AS stride FROM session_config WHERE chunk_size IS NOT NULL AND audio_fs IS NOT NULL")
_add("str10_overlap_windows", lambda t: t("wav2dur").where("dur > 0").select("utt", "dur", F.explode(N.overlap_windows((F.col("dur") * 1000).cast("bigint"), 300, 600, 300)).alias("w")).select("utt", "dur", "w.*"), "SELECT utt, dur, k * 600 AS begin, least((k + 1) * 600, n) AS end, greatest(k * 600 - 300, 0) AS \"from\", least(least((k + 1) * 600, n) + 300, n) AS \"to\" FROM (SELECT utt, dur, n, unnest(generate_series(0, (n - 1) // 600)) AS k FROM (SELECT utt, dur, CAST(trunc(dur * 1000) AS BIGINT) AS n FROM wav2dur WHERE dur > 0) WHERE n > 0)")


def _udf(f):
    return F.pandas_udf(lambda s: pd.Series([f(np.asarray(x)) for x in s]), ArrayType(DoubleType()))


def _fired(v: np.ndarray) -> list[float]:
    out, _ = decode.fired_vectors(v[:, None], np.abs(v) % 1)
    return out[:, 0].tolist()


def _beam(v: np.ndarray) -> list[float]:
    frames = np.log(np.exp(v[: len(v) // 8 * 8].reshape(-1, 8) * 4))
    frames = frames - np.log(np.exp(frames).sum(1, keepdims=True))
    units, score, _ = decode.prefix_beam_search(frames)[0]
    return [score, *map(float, units)]


_add("nm11_count", lambda t: _vectors(t).select("vec_id", F.size(_fire_udf()("v")).alias("n")), f"SELECT vec_id, CAST(floor(list_sum(list_transform({_V}, lambda x: abs(x) % 1)) + 1e-9) AS INT) AS n FROM embeddings")
_add("nm13_beam_search", lambda t: _vectors(t).select("vec_id", F.transform(_beam_udf()("v"), lambda x: F.round(x, 5)).alias("best")).select("vec_id", F.array_join(F.transform("best", lambda x: x.cast("string")), ",").alias("best")))
_add("nm7_resampled", lambda t: _vectors(t).select("vec_id", F.size(_resample_udf()("v")).alias("n")), f"SELECT vec_id, CAST(ceil(len(embedding) * 2.0) AS INT) AS n FROM embeddings")


def _fire_udf():
    return _udf(_fired)


def _beam_udf():
    return _udf(_beam)


def _resample_udf():
    return _udf(lambda v: decode.resample(v, 8000, 16000).tolist())
