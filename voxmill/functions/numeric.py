"""Maths over arrays of numbers as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients that recalibrate opinion scores, highest power first; personalised or not.
OPINION_POLYNOMIALS = {
    True: {"ovr": (-0.00533021, 0.005101, 1.18058466, -0.11236046), "sig": (-0.01019296, 0.02751166, 1.19576786, -0.24348726), "bak": (-0.04976499, 0.44276479, -0.1644611, 0.96883132)},
    False: {"ovr": (-0.06766283, 1.11546468, 0.04602535), "sig": (-0.08397278, 1.22083953, 0.0052439), "bak": (-0.13166888, 1.60915514, -0.39604546)},
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row. A lambda's body would work out an outer expression for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def log_add(a: Column, b: Column) -> Column:
    """NM1: log(exp(a) + exp(b)), stable."""
    m = F.greatest(a, b)
    return F.log(F.exp(a - m) + F.exp(b - m)) + m


def softmax(a: Column, mask: Column | None = None) -> Column:
    """NM2: masked-out places (mask 0) get 0."""
    kept = a if mask is None else F.zip_with(a, mask, lambda x, m: F.when(m != 0, x))
    powers = let(F.array_max(kept), lambda top: F.transform(kept, lambda x: F.coalesce(F.exp(x - top), F.lit(0.0))))
    return let(powers, lambda p: let(array_sum(p), lambda total: F.transform(p, lambda x: x / total)))


def log_softmax(a: Column, floor: float = 1e-10) -> Column:
    """NM2: the stable form, log(softmax + floor)."""
    return F.transform(softmax(a), lambda x: F.log(x + floor))


def relu(a: Column) -> Column:
    return F.transform(a, lambda x: F.greatest(x, F.lit(0.0)))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def swish(a: Column) -> Column:
    return F.transform(a, lambda x: x * sigmoid(x))


def double_swish(a: Column) -> Column:
    return F.transform(a, lambda x: x * sigmoid(x - 1))


def glu(a: Column) -> Column:
    """NM3: the first half gated by the sigmoid of the second."""
    half = (F.size(a) / 2).cast("int")
    return F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda x, g: x * sigmoid(g))


def basic_norm(a: Column, eps: float = 0.25) -> Column:
    """NM3: divided by the root of the mean square plus eps."""
    scale = F.sqrt(array_sum(F.transform(a, lambda x: x * x)) / F.size(a) + eps)
    return let(scale, lambda k: F.transform(a, lambda x: x / k))


def cmvn(a: Column, shift: Column, scale: Column) -> Column:
    """NM4: (x + shift) * scale."""
    return F.zip_with(F.zip_with(a, shift, lambda x, m: x + m), scale, lambda x, v: x * v)


def frame_energy_db(samples: Column, frame: int = 400, hop: int = 160) -> Column:
    """NM5: 10 log10(sum of squares + 1e-6) of each whole frame."""
    frames = F.floor((F.size(samples) - frame) / hop).cast("int")
    places = F.when(F.size(samples) >= frame, F.sequence(F.lit(0), frames)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda k: 10 * F.log10(array_sum(F.transform(F.slice(samples, k * hop + 1, frame), lambda x: x * x)) + 1e-6))


def noise_level(decibels: Column, frames: int = 100) -> Column:
    """NM6: the running mean over ``frames`` of a list of decibels; the first one starts it."""
    return F.aggregate(decibels, F.lit(-100.0), lambda n, d: F.when(n < -99.9, d).otherwise((d + n * (frames - 1)) / frames))


def dot(a: Column, b: Column) -> Column:
    """NM17."""
    return array_sum(F.zip_with(a, b, lambda x, y: x * y))


def gcd(a: Column, b: Column) -> Column:
    """NM17: by the remainders of Euclid's algorithm, at most 90 of them for 64-bit numbers."""
    start = F.struct(F.abs(a).cast("bigint").alias("a"), F.abs(b).cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(92)), start, lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % s["b"]).alias("b"))), lambda s: s["a"])


def lcm(a: Column, b: Column) -> Column:
    """NM17: 0 if either is 0."""
    g = gcd(a, b)
    return F.when((a == 0) | (b == 0), F.lit(0).cast("bigint")).otherwise((F.abs(a) / g).cast("bigint") * F.abs(b).cast("bigint"))


def argmax(a: Column) -> Column:
    """SRT5: place (from 0) of the first greatest value."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def top_k(a: Column, k: int) -> Column:
    """SRT3: ARRAY<STRUCT<value, place>> of the k greatest, equal values by place."""
    placed = F.transform(a, lambda x, i: F.struct((-x).alias("neg"), i.alias("place")))
    return F.transform(F.slice(F.array_sort(placed), 1, k), lambda s: F.struct((-s["neg"]).alias("value"), s["place"].alias("place")))


def ctc_collapse(ids: Column, blank: int = 0, tags: int = 4) -> Column:
    """NM12: without the leading tags, repeats and blanks."""
    body = F.slice(ids, F.lit(tags + 1), F.greatest(F.size(ids) - tags, F.lit(0)))
    return F.filter(body, lambda x, i: (x != blank) & ((i == 0) | (x != F.get(body, i - 1))))


def pieces_to_text(pieces: Column) -> Column:
    """NM12: word pieces joined, the word mark made a blank."""
    return F.trim(F.regexp_replace(F.array_join(pieces, ""), "▁", " "))


def stack_frames(frames: Column, m: int = 7, n: int = 6) -> Column:
    """WN11: m frames in one, every n; (m - 1) / 2 copies of the first frame lead, the last is repeated as needed."""
    left = (m - 1) // 2
    size = F.size(frames)
    rows = F.ceil(size / n).cast("int")
    pick = F.sequence(F.lit(0), F.lit(m - 1))
    return F.when(
        size > 0,
        F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.flatten(F.transform(pick, lambda k: F.element_at(frames, F.least(F.greatest(r * n + k - left, F.lit(0)), size - 1) + 1)))),
    ).otherwise(F.array().cast("array<array<double>>"))


def polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    """Horner's rule, highest power first."""
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def recalibrated(x: Column, kind: str, personalised: bool = False) -> Column:
    """AG16: an opinion score of kind ovr, sig or bak."""
    return polynomial(x, OPINION_POLYNOMIALS[personalised][kind])


def hotword_matrix(ids: Column, units: int = 10) -> Column:
    """NM18: unit ids cut or filled with 0 to ``units``."""
    cut = F.slice(ids, 1, units)
    return F.concat(cut, F.array_repeat(F.lit(0), F.lit(units) - F.size(cut)))


def windows(length: Column, size: float, hop: float) -> Column:
    """GEN5: begins of the windows of ``size`` that fit into ``length``, every ``hop``; at least one for a length of size or more."""
    count = F.floor((length - size) / hop)
    return F.when(length >= size, F.transform(F.sequence(F.lit(0), count.cast("int")), lambda k: k * F.lit(hop))).otherwise(F.array().cast("array<double>"))


def chunk_bounds(length: Column, stride: Column) -> Column:
    """GEN6, SNK6: ARRAY<STRUCT<k, begin, end>>: [k*stride, min((k+1)*stride, length))."""
    count = F.floor((length - 1) / stride).cast("int")
    return F.when(
        length > 0, F.transform(F.sequence(F.lit(0), count), lambda k: F.struct(k.alias("k"), (k * stride).cast("bigint").alias("begin"), F.least((k + 1) * stride, length).cast("bigint").alias("end")))
    ).otherwise(F.array().cast("array<struct<k:int,begin:bigint,end:bigint>>"))


def stride_bytes(chunk_ms_units: Column, interval: Column, rate: Column) -> Column:
    """GEN6: bytes of one message: 60 ms units over the interval, two bytes a sample."""
    return (60.0 * chunk_ms_units / interval / 1000 * rate * 2).cast("int")


def overlap_windows(length: Column, back: int, body: int, ahead: int) -> Column:
    """STR10: ARRAY<STRUCT<begin, end, from, to>> of chunks of ``body`` with look-back and look-ahead, clipped to the length."""
    return F.transform(
        chunk_bounds(length, F.lit(body)),
        lambda c: F.struct(c["begin"].alias("begin"), c["end"].alias("end"), F.greatest(c["begin"] - back, F.lit(0)).cast("bigint").alias("from"), F.least(c["end"] + ahead, length).cast("bigint").alias("to")),
    )
