"""Kernels against worked cases, brute force and round trips."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from voxmill.functions import decode as D
from voxmill.functions import timing as M
from voxmill.operators import align as A
from voxmill.operators import keyed as K
from voxmill.operators import segments as S
from voxmill.sources import readers as R
from voxmill.streaming import twopass, vad

words = st.lists(st.sampled_from("abcd"), max_size=8)


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@given(words, words)
@settings(max_examples=200, deadline=None)
def test_alignment_invariants(a, b):
    n, c, s, d, i, lab, rec = A.align_tokens(a, b)
    assert n == len(a) == c + s + d and len(b) == c + s + i
    assert s + d + i == brute_distance(a, b)
    assert [x for x in lab if x] == a and [x for x in rec if x] == b and len(lab) == len(rec)


def test_alignment_cases():
    assert A.align_tokens("a b c".split(), "a x c".split())[:5] == (3, 2, 1, 0, 0)
    assert A.align_tokens(["a", "b"], [])[:5] == (2, 0, 0, 2, 0)
    assert A.align_tokens([], ["a"])[:5] == (0, 0, 0, 0, 1)
    assert A.align_tokens([], []) == (0, 0, 0, 0, 0, [], [])
    assert A.printed(["中", ""], ["a", "bb"]) == [("中   ", "a  bb")]
    assert len(A.printed(list("abcdef"), list("abcdef"), 6)) == 2


def test_smoothed_times():
    assert A.smooth_times(["a", "b"], ["a", "c"], [[0, 10], [10, 20]]) == [[0, 10], [10, 20]]
    assert A.smooth_times(["a", "b"], ["a", "c", "d"], [[0, 10], [10, 21]]) == [[0, 10], [10, 15], [15, 21]]
    assert A.smooth_times(["a"], ["a"], []) == []
    assert A.smooth_times(["a"], ["a", "b"], [[0, 10]]) == [[0, 5], [5, 10]]  # the token before shares its span
    assert A.smooth_times([], ["a"], []) == [] and A.smooth_times(["a"], [], [[0, 10]]) == []
    assert A.smooth_times(["a", "b"], ["x", "a", "b"], [[0, 100], [100, 200]]) == [[0, 50], [50, 100], [100, 200]]  # the token after does


def test_sentences_and_paragraphs():
    assert M.cut_sentences(["你", "好", "。"], [[0, 100], [100, 200]]) == [{"text_seg": "你 好", "punc": "。", "start": 0, "end": 200, "ts_list": [[0, 100], [100, 200]]}]
    got = M.cut_sentences(["。", "a", "b", "！", "？", "c"], [[0, 1], [1, 2]])
    assert [(s["start"], s["end"], s["punc"]) for s in got] == [(-1, -1, "。"), (0, 2, "！"), (0, 0, "？")]
    sentences = [{"start": 0, "end": 3000, "text_seg": "a", "punc": "，"}, {"start": 3000, "end": 6000, "text_seg": "b", "punc": "。"}, {"start": 6000, "end": 9000, "text_seg": "c", "punc": ""}]
    assert [(p["begin"], p["end"]) for p in S.gather_paragraphs(sentences, 60_000)] == [(3000.0, 4800.0), (4800.0, 7800.0)]
    assert M.time_lines(["hello", "你好"], [[0, 1000], [1000, 1500], [1500, 2000]]) == [{"text": "hello", "begin_s": 0.0, "end_s": 1.0}, {"text": "你好", "begin_s": 1.0, "end_s": 2.0}]


def test_token_times():
    peaks = np.zeros(40)
    peaks[[10, 20, 30]] = 1.0
    got = D.token_times(np.full(40, 0.075), peaks, ["a", "b"])
    assert [t for t, _, _ in got] == ["<sil>", "a", "b", "<sil>"]
    assert got[1][1] == pytest.approx(8.5 * 0.02) and got[-1][2] == pytest.approx(0.8)
    assert D.token_times(np.zeros(3), np.zeros(3), ["a"]) == [] and D.token_times(np.ones(3), np.ones(3), []) == []
    scaled = D.token_times(np.full(40, 0.2), np.zeros(40), ["a", "b", "</s>"])
    assert [t for t, _, _ in scaled if t != "<sil>"] == ["a", "b"]


@given(st.lists(st.floats(0, 0.9), min_size=1, max_size=40), st.integers(1, 39))
@settings(max_examples=60, deadline=None)
def test_integrate_and_fire_in_chunks(alphas, cut):
    a, h = np.array(alphas), np.arange(len(alphas), dtype=float)[:, None]
    whole, state = D.fired_vectors(h, a)
    one, mid = D.fired_vectors(h[:cut], a[:cut])
    two, end = D.fired_vectors(h[cut:], a[cut:], carry=mid)
    assert np.allclose(whole, np.concatenate([one, two])) and np.allclose(state[1], end[1])
    assert len(whole) in (math.floor(sum(alphas) + 1e-9), math.floor(sum(alphas) - 1e-9))


def all_paths(logp, blank=0):
    t, v = logp.shape
    total = {}
    for path in np.ndindex(*([v] * t)):
        units = tuple(u for i, u in enumerate(path) if u != blank and (i == 0 or path[i - 1] != u))
        total[units] = np.logaddexp(total.get(units, -np.inf), sum(logp[i, u] for i, u in enumerate(path)))
    return total


@pytest.mark.parametrize("seed", range(5))
def test_beam_search_equals_all_paths(seed):
    rng = np.random.default_rng(seed)
    logp = np.log(rng.dirichlet(np.ones(3), size=5))
    best = max(all_paths(logp).items(), key=lambda kv: kv[1])
    units, score, frames = D.prefix_beam_search(logp, first_beam=3, second_beam=200)[0]
    assert tuple(units) == best[0] and score == pytest.approx(best[1]) and len(frames) == len(units)


def test_context_lifts_a_word():
    logp = np.log(np.array([[0.2, 0.45, 0.35]] * 2))
    assert D.prefix_beam_search(logp)[0][0] == [1]
    graph = D.WordGraph.build([[2, 1]], [3.0], step=2.0)
    assert D.prefix_beam_search(logp, graph=graph)[0][0] == [2, 1]


@given(st.lists(st.text("ab", min_size=1, max_size=3), min_size=1, max_size=4), st.text("abc", max_size=12))
@settings(max_examples=150, deadline=None)
def test_automaton_finds_all(ws, text):
    g = D.WordGraph.build([[ord(c) for c in w] for w in ws])
    want = sorted((i, i + len(w)) for w in set(ws) for i in range(len(text)) if text.startswith(w, i))
    assert sorted(g.matches([ord(c) for c in text])) == want


def test_walks_pay_back():
    g = D.WordGraph.build([[1, 2, 3]], [5.0], step=3.0)
    state, score = g.walk(0, 1)
    state, more = g.walk(state, 2)
    assert (score, more) == (3.0, 3.0)
    assert g.walk(state, 9) == (0, -6.0) and g.walk(state, 3)[1] == 8.0 and g.leave(state) == -6.0
    e = D.EscapeGraph.build([("ab", [(1, "a"), (2, "b")]), ("x" * 101, [(3, "x")])], score=2.0, growth=1.0)
    s, w = e.walk(0, 1)
    assert w == 2.0 and e.walk(s, 7) == (0, -2.0) and e.walk(s, 2)[1] == 3.0 and 3 not in e.arcs[0]


def test_pieces_and_words():
    assert D.join_pieces(["he@@", "llo", "world"])[0] == "hello world"
    assert D.join_pieces(["你", "好", "ab@@", "c"])[0] == "你好abc"
    assert D.join_pieces(["a", "b", "cd"])[0] == "ab cd"
    assert D.join_pieces(["lo@@", "中"]) == ("lo 中", False) and D.join_pieces(["he@@", "lo@@"]) == ("helo", False)
    assert D.join_pieces(["a", "b"], after_word=True) == (" ab", True) and D.join_pieces(["中", "ab"]) == ("中ab", True)
    assert D.join_pieces([]) == ("", False) and D.join_pieces(["<s>", "你"]) == ("你", False)
    assert D.join_pieces(["▁i'm", "▁he", "re"], "en-bpe")[0] == "I'm here"
    assert D.merge_timed_pieces(["he@@", "llo", "好"], [(0, 1), (1, 2), (2, 3)]) == (["hello", "好"], [(0, 2), (2, 3)])
    assert D.spaced(["a", "b", "你", "c"]) == "a b你c"
    assert D.longest_match("the 能够x", {"▁the": 1, "▁t": 2, "能够": 3, "能": 4}) == ([1, 3], False)


def test_punctuation():
    none = lambda ws: [D.NONE] * len(ws)
    assert D.punctuate(["a", "b"], none)[0] == "a b。"
    assert D.punctuate(["hello", "world"], lambda ws: [D.COMMA, D.NONE])[0] == "hello， world。"
    first_end = lambda ws: [D.STOP, *[D.NONE] * (len(ws) - 1)]
    assert D.punctuate([f"w{i}" for i in range(25)], first_end)[1] == [D.STOP, *[D.NONE] * 23, D.STOP]  # no batch ends at its first word
    assert D.punctuate([], none) == ("", [])
    assert D.punctuate(["你", "好"], lambda ws: [D.NONE, D.COMMA])[0] == "你好。"
    words_ = [str(k) for k in range(45)]
    text, marks = D.punctuate(words_, lambda ws: [D.STOP if w.endswith("9") else D.NONE for w in ws])
    assert len(marks) == 45 and marks[9] == D.STOP and marks[-1] == D.STOP and "9。10" in text
    live = D.LivePunctuation(lambda ws: [D.STOP if w == "b" else D.NONE for w in ws])
    assert live.feed(["a", "b", "c"]) == "a b。c" and live.kept == ["c"]


def test_signals():
    t = np.arange(1600) / 16000
    tone = np.sin(2 * np.pi * 300 * t)
    down = D.resample(tone, 16000, 8000)
    assert len(down) == 800 and np.abs(down[50:750] - np.sin(2 * np.pi * 300 * np.arange(800) / 8000)[50:750]).max() < 0.02
    assert list(D.reflect_pad(np.array([1, 2, 3]), 2, 1)) == [3, 2, 1, 2, 3, 2]
    both = D.position_code(6, 8)
    assert np.allclose(both[3:], D.position_code(3, 8, start=3))
    assert D.mel_energies(tone).shape == (8, 80) and D.mel_energies(tone[:10]).shape == (0, 80)
    assert len(D.hop_windows(np.ones(16000))) >= 1 and D.hop_windows(np.array([])) == []


def test_wav_round_trip():
    x = np.clip(np.random.default_rng(0).normal(0, 0.2, 500), -1, 0.99)
    data = R.encode_wav(x, 8000)
    back, rate = R.decode_wav(data)
    assert rate == 8000 and np.abs(back - x).max() <= 1 / 32768
    extra = data[:12] + b"LIST" + (4).to_bytes(4, "little") + b"abcd" + data[12:]
    assert np.array_equal(R.decode_wav(extra)[0], back)
    with pytest.raises(R.BadWav):
        R.decode_wav(b"junk" * 20)
    with pytest.raises(R.BadWav):
        R.decode_wav(R.encode_wav(x, 8000, bits=8))
    assert len(R.decode_wav(data, strict=False)[0]) == 500 and R.decode_wav(b"", strict=False)[0].size == 0


@given(st.lists(st.booleans(), max_size=150), st.integers(1, 60), st.sampled_from([200, 350, 800]), st.sampled_from([500, 1500]))
@settings(max_examples=80, deadline=None)
def test_vad_does_not_depend_on_chunks(flags, chunk, tail, longest):
    frames = [(f, i == len(flags) - 1) for i, f in enumerate(flags)]
    whole = vad.boundaries(vad.SpeechState(), frames, tail, longest)
    state, parts = vad.SpeechState(), []
    for a in range(0, len(frames), chunk):
        parts += vad.boundaries(state, frames[a : a + chunk], tail, longest)

    def closed(bounds):
        out, begin = [], None
        for b, e in bounds:
            begin = b if b >= 0 else begin
            if e >= 0:
                out.append((begin, e))
        return out

    assert closed(whole) == closed(parts)
    assert all(0 <= b < e for b, e in closed(whole)) and all(x[1] <= y[0] for x, y in zip(closed(whole), closed(whole)[1:]))


def test_vad_cases():
    assert vad.boundaries(vad.SpeechState(), [(False, i == 99) for i in range(100)], 800, 15000) == []
    frames = [(20 <= i < 120, i == 299) for i in range(300)]
    (b, e), *rest = vad.boundaries(vad.SpeechState(), frames, 800, 15000)
    assert b == 0 and 1200 <= e <= 1500 and not rest
    cut = vad.boundaries(vad.SpeechState(), [(True, i == 299) for i in range(300)], 800, 1000)
    assert len(cut) >= 2 and all(y - x <= 1020 for x, y in cut)


def test_buffers():
    steps, rest = twopass.whole_steps(b"", b"x" * 3500, False)
    assert [len(s) for s in steps] == [1600, 1600] and len(rest) == 300
    steps, rest = twopass.whole_steps(rest, b"y", True)
    assert [len(s) for s in steps] == [301] and rest == b""
    assert twopass.trimmed_from(None, 5000, 0) == 3000 and twopass.trimmed_from(1000, 5000, 0) == 0
    assert [(a, b) for a, b, _ in twopass.chunk_plan(25, 10, 5)] == [(0, 10), (10, 20), (20, 25)]
    assert [(a, b) for a, b, _ in twopass.chunk_plan(28, 10, 5)] == [(0, 10), (10, 20), (20, 25), (25, 28)]
    assert twopass.chunk_plan(0, 10, 5) == []


@pytest.mark.parametrize("n", [1, 4, 6, 7, 13, 30])
def test_stacking_in_chunks(n):
    frames = np.arange(n, dtype=float)[:, None]
    whole = twopass.FrameStacker().feed(frames, True)
    s = twopass.FrameStacker()
    parts = [s.feed(frames[a : a + 5], a + 5 >= n) for a in range(0, n, 5)]
    assert np.array_equal(whole, np.concatenate([p for p in parts if len(p)]))


@given(st.lists(st.integers(1, 30), min_size=4, max_size=25), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_speaker_split(counts, parts):
    got = K.split_by_speaker([(f"s{i}", c) for i, c in enumerate(counts)], parts)
    assert [s for s, _ in got] == [f"s{i}" for i in range(len(counts))]
    places = [p for _, p in got]
    assert places == sorted(places) and set(places) == set(range(parts))


def test_speaker_split_needs_speakers():
    with pytest.raises(ValueError):
        K.split_by_speaker([("a", 1)], 2)


@pytest.mark.parametrize("n", [0, 1, 99, 900, 901, 1000, 1001, 5000, 33900])
def test_hop_bounds_equal_the_windows(n):
    clip = np.arange(n)
    repeated = np.tile(clip, 1024)
    assert [w.tolist() for w in D.hop_windows(clip, rate=100)] == [repeated[a:b].tolist() for a, b in D.hop_bounds(n, rate=100)]


def test_speaker_split_hands_on_and_back(spark):
    counts = [("a", 1), ("b", 9), ("c", 2), ("d", 2)]
    assert K.split_by_speaker(counts, 2) == [("a", 0), ("b", 0), ("c", 1), ("d", 1)]
    assert K.split_by_speaker([("a", 1), ("b", 1), ("c", 8), ("d", 1)], 2) == [("a", 0), ("b", 0), ("c", 1), ("d", 1)]
    assert K.split_by_speaker([("a", 5), ("b", 1), ("c", 1), ("d", 1)], 2) == [("a", 0), ("b", 1), ("c", 1), ("d", 1)]
    rows = [(s, k * 100 + i) for k, (s, c) in enumerate([("z", 5), ("y", 1), ("x", 1), ("w", 1)]) for i in range(c)] + [(None, 999)]
    got = K.speaker_split(spark.createDataFrame(rows, "spk string, line_no int"), 2).groupBy("spk").agg(F.max("part").alias("p"), F.count("*").alias("n")).collect()
    assert {r["spk"]: (r["p"], r["n"]) for r in got} == {"z": (0, 5), "y": (1, 1), "x": (1, 1), "w": (1, 1)}


def test_distances_in_blocks_equal_the_matrix():
    rng = np.random.default_rng(0)
    for n, m in ((0, 3), (1, 1), (7, 0), (30, 41), (100, 9)):
        a, b = rng.integers(0, 4, n), rng.integers(0, 4, m)
        d = A._Distances(a, b)
        assert all(d[x, y] == brute_distance(a[:x].tolist(), b[:y].tolist()) for x in range(n, -1, -1) for y in (0, m // 2, m))


def test_distance_beyond_the_alphabet(spark):
    many = [f"t{i}" for i in range(20_500)]
    df = spark.createDataFrame([(many, [*many[:-1], "x"]), (["a", "b"], ["b"]), ([], [])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(A.distance(F.col("a"), F.col("b"))).collect()] == [1, 1, 0]


def frames_of(flags, final=True):
    return [(t, s, final and t == len(flags) - 1) for t, s in enumerate(flags)]


def test_streams_take_input_in_any_order(spark, tmp_path):
    """A file a micro-batch, early frames and late messages: the same result as in order."""
    from voxmill.plans.stream_queries import _run

    rng = np.random.default_rng(3)
    flags = (rng.random(400) < np.repeat([0.0, 1.0, 0.1, 1.0], 100)).tolist()
    rows = [("s", int(t), bool(x), bool(f)) for t, x, f in frames_of(flags)]
    order = rng.permutation(len(rows))
    schema = "stream_id string, frame int, speech boolean, is_final boolean"
    path = str(tmp_path / "frames")
    for k in range(4):
        part = [rows[i] for i in order[k::4]] + [rows[order[k]]]  # one frame given twice
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    bounds = _run(vad.segment_stream(twopass.paced(spark, path, schema), 350, 8000, None), spark, "vad-test").collect()
    whole = vad.segments_of_table(spark.createDataFrame(rows, schema), 350, 8000).collect()
    begins, ends = sorted(r["start_ms"] for r in bounds if r["start_ms"] >= 0), sorted(r["end_ms"] for r in bounds if r["end_ms"] >= 0)
    assert begins == sorted(r["start_ms"] for r in whole) and ends == sorted(r["end_ms"] for r in whole) and len(whole) > 1


def test_merge_keeps_late_numbers_and_first_deliveries(spark, tmp_path):
    from voxmill.plans.stream_queries import _run

    schema = "conn_id bigint, seq_no int, mode string, text string, recv_at string, msg_id bigint"
    said = [(1, 3, "2pass-online", "d", "2025-01-01", 4), (1, 2, "2pass-offline", "C", "2025-01-03", 3), (1, 0, "2pass-online", "a", "2025-01-01", 1), (1, 1, "2pass-offline", "B", "2025-01-02", 2), (1, 1, "2pass-offline", "x", "2025-01-09", 9), (1, 2, "2pass-offline", "c", "2025-01-01", 8), (1, 4, None, None, None, 7)]
    path = str(tmp_path / "said")
    for row in said:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)
    states = _run(twopass.merge_stream(twopass.paced(spark, path, schema), None, 50), spark, "merge-test", "update")
    assert states.groupBy("conn_id").agg(F.max_by("text", "_batch"), F.max("seq_no")).collect()[0] == (1, "Bcd", 4)
