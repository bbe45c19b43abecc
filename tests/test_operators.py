"""Operators on small tables: hand-made cases, nulls, empty tables, repeated rows, clashing columns."""

import re

import pytest
from pyspark.sql import functions as F

from voxmill.functions import numeric as N
from voxmill.functions import text as T
from voxmill.functions import timing as M
from voxmill.operators import align as A
from voxmill.operators import hotwords as H
from voxmill.operators import keyed as K
from voxmill.operators import lexicon as L
from voxmill.operators import rejects
from voxmill.operators import segments as S
from voxmill.plugins import score_with
from voxmill.sources import readers as R
from voxmill.sources import sinks as W
from voxmill.streaming import twopass, vad


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).collect()[0][0]


# ---- failing lines ---------------------------------------------------------------------------------------------------
def by_hand(line):
    """The rules one character at a time."""
    if line is None:
        return "columns"
    if line.endswith("\r"):
        line = line[:-1]
    values, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            i += 1
            value = ""
            while True:
                if i >= len(line):
                    return "quoting"
                if line[i] != '"':
                    value += line[i]
                    i += 1
                elif line[i + 1 : i + 2] == '"':
                    value += '"'
                    i += 2
                else:
                    i += 1
                    break
            if i < len(line) and line[i] != "\t":
                return "quoting"
        else:
            end = line.find("\t", i)
            end = len(line) if end < 0 else end
            value = line[i:end]
            if '"' in value:
                return "quoting"
            i = end
        values.append(value)
        if i >= len(line):
            break
        i += 1
    if len(values) != 2:
        return "columns"
    if not re.fullmatch(r"[A-Za-z0-9_.-]{1,100}", values[0]):
        return "utt"
    p = values[1]
    if not p.startswith("/") or any(s in ("", "..") for s in p.split("/")[1:]) or re.search("[\x00-\x1f\x7f�]", p) or not re.search(r"\.(wav|flac|pcm|mp3|mp4)\Z", p, re.I):
        return "path"
    return None


LINES = [
    None, "", " ", "\r", "a\t/b.wav", "a\t/b.wav\r", "a\t/b.wav\r\r", "a\t/b.wav\t", "\t/b.wav", "a\t", '"a"\t"/b.wav"', '"a"x\t/b.wav', '"a\t/b.wav', 'a"\t/b.wav', 'a\t"/b""c.wav"', 'a\t"/b\tc.wav"', '""\t/b.wav', '"a"\t/b.WAV"', "a b\t/b.wav", "é\t/b.wav",
    "a\tb.wav", "a\t//b.wav", "a\t/x/../b.wav", "a\t/x/..b.wav", "a\t/b.wav/", "a\t/.wav", "a\t/b.ogg", "a\t/b\x01.wav", "a\t/b\x7f.wav", "a\t/b�.wav", "a\t/b.Mp4", "a\t/b\n.wav", "a\t/b.wav\n", "a" * 100 + "\t/b.wav", "a" * 101 + "\t/b.wav", "a|/b.wav", '"', '"""', '""""\t/b.wav', "a\t/" + "x" * 200_000 + ".flac", '"' + '""' * 50_000 + '"\t/b.wav', "\t" * 30_000,
    "a\t..", "a\t/..", "a\t/.../b.wav", "a\t/b.wav\r\n", "\ta\t/b.wav", '"a"\t"/b.wav"\r', '"a"\r\t/b.wav',
]


def test_failing_lines_equal_the_rules(spark):
    df = spark.createDataFrame(list(enumerate(LINES)), "line_id bigint, audio_in string").withColumn("reason", F.lit("clash")).withColumn("utt", F.lit(1)).withColumn("_line", F.lit(2))
    got = dict(rejects.failing_lines(df).collect())
    want = {i: r for i, x in enumerate(LINES) if (r := by_hand(x))}
    assert got == want
    loaded = {r["line_id"]: (r["utt"], r["path"]) for r in rejects.strict_load(df).collect()}
    assert set(loaded) == set(range(len(LINES))) - set(want) and loaded[10] == ("a", "/b.wav")


def test_failing_lines_of_nothing_and_of_copies(spark):
    empty = spark.createDataFrame([], "line_id bigint, audio_in string")
    assert rejects.failing_lines(empty).count() == 0 and rejects.strict_load(empty).count() == 0
    copies = spark.createDataFrame([(1, "x"), (2, "x"), (3, "a\t/b.wav"), (4, "a\t/b.wav")], "line_id bigint, audio_in string")
    assert sorted(map(tuple, rejects.failing_lines(copies).collect())) == [(1, "columns"), (2, "columns")]


# ---- text ------------------------------------------------------------------------------------------------------------
def test_text_cases(spark):
    assert one(spark, "你好 abc", T.tokens) == ["你", "好", "abc"]
    assert one(spark, "<unk><noise>a, b!é", T.tokens) == ["<unk>", "<noise>", "a,", "b!", "é"]
    assert one(spark, "a,b (c)", lambda c: T.tokens(c, "B")) == ["a", "b", "c"]
    assert one(spark, "<unk>a<b", T.strip_tags) == "a"
    assert one(spark, "他女儿在那边儿", T.remove_erhua) == "他女儿在那边"
    assert [one(spark, x, T.zh_or_en) for x in ("hi 中", "hi", "")] == ["zh", "en", "zh"]
    assert one(spark, "i like 你 好 ok", T.join_mandarin) == "i like你好ok"
    assert one(spark, "ok你好", T.space_mandarin) == "ok 你 好"
    assert one(spark, "(ppl) 你好 <ppb> PPL hello, ａé <unk a>", T.normalize_dialog) == "<noise> 你 好 <noise> hello ae <unk>"
    assert one(spark, "a b.c/d e.f.wav", T.safe_name) == "a-b.c/d-e-f.wav"
    assert one(spark, "a:b:", lambda c: T.split_fields(c, ":", keep_tail=False)) == ["a", "b"]
    assert one(spark, 'date { day: "1" x: "a\\"b" year: "2" }', T.reorder_tagged) == 'date { year: "2" day: "1" }'
    assert one(spark, 'money { value: "1" currency: "E" } w { a: "}" }', T.reorder_tagged) == 'money { currency: "E" value: "1" } w { a: "}" }'
    assert one(spark, 'word { b: "1" a: "2" }', T.reorder_tagged) == 'word { b: "1" a: "2" }'
    with pytest.raises(ValueError):
        T.fold_case(F.lit("a"), True, True)
    nulls = [T.tokens, T.strip_tags, T.join_mandarin, T.space_mandarin, T.split_timed, T.remove_symbols, T.normalize_dialog, T.zh_or_en, T.blank_punctuation]
    assert all(one(spark, None, f) is None for f in nulls)
    assert one(spark, "", T.tokens) == [] and one(spark, "  ", T.join_mandarin) == ""


def test_timestamps_and_messages(spark):
    assert one(spark, "[[0,100],[100,200]]", M.parse_timestamps) == [[0, 100], [100, 200]]
    for bad in ("[[0,100],[1,2,3]]", "[[0]]", "x", "", "[]", "[[1,2],[3,4", '[[1,"a"]]'):
        assert one(spark, bad, M.parse_timestamps) == [], bad
    assert one(spark, None, M.parse_timestamps) == []
    assert one(spark, "[[0,100]]", lambda c: M.format_timestamps(M.parse_timestamps(c))) == "[[0,100]]"
    assert one(spark, '{"a b": 3, "c": null}', M.hotwords_of) == {"a b": 3}
    assert one(spark, '["x","y"]', M.hotwords_of) == {"x": 20, "y": 20}
    assert one(spark, '"x y"', M.hotwords_of) == {"x": 20, "y": 20}
    assert one(spark, "x  y x", M.hotwords_of) == {"x": 20, "y": 20}
    assert one(spark, None, M.hotwords_of) is None and one(spark, "", M.hotwords_of) == {}
    assert one(spark, "a b 5\nc\nd 7\na b 6\n", M.hotwords_json) == '{"d":7,"a b":6}'
    assert one(spark, "a b 5", M.hotword_line)["word"] == "a b" and one(spark, "a b", M.hotword_line) is None
    assert one(spark, "solo", lambda c: M.hotword_line(c, True))["weight"] == 20
    assert one(spark, '{"vad_max_len": 9}', M.session_settings)["vad_max_len"] == 9
    assert one(spark, "{}", lambda c: M.session_settings(c, "offline"))["vad_tail_sil"] == 800
    assert one(spark, 1234, M.corpus_time, "int") == "00123" and one(spark, 1235, M.corpus_time, "int") == "00124" and one(spark, 123456, M.corpus_time, "int") == "12346"


def test_arrays(spark):
    assert one(spark, [0, 0, 0, 0, 0, 5, 5, 0, 5], N.ctc_collapse, "array<int>") == [5, 5]
    assert one(spark, [[1.0], [2.0], [3.0], [4.0]], N.stack_frames, "array<array<double>>") == [[1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0]]
    assert one(spark, [1.0, 3.0, 3.0], N.argmax, "array<double>") == 1
    assert one(spark, [], lambda c: N.stack_frames(c), "array<array<double>>") == []
    assert one(spark, [1, 2], N.hotword_matrix, "array<int>") == [1, 2] + [0] * 8
    assert one(spark, 0, lambda c: N.chunk_bounds(c, F.lit(5)), "int") == []
    assert [r["end"] for r in one(spark, 11, lambda c: N.chunk_bounds(c, F.lit(5)), "int")] == [5, 10, 11]
    assert one(spark, 12, lambda c: N.gcd(c, F.lit(18)), "int") == 6


# ---- keyed -----------------------------------------------------------------------------------------------------------
def test_keyed_cases(spark):
    rows = spark.createDataFrame([("foo", "1"), ("bar", "2"), ("foo", "3"), (None, "4")], "a string, b string")
    ids = spark.createDataFrame([("foo",), ("foo",), (None,)], "a string")
    assert sorted(r["b"] for r in K.filter_by_keys(rows, ids, "a").collect()) == ["1", "3"]
    assert sorted(r["b"] for r in K.filter_by_keys(rows, ids, "a", exclude=True).collect()) == ["2", "4"]
    s = spark.createDataFrame([("u1", "b", 0), ("u2", "a", 1), ("u3", "b", 2)], "utt string, spk string, n int")
    assert [(r["spk"], r["members"]) for r in K.group_to_list(s, "spk", "utt", "n").orderBy("first_line").collect()] == [("b", "u1 u3"), ("a", "u2")]
    for n, k in ((10, 3), (7, 7), (100, 8), (2, 5)):
        sizes = K.equal_split(spark.range(n), k, [F.col("id")]).groupBy("part").count().orderBy("part").collect()
        assert [r["count"] for r in sizes] == [n // k + (i < n % k) for i in range(k) if n // k + (i < n % k)]
    merged = K.merge_hotwords(spark.createDataFrame([("a", 10)], "word string, weight int"), spark.createDataFrame([("a", 20), ("b", 30)], "word string, weight int"))
    assert {tuple(r) for r in merged.collect()} == {("a", 10), ("b", 30)}
    with pytest.raises(Exception, match="no value for key"):
        K.lookup_strict(rows.where("a = 'bar'"), spark.createDataFrame([("foo", "x")], "a string, c string"), "a", "c").collect()
    split = K.validation_split(spark.range(1000).withColumn("k", F.col("id").cast("string")), "k", 0.05)
    assert split.where("split = 'valid'").count() == 50
    assert K.validation_split(spark.range(10), "id", count=0).where("split = 'valid'").count() == 0
    empty = spark.createDataFrame([], "a string, b string")
    assert K.filter_by_keys(empty, ids, "a").count() == 0 and K.equal_split(empty, 3, [F.col("a")]).count() == 0
    assert K.speakers_by_split(spark.createDataFrame([], "split string, spk string, dur double"), ["x"]).collect()[0]["hours"] == 0.0


def test_alignment_of_tables(spark):
    ref = spark.createDataFrame([("a", "x y z"), ("a", "x y"), ("b", "q"), ("c", None), ("d", "")], "utt string, text string")
    hyp = spark.createDataFrame([("a", "x", 1), ("a", "x y z", 2), ("c", "w", 1), ("d", None, 1)], "utt string, text string, ord int")
    got = sorted((r["utt"], r["n"], r["d"], r["i"]) for r in A.align_pairs(ref, hyp).collect())
    assert got == [("a", 2, 0, 1), ("a", 3, 0, 0), ("d", 0, 0, 0)]
    scored = A.align_pairs(ref, hyp)
    assert A.corpus_error(scored).collect()[0]["n"] == 5
    assert A.corpus_error(scored.where("false")).collect()[0]["wer"] == 0.0
    pairs = spark.createDataFrame([(list("abc"), list("axc")), ([], ["a"]), (["a"], []), (["你", "好"], ["你"])], "l array<string>, r array<string>")
    both = pairs.select(A.align_declared(F.col("l"), F.col("r")).alias("x"), A.align(F.col("l"), F.col("r")).alias("y"), A.distance(F.col("l"), F.col("r")).alias("d"))
    for r in both.collect():
        assert [r["x"][k] for k in "ncsdi"] == [r["y"][k] for k in "ncsdi"] and r["x"]["dist"] == r["d"]


def test_segments_in_time(spark):
    tests = spark.createDataFrame([("r", 10, 20, "t1"), ("r", 50, 60, "t2"), (None, 1, 2, "t3")], "rec string, start int, end int, name string")
    data = spark.createDataFrame([("r", 12, 21, 2), ("r", 11, 18, 1), ("r", 50, 63, 3)], "rec string, start int, end int, ord int")
    assert [(r["name"], r["d_ord"]) for r in S.tolerance_join(tests, data, "rec").collect()] == [("t1", 1)]
    turns = spark.createDataFrame([("r", "x", 0, 9000), ("r", "y", 9000, 30000)], "rec string, speaker string, start int, end int")
    segs = spark.createDataFrame([("r", 1, 8000, 25000), ("r", 2, 0, 10000), ("r", 3, 40000, 41000)], "rec string, seg int, start int, end int")
    assert {(r["seg"], r["speaker"], r["overlap_ms"]) for r in S.speaker_of_segments(segs, turns, "rec").collect()} == {(1, "y", 16000), (2, "x", 9000)}
    packed = S.pack_batches(spark.createDataFrame([("a", 100000.0), ("a", 200000.0), ("a", 50000.0), ("a", 70000.0), ("a", 10000.0)], "k string, ms double"), "k", "ms")
    assert len({r["batch"] for r in packed.collect()}) == 4


def test_lexicon_small(spark):
    lex = spark.createDataFrame([("a", "x", 0), ("b", "x", 1), ("c", "x y", 2), ("d", "z", 3)], "word string, pron string, line_no int")
    assert [r["mark"] for r in L.disambiguated(lex).orderBy("line_no").collect()] == ["#1", "#2", "", ""]
    counts = L.ngram_counts(spark.createDataFrame([("a b a",), (None,), ("",), ("  ",)], "text string"), (1, 2))
    assert {(r["ngram"], r["n"]) for r in counts.where("ord = 2").collect()} == {("<s> a", 1), ("a b", 1), ("b a", 1), ("a </s>", 1)}
    lam = L.best_mixture(spark.createDataFrame([(0.9, 0.1)] * 5 + [(0.1, 0.9)] * 5, "p1 double, p2 double"))
    assert abs(lam - 0.5) < 1e-6


def test_hotword_occurrences(spark):
    texts = spark.createDataFrame([(1, "ananas"), (2, None), (3, "")], "id bigint, text string")
    assert {tuple(r) for r in H.occurrences(texts, ["ana", "an", "", "zz"], "id", "text").collect()} == {(1, "ana", 2), (1, "an", 2)}
    assert H.occurrences(texts, [], "id", "text").count() == 0


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.scp").write_text("u1\t/x.wav\nu2 /y.wav\nu3\t/a b.wav\n\n", encoding="utf-8")
    lines = R.numbered_lines(spark, str(tmp_path / "m"))
    assert [r["line_no"] for r in lines.orderBy("line_no").collect()] == [0, 1, 2, 3]
    assert sorted(r["utt"] for r in R.parse_manifest(lines).collect()) == ["u1", "u3"]
    assert sorted(r["utt"] for r in R.parse_manifest(lines, "first").collect()) == ["u1", "u2", "u3"]
    assert sorted(r["path"] for r in R.parse_manifest(lines, "blanks").collect()) == ["/a", "/x.wav", "/y.wav"]
    seg = spark.createDataFrame([(0.0005, 1.5, "a\tb", "s"), (0.0, 1.0, "c", None)], "start double, end double, text string, speaker string")
    assert [r["value"] for r in W.segment_lines(seg).collect()] == ["0\t1500\ta b\ts"]
    (tmp_path / "t.tsv").write_text("start\tend\ttext\tspeaker\n0\t10\thi\ts1\nbad\n5\t6\tx\ts2\n")
    assert [(r["start_ms"], r["speaker"]) for r in R.read_segments(spark, str(tmp_path / "t.tsv")).orderBy("line_no").collect()] == [(0, "s1"), (5, "s2")]
    (tmp_path / "v.json").write_text('["<blank>", "a"]')
    assert [r["token"] for r in R.read_vocabulary(spark, str(tmp_path / "v.json"), "json").orderBy("id").collect()] == ["<blank>", "a"]
    (tmp_path / "s.json").write_text('[{"text_seg":"a","punc":"。","start":0,"end":5,"ts_list":[[0,5]]}]')
    assert R.read_sentences(spark, str(tmp_path / "s.json")).collect()[0]["sentences"][0]["end"] == 5
    assert one(spark, "<AddShift> <LearnRateCoef> 0 [ -1.5 2 ]", lambda c: R.parse_cmvn(c, "AddShift")) == [-1.5, 2.0]
    dialogue = spark.createDataFrame([("i\t0\t9\thi",), ("i\t0\t9\tEN\thi",), ("x",)], "value string")
    assert [r["lang"] for r in R.parse_dialogues(dialogue).collect()] == [None, "EN"]
    rows = spark.createDataFrame([("u", "hi", "hi <noise>", 0, 100, "/p/a.wav", "s", "m", "i"), ("v", "x", "<noise>", 0, 100, "/p/a.wav", "s", "m", "i"), ("w", "x", "x", 0, 1, "/p/a.wav", "s", "m", "i")], "utt string, text string, clean string, start int, end int, path string, spk string, gender string, idx string")
    assert [r["value"] for r in W.dialogue_files(rows)["segments"].collect()] == ["u i 0.0 1.0"]
    W.write_by_recording(spark.createDataFrame([("a", "x"), ("b", "y")], "wav_name string, value string"), str(tmp_path / "rec"))
    assert spark.read.text(str(tmp_path / "rec")).count() == 2


def test_sound_files(spark, tmp_path):
    import numpy as np

    folder = tmp_path / "in" / "spk1"
    folder.mkdir(parents=True)
    (folder / "a.wav").write_bytes(R.encode_wav(np.zeros(800), 8000))
    (folder / "b.wav").write_bytes(b"junk")
    (folder / "c.pcm").write_bytes(b"\x00\x40" * 10)
    got = {r["path"].rsplit("/", 1)[1]: r for r in R.read_audio(spark, str(tmp_path / "in"), "*").collect()}
    assert len(got["a.wav"]["samples"]) == 1600 and got["b.wav"]["error"] and got["c.pcm"]["samples"][0] == 0.5
    listed = {r["name"]: (r["utt"], r["speaker"]) for r in R.list_files(spark, str(tmp_path / "in"), "*.wav").collect()}
    assert listed["a"] == ("spk1_a.wav", "spk1")
    recordings = spark.createDataFrame([("u", [0.5] * 1600)], "utt string, samples array<double>")
    cuts = spark.createDataFrame([("u", 0, 0, 50), ("u", 1, 90, 200)], "utt string, seg int, start_ms int, end_ms int")
    sizes = {r["seg"]: len(R.decode_wav(bytes(r["wav"]))[0]) for r in W.cut_audio(recordings, cuts).collect()}
    assert sizes == {0: 800, 1: 160}


def test_two_passes(spark):
    rows = [(1, 5, 1, "2pass-online", "he"), (2, 5, 2, "2pass-online", "llo"), (3, 5, 3, "2pass-offline", "Hello."), (4, 5, 3, "2pass-offline", "Hello."), (5, 5, 4, "2pass-online", "wor"), (6, 6, 1, "online", None)]
    m = spark.createDataFrame(rows, "msg_id bigint, conn_id bigint, seq_no int, mode string, text string").withColumn("recv_at", F.lit(None).cast("timestamp"))
    assert {(r["conn_id"], r["text"]) for r in twopass.merged_text(m).collect()} == {(5, "Hello.wor"), (6, "")}
    assert twopass.merged_text(m.where("false")).count() == 0
    seg = spark.createDataFrame([("s", "2pass", 0, 1300), ("t", "offline", 0, 100), ("u", "online", 5, 5)], "stream_id string, mode string, start_ms int, end_ms int")
    assert sorted((r["pass"], r["start_ms"], r["end_ms"], r["is_final"]) for r in twopass.fan_out(seg).collect()) == [("2pass-offline", 0, 1300, True), ("2pass-online", 0, 600, False), ("2pass-online", 600, 1200, False), ("2pass-online", 1200, 1300, True), ("offline", 0, 100, True)]


def test_table_vad_equals_kernel(spark):
    flags = [20 <= i < 120 or 260 <= i < 300 for i in range(400)]
    rows = [("s", i, f) for i, f in enumerate(flags)] + [("s", 30, False), ("t", 0, None)]
    got = sorted((r["start_ms"], r["end_ms"]) for r in vad.segments_of_table(spark.createDataFrame(rows, "stream_id string, frame int, speech boolean"), 350, 8000).collect())
    want = vad.boundaries(vad.SpeechState(), [(f, i == 399) for i, f in enumerate(flags)], 350, 8000)
    assert got == want and len(got) == 2
    assert vad.segments_of_table(spark.createDataFrame([], "stream_id string, frame int, speech boolean")).count() == 0


def test_model_plug_point(spark):
    got = score_with(spark.range(5), lambda: lambda pdf: pdf.assign(score=pdf["id"] * 2.0), "id bigint, score double").agg(F.sum("score")).collect()[0][0]
    assert got == 20.0


def test_windows_of_long_recordings(spark, tmp_path):
    from voxmill.plans import kernel_queries

    spark.createDataFrame([("a", 339.0), ("b", 99.5), ("c", 0.5), ("d", 0.0)], "utt string, dur double").write.parquet(str(tmp_path / "wav2dur.parquet"))
    got = {r["utt"]: r["n"] for r in kernel_queries.queries()["ag15_hop_windows"](spark, str(tmp_path)).collect()}
    # A window that rounding makes a sample short is left out, as in the reference.
    whole = lambda hops: sum(int((k + 9.01) * 16000) - k * 16000 >= int(9.01 * 16000) for k in range(hops))
    assert got == {"a": whole(330), "b": whole(90), "c": whole(7)}  # half a second is doubled to 16 s


def test_declared_alignment_of_all_pairs(spark, tmp_path):
    from voxmill.plans import align_queries

    long = " ".join("abcdefghijklmnopqrst")
    spark.createDataFrame([("a", long), ("a", long + " z"), ("b", "uh"), ("b", "x y"), ("c", "uh")], "utt string, text string").write.parquet(str(tmp_path / "transcripts.parquet"))
    got = {r["utt"]: (r["dist"], r["surplus"]) for r in align_queries.queries()["ed5_declared_all"](spark, str(tmp_path)).collect()}
    assert got == {"a": (1, 1), "b": (2, 2), "c": (0, 0)}


@pytest.fixture()
def many_partitions(spark):
    """Exchanges of many small partitions, which the adaptive planner coalesces as it likes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_row_numbers_over_many_partitions(many_partitions):
    n, parts = 300_000, 7
    wide = many_partitions.range(n).select((F.col("id") * 7919 % n).alias("id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("filler"))
    got = K.row_numbers(wide, [F.col("id")], "n", "all")
    assert got.agg(F.count("*"), F.min("n"), F.max("n"), F.countDistinct("n"), F.sum((F.col("n") != F.col("id")).cast("int")), F.min("all"), F.max("all")).collect()[0] == (n, 0, n - 1, n, 0, n, n)
    sizes = sorted(r["count"] for r in K.equal_split(wide, parts, [F.col("id")]).groupBy("part").count().collect())
    assert sum(sizes) == n and sizes[-1] - sizes[0] <= 1 and len(sizes) == parts
    tied = K.row_numbers(wide.withColumn("k", F.col("id") % 3), [F.col("k")], "n")  # a third of the rows ties
    assert tied.agg(F.count("*"), F.countDistinct("n"), F.max("n")).collect()[0] == (n, n, n - 1)


def test_lexicon_arcs_over_many_partitions(many_partitions):
    lexicon = many_partitions.range(60_000).select(F.col("id").alias("line_no"), F.concat(F.lit("w"), "id").alias("word"), F.lit("a b c").alias("pron"))
    arcs = L.lexicon_arcs(lexicon)
    assert arcs.count() == 180_000
    states = arcs.where("dst <> 0").agg(F.count("*"), F.countDistinct("dst"), F.min("dst"), F.max("dst")).collect()[0]
    assert states == (120_000, 120_000, 1, 120_000)
    assert arcs.where("k = 0 and dst <> line_no * 2 + 1").count() == 0


def test_lines_without_an_id(spark):
    lines = spark.createDataFrame([(None, "a\t/a.wav"), (None, "bad"), (1, "b\t/b.wav"), (2, 'x"y')], "line_id bigint, audio_in string")
    assert sorted((r["line_id"] or 0, r["reason"]) for r in rejects.failing_lines(lines).collect()) == [(0, "columns"), (2, "quoting")]
