import pytest

from voxmill import pipeline


def test_options():
    d = {"stage": -1, "stop_stage": 4, "fast": False, "root": ""}
    assert pipeline.parse_options(["--stage", "2", "--fast", "true", "in", "--x"], d) == ({"stage": 2, "stop_stage": 4, "fast": True, "root": ""}, ["in", "--x"])
    for bad in (["--nope", "1"], ["--fast", "yes"], ["--stage"]):
        with pytest.raises(ValueError):
            pipeline.parse_options(bad, d)
    o = pipeline.ErrorOptions.parse(["--cs=1", "--maxw=60", "--padding-symbol=underline", "--other=3"])
    assert o.cs and o.maxw == 60 and o.pad == "_"


def test_stages_restart(spark, tmp_path):
    rows = [("u1", "/a.wav", "你好。", "s", 1.0), ("u2", "/b.wav", "再见", "s", 50.0), ("u3", "/c.wav", "完全不同的话", "r", 2.0)]
    ran = []

    def three(spark, have):
        ran.append(3)
        return pipeline.assemble(spark.createDataFrame(rows, "utt string, path string, text string, spk string, dur double"))

    def four(spark, have):
        ran.append(4)
        hyp = spark.createDataFrame([("u1", "你 好"), ("u3", "什么")], "utt string, text string")
        return {f"good_{n}": t for n, t in pipeline.published(have, hyp).items()}

    steps = {3: three, 4: four}
    first = pipeline.run(spark, str(tmp_path), steps, stop_stage=3)
    assert sorted(r["utt"] for r in first["text"].collect()) == ["u1", "u3"] and ran == [3]
    both = pipeline.run(spark, str(tmp_path), steps, stage=4)
    assert ran == [3, 4] and [tuple(r) for r in both["good_text"].collect()] == [("u1", "你好")]
    assert both["good_spk2utt"].collect()[0]["members"] == "u1"
