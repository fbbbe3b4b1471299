from pyspark.sql import functions as F

from speechprep.operators import manifest as mf
from speechprep.sources import annotations

XML = """<TEXT id="A">
  <S id="A_S001"><AUDIO start="0.5" end="3.25"/><FORM>ga-ni [laugh] cɵt, (x)</FORM></S>
  <S id="A_S002"><AUDIO start="4.0"/><FORM>no end</FORM></S>
  <S id="A_S003"><AUDIO start="4" end="6"/><FORM/></S>
  <S id="A_S004"><FORM>no audio</FORM></S>
  <S id="A_S005"><AUDIO start="6" end="7"/><FORM>one second</FORM></S>
  <S id="A_S006"><AUDIO start="7" end="27"/><FORM>twenty</FORM></S>
  <S id="A_S007"><AUDIO start="7" end="27.5"/><FORM>over</FORM></S>
  <S id="A_S008"><AUDIO start="28" end="30"/><FORM>[only note]</FORM></S>
  <S id="A_S009"><AUDIO start="30" end="32"/><FORM>ab <X>cd</X> e</FORM></S>
  <S id="A_S010"><AUDIO start="x" end="32"/><FORM>bad start</FORM></S>
  <S id="A_S011"><AUDIO start="40" end="42"/><FORM>first</FORM></S>
  <S id="A_S012"><AUDIO start="44" end="46"/><FORM>between</FORM></S>
  <S id="A_S011"><AUDIO start="50" end="53"/><FORM>last wins</FORM></S>
  <S><AUDIO start="60" end="62"/><FORM>no id</FORM></S>
  <S id="A_S014"><AUDIO start="64" end="nan"/><FORM>nan</FORM></S>
</TEXT>"""
WORDS = """<TEXT><W id="w1"><FORM>a</FORM><AUDIO start="0" end="2"/></W>
  <P><S id="deep"><FORM>b</FORM><AUDIO start="0" end="2"/></S></P></TEXT>"""


def nodes(spark, *documents):
    df = spark.createDataFrame(list(documents), "recording string, xml string")
    return annotations.parse_annotations(df)


def test_spans_of_a_document(spark):
    rows = {
        (r.sent_id, r.reason): r for r in nodes(spark, ("A", XML)).collect()
    }
    assert rows["A_S009", None].text == "ab "
    assert rows["A_S011", None].text == "last wins"
    assert rows["A_S011", None].pos == rows["A_S011", "replaced"].pos == 10
    assert rows["A_S011", "replaced"].text == "first"
    assert rows[None, None].text == "no id"
    assert rows["A_S002", "no timecode"].start == "4.0"
    assert {k for k in rows if k[1] in ("no text", "no audio")} == {
        ("A_S003", "no text"), ("A_S004", "no audio"),
    }


def test_words_stand_in_only_without_sentences(spark):
    rows = nodes(spark, ("W", WORDS), ("empty", "<TEXT/>"), ("broken", "<TEXT>")).collect()
    assert [(r.recording, r.sent_id, r.reason) for r in rows] == [
        ("W", "w1", None), ("broken", None, "bad document"),
    ]


def test_manifest_and_rejects_cover_every_node(spark):
    parsed = nodes(spark, ("A", XML))
    built = mf.build_manifest(parsed)
    got = {r.path: (r.sentence, r.duration, r.recording) for r in built.collect()}
    assert got == {
        "A_A_S001.wav": ("ga-ni cɵt", "2.750", "A"),
        "A_A_S006.wav": ("twenty", "20.000", "A"),
        "A_A_S009.wav": ("ab", "2.000", "A"),
        "A_A_S011.wav": ("last wins", "3.000", "A"),
        "A_A_S012.wav": ("between", "2.000", "A"),
        "A_None.wav": ("no id", "2.000", "A"),
    }
    reasons = {(r.sent_id, r.reason) for r in mf.rejects(parsed).collect()}
    assert reasons == {
        ("A_S002", "no timecode"), ("A_S003", "no text"), ("A_S004", "no audio"),
        ("A_S005", "too short"), ("A_S007", "too long"), ("A_S008", "empty after cleanup"),
        ("A_S010", "bad timecode"), ("A_S011", "replaced"), ("A_S014", "bad timecode"),
    }
    assert parsed.count() == len(got) + len(reasons)
    assert mf.total_minutes(built).first().asDict() == {"n_clips": 6, "minutes": "0.5"}


def test_clip_windows(spark):
    rows = [("a", 0.5, 3.25), ("b", -1.0, 1.5)]
    df = spark.createDataFrame(rows, "path string, start_s double, end_s double")
    got = {r.path: (r.start_sample, r.end_sample) for r in mf.clip_windows(df).collect()}
    assert got == {"a": (8000, int(3.45 * 16000)), "b": (0, int(1.7 * 16000))}


def test_pairing_prefers_exact_then_lowest_path(spark):
    recordings = spark.createDataFrame(
        [("/w/A.wav", "A"), ("/w/b.wav", "b"), ("/w/c.wav", "c"), ("/v/A.wav", "A")],
        "path string, stem string",
    )
    documents = spark.createDataFrame(
        [("/x/A.xml", "A"), ("/x/a.xml", "a"), ("/x/B.xml", "B"), ("/w/B.xml", "B"), ("/x/z.xml", "z")],
        "path string, stem string",
    )
    got = {r.path: r.annotation for r in mf.pair_annotations(recordings, documents).collect()}
    assert got == {
        "/w/A.wav": "/x/A.xml", "/v/A.wav": "/x/A.xml", "/w/b.wav": "/w/B.xml", "/w/c.wav": None,
    }
    assert [r.path for r in mf.missing_annotations(recordings, documents).collect()] == ["/w/c.wav"]


def test_many_recordings_of_one_name_are_not_multiplied(spark):
    recordings = spark.range(2000).selectExpr(
        "concat('/d', id, '/same.wav') as path", "'same' as stem"
    )
    documents = spark.range(1000).selectExpr(
        "concat('/x', id, '/SAME.xml') as path", "'SAME' as stem"
    )
    paired = mf.pair_annotations(recordings, documents)
    assert paired.count() == 2000
    assert [r.annotation for r in paired.select("annotation").distinct().collect()] == ["/x0/SAME.xml"]


def test_contract(spark):
    rows = [("a.wav", 16000, 1), ("b.wav", 16000, 2), ("c.wav", 8000, 1)]
    df = spark.createDataFrame(rows, "path string, sr int, channels int")
    got = {r.path: r.reason for r in mf.contract_violations(df).collect()}
    assert got == {"b.wav": "not mono", "c.wav": "wrong rate"}
    assert mf.require_contract(df.filter("path = 'a.wav'")).count() == 1
    try:
        mf.require_contract(df).collect()
    except Exception as e:
        assert "is not mono audio" in str(e)
    else:
        raise AssertionError("violations must stop the job")


def test_normalisation_runs_once_per_sentence(spark):
    df = spark.createDataFrame(
        [("A", 0, "s", "x", "0", "2", None)],
        "recording string, pos long, sent_id string, text string, start string, end string, reason string",
    )
    plan = mf.build_manifest(df, "jya")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    counted = mf.rejects(df, "jya").groupBy("reason").agg(F.count("*"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_compose_and_collapse(") == 1
