import csv
import io
import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from speechprep.operators import documents, timeline
from speechprep.sinks import files as file_sinks
from speechprep.sinks import tables
from speechprep.sources import files

DATE = "2024-01-01T00:00:00+00:00"
TEXTS = ["", " ", "a  b", "NA", "12", 'a<b & "c"', "x\ty", None, "one", "two words"]


def predictions(spark, n=60, recordings=("R", "sub/Q")):
    rng = random.Random(3)
    rows = [
        (r, k, rng.randint(1, 30_000), rng.choice(TEXTS))
        for r in recordings
        for k in rng.sample(range(3 * n), n)
    ]
    rows.append(("silent", 0, 500, ""))
    schema = "recording string, chunk_no long, length long, prediction string"
    df = spark.createDataFrame(rows, schema)
    return timeline.timeline(timeline.cap_length(df, "length", 1000), "length", 1000)


def recordings(spark):
    return spark.createDataFrame(
        [("R", "/in/R.wav"), ("sub/Q", "/in/sub/Q&A.wav"), ("silent", "/in/silent.wav")],
        "recording string, media string",
    )


def assemble(parts):
    out = {}
    rows = parts.collect()
    assert len({(r.recording, r.section, r.part_no) for r in rows}) == len(rows)
    for r in sorted(rows, key=lambda r: (r.section, r.part_no)):
        out[r.recording] = out.get(r.recording, "") + r.body
    return out


def kept_rows(timed):
    rows = sorted(timed.collect(), key=lambda r: (r.recording, r.chunk_no))
    return {
        name: [r for r in rows if r.recording == name and r.prediction]
        for name in ("R", "sub/Q", "silent")
    }


def test_timeline(spark):
    rows = predictions(spark).orderBy("recording", "chunk_no").collect()
    end = {}
    for r in rows:
        start = end.get(r.recording, 0.0)
        assert (r.start_s, r.duration_s) == (start, min(r.length, 25_000) / 1000)
        end[r.recording] = r.end_s
        assert round(r.end_s * 1000) == round(start * 1000) + r.length


@pytest.mark.parametrize("part", [5, 64, 4096])
def test_plain_text(spark, part):
    timed = predictions(spark)
    want = {k: "".join(" " + r.prediction for r in v) for k, v in kept_rows(timed).items()}
    assert assemble(documents.plain_text(timed, recordings(spark), part)) == want
    assert assemble(documents.plain_text(timed, part=part)) == {k: t for k, t in want.items() if t}


@pytest.mark.parametrize("part", [5, 4096])
def test_annotation_xml(spark, part):
    timed = predictions(spark)
    got = assemble(documents.annotation_xml(timed, recordings(spark), "tdh", part))
    for name, rows in kept_rows(timed).items():
        corpus = name.rsplit("/", 1)[-1]
        root = ET.Element("TEXT", {"id": corpus, "xml:lang": "tdh"})
        for n, r in enumerate(rows, 1):
            s = ET.SubElement(root, "S", id=f"{corpus}_S{n:03d}")
            ET.SubElement(s, "AUDIO", start=f"{r.start_s:.1f}", end=f"{r.end_s:.1f}")
            ET.SubElement(s, "FORM", kindOf="phono").text = r.prediction
            for word in r.prediction.split(" "):
                ET.SubElement(ET.SubElement(s, "W"), "FORM").text = word
        buffer = io.BytesIO()
        ET.ElementTree(root).write(buffer, encoding="utf-8", xml_declaration=True)
        assert got[name] == buffer.getvalue().decode("utf-8")


@pytest.mark.parametrize("part, words", [(5, True), (4096, True), (64, False)])
def test_tier_xml(spark, part, words):
    timed = predictions(spark)
    got = assemble(documents.tier_xml(timed, recordings(spark), "tdh", DATE, words, part))
    media = {r.recording: r.media for r in recordings(spark).collect()}
    for name, rows in kept_rows(timed).items():
        root = ET.fromstring(got[name].encode("utf-8"))
        assert root.get("DATE") == DATE
        assert root.find("HEADER/MEDIA_DESCRIPTOR").get("MEDIA_URL") == "file://" + media[name]
        slots = [(s.get("TIME_SLOT_ID"), int(s.get("TIME_VALUE"))) for s in root.iter("TIME_SLOT")]
        tx = root.find("TIER[@TIER_ID='tx']")
        assert tx.get("LANG_REF") == "tdh"
        number, want_tx, want_words, want_slots = 0, [], [], []
        for k, r in enumerate(rows, 1):
            number += 1
            parent = f"a{number}"
            want_tx.append((parent, f"ts{2 * k - 1}", f"ts{2 * k}", r.prediction))
            want_slots += [(f"ts{2 * k - 1}", round(r.start_s * 1000)), (f"ts{2 * k}", round(r.end_s * 1000))]
            previous = None
            for word in r.prediction.split() if words else []:
                number += 1
                want_words.append((f"a{number}", parent, previous, word))
                previous = f"a{number}"
        assert slots == want_slots
        assert want_tx == [
            (a.get("ANNOTATION_ID"), a.get("TIME_SLOT_REF1"), a.get("TIME_SLOT_REF2"), a[0].text)
            for a in tx.iter("ALIGNABLE_ANNOTATION")
        ]
        assert want_words == [
            (a.get("ANNOTATION_ID"), a.get("ANNOTATION_REF"), a.get("PREVIOUS_ANNOTATION"), a[0].text)
            for a in root.iter("REF_ANNOTATION")
        ]
        assert root.find("HEADER/PROPERTY").text == str(number)
        assert (root.find("TIER[@TIER_ID='word']") is not None) == bool(want_words)
        assert (root.find("CONSTRAINT") is not None) == bool(want_words)
        assert len(root.findall("LINGUISTIC_TYPE")) == (2 if want_words else 1)
        assert got[name].endswith("</ANNOTATION_DOCUMENT>\n")


def test_no_language_no_media(spark):
    bare = assemble(documents.tier_xml(predictions(spark), recordings(spark).select("recording"), None, DATE))
    for text in bare.values():
        assert "LANG" not in text and "MEDIA_DESCRIPTOR" not in text
        ET.fromstring(text.encode("utf-8"))


def test_sentence_numbers_grow_past_three_digits(spark):
    df = spark.range(1_203).selectExpr("'r' as recording", "id as chunk_no", "'x' as prediction")
    ids = [r.sentence_id for r in documents.sentences(df).orderBy("chunk_no").collect()]
    assert (ids[0], ids[998], ids[1_202]) == ("r_S001", "r_S999", "r_S1203")


def test_prediction_csv_reads_back(spark, tmp_path):
    timed = predictions(spark)
    got = assemble(documents.prediction_csv(timed, recordings(spark), 7))
    for name in ("R", "sub/Q"):
        rows = list(csv.DictReader(io.StringIO(got[name])))
        want = sorted((r for r in timed.collect() if r.recording == name), key=lambda r: r.chunk_no)
        assert [(r["Chunk"], r["Prediction"], float(r["Start"]), float(r["Duration"])) for r in rows] == [
            (f"chunk_{r.chunk_no:06d}.wav", r.prediction or "", r.start_s, r.duration_s) for r in want
        ]
        path = tmp_path / (name.replace("/", "_") + ".tsv")
        path.write_text(got[name], encoding="utf-8")
        back = files.read_predictions(spark, str(path)).orderBy("Start", "Chunk").collect()
        assert [r.Prediction for r in back] == [r.prediction or None for r in want]
        strict = files.read_predictions(spark, str(path), na_values="pandas")
        assert strict.filter("Prediction = 'NA'").count() == 0
        assert strict.filter("Prediction = '12'").count() == sum(r.prediction == "12" for r in want)


def test_every_document_is_one_file_in_order(spark, tmp_path):
    timed = predictions(spark)
    parts = documents.plain_text(timed, part=8)
    whole = assemble(parts)
    targets = recordings(spark).select(
        "recording", timeline.result_path(F.col("media"), "/in", "txt").alias("file")
    )
    assert [r.file for r in targets.collect()] == [
        "/in_result/R.txt", "/in_result/sub/Q&A.txt", "/in_result/silent.txt",
    ]
    local = targets.withColumn("file", F.concat(F.lit(str(tmp_path)), "file"))
    for _ in range(2):  # writing again gives the same files
        written = file_sinks.write_documents(parts, local).collect()
    sizes = {r.file: r.bytes for r in written}
    for name, file in (("R", "in_result/R.txt"), ("sub/Q", "in_result/sub/Q&A.txt")):
        path = tmp_path / file
        assert path.read_text("utf-8") == whole[name]
        assert sizes[str(path)] == path.stat().st_size
    names = {p.name for p in tmp_path.rglob("*") if p.is_file()}
    assert names == {f.rsplit("/", 1)[1] for f in sizes}


def test_tables_round_trip(spark, tmp_path):
    rows = [
        ("a_S1.wav", "plain", "1.500", "a"), ("a_S2.wav", 'say "x"', "2.000", "a"),
        ("b_S1.wav", "tab\there", "2.000", "b"), ("b_S2.wav", "NA", "3.000", "b"),
        ("b_S3.wav", " padded ", "3.000", "b"), ("b_S4.wav", "null", "3.000", "b"),
    ]
    df = spark.createDataFrame(rows, "path string, sentence string, duration string, recording string")
    tables.write_manifest(df, str(tmp_path / "all"))
    back = files.read_manifest(spark, str(tmp_path / "all"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    text = "".join(p.read_text() for p in (tmp_path / "all").glob("part-*"))
    assert 'a_S2.wav\t"say ""x"""\t2.000\ta\n' in text
    assert files.read_manifest(spark, str(tmp_path / "all"), "pandas").filter("sentence is null").count() == 2

    tables.write_splits(df.withColumn("split", F.when(F.col("recording") == "a", "train").otherwise("test")), str(tmp_path / "s"))
    train = files.read_split(spark, str(tmp_path / "s" / "split=train"))
    assert sorted(r.path for r in train.collect()) == ["a_S1.wav", "a_S2.wav"]

    table = timeline.prediction_table(predictions(spark))
    tables.write_predictions(table, str(tmp_path / "p"))
    back = files.read_predictions(spark, str(tmp_path / "p" / "recording=R"))
    assert back.count() == 60


def test_annotations_timed_on_the_way(spark):
    rows = [("a", i, 100 * i + 7, ["x y", "", None, " ", "w"][i % 5]) for i in range(0, 40, 2)]
    rows += [("b", 3, 5, None), ("c", 900, 25_000, "z z z")]
    chunks = spark.createDataFrame(rows, "recording string, chunk_no long, length_ms long, prediction string")
    for words in (True, False):
        once = documents.timed_annotations(chunks, "length_ms", 1000, words, part=8)
        twice = documents.annotations(timeline.timeline(chunks, "length_ms", 1000), words, part=8)
        columns = sorted(set(once.columns) & set(twice.columns))
        assert {"ann_no", "sentence_no", "start_ms", "end_ms", "start_s"} <= set(columns)
        assert sorted(map(str, once.select(*columns).collect())) == sorted(map(str, twice.select(*columns).collect()))
