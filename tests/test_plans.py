"""All stages on generated files."""

import json
import wave
import xml.etree.ElementTree as ET

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_manifest import XML
from wavs import speech_like, write_wav

from speechprep.operators import split as sp
from speechprep.operators import vocab as vc
from speechprep.plans import stages
from speechprep.sinks import files as file_sinks
from speechprep.sinks import tables
from speechprep.sources import annotations, files


@pytest.fixture
def corpus(tmp_path):
    wavs, xmls = tmp_path / "wav", tmp_path / "xml"
    wavs.mkdir(), xmls.mkdir()
    x = speech_like([(51.5, 0.5)], 16_000, 1)
    write_wav(wavs / "A.wav", [x], 16_000)
    write_wav(wavs / "B.WAV", [x[: 44_100 * 4], -x[: 44_100 * 4]], 44_100)
    write_wav(wavs / "_tmp_C.wav", [x[:100]], 16_000)
    write_wav(wavs / "none.wav", [x[:100]], 16_000)
    write_wav(wavs / "void.wav", [x[:100]], 16_000)
    (wavs / "broken.wav").write_bytes(b"RIFF")
    (xmls / "A.xml").write_text(XML, encoding="utf-8")
    one = '<TEXT><S id="{0}"><AUDIO start="0.25" end="1.75"/><FORM>só, {0}</FORM></S></TEXT>'
    (xmls / "b.xml").write_bytes(
        ('<?xml version="1.0" encoding="iso-8859-1"?>' + one.format("B_S001")).encode("latin-1")
    )
    (xmls / "broken.xml").write_text(one.format("broken_S001"), encoding="utf-8")
    (xmls / "void.xml").write_text("<TEXT/>", encoding="utf-8")
    return tmp_path


def test_preparation_to_training_rows(spark, corpus):
    prepared = stages.prepare(spark, str(corpus / "wav"), str(corpus / "xml"))
    rows = {r.path: r for r in prepared.manifest.collect()}
    # A has 51.5 s: the sentence at 50 s is cut short, those at 60 s are past the end
    assert set(rows) == {
        "A_A_S001.wav", "A_A_S006.wav", "A_A_S009.wav", "A_A_S011.wav", "A_A_S012.wav",
        "B_B_S001.wav",
    }
    assert rows["B_B_S001.wav"].sentence == "só B_S001"
    assert ("A", "empty clip") in {(r.recording, r.reason) for r in prepared.rejects.collect()}
    assert {r.stem for r in prepared.missing.collect()} == {"none"}
    assert {r.stem for r in prepared.empty.collect()} == {"void"}
    assert [r.path.rsplit("/", 1)[1] for r in prepared.unreadable.collect()] == ["broken.wav"]

    clips = stages.clips(prepared)
    lengths = {r.path: len(r.samples) for r in clips.collect()}
    assert lengths["A_A_S006.wav"] == int(27.2 * 16_000) - 7 * 16_000
    assert lengths["A_A_S011.wav"] == int(1.5 * 16_000)
    assert lengths["B_B_S001.wav"] == int(1.95 * 16_000) - 4_000
    assert set(lengths) == set(rows)
    silent = clips.filter("path = 'B_B_S001.wav'").first().samples
    assert np.abs(silent).max() <= 1  # opposite channels cancel out

    written = file_sinks.write_clips(clips, str(corpus / "clips"), 16_000)
    assert written.count() == 6
    with wave.open(str(corpus / "clips" / "A_A_S009.wav")) as f:
        assert f.getnframes() == lengths["A_A_S009.wav"] == int(2.2 * 16_000)
    tables.write_manifest(prepared.manifest, str(corpus / "all"))
    manifest = files.read_manifest(spark, str(corpus / "all"))
    assert manifest.count() == 6
    assigned = stages.split_corpus(manifest)
    assert {r.split: r.n_clips for r in sp.split_summary(assigned).collect()} == {
        "train": 6, "valid": 0, "test": 0,
    }

    vocab = vc.vocabulary(manifest)
    tables.write_vocabulary(vc.vocabulary_json(vocab), str(corpus / "vocab"))
    stored = json.loads("".join(p.read_text("utf-8") for p in (corpus / "vocab").glob("part-*")))
    alphabet = vc.Alphabet.load(vocab)
    assert list(stored) == list(alphabet.chars) and "|" in stored and "ó" in stored
    made = stages.training_rows(manifest, prepared, alphabet)
    assert_no_exchange_carries(made, "samples")
    batched = made.collect()
    assert len(batched) == len(rows)
    assert {len(r.input_values) for r in batched} == {max(lengths.values())}
    for r in batched:
        assert sum(r.attention_mask) == lengths[r.path]
        n = len(rows[r.path].sentence)
        assert all(i >= 0 for i in r.labels[:n]) and set(r.labels[n:]) <= {-100}
        own = np.array(r.input_values[: lengths[r.path]])
        if r.path != "B_B_S001.wav":  # that one is silent
            assert abs(own.mean()) < 1e-4 and own.std() == pytest.approx(1, abs=1e-3)
        assert not any(r.input_values[lengths[r.path] :])


def assert_no_exchange_carries(df, column):
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any(column in line for line in exchanges)
    todo, seen = [df._jdf.queryExecution().optimizedPlan()], 0
    while todo:
        node = todo.pop()
        if "Repartition" in node.nodeName():
            seen += 1
            names = [node.output().apply(i).name() for i in range(node.output().size())]
            assert column not in names and "input_values" not in names
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert seen


def test_vanished_annotations_are_listed(spark, tmp_path):
    paired = spark.createDataFrame(
        [("a", str(tmp_path / "none.xml")), ("b", None)], "stem string, annotation string"
    )
    nodes = annotations.parse_annotations(annotations.read_documents(paired))
    assert [(r.recording, r.reason) for r in nodes.collect()] == [("a", "unreadable document")]


def test_equal_stems_and_lost_files(spark, tmp_path):
    """``A.wav`` and ``A.WAV`` share an annotation; nothing is multiplied or lost."""
    wavs, xmls = tmp_path / "wav", tmp_path / "xml"
    wavs.mkdir(), xmls.mkdir()
    span = '<S id="{0}"><AUDIO start="{1}" end="{2}"/><FORM>word {0}</FORM></S>'
    two = span.format("S001", 0, 1.5) + span.format("S002", 2, 4)
    for seed, name in enumerate(("A.wav", "A.WAV")):
        write_wav(wavs / name, [speech_like([(5, 0.5)], 16_000, seed)], 16_000)
    (wavs / "junk.wav").write_bytes(b"junk")
    for name in ("A", "junk"):
        (xmls / f"{name}.xml").write_text(f"<TEXT>{two}</TEXT>")
    prepared = stages.prepare(spark, str(wavs), str(xmls))
    kept = prepared.manifest.collect()
    assert len(kept) == len({r.path for r in kept}) == 4
    clips = {r.path: r.samples for r in stages.clips(prepared).collect()}
    assert set(clips) == {r.path for r in kept} and len({tuple(s) for s in clips.values()}) == 4
    reasons = sorted((r.recording, r.reason) for r in prepared.rejects.collect())
    assert reasons == [("junk", "unreadable audio")] * 2
    assert [r.path.rsplit("/", 1)[1] for r in prepared.unreadable.collect()] == ["junk.wav"]


CHARS = ["a", "b", "|", "[UNK]", "[PAD]"]


def scorer_factory():
    """A frame per 100 ms: 'a' if loud, 'b' if soft, blank if silent."""

    def make_scorer():
        def scorer(samples):
            whole = samples[: len(samples) // 1_600 * 1_600].reshape(-1, 1_600)
            peak, mean = np.abs(whole).max(axis=1, initial=0), np.abs(whole).sum(axis=1) / 1_600
            ids = np.where(peak > 9_000, 0, np.where(mean > 600, 1, 4))
            return np.eye(5)[ids]

        return scorer

    return make_scorer


def test_transcription_and_exports(spark, tmp_path):
    audio_dir = tmp_path / "new"
    (audio_dir / "sub").mkdir(parents=True)
    pattern = [(0.4, 0), (1.2, 0.6), (1.0, 0), (1.3, 0.2), (0.9, 0), (1.1, 0.6), (0.7, 0)]
    write_wav(audio_dir / "A.wav", [speech_like(pattern, 16_000, 1)], 16_000)
    write_wav(audio_dir / "sub" / "A.wav", [speech_like(pattern[:3], 32_000, 2)], 32_000)
    write_wav(audio_dir / "sub" / "quiet.wav", [np.zeros(16_000)], 16_000)
    write_wav(audio_dir / "long.wav", [np.full(16_000 * 30, 0.5)], 16_000)

    recordings = stages.find_recordings(spark, f"file://{audio_dir}/")
    assert {r.stem for r in recordings.collect()} == {"A", "sub/A", "sub/quiet", "long"}
    chars = F.array(*map(F.lit, CHARS))
    (audio_dir / "junk.wav").write_bytes(b"RIFF")
    recordings = stages.find_recordings(spark, f"file://{audio_dir}/")
    done = stages.transcribe(
        recordings, scorer_factory(), chars, CHARS.index("[PAD]"), scale=False
    )
    assert [r.recording for r in done.failures.collect()] == ["junk"]
    done.predictions.write.parquet(str(tmp_path / "predictions"))
    predictions = spark.read.parquet(str(tmp_path / "predictions"))
    got = {}
    for r in predictions.orderBy("recording", "chunk_no").collect():
        got.setdefault(r.recording, []).append((r.prediction, r.start_s, r.end_s))
    assert {k: [t for t, _, _ in v] for k, v in got.items()} == {
        "A": ["a", "b", "a"], "sub/A": ["a"], "long": ["a"],
    }
    starts = [s for _, s, _ in got["A"]]
    np.testing.assert_allclose(starts, [0, 2.1, 4.35], atol=0.1)
    assert got["A"][-1][2] == pytest.approx(6.6) and got["long"][0][2] == 25.0
    assert all(a[2] == b[1] for a, b in zip(got["A"], got["A"][1:]))

    written = stages.export(predictions, recordings, f"file:{audio_dir}", "tdh", "2024-01-01T00:00:00+00:00", failures=done.failures)
    names = {r.file[len(str(tmp_path)) + 1 :] for r in written.collect()}
    folder = tmp_path / "new_result"
    assert not any("junk" in n for n in names)
    assert names >= {f"new_result/{s}.{e}" for s in ("A", "sub/A", "sub/quiet", "long") for e in ("tsv", "xml", "eaf", "txt")}
    assert (folder / "sub" / "quiet.tsv").read_text().startswith("Chunk,Prediction,Start,End,Duration\n")
    assert (folder / "A.txt").read_text() == " a b a"
    root = ET.parse(folder / "sub" / "A.xml").getroot()
    assert [s.get("id") for s in root.findall("S")] == ["A_S001"]
    eaf = ET.parse(folder / "A.eaf").getroot()
    assert len(list(eaf.iter("ALIGNABLE_ANNOTATION"))) == 3
    assert eaf.find("HEADER/MEDIA_DESCRIPTOR").get("MEDIA_URL") == f"file://{audio_dir}/A.wav"


def test_source_times_do_not_drift(spark, tmp_path):
    pattern = [(27.0, 0.6), (1.0, 0), (2.0, 0.6)]
    write_wav(tmp_path / "A.wav", [speech_like(pattern, 16_000, 5)], 16_000)
    recordings = stages.find_recordings(spark, str(tmp_path))
    chars = F.array(*map(F.lit, CHARS))
    by = {
        times: stages.transcribe(recordings, scorer_factory(), chars, 4, times=times, scale=False)
        .predictions.orderBy("chunk_no").collect()
        for times in ("scored", "source")
    }
    assert by["scored"][1].start_s == 25.0
    assert by["source"][1].start_s == pytest.approx(27.5, abs=0.1)
    assert by["source"][1].end_s == 30.0


def test_checkpoint_folders(spark, tmp_path):
    for n in (900, 1000):
        (tmp_path / f"checkpoint-{n}").mkdir()
    (tmp_path / "runs").mkdir()
    names = files.list_checkpoints(spark, str(tmp_path), "r").collect()
    assert {(r.run, r.name) for r in names} == {("r", "checkpoint-900"), ("r", "checkpoint-1000")}
