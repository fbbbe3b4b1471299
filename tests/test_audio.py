import struct
import wave
from types import SimpleNamespace

import numpy as np
import pytest
from wavs import speech_like, write_wav

from speechprep.sinks import files as file_sinks
from speechprep.session import spread
from speechprep.sources import audio, files, storage


def test_flat_and_recursive_scans(spark, tmp_path):
    x = np.zeros(160)
    (tmp_path / "sub").mkdir()
    for name in ("A.wav", "B.WAV", "_tmp_c.wav", "sub/D.wav"):
        write_wav(tmp_path / name, [x], 16_000)
    (tmp_path / "note.txt").write_text("x")
    flat = files.scan_recordings(spark, str(tmp_path))
    deep = files.scan_recordings(spark, str(tmp_path), recursive=True)
    assert {r.stem for r in flat.collect()} == {"A", "B"}
    assert {r.stem for r in deep.collect()} == {"A", "_tmp_c", "D"}
    assert flat.first().length == (tmp_path / "A.wav").stat().st_size


@pytest.mark.parametrize("width, tolerance", [(1, 1 / 128), (2, 0), (3, 1e-4), (4, 1e-4)])
def test_widths_and_channels(spark, tmp_path, width, tolerance):
    left = np.rint(speech_like([(2.3, 0.7)], 16_000, 1) * 1_000) / 32_768 * 8
    right = np.rint(speech_like([(2.3, 0.7)], 16_000, 2) * 1_000) / 32_768 * 8
    write_wav(tmp_path / "a.wav", [left, right], 16_000, width)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    h = headers.first()
    assert (h.sr, h.channels, h.sample_width, h.frames, h.error) == (16_000, 2, width, 36_800, None)
    for mode, want in (("first", left), ("mean", (left + right) / 2)):
        rows = audio.read_blocks(headers, mode).orderBy("block_no").collect()
        assert [(r.block_no, len(r.samples)) for r in rows] == [(0, 16_000), (1, 16_000), (2, 4_800)]
        got = np.concatenate([r.samples for r in rows]) / 32_768
        assert np.abs(got - want).max() <= tolerance + 0.5 / 32_768


def test_long_file_is_read_by_many_tasks(spark, tmp_path):
    x = np.rint(speech_like([(200, 0.5)], 8_000, 3) * 32_767) / 32_768
    write_wav(tmp_path / "long.wav", [x], 8_000)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    blocks = audio.read_blocks(headers, rate=8_000)
    rows = blocks.orderBy("block_no").collect()
    assert [r.block_no for r in rows] == list(range(200))
    np.testing.assert_array_equal(np.concatenate([r.samples for r in rows]) / 32_768, x)
    ranges = audio._ranges(headers, 8_000)
    assert ranges.count() == 4


def test_windows_of_resampled_files_equal_slices_of_the_whole(spark, tmp_path):
    x = speech_like([(3.1, 0.6)], 44_100, 4)
    write_wav(tmp_path / "a.wav", [x], 44_100)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    whole = np.concatenate([r.samples for r in audio.read_blocks(headers).orderBy("block_no").collect()])
    bounds = [(0, 100), (7, 16_001), (15_999, 16_000), (33_333, 44_444), (49_000, 60_000), (70_000, 70_001)]
    windows = spark.createDataFrame(
        [("a", f"{i}.wav", s, e) for i, (s, e) in enumerate(bounds)],
        "recording string, path string, start_sample long, end_sample long",
    )
    got = {r.path: r.samples for r in audio.read_windows(headers, windows, "path").collect()}
    want = {f"{i}.wav": whole[s:e].tolist() for i, (s, e) in enumerate(bounds)}
    assert got == {k: s for k, s in want.items() if s}


def test_bad_files_are_reported_and_do_not_stop_others(spark, tmp_path):
    write_wav(tmp_path / "good.wav", [np.zeros(1_600)], 16_000)
    (tmp_path / "bad.wav").write_bytes(b"not a wav file at all")
    (tmp_path / "cut.wav").write_bytes(b"RIFF\x00\x00\x00\x00WAVE")
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    errors = {r.stem: r.error for r in headers.collect()}
    assert errors["good"] is None and errors["bad"] and errors["cut"]
    assert [r.recording for r in audio.read_blocks(headers).collect()] == ["good"]


def chunk(name, data):
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def riff(fmt, data):
    body = b"WAVE" + chunk(b"fmt ", fmt) + chunk(b"LIST", b"odd") + chunk(b"data", data)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def fmt(code, channels, rate, bits, frame=None):
    frame = channels * bits // 8 if frame is None else frame
    return struct.pack("<HHIIHH", code, channels, rate, rate * frame, frame, bits)


SUBFORMAT = bytes.fromhex("000000001000800000aa00389b71")


def extensible(code, bits, tail=SUBFORMAT):
    return fmt(0xFFFE, 1, 16_000, bits) + struct.pack("<HHI", 22, bits, 4) + struct.pack("<H", code) + tail


def test_floating_point_and_extensible_formats(spark, tmp_path):
    x = np.array([0, 0.025, -0.5, 0.999, -1, 2, np.nan])
    want = [0, 819, -16_384, 32_735, -32_768, 32_767, 0]
    ints = np.clip(np.rint(np.nan_to_num(x) * 32_768), -32_768, 32_767).astype("<i2").tobytes()
    made = {
        "float32": riff(fmt(3, 1, 16_000, 32), x.astype("<f4").tobytes()),
        "float64": riff(fmt(3, 1, 16_000, 64), x.astype("<f8").tobytes()),
        "extfloat": riff(extensible(3, 32), x.astype("<f4").tobytes()),
        "extint": riff(extensible(1, 16), ints),
    }
    for name, data in made.items():
        (tmp_path / f"{name}.wav").write_bytes(data)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    got = {r.recording: r.samples for r in audio.read_blocks(headers).collect()}
    assert set(got) == set(made)
    for name, samples in got.items():
        assert np.abs(np.array(samples) - want).max() <= 1, name


def test_senseless_headers_are_errors(spark, tmp_path):
    bad = {
        "rate": fmt(1, 1, 0, 16), "channels": fmt(1, 0, 16_000, 16, 2), "align": fmt(1, 1, 16_000, 16, 0),
        "frame": fmt(1, 2, 16_000, 16, 2), "bits": fmt(1, 1, 16_000, 12, 2), "wide": fmt(1, 1, 16_000, 64),
        "alaw": fmt(6, 1, 16_000, 8), "half": fmt(3, 1, 16_000, 16), "short": b"\1\0\1\0",
        "guid": extensible(1, 16, b"\1" * 14), "noguid": fmt(0xFFFE, 1, 16_000, 16),
    }
    for name, described in bad.items():
        (tmp_path / f"{name}.wav").write_bytes(riff(described, b"\0" * 64))
    write_wav(tmp_path / "good.wav", [np.zeros(1_600)], 16_000)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    assert {r.stem: bool(r.error) for r in headers.collect()} == dict.fromkeys(bad, True) | {"good": False}
    assert [r.recording for r in audio.energies(headers).collect()] == ["good"]


def test_tasks_grow_with_the_work(spark, tmp_path):
    narrow = spark.range(1000).selectExpr("cast(id as string) as recording", "id as start_sample")
    assert spread(narrow, "recording", per_task=10).rdd.getNumPartitions() == 100
    assert spread(narrow, "recording", per_task=10_000).rdd.getNumPartitions() < 100


def test_deep_folders_are_listed_level_by_level(spark, tmp_path):
    folder = tmp_path / "one"
    for depth in range(3):
        for k in range(4):
            (folder / f"d{k}").mkdir(parents=True, exist_ok=True)
            (folder / f"d{k}" / f"x{depth}{k}.wav").write_bytes(b"")
        folder = folder / "d0"
    found = files.list_files(spark, str(tmp_path), recursive=True).collect()
    assert sorted(r.path for r in found) == sorted(str(p) for p in tmp_path.rglob("*.wav"))


def test_file_systems(monkeypatch):
    made = []

    def from_uri(uri):
        made.append(uri)
        return object(), uri.split("://")[1].rstrip("/") if uri.startswith("s3") else "/"

    class Stores:
        LocalFileSystem = storage.fs.LocalFileSystem
        FileSystem = SimpleNamespace(from_uri=from_uri)

    monkeypatch.setattr(storage, "fs", Stores)
    storage._connect.cache_clear()
    assert storage.resolve("s3a://bucket/a/b.wav")[1] == "bucket/a/b.wav"
    assert storage.resolve("s3://bucket/c")[1] == "bucket/c"
    assert storage.resolve("hdfs:/x/y")[1] == storage.resolve("hdfs:///x/y")[1] == "/x/y"
    assert made == ["s3://bucket/", "hdfs:///"]
    for local in ("/a:b/c", "file:/a:b/c", "file:///a:b/c"):
        assert storage.resolve(local)[1] == "/a:b/c"
    with pytest.raises(ValueError):
        storage.resolve("ftp://host/x")
    storage._connect.cache_clear()


def test_clips_are_written_as_wav_files(spark, tmp_path):
    rows = [("a_S1.wav", [1, -2, 3]), ("a_S2.wav", list(range(500)))]
    df = spark.createDataFrame(rows, "path string, samples array<short>")
    for _ in range(2):  # writing again gives the same files
        written = file_sinks.write_clips(df, str(tmp_path / "clips"), 16_000).collect()
    assert {r.file.rsplit("/", 1)[1] for r in written} == {"a_S1.wav", "a_S2.wav"}
    assert sorted(p.name for p in (tmp_path / "clips").iterdir()) == ["a_S1.wav", "a_S2.wav"]
    for name, samples in rows:
        with wave.open(str(tmp_path / "clips" / name)) as f:
            assert (f.getframerate(), f.getnchannels(), f.getsampwidth()) == (16_000, 1, 2)
            assert np.frombuffer(f.readframes(10_000), "<i2").tolist() == samples
