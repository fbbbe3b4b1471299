import numpy as np
import pytest
from pyspark.sql import functions as F
from wavs import speech_like, write_wav

from speechprep.operators import signal, silence
from speechprep.sources import audio, files

RATE = 16_000


def as_blocks(spark, recordings, block):
    rows = [
        (name, i // block, x[i : i + block].tolist())
        for name, x in recordings.items()
        for i in range(0, len(x), block)
    ]
    return spark.createDataFrame(rows, "recording string, block_no long, samples array<short>")


def chunks_by_loop(x, window, offset):
    """Segment one recording directly, millisecond by millisecond."""
    length = round(len(x) / 16)
    x = x.astype(np.int64)
    whole = int(np.sqrt((x * x).sum() / len(x)))
    limit = whole * 10 ** (-offset / 20)
    padded = np.concatenate([x, np.zeros(32, np.int64)])
    starts = []
    for i in range(length - window + 1):
        piece = padded[16 * i : 16 * (i + window)]
        if int(np.sqrt((piece * piece).sum() / (16 * window))) <= limit:
            starts.append(i)
    ranges = []
    for i in starts:
        if ranges and i - ranges[-1][1] <= window:
            ranges[-1][1] = i
        else:
            ranges.append([i, i])
    ranges = [(a, b + window) for a, b in ranges]
    if ranges == [(0, length)]:
        return ranges, []
    cuts = [0] + [(a + b) // 2 for a, b in ranges if a > 0 and b < length] + [length]
    return ranges, list(zip(cuts, cuts[1:]))


@pytest.fixture(scope="module")
def recordings():
    rng = np.random.default_rng(11)
    made = {}
    for i in range(14):
        parts = [(rng.integers(5, 90) / 1000, rng.choice([0.0, 0.01, 0.4, 0.6])) for _ in range(8)]
        x = speech_like(parts, RATE, seed=i)
        made[f"r{i}"] = (x * 20_000).astype(np.int16)[: len(x) - int(rng.integers(0, 20))]
    made["silent"] = np.zeros(3_200, np.int16)
    made["loud"] = np.full(3_200, 9_000, np.int16)
    made["short"] = np.full(100, 50, np.int16)
    return made


@pytest.mark.parametrize("window, offset, tile", [(10, 10, 16), (25, 6, 40), (50, 3, 60_000)])
def test_segments_match_a_loop(spark, recordings, window, offset, tile):
    energy = signal.energy_blocks(as_blocks(spark, recordings, 64))
    ranges = silence.silence_ranges(energy, 4, window, offset, tile_ms=tile)
    found = {}
    for r in ranges.collect():
        found.setdefault(r.recording, []).append((r.start_ms, r.end_ms))
    made = silence.segment(energy, 4, window, offset, tile_ms=tile).collect()
    got = {}
    for r in sorted(made, key=lambda r: r.chunk_no):
        assert r.chunk_no == len(got.setdefault(r.recording, []))
        got[r.recording].append((r.start_ms, r.end_ms))
    for name, x in recordings.items():
        want_ranges, want_chunks = chunks_by_loop(x, window, offset)
        assert sorted(found.get(name, [])) == want_ranges, name
        assert got.get(name, []) == want_chunks, name


def test_segments_of_files_match_segments_of_blocks(spark, recordings, tmp_path):
    for name, x in recordings.items():
        write_wav(tmp_path / f"{name}.wav", [x / 32_768], RATE)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    energy = signal.energy_blocks(as_blocks(spark, recordings, 64))
    picture = lambda df: sorted(
        (r.recording, r.chunk_no, r.start_ms, r.end_ms) for r in df.collect()
    )
    assert picture(audio.segment(headers, 25, 6, tile_ms=40)) == picture(
        silence.segment(energy, 4, 25, 6)
    )


def test_loudness(spark, recordings):
    energy = signal.energy_blocks(as_blocks(spark, recordings, 64))
    for r in signal.loudness(energy).collect():
        x = recordings[r.recording].astype(np.int64)
        rms = int(np.sqrt((x * x).sum() / len(x)))
        assert (r.n_samples, r.rms, r.length_ms) == (len(x), rms, round(len(x) / 16))
        assert r.dbfs == pytest.approx(20 * np.log10(rms / 32_768)) if rms else r.dbfs is None


def test_the_audio_is_looked_at_once_per_pass(spark, recordings):
    energy = signal.energy_blocks(as_blocks(spark, recordings, 64))
    loud = signal.loudness(energy)
    runs = silence.find_runs(energy, loud, 4, 25, 6, tile_ms=40)
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [runs(") == 1
    assert plan.count("ArrowEvalPython [energies(") == 2  # loudness, then runs


def test_downmix(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 6.0], [5.0, 1.0]],), ([[7.0]],)], "c array<array<double>>")
    got = df.select(signal.downmix(F.col("c")).alias("m"), signal.downmix(F.col("c"), "first").alias("f"))
    assert [(r.m, r.f) for r in got.collect()] == [([3.0, 3.0], [1.0, 2.0]), ([7.0], [7.0])]


def resample_by_definition(x, source, target):
    """Each output sample from the continuous filter, one at a time."""
    base = min(source, target) * 0.99
    n = -(-len(x) * target // source)
    times = np.arange(len(x)) / source
    out = []
    for m in range(n):
        t = (times - m / target) * base
        h = np.sinc(t) * np.cos(np.clip(t, -6, 6) * np.pi / 12) ** 2 * (np.abs(t) < 6)
        out.append((x * h).sum() * base / source)
    return np.array(out)


@pytest.mark.parametrize("source, target", [(8_000, 16_000), (44_100, 16_000), (22_050, 16_000), (32_000, 16_000)])
def test_resampling(spark, source, target):
    rng = np.random.default_rng(1)
    n = source // 20 * 3 + 17
    x = (rng.normal(0, 1, n) * 3_000).astype(np.int16)
    _, _, step, _ = signal.resampling_kernel(source, target)
    block = step * max(1, 1_000 // step)
    out = signal.resample(as_blocks(spark, {"r": x}, block), source, target, block)
    got = np.concatenate([r.samples for r in out.orderBy("block_no").collect()])
    np.testing.assert_allclose(got, resample_by_definition(x, source, target), atol=1e-6)


def test_resampling_refuses_blocks_that_do_not_line_up(spark):
    with pytest.raises(ValueError):
        signal.resample(as_blocks(spark, {"r": np.zeros(10, np.int16)}, 10), 44_100, 16_000, 1_000)


def test_a_steady_tone_keeps_its_pitch_and_level(spark, tmp_path):
    t = np.arange(44_100 * 3) / 44_100
    tone = 0.5 * np.sin(2 * np.pi * 440 * t)
    write_wav(tmp_path / "tone.wav", [tone], 44_100)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    rows = audio.read_blocks(headers).orderBy("block_no").collect()
    got = np.concatenate([r.samples for r in rows]) / 32_768
    assert len(got) == 48_000 and [len(r.samples) for r in rows] == [16_000] * 3
    want = 0.5 * np.sin(2 * np.pi * 440 * np.arange(48_000) / 16_000)
    assert np.abs(got - want)[200:-200].max() < 1e-3


def test_cut_samples_across_blocks(spark):
    x = {"a": np.arange(1_000, dtype=np.int16), "b": -np.arange(500, dtype=np.int16)}
    windows = [("a", "w0", 0, 64), ("a", "w1", 63, 65), ("a", "w2", 990, 2_000), ("b", "w3", 100, 400),
               ("b", "w4", 500, 600), ("a", "w5", 5, 5)]
    df = spark.createDataFrame(windows, "recording string, path string, start_sample long, end_sample long")
    got = {r.path: r.samples for r in signal.cut_samples(df, as_blocks(spark, x, 64), 64).collect()}
    want = {p: x[r][a:b].tolist() for r, p, a, b in windows}
    assert got == {p: s for p, s in want.items() if s}


def test_blocks_kept_in_buckets_are_not_shuffled_again(spark):
    x = {"a": np.arange(1_000, dtype=np.int16)}
    audio.write_block_table(as_blocks(spark, x, 64), "kept_blocks", 4)
    try:
        windows = spark.createDataFrame(
            [("a", "w", 10, 100)], "recording string, path string, start_sample long, end_sample long"
        )
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        cut = signal.cut_samples(windows, spark.table("kept_blocks"), 64)
        plan = cut._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("FileScan")
        assert "Exchange" not in plan[plan.rindex("Sort [recording", 0, scan) : scan]
        assert cut.first().samples == list(range(10, 100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE kept_blocks")
