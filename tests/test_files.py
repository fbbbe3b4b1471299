"""Tables of tiles, packed windows, listings as a data source, and published files."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from wavs import speech_like, write_wav

from speechprep.operators import ordering
from speechprep.operators.vocab import Alphabet
from speechprep.sinks import files as file_sinks
from speechprep.sinks import publish
from speechprep.sources import audio, files, listing, tiles


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# tiles


def blocks_of(spark, recordings, size):
    rows = [
        (name, k // size, x[k : k + size].tolist())
        for name, x in recordings.items()
        for k in range(0, len(x), size)
    ]
    return spark.createDataFrame(rows, "recording string, block_no long, samples array<short>").repartition(4)


def clips_of(spark, rows):
    return spark.createDataFrame(
        rows, "path string, sentence string, recording string, start_sample long, end_sample long"
    )


ALPHABET = Alphabet(tuple("abc|") + ("[UNK]", "[PAD]"))


@pytest.mark.parametrize("tile_blocks", [1, 3, 100])
def test_training_rows_from_tiles(spark, no_broadcast, tile_blocks):
    rng = np.random.default_rng(4)
    recordings = {n: rng.integers(-9_000, 9_000, k).astype(np.int16) for n, k in (("hot", 5_003), ("r", 300), ("s", 10))}
    kept = tiles.write_tiles(blocks_of(spark, recordings, 50), 3, 50, tile_blocks, longest=240)
    rows, want = [], {}
    for i in range(120):
        name = ("hot", "hot", "r", "s")[i % 4]
        start = int(rng.integers(0, len(recordings[name])))
        end = start + int(rng.integers(1, 241))
        rows.append((f"{i}.wav", "ab c"[: i % 5], name, start, end))
        want[f"{i}.wav"] = recordings[name][start:end]
    rows.append(("past.wav", "a", "r", 300, 400))
    rows.append(("gone.wav", "a", "no recording", 0, 10))
    made = tiles.training_rows(clips_of(spark, rows), kept, ALPHABET, batch_size=4)

    plan = made._jdf.queryExecution().executedPlan().toString().splitlines()
    audio_columns = re.compile(r"(?<!n_)samples#|pieces?#")
    scans = [line for line in plan if "FileScan" in line and audio_columns.search(line.split("Batched")[0])]
    assert len(scans) == 1 and "Bucketed: true" in scans[0]
    assert not any(audio_columns.search(line) for line in plan if "Exchange" in line)
    assert any("Exchange hashpartitioning(recording" in line for line in plan)

    got = {r.path: r for r in made.collect()}
    assert set(got) == set(want)
    longest = {}
    for r in got.values():
        key = r.shard, r.batch_no
        longest[key] = max(longest.get(key, 0), len(want[r.path]))
    for path, r in got.items():
        own = want[path].astype(np.float64) / 32_768
        scaled = (own - own.mean()) / np.sqrt(own.var() + 1e-7)
        assert len(r.input_values) == len(r.attention_mask) == longest[r.shard, r.batch_no]
        np.testing.assert_allclose(r.input_values[: len(own)], scaled, rtol=1e-5, atol=1e-6)
        assert sum(r.attention_mask) == len(own) and not any(r.input_values[len(own) :])
    assert max(Counter((r.shard, r.batch_no) for r in got.values()).values()) == 4
    labels = got["4.wav"].labels
    assert [x for x in labels if x != -100] == [0, 1, 3, 2]
    kept.drop(spark)


def test_clips_longer_than_the_margin_fail(spark):
    kept = tiles.write_tiles(blocks_of(spark, {"r": np.arange(900, dtype=np.int16)}, 50), 2, 50, 4, longest=100)
    clips = clips_of(spark, [("a.wav", "a", "r", 0, 101)])
    with pytest.raises(Exception, match="longer than 100 samples"):
        tiles.training_rows(clips, kept, ALPHABET).collect()
    assert tiles.training_rows(clips.limit(0), kept, ALPHABET).collect() == []
    kept.drop(spark)


# packing


def test_packed_by_weight(spark):
    rows = spark.range(2_000).select(
        F.col("id"), F.when(F.col("id") % 100 == 0, 5_000).otherwise(F.col("id") % 7).alias("w")
    )
    tasks = ordering.packed(rows.repartition(5), [F.col("id")], F.col("w"), 20_000, rows_per_range=300)
    got = tasks.select("id", "w", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.id for r in got) == list(range(2_000))
    per_task = Counter()
    for r in got:
        per_task[r.p] += r.w
    assert len(per_task) >= 5 and max(per_task.values()) <= 20_000 + 5_000
    # stretches of the order: a task's rows lie before the next one's
    ends = {p: (min(r.id for r in got if r.p == p), max(r.id for r in got if r.p == p)) for p in per_task}
    bounds = [ends[p] for p in sorted(ends)]
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    assert ordering.packed(rows.limit(0), [F.col("id")], F.col("w"), 10).collect() == []


def test_windows_are_packed_by_bytes(spark, tmp_path, monkeypatch):
    write_wav(tmp_path / "long.wav", [speech_like([(30, 0.5)], 16_000, 3)], 16_000)
    for k in range(40):
        write_wav(tmp_path / f"s{k:02}.wav", [speech_like([(0.1, 0.5)], 8_000, k)] * 2, 8_000)
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path)))
    spans = [("long", i * 8_000, i * 8_000 + 16_000) for i in range(58)] + [(f"s{k:02}", 0, 9_999) for k in range(40)]
    windows = spark.createDataFrame(
        [(r, f"{i}.wav", s, e) for i, (r, s, e) in enumerate(spans)],
        "recording string, path string, start_sample long, end_sample long",
    )
    placed = windows.withColumnRenamed("path", "clip").join(
        headers.withColumnRenamed("stem", "recording").drop("error"), "recording"
    )
    dealt = audio.packed_windows(placed, 16_000, per_task=400_000)
    rows = dealt.select("path", "recording", F.spark_partition_id().alias("p"), audio.window_bytes(16_000).alias("w")).collect()
    per_task, opened = Counter(), Counter()
    for r in rows:
        per_task[r.p] += r.w
    for _, p in {(r.path, r.p) for r in rows}:
        opened[p] += 1
    assert max(per_task.values()) <= 400_000 + max(r.w for r in rows)
    assert sum(opened.values()) <= len({r.path for r in rows}) + len(per_task)  # cut at most between tasks
    got = {r.path: len(r.samples) for r in audio.read_windows(headers, windows, "path").collect()}
    assert got == {f"{i}.wav": 16_000 if r == "long" else 1_600 for i, (r, _, _) in enumerate(spans)}


def test_overlapping_ranges_are_read_once(tmp_path):
    (tmp_path / "a").write_bytes(bytes(range(256)) * 4)
    (tmp_path / "b").write_bytes(b"other")
    whole, ranges = bytes(range(256)) * 4, audio.ByteRanges()
    for low, high in ((0, 10), (5, 50), (5, 20), (20, 60), (300, 310), (310, 320), (0, 4), (1_000, 1_100)):
        assert ranges.read(str(tmp_path / "a"), low, high) == whole[low:high]
    assert ranges.read(str(tmp_path / "b"), 1, 3) == b"th"
    ranges.close()


# listings


def test_conditions_on_names_are_pushed(spark, tmp_path):
    for name in ("a.wav", "b.WAV", "c.txt", "checkpoint-1", "é.wav"):
        (tmp_path / name).write_bytes(b"x" * len(name))
    (tmp_path / "checkpoint-2").mkdir()

    def entries(*conditions):
        level = files._level(spark, files._root(spark, str(tmp_path)))
        return level.filter(F.expr(" and ".join(f"({c})" for c in conditions)))

    def names(*conditions):
        return {r.name for r in entries(*conditions).collect()}

    ends = entries("endswith(name, '.wav')")
    assert "Filter " not in ends._jdf.queryExecution().executedPlan().toString()
    assert {r.name for r in ends.collect()} == {"a.wav", "é.wav"}
    assert names("directory") == {"checkpoint-2"}
    assert names("not directory", "name like 'checkpoint%'") == {"checkpoint-1"}
    assert names("name in ('c.txt', 'd') or length = 12", "not directory") == {"c.txt", "checkpoint-1"}
    assert names("length = 5", "name <> 'é.wav'") == {"a.wav", "b.WAV", "c.txt"}
    assert names("name like '%.W%'") == {"b.WAV"} and names("name = 'c.txt'") == {"c.txt"}


def test_a_level_is_cut_into_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "FOLDERS_PER_TASK", 10)
    for k in range(45):
        (tmp_path / f"d{k}" / "deep").mkdir(parents=True)
        (tmp_path / f"d{k}" / "deep" / "x.wav").write_bytes(b"")
    level = spark.createDataFrame([(str(tmp_path / f"d{k}"),) for k in range(45)], "path string").coalesce(1)
    assert files._level(spark, level).rdd.getNumPartitions() >= 5
    assert files._level(spark, level.limit(0)).collect() == []
    found = files.scan_recordings(spark, str(tmp_path), recursive=True)
    assert found.count() == 45 and {r.stem for r in found.collect()} == {"x"}


# publishing


def clips_table(spark, n=30):
    return spark.range(n).repartition(4).selectExpr(
        "concat('c', id, '.wav') as path", "array(smallint(id), smallint(-id)) as samples"
    )


def test_clips_are_published_with_their_digests(spark, tmp_path):
    for _ in range(2):  # writing again gives the same files
        written = file_sinks.write_clips(clips_table(spark), f"file:{tmp_path}/clips", 16_000).collect()
        assert len(written) == 30
    names = sorted(p.name for p in (tmp_path / "clips").iterdir())
    assert names == sorted(f"c{k}.wav" for k in range(30))
    for r in written:
        data = (tmp_path / "clips" / r.file.rsplit("/", 1)[1]).read_bytes()
        assert (r.bytes, r.md5) == (len(data), hashlib.md5(data).hexdigest())


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    bad = F.when(F.col("path") == "c17.wav", F.raise_error(F.lit("broken")).cast("array<short>"))
    clips = clips_table(spark).withColumn("samples", F.coalesce(bad, F.col("samples")))
    with pytest.raises(Exception, match="broken"):
        file_sinks.write_clips(clips, str(tmp_path / "clips"), 16_000)
    assert not list((tmp_path / "clips").rglob("*.*")) and not list((tmp_path / "clips").iterdir())


def test_files_of_attempts_that_did_not_count_are_not_published(spark, tmp_path):
    def write(folder):
        def stage(batches):
            for batch in batches:
                for path in batch["path"].to_pylist():
                    for attempt in range(2):  # the first is not reported
                        name = publish.staged_name(folder)
                        size = file_sinks._store(name, f"{path} {attempt}".encode())
                    yield publish.staged_batch([(f"{tmp_path}/out/{path}", name, size, "")])

        return clips_table(spark, 5).mapInArrow(stage, "file string, staged string, bytes long, md5 string")

    assert publish.published(write, str(tmp_path / "out")).count() == 5
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == {f"c{k}.wav": f"c{k}.wav 1" for k in range(5)}


def test_equal_names_are_an_error(spark, tmp_path):
    twice = clips_table(spark, 3).union(clips_table(spark, 1))
    with pytest.raises(ValueError, match="c0.wav"):
        file_sinks.write_clips(twice, str(tmp_path / "clips"), 16_000)
    assert not list((tmp_path / "clips").iterdir())


def test_a_move_that_another_attempt_made(tmp_path):
    (tmp_path / "staged").write_text("x")
    publish._move(str(tmp_path / "staged"), str(tmp_path / "out" / "a"))
    publish._move(str(tmp_path / "staged"), str(tmp_path / "out" / "a"))  # again: done already
    assert (tmp_path / "out" / "a").read_text() == "x"
    with pytest.raises(OSError):
        publish._move(str(tmp_path / "none"), str(tmp_path / "out" / "b"))


def test_recordings_are_streamed_into_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    made = {f"r{k}.wav": rng.integers(-32_768, 32_768, 100 * k + 7).astype(np.int16) for k in range(4)}
    rows = [
        (name, i // 50, 8_000, name in ("r1.wav", "r3.wav"), x[i : i + 50].tolist())
        for name, x in made.items() for i in range(0, len(x), 50)
    ]
    blocks = spark.createDataFrame(
        rows, "path string, block_no long, rate int, floating boolean, samples array<short>"
    ).repartition(5)
    written = file_sinks.write_recordings(blocks, str(tmp_path / "wav")).collect()
    for r in written:
        data = (tmp_path / "wav" / r.file.rsplit("/", 1)[1]).read_bytes()
        assert (r.bytes, r.md5) == (len(data), hashlib.md5(data).hexdigest())
    headers = audio.read_headers(files.scan_recordings(spark, str(tmp_path / "wav")))
    assert {r.stem: r.floating for r in headers.collect()} == {f"r{k}": k in (1, 3) for k in range(4)}
    got = audio.read_blocks(headers, rate=8_000).collect()
    assert {f"{r.recording}.wav": list(r.samples) for r in got} == {n: x.tolist() for n, x in made.items()}
