"""Features, batches, decoding, metrics, training history."""

import random

import numpy as np
from pyspark.sql import functions as F

from speechprep.operators import batches, ctc, history, metrics, running


def test_scaled_features(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(3, 2, n).astype(np.float32).tolist()) for i, n in enumerate([1, 5, 400])]
    rows.append((9, []))
    df = spark.createDataFrame(rows, "i int, x array<float>")
    got = {r.i: r.y for r in df.select("i", batches.scale_features(F.col("x")).alias("y")).collect()}
    for i, x in rows:
        x = np.array(x)
        want = (x - x.mean()) / np.sqrt(x.var() + 1e-7) if len(x) else x
        np.testing.assert_allclose(got[i], want, atol=1e-5)


def test_length_batches(spark):
    df = spark.range(1000).selectExpr("id", "cast(id * 7919 % 501 as int) as n")
    rows = batches.length_batches(df, "id", F.col("n"), batch_size=8).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.shard, r.batch_no), []).append(r.n)
    assert len(rows) == 1000 and max(map(len, groups.values())) == 8
    by_shard = {}
    for (shard, _), lengths in sorted(groups.items()):
        by_shard.setdefault(shard, []).extend([sorted(lengths, reverse=True)])
    for lists in by_shard.values():  # batches follow each other from long to short
        assert all(a[-1] >= b[0] for a, b in zip(lists, lists[1:]))
        assert all(len(b) == 8 for b in lists[:-1])


def test_padding(spark):
    rows = [(0, [1.0, 2.0, 3.0], [1]), (0, [4.0], [2, 3]), (1, [5.0], [4])]
    df = spark.createDataFrame(rows, "batch_no int, input_values array<double>, labels array<int>")
    got = {tuple(r.input_values): (r.attention_mask, r.labels) for r in batches.pad_batches(df, ["batch_no"]).collect()}
    assert got == {
        (1.0, 2.0, 3.0): ([1, 1, 1], [1, -100]),
        (4.0, 0.0, 0.0): ([1, 0, 0], [2, 3]),
        (5.0,): ([1], [4]),
    }
    wide = batches.pad_batches(df, ["batch_no"], inputs_multiple=4, min_labels=3).collect()
    assert {len(r.input_values) for r in wide} == {4}
    assert {len(r.labels) for r in wide} == {3}


def greedy(frames, blank, chars):
    out, last = [], None
    for scores in frames:
        best = int(np.argmax(scores))
        if best != last and best != blank:
            out.append(chars[best])
        last = best
    return "".join(out).replace("|", " ").strip()


def test_ctc_matches_a_loop(spark):
    rng = np.random.default_rng(3)
    chars = ["a", "b", "|", "[PAD]"]
    rows = []
    for i in range(60):
        frames = rng.integers(0, 3, (int(rng.integers(0, 12)), 4)).astype(float)  # many ties
        rows.append((i, frames.tolist()))
    df = spark.createDataFrame(rows, "i int, frames array<array<double>>")
    decoded = df.select("i", ctc.decode(F.col("frames"), F.array(*map(F.lit, chars)), 3).alias("t"))
    got = {r.i: r.t for r in decoded.collect()}
    assert got == {i: greedy(f, 3, chars) for i, f in rows}


def test_blank_keeps_equal_neighbours_apart(spark):
    df = spark.createDataFrame([([0, 0, 3, 0, 1, 1],), ([],), ([3, 3],)], "ids array<int>")
    got = [r.c for r in df.select(ctc.collapse(F.col("ids"), 3).alias("c")).collect()]
    assert got == [[0, 0, 1], [], []]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_error_rates_match_dynamic_programming(spark):
    rng = random.Random(5)
    words = ["a", "bb", "cé", "d", "\U00020000x", "e"]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 15)))
    pairs = [(i % 3, line(), line()) for i in range(80)] + [(0, "same text", "same text")]
    df = spark.createDataFrame(pairs, "g int, reference string, hypothesis string")
    wer = {r.g: (r.edits, r.ref_words) for r in metrics.word_error_rate(df, ["g"]).collect()}
    cer = {r.g: (r.edits, r.ref_chars) for r in metrics.char_error_rate(df, ["g"]).collect()}
    for g in range(3):
        mine = [(a, b) for k, a, b in pairs if k == g]
        assert wer[g] == (
            sum(distance(a.split(), b.split()) for a, b in mine), sum(len(a.split()) for a, _ in mine)
        )
        assert cer[g] == (sum(distance(a, b) for a, b in mine), sum(len(a) for a, _ in mine))
    same = df.filter("reference = hypothesis")
    assert metrics.word_error_rate(same).first().wer == 0
    everything = metrics.word_error_rate(df).first()
    assert everything.edits == sum(e for e, _ in wer.values())


def test_running_aggregates_match_a_loop(spark, monkeypatch):
    rng = random.Random(9)
    rows = []
    for key in ("a", "b", "hot"):
        places = rng.sample(range(500), 300 if key == "hot" else 40)
        rows += [(key, p, rng.randint(1, 9)) for p in places]
    df = spark.createDataFrame(rows, "k string, p long, x long").repartition(7)
    outputs = {
        "s": ("sum", F.col("x")), "lo": ("min", F.col("x")), "hi": ("max", F.col("x")),
        "n": ("sum", F.lit(1)),
    }
    want = {}
    for key in ("a", "b", "hot"):
        seen = []
        for _, p, x in sorted(r for r in rows if r[0] == key):
            want[key, p] = (sum(seen), min(seen, default=None), max(seen, default=None), len(seen))
            seen.append(x)
    for block, wide in ((1, 4096), (1, 3), (7, 2), (64, 4096), (4096, 4096)):
        monkeypatch.setattr(running, "WIDE", wide)
        got = running.before(df, ["k"], "p", outputs, block).collect()
        assert {(r.k, r.p): (r.s, r.lo, r.hi, r.n) for r in got} == want


def test_windows_over_rows_are_bounded_by_blocks(spark):
    df = spark.range(10).selectExpr("'a' as k", "id as p", "id as x")
    plan = running.before(df, ["k"], "p", {"s": ("sum", F.col("x"))})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    row_windows = [line for line in text.splitlines() if "Window [sum(x" in line]
    assert row_windows and all("_block_65536" in line for line in row_windows)


def stop_by_loop(scores, patience):
    best, idle = None, 0
    for i, score in enumerate(scores):
        if best is None or score < best:
            best, idle = score, 0
        else:
            idle += 1
        if idle >= patience:
            return i
    return None


def test_history(spark):
    rng = random.Random(2)
    runs = {r: [rng.randint(0, 40) / 10 for _ in range(60)] for r in range(20)}
    runs[99] = [1.0] * 11
    runs[98] = [1.0] * 10
    rows = [(r, 100 * i, s) for r, scores in runs.items() for i, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "run int, step long, wer double")
    for block in (300, 4096):
        got = {r.run: r.stop_step for r in history.early_stop(df, 10, block).collect()}
        for r, scores in runs.items():
            at = stop_by_loop(scores, 10)
            assert got[r] == (None if at is None else 100 * at)
    best = {r.run: (r.best_step, r.best_wer) for r in history.best_step(df).collect()}
    assert best == {r: (100 * s.index(min(s)), min(s)) for r, s in runs.items()}


def test_latest_checkpoint_compares_numbers(spark):
    names = ["checkpoint-900", "checkpoint-1000", "checkpoint-old", "other"]
    df = spark.createDataFrame([("r", n) for n in names], "run string, name string")
    assert history.latest_checkpoint(df).first().checkpoint == "checkpoint-1000"
