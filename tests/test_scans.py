"""One-pass scans, edit distances without a cap, and documents of any length."""

import random
import resource

import pytest
from pyspark.sql import functions as F
from test_manifest import XML

from speechprep.functions import edits
from speechprep.operators import history, running
from speechprep.sources import annotations

# edit distances


def table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance_equals_the_table():
    rng = random.Random(4)
    for _ in range(600):
        kinds = rng.choice([1, 2, 5, 50])
        a, b = ([f"w{rng.randrange(kinds)}" for _ in range(rng.choice([0, 1, 2, 9, 40, 130]))] for _ in range(2))
        if rng.random() < 0.3:
            b = a[: len(a) // 2] + b[:3] + a[len(a) // 2 + 1 :]
        assert edits.edit_distance(a, b) == edits.edit_distance(b, a) == table(a, b)


def test_more_distinct_words_than_characters(spark):
    many = [f"{i:x}" for i in range(1_100_000)]
    changed = [*many[:500_000], "q q", *many[500_003:], "r"]  # three words become two, one is added
    pairs = spark.createDataFrame(
        [(1, " ".join(many), " ".join(changed)), (2, " ".join(many), "a b zz"), (3, "a b c", "a c"), (4, None, "a")],
        "id int, ref string, hyp string",
    )
    got = {r.id: r.n for r in pairs.select("id", edits.word_edits(F.col("ref"), F.col("hyp")).alias("n")).collect()}
    assert got == {1: 4, 2: 1_100_000 - 2, 3: 1, 4: None}


# early stopping


def stop(wers, patience):
    best, idle, at = None, 0, None
    for step, wer in wers:
        if best is None or (wer is not None and wer < best):
            best, idle = wer if wer is not None else best, 0
        else:
            idle += 1
            if idle >= patience and at is None and wer is not None:
                at = step
    return at


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_early_stop_in_one_pass(spark, monkeypatch, block):
    monkeypatch.setattr(running, "WIDE", 4)
    rng = random.Random(block)
    rows, want = [], {}
    for run in range(40):
        steps = sorted(rng.sample(range(0, 5_000_000 if run % 2 else 120), rng.choice([1, 2, 12, 60])))
        wers = [(s, rng.choice([None, 0.5, 0.25, rng.random()]) if run % 3 else rng.random()) for s in steps]
        rows += [(f"r{run}", s, w) for s, w in wers]
        want[f"r{run}"] = len(wers), stop(wers, 5)
    given = spark.createDataFrame(rows, "run string, step long, wer double").repartition(4)
    got = history.early_stop(given, patience=5, block=block)
    assert {r.run: (r.n_evals, r.stop_step) for r in got.collect()} == want
    assert history.early_stop(given.limit(0)).collect() == []


def test_rows_are_read_twice_with_one_carry(spark):
    given = spark.range(1000).selectExpr("string(id % 3) as run", "id as step", "rand(1) as wer")
    seen = running.first_least(given, ["run"], "step", F.col("wer"), "n", "best")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = seen._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    rows = [x for x in plan if "Exchange hashpartitioning(run" in x and "_block_" in x and "Reused" not in x]
    assert len(rows) == sum("Range (" in x for x in plan) == 2


# documents


def chunks(count, tag):
    yield b"<TEXT>"
    body = b'<%s id="N%d"><AUDIO start="1" end="2"/><FORM>%s</FORM><X><Y/></X></%s> tail \n'
    for i in range(0, count, 100):
        yield b"".join(body % (tag, k, b"word " * 20, tag) for k in range(i, i + 100))
    yield b"</TEXT>"


def test_a_long_document_is_read_in_little_memory():
    """60 MB, whose sentences turn out to be S only at its end."""

    def read():
        parts = chunks(330_000, b"W")
        last = next(parts)
        for part in parts:
            yield last
            last = part
        yield b'<S id="late"><FORM>only</FORM></S>' + last

    assert sum(map(len, chunks(330_000, b"W"))) > 50 << 20
    list(annotations._nodes(lambda: chunks(1_000, b"W")))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert list(annotations._nodes(read)) == [(0, "late", "only", None, None, "no audio")]
    assert sum(1 for _ in annotations._nodes(lambda: chunks(330_000, b"W"))) == 330_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 20 << 10  # kB


@pytest.mark.parametrize("size", [1, 7, 1 << 16])
def test_documents_in_chunks_and_from_files(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(annotations, "CHUNK", size)
    encoded = XML.replace("é", "e").encode("utf-8")
    bad = encoded[:-5]
    late = encoded.replace(b"</TEXT>", b"&nothing;</TEXT>")
    latin = '<?xml version="1.0" encoding="iso-8859-1"?><TEXT><W id="1"><FORM>só</FORM></W></TEXT>'.encode("latin-1")
    made = {"good": encoded, "bad": bad, "late": late, "latin": latin, "empty": b"", "root": b"<S id='1'/>"}
    for name, data in made.items():
        (tmp_path / f"{name}.xml").write_bytes(data)
    listed = [(n, str(tmp_path / f"{n}.xml")) for n in [*made, "none"]] + [("unpaired", None)]
    paired = spark.createDataFrame(listed, "stem string, annotation string")
    whole = annotations.parse_annotations(annotations.read_documents(paired))
    from_files = annotations.parse_files(paired)
    rows = sorted(map(tuple, from_files.collect()), key=str)
    assert rows == sorted(map(tuple, whole.collect()), key=str)
    reasons = {r[0]: r[-1] for r in rows if r[0] != "good"}
    assert reasons == {
        "bad": "bad document", "late": "bad document", "empty": "bad document",
        "none": "unreadable document", "latin": "no audio",
    }
    assert sum(r[0] == "good" for r in rows) > 5
    assert next(r for r in rows if r[0] == "latin")[3] == "só"
