import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechprep.operators import split
from speechprep.operators import vocab as vc


def clips(spark, recordings, per=3):
    return spark.range(recordings * per).selectExpr(
        f"concat('R', id div {per}, '_S00', id % {per}, '.wav') as path",
        "'x' as sentence",
        f"concat('R', id div {per}) as recording",
    )


@pytest.mark.parametrize("n", [1, 9, 10, 25, 137])
def test_sizes_and_no_leak(spark, n):
    assigned = split.assign_splits(clips(spark, n))
    per = {r.split: r for r in split.split_summary(assigned).collect()}
    b = n // 10
    assert {k: r.n_recordings for k, r in per.items()} == {
        "train": n - 2 * b, "valid": b, "test": b,
    }
    assert sum(r.n_clips for r in per.values()) == 3 * n
    assert split.leaked_recordings(assigned, "recording").count() == 0


def test_same_split_for_any_partitioning_and_other_for_another_seed(spark):
    rows = clips(spark, 60)
    picture = lambda df: sorted((r.path, r.split) for r in df.select("path", "split").collect())
    base = picture(split.assign_splits(rows))
    for n in (1, 4, 16):
        assert picture(split.assign_splits(rows.repartition(n))) == base
    assert picture(split.assign_splits(rows, seed=7)) != base


def test_one_recording_with_most_clips_is_not_shuffled(spark):
    rows = clips(spark, 30).unionByName(
        spark.range(5000).selectExpr(
            "concat('R3_S1', id, '.wav') as path", "'x' as sentence", "'R3' as recording"
        )
    )
    assigned = split.assign_splits(rows)
    # the tree itself, without the subquery that finds the cuts
    names, todo = set(), [assigned._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        names.add(node.nodeName())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert names <= {"Project", "Union", "Range"}
    assert split.leaked_recordings(assigned, "recording").count() == 0


def test_recording_key(spark):
    names = ["A_S001.wav", "A_B_S12_x.wav", "A_A_S001.wav", "A_w1.wav", "a_S1_S2.wav"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r.k for r in df.select(split.recording_key(F.col("p")).alias("k")).collect()]
    assert got == ["A", "A_B", "A_A", "A_w1.wav", "a"]


def sentences(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "sentence string")


def table(vocab):
    return {r["char"]: r["id"] for r in vocab.collect()}


def test_vocabulary(spark):
    vocab = vc.vocabulary(sentences(spark, "ab a", "c"), sentences(spark, "b"))
    expected = {"a": 0, "b": 1, "c": 2, "|": 3, "[UNK]": 4, "[PAD]": 5}
    assert table(vocab) == expected
    assert json.loads(vc.vocabulary_json(vocab).first().json) == expected


def test_separator_needs_a_space_or_two_sentences(spark):
    assert "|" not in table(vc.vocabulary(sentences(spark, "ab"), sentences(spark, "c")))
    assert "|" in table(vc.vocabulary(sentences(spark, "ab", ""), sentences(spark, "c")))
    assert "|" in table(vc.vocabulary(sentences(spark, "a b")))
    assert table(vc.vocabulary(sentences(spark, ""))) == {"[UNK]": 0, "[PAD]": 1}


def test_code_point_order_beyond_the_bmp(spark):
    chars = ["\U00020000", "￮", "z", "é"]
    vocab = table(vc.vocabulary(sentences(spark, "".join(chars))))
    assert [c for c in vocab if len(c) == 1] == sorted(chars)


def test_encode_and_decode(spark):
    alphabet = vc.Alphabet.load(vc.vocabulary(sentences(spark, "ab a", "c")))
    assert (alphabet.unknown_id, alphabet.pad_id) == (4, 5)
    df = sentences(spark, "a b|c", "", "aa\U00020000b ", None)
    rows = df.select(alphabet.encode(F.col("sentence")).alias("l")).collect()
    assert [r.l for r in rows] == [[0, 3, 1, 3, 2], [], [0, 0, 4, 1, 3], None]
    labels = spark.createDataFrame([([0, 0, 3, 1, -100, 5, 3],)], "l array<int>")
    assert labels.select(alphabet.decode(F.col("l")).alias("t")).first().t == "aa b"
