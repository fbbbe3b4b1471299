"""The language model against plain dictionaries, and on held-out texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from speechprep.llm import lm
from speechprep.llm.spans import texts_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORDS.findall((text or "").translate(AZ)), "</s>"]


def plain(rows, order, mass, fold=2):
    """(doc_id, held_out, n_tokens, n_known, N, base, score) from dictionaries."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == fold for i, _ in rows]
    grams = {n: Counter() for n in range(1, order + 1)}
    for (_, text), out in zip(rows, held):
        if out:
            continue
        seq = ["<s>", *tokens(text)]
        for n in grams:
            grams[n].update(
                tuple(seq[i - n + 1 : i + 1]) for i in range(1, len(seq)) if i - n + 1 >= 0
            )
    one = grams[1]
    total, kinds = sum(one.values()), len(one)
    n1, n2 = (sum(c == k for c in one.values()) for k in (1, 2))
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    trained = sum(not h for h in held)

    def probability(context, word):
        if not context:
            if not total:
                return 1.0
            c = one[(word,)]
            return (c - d) / total if c else d * kinds / total
        seen = trained if context == ("<s>",) else grams[len(context)][context]
        lower = probability(context[1:], word)
        return (grams[len(context) + 1][(*context, word)] + mass * lower) / (seen + mass)

    result = []
    for (number, text), out in zip(rows, held):
        seq = ["<s>", *tokens(text)]
        own = seq[1:]
        base = sum(math.log10((one[(w,)] + 1) / (total + kinds + 1)) for w in own)
        score = sum(
            math.log10(probability(tuple(seq[max(0, i - order + 1) : i]), seq[i]))
            for i in range(1, len(seq))
        )
        known = sum(one[(w,)] > 0 for w in own)
        result.append((number, out, len(own), known, total, base, score))
    return result


def run(spark, rows, order, mass, slices=3):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, part int")
    got = lm.score_texts(
        df.repartition(slices), lm.crc_fold(F.col("doc_id"), 7, 2), model=lm.Model(order, mass)
    )
    return [tuple(r) for r in got.collect()]


def compare(got, want):
    def key(row):
        return [str(row[0]), row[2], row[3], round(row[6], 6)]

    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm, "PART_BYTES", 4000)
    rng = random.Random(order)
    words = ["a", "A", "b", "the", "Ünï", "É", "é", "x.y", "\x1c"] + [f"w{i}" for i in range(60)]

    def text():
        n = rng.choice([0, 1, 2, 3, 40, 90])
        picked = [words[min(int(rng.expovariate(0.15)), len(words) - 1)] for _ in range(n)]
        return "".join(w + rng.choice([" ", "\n", "\t  "]) for w in picked)

    rows = [(i, text()) for i in range(150)] + [(900, None), (901, ""), (None, "a b the")]
    rows += [(5, rows[5][1]), (903, rows[4][1]), (904, "the " * 3000), (905, "new " * 9)]
    compare(run(spark, rows, order, 3.5), plain(rows, order, 3.5))


def test_without_training_texts_and_without_rows(spark):
    out = [(i, t) for i, t in ((i, "a b") for i in range(200)) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = run(spark, out, 2, 5.0)
    compare(got, plain(out, 2, 5.0))
    assert all(r[5] == r[6] == 0 for r in got)
    assert run(spark, [], 2, 5.0) == []


def test_probabilities_sum_to_one():
    """Over all known tokens and one unknown one, behind seen and unseen contexts."""
    data = ["a b c", "a b", "c a b b", "d", "", "a a"]
    vocabulary = sorted({w for t in data for w in tokens(t)} - {"</s>"})
    for context in ("a", "b", "zz"):
        cases = [f"{context} {w}" for w in [*vocabulary, "unseen"]] + [context]
        block = lm.Grams(texts_of(pa.array(data + cases)), 2)
        trains = np.arange(len(data) + len(cases)) < len(data)
        counts = {n: block.counts(n, trains) for n in (1, 2)}
        one = counts[1]
        totals = lm.Totals(one.sum(), (one > 0).sum(), (one == 1).sum(), (one == 2).sum())
        walk = lm.Automaton(block, counts, totals, lm.Model(2, 2.0)).walk()
        second = block.firsts[len(data) : -1] + 1
        assert (10 ** walk[second]).sum() == pytest.approx(1)


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    rng = random.Random(1)
    follow = {w: rng.sample(range(200), 3) for w in range(200)}
    rows = []
    for i in range(300):
        w, out = rng.randrange(200), []
        for _ in range(120):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        rows.append((i, " ".join(out)))
    held = [r for r in run(spark, rows, 2, 5.0) if r[1]]
    assert len(held) > 20
    assert all(r[6] > 0.5 * r[5] > r[5] for r in held)
