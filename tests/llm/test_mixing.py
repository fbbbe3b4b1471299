"""Mixing against sorting, fill-in-the-middle against slicing, vector codes against
brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechprep.llm import codes, fim, mixing
from speechprep.llm.spans import texts_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

# mixing


def mixed(rows, weights, repeats=3, seed=7, share=1):
    """``[(id, size, source size, target, taken)]`` of ``(id, text, source)`` rows."""
    size = [len(WORDS.findall(t or "")) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, s), n in zip(rows, size, strict=True):
        total[s] += n
    target, budget = {s: 0.0 for s in total}, sum(size) * share
    open_ = {s for s in total if weights.get(s)}
    while open_:
        left = budget - sum(target[s] for s in total if s not in open_)
        per = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * per > repeats * total[s]}
        target |= {s: float(repeats * total[s]) if s in over else weights[s] * per for s in open_}
        if not over:
            break
        open_ -= over
    order = sorted(
        range(len(rows)),
        key=lambda i: hashlib.md5(f"{seed}:{'' if rows[i][0] is None else rows[i][0]}:{rows[i][1] or ''}".encode()).hexdigest()[:15],
    )
    below, out = defaultdict(int), []
    for i in order:
        s, n = rows[i][2], size[i]
        full = min(int(target[s] // total[s]), repeats) if total[s] else 0
        rest = target[s] - full * total[s] if full < repeats else 0
        more = n > 0 and below[s] < rest and int((rest - below[s]) / n + 0.5) >= 1
        below[s] += n
        out.append((rows[i][0], n, total[s], target[s], n * (full + more)))
    return out


def table(spark, rows):
    schema = "doc_id long, text string, source string, size int, _source string, taken int, weight int"
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], schema).repartition(5)


def result(df):
    return sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in df.collect()), key=repr)


def corpus():
    rows = [(i, "w " * (i * 7 % 40), f"s{i % 3}") for i in range(400)]
    rows += [(1000 + i, "one two", "tiny") for i in range(3)]
    rows += [(None, None, None), (None, "a b c", None), (2000, "", "empty"), (2001, " \n", "empty")]
    rows += [(5, "same text", "s1")] * 90 + [(None, "x y z", "s2")] * 50  # copies, and copies without an id
    return rows


@pytest.mark.parametrize("cycle", [(1.0, 2.0, 3.0), (5.0, 0.0, 1.0, 0.25)])
def test_mix(spark, cycle):
    rows = corpus()
    docs = table(spark, rows)
    weights = mixing.cycled_weights(docs, "source", cycle)
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    listed = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    assert {r.source: r.weight for r in weights.collect()} == listed
    got = result(mixing.mix(docs, weights))
    assert got == sorted(mixed(rows, listed), key=repr)
    assert got == result(mixing.mix(docs.repartition(3), weights))  # a rerun, laid out otherwise
    assert all(taken <= 3 * size for _, size, _, _, taken in got)


def test_mix_nested(spark):
    rows = corpus()
    docs = table(spark, rows)
    weights = mixing.cycled_weights(docs, "source", (1.0,))
    small, large = (
        {(r.doc_id, r.source, r.size): r.n for r in
         mixing.mix(docs, weights, share=share).groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("n")).collect()}
        for share in (0.3, 0.7)
    )
    assert all(small[k] <= large[k] for k in large) and sum(small.values()) < sum(large.values())


def test_mix_cuts_one_bucket_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL_BITS", 4)  # many documents in every bucket, 15 levels
    rows = corpus()
    docs = table(spark, rows)
    weights = spark.createDataFrame([("s0", 1.0), ("s1", 2.5), (None, 1.0)], "source string, weight double")
    assert result(mixing.mix(docs, weights)) == sorted(mixed(rows, {"s0": 1.0, "s1": 2.5, None: 1.0}), key=repr)


def test_mix_of_nothing(spark):
    empty = table(spark, corpus()).limit(0)
    assert mixing.mix(empty, mixing.cycled_weights(empty, "source", (1.0, 2.0))).collect() == []
    wordless = table(spark, [(1, "", "a"), (2, None, None)])
    got = result(mixing.mix(wordless, mixing.cycled_weights(wordless, "source", (1.0,))))
    assert got == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


# fill-in-the-middle

UNITS = {"line": re.compile(r"[^\n]*\n|[^\n]+"), "character": re.compile(r"(?s).")}


def in_the_middle(number, text, unit, percent, spm):
    text = text or ""
    units = UNITS[unit].findall(text)
    digest = hashlib.sha256(f"7:{'' if number is None else number}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def middle_texts():
    rng = np.random.default_rng(5)
    alphabet = np.array(["a", "b", "\n", "é", "漢", "𝄞", "\n\n", "<P", ">", "<", "S>", "\r", "\x80", "\0"])
    rows = [(i, "".join(rng.choice(alphabet, rng.integers(0, 60)))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "\n"), (903, "x"), (904, "a <S> b\nc"), (905, "<M>"), (None, "a\nb\nc")]
    rows += [(906, "line\n" * 200_000 + "é" * 100_001), (907, "x" * 300_000), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize(("unit", "percent", "spm"), [("line", 100, 50), ("character", 60, 100), ("character", 100, 0)])
def test_fill_in_middle(spark, unit, percent, spm):
    rows = middle_texts()
    schema = "doc_id long, text string, _id int, form int, output int, _h1 int"
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], schema).repartition(3)
    made = fim.fill_in_middle(docs, unit=unit, percent=percent, spm_percent=spm)
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = [(n, *in_the_middle(n, t, unit, percent, spm), t or "") for n, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert made.limit(0).collect() == []


def test_fill_in_middle_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fim.fill_in_middle(empty).collect() == []


def test_select_finds_every_mark():
    import pyarrow as pa

    texts = texts_of(pa.array(["\n" * 20, "a\nb" * 7, "", "ab", "é\n漢\n"]))
    units = fim.Units(texts, "line")
    feeds = np.flatnonzero(texts.data == 10)
    assert units.marked.select(np.arange(len(feeds))).tolist() == feeds.tolist()
    assert units.marked.before(np.arange(len(texts.data) + 1)).tolist() == [int((feeds < k).sum()) for k in range(len(texts.data) + 1)]


# vector codes


def quantised(vectors, parts, entries, rounds, scale=1024):
    """``[(id, code, error)]`` and codebooks of ``(id, label, vector)`` rows."""
    good = [(i, v) for i, _, v in vectors if v and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    whole = np.array([[int(np.floor(np.float64(np.clip(x, -65536, 65536)) * scale)) for x in v] for _, v in good])
    width = whole.shape[1] // parts
    books, found = [], []
    for part in range(parts):
        own = whole[:, part * width : (part + 1) * width]
        book = own[:entries].copy()
        for step in range(rounds + 1):
            apart = ((own[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
            nearest = apart.argmin(axis=1)
            if step < rounds:
                for e in set(nearest.tolist()):
                    held = own[nearest == e]
                    book[e] = [int(x) // len(held) for x in held.sum(axis=0)]
        books.append(book)
        found.append((nearest, apart.min(axis=1)))
    coded = [("".join(f"{n[k]:02x}" for n, _ in found), int(sum(d[k] for _, d in found))) for k in range(len(good))]
    return [(i, c, e) for (i, _), (c, e) in zip(good, coded, strict=True)], books


def vectors(kind, count=900, width=8):
    rng = np.random.default_rng(3)
    if kind == "clusters":
        centers = rng.normal(size=(12, width)) * 3
        found = centers[rng.integers(0, 12, count)] + rng.normal(size=(count, width)) * 0.02
    elif kind == "equal":
        found = np.repeat(rng.normal(size=(3, width)), count // 3, axis=0)
    elif kind == "large":
        found = rng.normal(size=(count, width)) * 70_000
    else:
        found = rng.integers(-2, 3, size=(count, width)) / 1024
    rows = [(int(i), int(i) % 5 if i % 7 else None, [float(np.float32(x)) for x in v]) for i, v in enumerate(found)]
    odd = [None, [], [1.0] * (width - 1), [None] * width, [float("nan")] + [0.0] * (width - 1), [0.0] * (2 * width)]
    odd += [[float("-inf")] + [0.0] * (width - 1)]
    return rows + [(-5 + k, 1, v) for k, v in enumerate(odd[:4])] + [(5000 + k, 1, v) for k, v in enumerate(odd[4:])] + [
        (None, 2, rows[0][2]), rows[1], rows[1]
    ]


@pytest.mark.parametrize("kind", ["clusters", "equal", "large", "ties"])
def test_codes(spark, monkeypatch, kind):
    monkeypatch.setattr(codes, "CHUNK_VECTORS", 250)
    monkeypatch.setattr(codes, "BLOCK_PIECES", 32)
    rows = vectors(kind)
    schema = "vec_id long, label int, embedding array<float>, _id int, error int, ids int"
    given = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema).repartition(3)
    coded, books = codes.compress(given, parts=2, entries=16, rounds=3)
    want, want_books = quantised(rows, 2, 16, 3)
    assert [b.tolist() for b in books] == [b.tolist() for b in want_books]
    got = codes.with_label_errors(coded).collect()
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=repr) == sorted(want, key=repr)
    sums = defaultdict(int)
    for r in got:
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] for r in got)


def test_blocks_are_settled_by_their_boxes():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 4)) * 5000
    values = np.floor(centers[rng.integers(0, 6, 4096)] + rng.normal(size=(4096, 4))).astype(np.int64)
    order = np.argsort(codes.hilbert_keys(values), kind="stable")
    own, size = values[order], codes.BLOCK_PIECES
    begins = np.arange(0, len(own), size)
    stored = {
        "place": codes._packed(order), "piece": codes._packed(own),
        "low": codes._packed(np.minimum.reduceat(own, begins)), "high": codes._packed(np.maximum.reduceat(own, begins)),
        "total": codes._packed(np.add.reduceat(own, begins)),
    }
    part = codes._Part(stored, codes.Layout(1, 4), np.floor(centers).astype(np.int64))
    _, single = part.assign()
    assert single.mean() > 0.5


def test_neighbours_on_the_curve_touch():
    side = np.arange(16)
    grid = np.array([(x, y) for x in side for y in side])
    # as many cells as the curve has: every step goes to a neighbouring cell
    order = np.argsort(codes.hilbert_keys(grid), kind="stable")
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_codes_of_nothing(spark):
    given = spark.createDataFrame([(1, 2, None)], "vec_id long, label int, embedding array<float>")
    coded, books = codes.compress(given)
    assert codes.with_label_errors(coded).collect() == []
    assert codes.books_digest(books) == hashlib.sha256(b"").hexdigest()
