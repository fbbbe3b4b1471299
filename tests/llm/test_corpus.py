"""Operators on the whole corpus, and the pipeline, against plain Python."""

import math
import random
import sys
from pathlib import Path

import plain
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from speechprep.llm import common, decontam, linededup, neardup, quality, queries, spans

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402

NATIVE = ("Python", "Pandas", "Arrow")


def frame(spark, rows, slices=3):
    """``(doc_id, text)`` rows with further columns that operators use themselves."""
    schema = "doc_id long, text string, _id string, _hash int, node int, held int, _gone int, gone int"
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], schema).repartition(slices)


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in NATIVE)


# shared helpers


def test_join_facts_with_heavy_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_ROWS", 10)
    keys = [None] * 50 + [1] * 400 + [2] * 5 + list(range(10, 60))
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    facts = spark.createDataFrame(
        [(1, "one", 400), (2, "two", 5), (10, "ten", 1), (99, "none", 12)], "k long, f string, n long"
    )
    got = common.join_facts(rows, facts, "k", "n", len(keys)).collect()
    names = {1: "one", 2: "two", 10: "ten"}
    assert sorted((r.i, r.f) for r in got) == [(i, names.get(k)) for i, k in enumerate(keys)]


def test_join_facts_spreads_heavy_keys(spark):
    """A third of the rows, all equal, has one key: no task gets much more than the rest."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        rows = spark.range(60_000).repartition(24).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"),
            F.when(F.col("id") % 3 > 0, F.col("id")).alias("i"),
        )
        facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("f"))
        joined = common.join_facts(rows, facts, "k", "n", 60_000)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert any("Exchange hashpartitioning(k" in x and "_spread" in x for x in plan.splitlines())
        needed = F.max(F.xxhash64(*joined.columns))  # or the join would be dropped
        by_task = joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), needed)
        sizes = [r.rows for r in by_task.collect()]
        assert len(sizes) == 16 and max(sizes) <= 2 * sorted(sizes)[8]
        got = joined.select("n").agg(F.count("n"), F.max("n")).first()
        assert tuple(got) == (60_000, 20_000)
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def test_components(spark):
    rng = random.Random(6)
    nodes = [rng.getrandbits(62) for _ in range(300)]
    chain = list(zip(nodes[:100], nodes[1:100], strict=False))
    star = [(nodes[150], n) for n in nodes[151:250]]
    extra = [(nodes[250], nodes[251]), (nodes[251], nodes[250]), (nodes[252], nodes[252])]
    edges = spark.createDataFrame(chain + star + extra, "a long, b long")
    got = {r.node: r.root for r in common.components(edges).collect()}
    groups = [nodes[:100], nodes[150:250], nodes[250:252]]
    assert got == {n: min(g) for g in groups for n in g}
    assert common.components(edges.limit(0)).count() == 0


# line dedup


def paragraphs(rng):
    lines = ["", "  ", "header", "Ünï", "a", "b", "c", "footer of all"]
    out = []
    for _ in range(rng.choice([0, 1, 2, 4, 12, 40])):
        if rng.random() < 0.3:
            out += ["licence one", "licence two", "", "licence three"][: rng.randint(2, 4)]
        else:
            out.append(rng.choice([*lines, f"own {rng.random()}", f"own {rng.random()}"]))
    return "\n".join(out)


def test_line_dedup(spark):
    rng = random.Random(11)
    rows = [(i, paragraphs(rng)) for i in range(150)]
    rows += [(1000 + i, rows[i % 7 + 100][1]) for i in range(40)]  # whole copies
    rows += [(2000, None), (2001, ""), (2002, "x\ny\nz"), (2003, "x\ny\nz\n" * 1500)]
    rows += [rows[3], (None, "x\ny\nz\nnull id")]
    got = linededup.deduplicate(frame(spark, rows))
    no_python(got)
    want = plain.line_dedup(rows)
    have = sorted((str(r[0]), *r[1:]) for r in got.collect())
    assert have == sorted((str(i), *want[i, t]) for i, t in rows)
    kept = linededup.drop_repeats(frame(spark, rows)).collect()
    left = {r.doc_id: r.text for r in kept}
    for i, t in rows:
        _, removed, text = want[i, t]
        if removed and not plain.WORDS.search(text):
            assert i not in left
        else:
            assert left[i] == (text if removed else t)
    assert kept[0]._id == "x" and linededup.deduplicate(frame(spark, [])).count() == 0


# near duplicates


def edited(rng, words, share):
    return [f"e{rng.random()}" if rng.random() < share else w for w in words]


def copies(rng):
    """A large group of near copies with many borderline ones, small groups, exact
    copies, shared passages, short and empty texts."""
    base = [f"w{rng.randint(0, 3000)}" for _ in range(120)]
    texts = [base] + [edited(rng, base, rng.choice([0.01, 0.03, 0.06, 0.1])) for _ in range(260)]
    for _ in range(30):
        own = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 20, 80, 400]))]
        texts += [own, edited(rng, own, 0.03), edited(rng, own, 0.03), own]
    passage = base[:60]
    texts += [passage + [f"p{rng.random()}" for _ in range(100)] for _ in range(60)]
    out = [" ".join(t) for t in texts]
    out += ["One Two", "one  TWO", "one two three", "one", "ONE", "é É", "É é", "", "  \n", None, None]
    out += ["the the " * 3000, "the the " * 2999 + "x"]
    return out


@pytest.mark.parametrize("words,blocks", [(2, 24), (5, 1000), (1, 24)])
def test_near_duplicates(spark, monkeypatch, words, blocks):
    monkeypatch.setattr(neardup, "BLOCK_CLASSES", blocks)
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 50)
    monkeypatch.setattr(common, "HEAVY_ROWS", 20)
    rng = random.Random(words)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(copies(rng))]
    rows += [rows[5], (None, rows[9][1]), (None, "only null ids here"), (None, "only null ids here")]
    how = neardup.Similarity(words=words, percent=80)
    got = neardup.near_duplicates(frame(spark, rows), how=how).collect()
    want = plain.near_duplicates(rows, words, 80)
    have = sorted(map(str, (tuple(r)[:3] for r in got)))
    assert have == sorted(str((i, *want[i, t])) for i, t in rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_blocks_of_one_set(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 1)
    rows = list(enumerate(copies(random.Random(3))[:25]))
    how = neardup.Similarity(words=2, percent=80)
    got = neardup.near_duplicates(frame(spark, rows), how=how).collect()
    want = plain.near_duplicates(rows, 2, 80)
    assert {(r[0], *r[1:3]) for r in got} == {(i, *want[i, t]) for i, t in rows}


def test_margin_of_the_sketches():
    how = neardup.Similarity(words=2, percent=80)
    share, least = how.percent / 100, math.ceil(how.keep * (how.percent / 100 - how.spread))

    def below(n):
        return sum(math.comb(how.keep, k) * share**k * (1 - share) ** (how.keep - k) for k in range(n))

    assert below(how.least) + below(least) < 4e-8


def test_dropping_near_duplicates(spark):
    rows = [(i, t) for i, t in enumerate(copies(random.Random(1))) if i % 3 == 0]
    how = neardup.Similarity()
    left = neardup.drop_near_duplicates(frame(spark, rows), how=how).collect()
    want = plain.near_duplicates(rows, 5, 80)
    assert sorted(r.doc_id for r in left) == sorted(i for i, t in rows if want[i, t][1] == i)
    assert left[0]._id == "x"
    assert neardup.near_duplicates(frame(spark, []), how=how).count() == 0
    assert neardup.near_duplicates(frame(spark, [(1, ""), (2, None)]), how=how).count() == 2


def test_dropping_near_duplicates_by_row(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, a), (None, a), (None, "alone"), (None, None), (2, b), (3, b), (3, "alone too"), (3, b)]
    left = neardup.drop_near_duplicates(frame(spark, rows)).collect()
    want = [(1, a), (2, b), (3, "alone too"), (None, "alone"), (None, None)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in left))) == sorted(map(str, want))


def test_shingle_sets_of_many_texts_equal_those_of_each():
    import pyarrow as pa

    texts = ["", "a", "a b", "A b c a b", "x  y\nz x y", "é"]
    together = neardup.shingle_sets(spans.texts_of(pa.array(texts)), 2)
    for text, found in zip(texts, together, strict=True):
        alone = neardup.shingle_sets(spans.texts_of(pa.array([text])), 2)[0]
        assert found.tolist() == alone.tolist()
        assert len(found) == len(plain.shingles(text, 2))


# decontamination


def leaks(rng):
    words = [f"w{k}" for k in range(40)] + ["the", "The", "É", "é9"]

    def some(n):
        return rng.choices(words, k=n)

    items = [(i, " ".join(some(rng.choice([1, 2, 3, 9, 10, 11, 40])))) for i in range(25)]
    items += [(25, items[0][1].upper()), (None, items[6][1]), (26, None), (27, "?!"), (10, "the the the the")]
    rows = []
    for i in range(120):
        parts = some(rng.choice([0, 1, 5, 60]))
        for _ in range(rng.choice([0, 0, 1, 3])):
            passage = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, max(len(passage) - 10, 0))
            parts += passage[cut : cut + rng.choice([9, 10, 12, 40])] + some(2)
        rows.append((i, "".join(w + rng.choice([" ", "-", "\n", ". "]) for w in parts)))
    rows += [rows[3], (500, None), (501, ""), (502, "the " * 5000), (None, rows[4][1]), (None, None)]
    return rows, items


@pytest.mark.parametrize("seed,most", [(1, 1_000_000), (2, 250)])
def test_contamination(spark, monkeypatch, seed, most):
    monkeypatch.setattr(decontam, "BROADCAST_SHINGLES", most)  # 250: in several passes
    monkeypatch.setattr(decontam, "ROW_WINDOWS", 1 + seed)
    monkeypatch.setattr(common, "HEAVY_ROWS", 20)
    rows, items = leaks(random.Random(seed))
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    got = decontam.contamination(frame(spark, rows), bench)
    no_python(got)
    want = plain.contamination(rows, items)
    have = sorted((str(r[0]), r[1], r[2], list(r[3])) for r in got.collect())
    assert have == sorted((str(i), *want[i, t]) for i, t in rows)
    clean = decontam.drop_contaminated(frame(spark, rows), bench).collect()
    left = [(i, t) for i, t in rows if not want[i, t][1]]
    assert sorted(map(str, ((r.doc_id, r.text) for r in clean))) == sorted(map(str, left))


def test_contaminated_rows_without_id_take_no_others(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    rows = [(None, "x a b c"), (None, "clean"), (None, None), (7, "a b"), (7, "a b c"), (7, "a b")]
    left = decontam.drop_contaminated(frame(spark, rows), items).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in left))) == [
        "(7, 'a b')", "(7, 'a b')", "(None, 'clean')", "(None, None)"
    ]
    assert left[0]._gone == 4


def test_contamination_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.contamination(frame(spark, []), items).count() == 0
    got = decontam.contamination(frame(spark, [(1, "a b c")]), items.limit(0)).first()
    assert (got.n_words, got.n_hit, got["items"]) == (3, 0, [])
    assert decontam.with_digest(decontam.contamination(frame(spark, [(1, "a b c")]), items)).first().contaminated


# the pipeline


def corpus(rng):
    """Documents with something for every stage."""
    def line(n):
        return " ".join(f"v{rng.randint(0, 5000)}" for _ in range(n))

    def text():
        return "\n".join(line(rng.randint(8, 15)) for _ in range(rng.randint(6, 9)))

    out = [text() for _ in range(60)]
    out += [line(10), "", "same line\n" * 30]  # rejected
    notice = "\n".join(line(12) for _ in range(4))
    out += [f"{text()}\n{notice}\n{text()}" for _ in range(10)]
    out += [out[1], out[2], out[2]]  # copies
    for k in (3, 4):
        words = out[k].split(" ")
        words[20] = "edited"
        out += [" ".join(words).replace("\n", " \n")]
    item = line(30)
    out += [f"{text()}\n{item}\n{text()}", f"{text()} {item.upper()}"]
    return list(enumerate(out)), [(1, item), (2, line(40))]


def test_pipeline(spark, tmp_path):
    rows, items = corpus(random.Random(9))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    from test_texts import plain_quality

    now = [(i, t) for i, t in rows if plain_quality(t)[-1]]
    assert 0 < len(now) < len(rows)
    cleaned = plain.line_dedup(now)
    deduped = []
    for i, t in now:
        _, removed, text = cleaned[i, t]
        if not removed or plain.WORDS.search(text):
            deduped.append((i, text if removed else t))
    assert 0 < len(deduped) < len(now) and any(cleaned[k][1] for k in now)
    groups = plain.near_duplicates(deduped, 5, 80)
    unique = [(i, t) for i, t in deduped if groups[i, t][1] == i]
    assert len(unique) < len(deduped)
    leaked = plain.contamination(unique, items)
    clean = [(i, t) for i, t in unique if not leaked[i, t][1]]
    assert len(clean) < len(unique)
    own = Tokenizer.from_file(queries.vocabulary(corpus_pipeline.VOCABULARY))
    assert {i: got[i].ids for i in got} == {
        i: own.encode(t, add_special_tokens=False).ids for i, t in clean
    }
    assert all(r.n_tokens == len(r.ids) for r in got.values())
    hashed = spark.createDataFrame(clean, "doc_id long, t string").select(
        "doc_id", F.sha2(F.col("t").cast("binary"), 256).alias("h")
    )
    assert {r.doc_id: r.h for r in hashed.collect()} == {i: r.decoded_sha256 for i, r in got.items()}


def test_stages_keep_the_columns_of_documents_and_take_empty_tables(spark, tmp_path):
    docs = frame(spark, []).select("doc_id", "text").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1).cast("long")}
    )
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0
    assert quality.keep_good(docs).count() == 0


def test_unrelated_texts_over_few_words_make_no_large_bundles(spark):
    """Texts of 80 of 300 words share values, but no two are similar."""
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(300)]
    how = neardup.Similarity(words=2, percent=80)

    def largest(count):
        rows = [(i, " ".join(rng.choices(vocabulary, k=80))) for i in range(count)]
        rows += [(count + i, text + " again") for i, (_, text) in enumerate(rows[:30])]
        texts = spark.createDataFrame(rows, "_id long, _text string").withColumn("_hash", F.xxhash64("_text"))
        sketched = common.settled(neardup._sketches(texts.repartition(4), how))
        listed = neardup._listed(sketched, neardup._counts(sketched), how)
        classes = listed.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "cold", "hot")))
        sizes = neardup._bundles(common.settled(classes), how).groupBy("root").count()
        return sizes.agg(F.count("*").alias("bundles"), F.sum("count").alias("nodes"), F.max("count").alias("most")).first()

    for count in (3_000, 12_000):
        found = largest(count)
        assert found.bundles >= 30 and found.nodes <= 60 + count / 20 and found.most <= 20


def test_second_lists_find_what_short_lists_miss(spark, monkeypatch):
    """Many more similar texts than a list may hold, among others that share their words."""
    monkeypatch.setattr(neardup, "SHORT_LIST", 2)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(60)]
    base = [rng.choices(words, k=50) for _ in range(6)]
    rows = []
    for i in range(150):
        text = list(base[i % 6])
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(50)] = rng.choice([*words, f"own{rng.random()}"])
        rows.append((i, " ".join(text)))
    rows += [(200 + i, " ".join(words[i : i + k])) for i in range(12) for k in (4, 5, 6, 9, 12, 15)]
    for limit in (1 << 16, 5):  # with and without hot values
        monkeypatch.setattr(neardup, "HOT_ROWS", limit)
        how = neardup.Similarity(words=2, percent=80)
        got = neardup.near_duplicates(frame(spark, rows), how=how).collect()
        want = plain.near_duplicates(rows, 2, 80)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, *want[i, t]) for i, t in rows)


@pytest.mark.parametrize("part", [16, 1 << 15])
def test_long_lists_hold_no_unrelated_texts_together(spark, monkeypatch, part):
    """Texts of so few words that most pairs of values are in long lists."""
    monkeypatch.setattr(neardup, "SHORT_LIST", 2)
    monkeypatch.setattr(neardup, "LARGE_BUNDLE", 20, raising=False)
    monkeypatch.setattr(neardup, "LIST_PART", part, raising=False)
    rng = random.Random(4)
    texts = [rng.choices([f"w{k}" for k in range(15)], k=60) for _ in range(300)]
    texts += [edited(rng, texts[i % 10], rng.choice([0.02, 0.04])) for i in range(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    held, members = [], neardup._members

    def watched(texts, placed, how):
        held.append(placed.groupBy("bundle").count().agg(F.max("count"), F.sum("count")).first())
        return members(texts, placed, how)

    monkeypatch.setattr(neardup, "_members", watched)
    got = neardup.near_duplicates(frame(spark, rows), how=neardup.Similarity(words=2, percent=80)).collect()
    want = plain.near_duplicates(rows, 2, 80)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, *want[i, t]) for i, t in rows)
    assert held[0][0] <= 10 and held[0][1] <= 100
