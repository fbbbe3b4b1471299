import random
import re
import tracemalloc
import unicodedata

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from speechprep.functions import text as tx
from speechprep.functions import values as v

CASES = [
    (None, "a [x] (y), b!", "a b"),
    (None, "a [x\ny] b", "a [x y] b"),
    (None, "(a (b) c)", "c)"),
    (None, "  a 　b\u001cc  ", "a b c"),
    (None, "é  x", "é x"),
    (None, "[all gone] (this too)!", ""),
    ("xx", "F-D; <a>", "F-D <a>"),
    ("tdh", "ga--ni a-b…c:d", "ga ni ab cːd"),
    ("tdh", 'a᷉ o̵ "=_/§Xz ...y', "ã o z y"),
    ("nru", "mm... F<a>D ʰʰ◊", "mmm… a ʰ|"),
    ("nru", "m… mmmmm… m", "mmm… mmm… m"),
    ("jya", "@go'ma漢字 X-tA 12", "go'ma ta"),
    ("jya", "o'k @a'b'c 漢 d", "ok a'b'c d"),
    ("jya", "\U00020001ɡa--b {c} ٣.…z", "ga b c z"),
    ("jya", "a ( ) b @ 'c", "a b c"),
]


def apply(spark, rows, make):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    out = df.select("i", make(F.col("t")).alias("r")).collect()
    return [r.r for r in sorted(out, key=lambda r: r.i)]


@pytest.mark.parametrize("language", [None, "xx", "tdh", "nru", "jya"])
def test_normalisers(spark, language):
    cases = [c for c in CASES if c[0] == language]
    texts, expected = [c[1] for c in cases], [c[2] for c in cases]
    assert apply(spark, texts, lambda t: tx.normalize(t, language)) == expected
    blank = apply(spark, texts, lambda t: tx.is_blank(t, language))
    assert blank == [e == "" for e in expected]


def test_language_column_equals_language_argument(spark):
    rows = [(i, lang, text) for i, (lang, text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, language string, t string")
    out = df.select("i", tx.normalize(F.col("t"), F.col("language")).alias("r")).collect()
    assert [r.r for r in sorted(out, key=lambda r: r.i)] == [c[2] for c in CASES]


def test_white_space_class_is_unicode_white_space(spark):
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    df = spark.createDataFrame([(chr(p),) for p in points if p < 0x20000], "c string")
    native = {
        r.c
        for r in df.filter(F.col("c").rlike(f"^[{tx.WS}]$")).collect()
    }
    fast = {r.c for r in df.filter(F.col("c").rlike(f"^{tx.SPACES}$")).collect()}
    expected = {chr(p) for p in points if chr(p).isspace()}
    assert native == fast == expected


def test_nfc_matches_unicodedata(spark):
    texts = ["à́", "가", "Å", "q̣̇", "plain", None]
    got = apply(spark, texts, tx.clean_markup)
    assert got == [t and unicodedata.normalize("NFC", t) for t in texts]


def test_composing_holds_a_part_of_a_batch():
    texts = [f"{i}  e\u0301 " + "x" * 20_000 for i in range(1999)] + [None, ""]
    batch = pa.array(texts, pa.string())  # 40 MB
    want = [t and f"{i} é " + "x" * 20_000 for i, t in enumerate(texts)]
    want = want + want[7:]
    tracemalloc.start()
    try:
        at = 0
        for part in tx._compose_and_collapse(iter([batch, batch[:0], batch[7:]])):
            for got in part:
                assert got.as_py() == want[at]
                at += 1
        assert at == len(want)
        assert tracemalloc.get_traced_memory()[1] < 10_000_000
    finally:
        tracemalloc.stop()


def test_batches_that_leave_in_parts(spark):
    rows = [f"{i}  [x]e\u0301 " + "y" * 10_000 if i % 5 else None for i in range(500)]
    want = [t and f"{i} é " + "y" * 10_000 for i, t in enumerate(rows)]
    assert apply(spark, rows, tx.clean_markup) == want
    both = apply(spark, rows, lambda t: F.concat(tx.clean_markup(t), tx.normalize(t, "tdh")))
    assert both == [t and t + t for t in want]


def test_skip_markers_only_for_their_language(spark):
    texts = ["x fin peu audible", "BEGAIEMENT", "BEGAIMENT", "fine"]
    assert apply(spark, texts, lambda t: tx.is_skipped(t, "nru")) == [True, True, False, False]
    assert apply(spark, texts, lambda t: tx.is_skipped(t, "tdh")) == [False] * 4


def test_registered_language(spark):
    tx.register_normalizer("zz", lambda t: F.upper(t), lambda t: F.concat(t, F.lit(".")))
    tx.register_skip("zz", lambda t: F.startswith(t, F.lit("!")))
    try:
        assert apply(spark, ["a [b] c", "!d"], lambda t: tx.normalize(t, "zz")) == ["A C.", "D."]
        assert apply(spark, ["a", "!d"], lambda t: tx.is_skipped(t, "zz")) == [False, True]
    finally:
        tx._NORMALIZERS.pop("zz")
        tx._SKIPS.pop("zz")


def test_registered_functions_in_python(spark):
    @F.pandas_udf("string")
    def before(t: pd.Series) -> pd.Series:
        return t + " [gone] e\u0301"

    @F.arrow_udf("string")
    def after(t: pa.Array) -> pa.Array:
        return pa.array([x and x.upper() for x in t.to_pylist()], pa.string())

    tx.register_normalizer("zz", before, after)
    try:
        rows = ["a  b", "", None]
        assert apply(spark, rows, lambda t: tx.normalize(t, "zz")) == ["A B É", "É", None]
        assert apply(spark, rows, lambda t: tx.normalize(after(t), "zz")) == ["A B É", "É", None]
        tx.register_normalizer("zz", before)
        by_row = F.when(F.col("i") == 0, "zz").otherwise("tdh")
        assert apply(spark, rows, lambda t: tx.normalize(t, by_row)) == ["a b é", "", None]
    finally:
        tx._NORMALIZERS.pop("zz")


def test_escapes_and_word_splits(spark):
    assert apply(spark, ['a<b & "c">'], tx.escape_text) == ['a&lt;b &amp; "c"&gt;']
    assert apply(spark, ['a<b & "c">'], tx.escape_attribute) == ["a&lt;b &amp; &quot;c&quot;&gt;"]
    assert apply(spark, ["a  b ", ""], tx.split_on_space) == [["a", "", "b", ""], [""]]
    assert apply(spark, [" a 　b ", ""], tx.split_words) == [["a", "b"], []]


def test_seconds(spark):
    texts = [" 1.5 ", "1e1", "1_0", ".5", "5.", "-2", "inf", "nan", "x", "1d", "", None, "\t3\n"]
    got = apply(spark, texts, v.parse_seconds)
    assert got == [1.5, 10.0, 10.0, 0.5, 5.0, -2.0, float("inf"), None, None, None, None, None, 3.0]


def test_formatting(spark):
    rng = random.Random(4)
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 2.5, 1234567.85, 0.0005, 0.0015, 99.9995, -0.25, 3.0625]
    values += [rng.randint(0, 10**7) / 10**4 for _ in range(3000)]
    values += [rng.randint(0, 10**6) / 16000 for _ in range(3000)]
    values += [rng.uniform(0, 10 ** rng.randint(0, 6)) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    rows = df.select(
        "x",
        v.format_seconds(F.col("x"), 1).alias("a"),
        v.format_seconds(F.col("x"), 3).alias("b"),
        v.to_millis(F.col("x")).alias("ms"),
    ).collect()
    for r in rows:
        assert (r.a, r.b, r.ms) == (f"{r.x:.1f}", f"{r.x:.3f}", round(r.x * 1000))


def test_paths(spark):
    paths = ["/a/b.c.wav", "x", "/d/.hidden", "file:/q/A B.WAV"]
    assert apply(spark, paths, v.stem) == ["b.c", "x", ".hidden", "A B"]
    assert apply(spark, paths, v.suffix) == [".wav", "", "", ".WAV"]
    assert apply(spark, paths, v.parent) == ["/a", "", "/d", "file:/q"]


@pytest.mark.parametrize("language", [None, "jya", F.col])
def test_text_goes_to_python_once(spark, language):
    df = spark.createDataFrame([("a", "jya")], "t string, language string")
    code = language("language") if callable(language) else language
    cleaned = df.withColumn("r", tx.normalize(F.col("t"), code)).filter("r != ''")
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_compose_and_collapse(") == 1


# The rules one after the other, as they are stated.
def _one_by_one_tdh(t):
    t = re.sub("--+|[.…]+", " ", t).replace("-", "").replace(":", "ː").replace("᷉", "̃")
    return t.translate(dict.fromkeys(map(ord, "̵" + tx.TDH_DELETED)))


def _one_by_one_jya(t):
    han = "[㐀-䶿一-鿿豈-﫿\U00020000-\U0002fa1f]"
    white = "[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace()) + "]"

    def kept(word):
        at = word.find("@")
        return word if at < 0 else word[: at + 1] + word[at + 1 :].replace("'", tx.JYA_APOSTROPHE)

    t = "".join(kept(w) for w in re.split(f"({white}+)", t))
    t = re.sub(f"@([^{white[1:-1]}]+){white}*{han}+", r"\1", t) if "@" in t else t
    t = re.sub(f"{han}|[@X]", "", t)
    t = re.sub("--+|[.…]+", " ", t).replace("-", "").replace("ɡ", "g")
    t = re.sub(r"\d", "", t.translate(dict.fromkeys(map(ord, tx.JYA_DELETED))))
    return t.lower()


def _shared(t):
    t = re.sub(r"\([^\n]*?\)", "", re.sub(r"\[[^\n]*?\]", "", t))
    t = t.translate(dict.fromkeys(map(ord, tx.PUNCTUATION)))
    return " ".join(unicodedata.normalize("NFC", t).split())


def _finished_jya(t):
    t = t.translate(dict.fromkeys(map(ord, tx.JYA_BRACKETS))).replace(tx.JYA_APOSTROPHE, "'")
    return re.sub("  +", " ", t).strip(" ")


@pytest.mark.parametrize("language", ["tdh", "jya"])
def test_composed_rules_equal_the_rules_one_by_one(spark, language):
    rng = random.Random(17)
    marks = list("-.…@X,;!?[]()'\"=_/§: \n") + ["漢", "字", "ɡ", "̵", "᷉", "e", "́", "a", "7", "٣", "《", "<"]
    texts = ["".join(rng.choices(marks, k=rng.randint(0, 14))) for _ in range(6_000)]
    texts += ["a-漢-b", "-X.@.-", "--X.", ".漢…-字--", "[a,]b", "(,)", "-,-", "a,-漢"]
    if language == "tdh":
        want = [_shared(_one_by_one_tdh(t)) for t in texts]
    else:
        want = [_finished_jya(_shared(_one_by_one_jya(t))) for t in texts]
    assert apply(spark, texts, lambda t: tx.normalize(t, language)) == want
