"""Operators on single texts: against the library, and against plain Python."""

import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from speechprep.llm import bpe, quality, spans, tokencount

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BITS = ["a", "aa", "ab", "the", " ", "  ", "\n", "\t", " ", "\u0085", "\x1c", "é", "é"]
BITS += ["Σ", "ς", "İ", "ſ", "'s", "'LL", "1", "²", "漢", "😀", "<|endoftext|>", "<|startoftext|>"]
BITS += ["<|", "　", "!", "...", "\x00", "​", "_", "ͅ", "ǅ", "of the"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = ["".join(rng.choices(BITS, k=rng.randint(0, 25))) for _ in range(3000)]
    out += ["".join(rng.choices("abcdeaeiouthing ", k=rng.randint(0, 60))) for _ in range(3000)]
    out += ["a" * 5000, "ab" * 3000, " " * 3000, "\n" * 99 + "x", "-" * 2000]
    out += ["".join(rng.choices("ab", k=4000)), "".join(rng.choices("etaoinshr", k=9000))]
    return out


@pytest.fixture(scope="module")
def rows(spark, texts):
    data = [(i, t, 1) for i, t in enumerate([*texts, None, None, texts[0]])]
    # extra columns whose names the operators use themselves
    return spark.createDataFrame(data, "doc_id long, text string, ids int")


def test_encoding_is_the_librarys_and_decoding_inverts_it(rows, texts):
    own = Tokenizer.from_file(BYTE)
    encoded = bpe.encode(rows, BYTE)
    got = {r.doc_id: r for r in bpe.decode(encoded, BYTE).collect()}
    assert len(got) == len(texts) + 3
    assert sorted(map(str, got.values())) == sorted(map(str, bpe.round_trip(rows, BYTE).collect()))
    for i, text in enumerate([*texts, "", "", texts[0]]):
        ids = own.encode(text, add_special_tokens=False).ids
        assert got[i].ids == ids, text[:50]
        assert got[i].decoded == own.decode(ids, skip_special_tokens=False) == text


def test_decoding_any_ids(spark):
    own = Tokenizer.from_file(BYTE)
    rng = random.Random(1)
    cases = [rng.choices(range(50257), k=9) for _ in range(300)] + [[], None]
    df = spark.createDataFrame(list(enumerate(cases)), "n int, ids array<int>")
    for r in bpe.decode(df, BYTE).collect():
        assert r.decoded == own.decode(cases[r.n] or [], skip_special_tokens=False)


def test_counts_are_the_librarys(rows, texts):
    own = Tokenizer.from_file(WORD)
    got = {r.doc_id: r for r in tokencount.token_counts(rows, WORD, limit=100).collect()}
    for i, text in enumerate([*texts, "", "", texts[0]]):
        n = len(own.encode(text, add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].over_limit) == (n, n > 100), text[:50]
        assert got[i].n_bytes == len(text.encode())


def test_kept_pieces_are_bounded(monkeypatch, texts):
    monkeypatch.setattr(tokencount, "KEPT_PIECES", 50)
    monkeypatch.setattr(bpe, "KEPT_PIECES", 50)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 50)
    counter, encoder = tokencount.Counter(WORD), bpe.Encoder(BYTE)
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    for text in texts[2000:4000:7]:
        ids = word.encode(text, add_special_tokens=False).ids
        assert counter.counts([text, "ab", text]) == [len(ids), 1, len(ids)]
        assert encoder.encode(text).tolist() == byte.encode(text, add_special_tokens=False).ids
    assert len(encoder.spaced) <= 50 and len(encoder.spaced.older) <= 50


def plain_quality(text, limits=quality.DEFAULT):
    words = WORDS.findall(text or "")
    chars = sum(map(len, words))

    def covered(n):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        often = Counter(grams)
        return {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(n)}

    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    out = [len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), len(again)]
    out += [len(covered(3)), sum(map(len, again))]
    out += [sum(len(words[i]) for i in covered(n)) for n in limits.ngram_chars]
    failed = len(words) < 50 or 100 * out[4] > 50 * len(words)
    bad = len(again) > limits.lines * len(lines)
    bad |= sum(map(len, again)) > limits.line_chars * sum(map(len, lines))
    bad |= any(
        d > share * chars for d, share in zip(out[6:], limits.ngram_chars.values(), strict=True)
    )
    return [*out, failed, not failed and not bad]


def repetitive(rng):
    words = rng.choices(["x", "yé", "zz#", "w漢", "|", "q"], k=rng.choice([0, 1, 30, 60, 200]))
    start = rng.randint(0, 40)
    words += words[start : start + rng.choice([0, 5, 12, 40])]
    words += [f"v{rng.random()}" for _ in range(rng.choice([0, 50, 300]))]
    return "".join(w + rng.choice([" ", " ", " ", "\n", "\t ", " \n\n"]) for w in words)


def test_quality_measures(spark):
    rng = random.Random(2)
    cases = [repetitive(rng) for _ in range(300)] + ["", " \n ", "a\nb\na\nb\na", None, "x " * 4000]
    new = [f"w{i}" for i in range(100)]
    cases.append(" ".join(new + new[10:24]))  # repeated, but not beyond the base rule
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id int, text string")
    got = {r[0]: list(r[1:]) for r in quality.quality(df.repartition(3)).collect()}
    assert got == {i: plain_quality(t) for i, t in enumerate(cases)}
    assert len({tuple(v[-2:]) for v in got.values()}) == 3
    clash = df.selectExpr("text", "doc_id as c0", "doc_id as kept")
    kept = {r.c0 for r in quality.keep_good(clash).collect()}
    assert kept == {i for i, v in got.items() if v[-1]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, BYTE), BYTE).count() == 0
    assert tokencount.token_counts(none, WORD).count() == 0
    assert quality.quality(none).count() == quality.keep_good(none).count() == 0


def test_spans():
    texts = ["", "a  b\n", "\n\n", "Ünï x", "", "b"]
    t = spans.texts_of(pa.array(["skip", *texts]).slice(1))
    starts, ends = t.words()
    raw = t.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(starts, ends, strict=True)] == ["a", "b", "Ünï", "x", "b"]
    assert t.owners(starts).tolist() == [1, 1, 3, 3, 5]
    a, b = t.lines()
    assert [raw[x:y].decode() for x, y in zip(a, b, strict=True)] == [
        line for text in texts for line in text.split("\n")
    ]
    hashes = t.hashes(starts, ends)
    assert hashes[1] == hashes[4] and len(set(hashes.tolist())) == 4
    values, firsts = spans.grams(hashes, t.owners(starts), 2)
    assert firsts.tolist() == [0, 2]
    assert len(values) == 2 and np.all(values != 0)


def test_counts_of_long_runs_without_space():
    counter, library = tokencount.Counter(WORD), Tokenizer.from_file(WORD)
    library.no_truncation()
    rng = random.Random(8)
    runs = ["".join(rng.choices(letters, k=n)) for n in (2047, 2049, 20_000) for letters in ("a", "ab", "thes", "éa漢", "xyz0")]
    assert counter.counts(runs) == [len(library.encode(r, add_special_tokens=False).ids) for r in runs]
    began = time.process_time()
    counter.counts(["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))])
    assert time.process_time() - began < 20
