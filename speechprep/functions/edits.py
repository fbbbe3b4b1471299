"""Edit distances between transcripts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS
from .values import once

# First code point used for word codes: one code point per distinct word; and how many
# there are from it on.
_FIRST_CODE = 0x10000
CODES = 0x110000 - _FIRST_CODE - 1


def squeeze(text: Column) -> Column:
    """Inner white space of two or more becomes one space; ends are stripped."""
    inner = F.regexp_replace(text, f"[{WS}]{{2,}}", " ")
    return F.regexp_replace(inner, f"^[{WS}]+|[{WS}]+$", "")


def scoring_words(text: Column) -> Column:
    return F.filter(F.split(squeeze(text), " "), lambda w: w != "")


def _as_code_points(words: Column, known: Column) -> Column:
    """One code point per word: its place among the known words, 0 if unknown."""
    codes = F.transform(
        words,
        lambda w: F.lpad(F.hex(F.array_position(known, w) + F.lit(_FIRST_CODE)), 8, "0"),
    )
    return F.decode(F.unhex(F.array_join(codes, "")), "UTF-32")


def edit_distance(left: list, right: list) -> int:
    """Edits between two sequences of any values, by bit vectors: a whole column of the
    table of distances is two whole numbers with a bit per value."""
    begin = 0
    for a, b in zip(left, right):
        if a != b:
            break
        begin += 1
    left, right = left[begin:], right[begin:]
    while left and right and left[-1] == right[-1]:
        left, right = left[:-1], right[:-1]
    pattern, text = sorted((left, right), key=len)
    if not pattern:
        return len(text)
    places: dict = {}
    for place, value in enumerate(pattern):
        places.setdefault(value, []).append(place)
    size = len(pattern)
    every = (1 << size) - 1
    up, down, distance = every, 0, size
    for value in text:
        same = sum(1 << place for place in places.get(value, ()))
        diagonal = same | down
        level = (((same & up) + up) ^ up) | same
        plus = down | (every & ~(level | up))
        minus = up & level
        # the last row's step, seen at the highest bit
        distance += (plus.bit_length() == size) - (minus.bit_length() == size)
        plus, minus = plus << 1 | 1, minus << 1
        up = (minus | ~(diagonal | plus)) & every
        down = plus & diagonal & every
    return distance


def word_edits(reference: Column, hypothesis: Column) -> Column:
    """Substitutions, deletions and insertions of words.

    Spark's ``levenshtein`` counts characters, so each distinct reference word
    gets its own character first. Words only the hypothesis has can never match
    and share one. Unicode has 1 048 575 characters for that; a reference with more
    distinct words than that is compared by ``edit_distance`` in Python.
    """

    def edits(texts: Column) -> Column:
        ref, hyp = texts["ref"], texts["hyp"]
        return once(
            F.array_distinct(ref),
            lambda known: F.when(
                F.size(known) <= CODES,
                F.levenshtein(_as_code_points(ref, known), _as_code_points(hyp, known)),
            ),
        )

    @F.arrow_udf("int")
    def counted(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left.to_pylist(), right.to_pylist())
        return pa.array([None if a is None else edit_distance(a, b) for a, b in pairs], pa.int32())

    ref, hyp = scoring_words(reference), scoring_words(hypothesis)
    short = once(F.struct(ref.alias("ref"), hyp.alias("hyp")), edits)
    # so many words have as many characters and as many spaces at least
    many = (F.length(reference) > 2 * CODES) & (F.size(F.array_distinct(ref)) > CODES)
    # no array leaves the JVM but those of such a reference
    return F.coalesce(short, counted(F.when(many, ref), F.when(many, hyp)))


def word_count(text: Column) -> Column:
    return F.size(scoring_words(text))


def char_edits(reference: Column, hypothesis: Column) -> Column:
    return F.levenshtein(squeeze(reference), squeeze(hypothesis))


def char_count(text: Column) -> Column:
    return F.length(squeeze(text))
