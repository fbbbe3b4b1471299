"""Fill-in-the-middle: texts cut at two unit ends and put together in another order.

The UTF-8 bytes of many texts are viewed as 64-bit words. Arithmetic on whole words
marks the bytes that end a unit (a line, or a code point), a population count per word
and a running sum say how many units end before each word, and the end of unit ``k`` of
a text is found by a search of that sum for its word and a select within the word. No
unit is listed.

Where a text is cut is drawn from a digest of its id, so every run cuts alike: with
``h1`` to ``h4`` the first four groups of eight digits of the hexadecimal SHA-256 of
``seed:id``, of ``n`` units the prefix ends after the smaller of ``h1 % (n + 1)`` and
``h2 % (n + 1)``, the middle after the larger.

Defined results: a null text is an empty one; an empty text, and one that contains a
sentinel, stays as it is (form ``plain``); a null id is digested as an empty string;
rows are cut one by one, so repeated rows get equal results; either part may be empty; a
long text is cut like any other; the table may be empty; of extra columns nothing is
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechprep.functions.values import once
from speechprep.llm.spans import Texts, pieces

_ONES = np.uint64(0x0101010101010101)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_LINE_FEEDS = np.uint64(0x0A0A0A0A0A0A0A0A)


@dataclass(frozen=True)
class Sentinels:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _starts(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that begins a code point (none that looks 10xxxxxx)."""
    return (~words | words << np.uint64(1)) & _HIGH


def _line_feeds(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed."""
    other = words ^ _LINE_FEEDS
    # adding does not carry into the next byte; the high bit stays clear for zero only
    return ~(((other & _LOW7) + _LOW7) | other) & _HIGH


class Marked:
    """Marked bytes of a run of bytes, with counts before any byte and select."""

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks
        self.sums = np.zeros(len(marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.sums[1:])

    def before(self, at: np.ndarray) -> np.ndarray:
        """How many marks stand before the bytes ``at``."""
        word = at >> 3
        shift = (at & 7).astype(np.uint64) * np.uint64(8)
        inside = np.append(self.marks, np.uint64(0))[word] & ((np.uint64(1) << shift) - np.uint64(1))
        return self.sums[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of mark ``k``, counted from 0."""
        word = np.searchsorted(self.sums, k, "right") - 1
        rank = (k - self.sums[word]).astype(np.uint64)
        # byte i of the product counts the marks in bytes 0 to i; no sum exceeds 8
        counts = (self.marks[word] >> np.uint64(7)) * _ONES
        # the high bit stays where a byte's count is at most the rank
        at_most = ((rank * _ONES | _HIGH) - counts) & _HIGH
        return word * 8 + np.bitwise_count(at_most).astype(np.int64)


class Units:
    """The units of texts, by counts and ends."""

    def __init__(self, texts: Texts, unit: str) -> None:
        size = len(texts.data)
        padded = np.zeros(-(-size // 8) * 8, dtype=np.uint8)
        padded[:size] = texts.data
        words = padded.view("<u8")
        starts = _starts(words)
        self.characters = Marked(starts)
        self.begins, self.ends = texts.starts[:-1], texts.starts[1:]
        if unit == "line":
            self.marked = Marked(_line_feeds(words))
        elif unit == "character":
            # the byte before each start, from the next word for the last byte
            following = np.append(starts[1:], _HIGH)
            self.marked = Marked(starts >> np.uint64(8) | following << np.uint64(56))
        else:
            raise ValueError(f"unit {unit}: line or character")
        self.earlier = self.marked.before(self.begins)
        self.closed = self.marked.before(self.ends) - self.earlier
        last = texts.data[np.maximum(self.ends - 1, 0)] if size else np.zeros(len(texts), np.uint8)
        # what follows the last line feed is a line without one
        self.open = (self.ends > self.begins) & (unit == "line") & (last != 0x0A)
        self.counts = self.closed + self.open

    def end_of(self, k: np.ndarray) -> np.ndarray:
        """The byte after the first ``k`` units of each text."""
        out = np.where(k > 0, self.ends, self.begins)
        inner = np.flatnonzero((k > 0) & (k <= self.closed))
        out[inner] = self.marked.select(self.earlier[inner] + k[inner] - 1) + 1
        return out

    def length(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Code points between bytes."""
        return self.characters.before(end) - self.characters.before(begin)


def drawn(id_: Column, seed: int, group: int) -> Column:
    """Group ``group`` (0 to 3) of the digest of ``seed:id``, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "line",
    percent: int = 100,
    spm_percent: int = 50,
    seed: int = 7,
    sentinels: Sentinels = Sentinels(),
) -> DataFrame:
    """``(id_col, n, form, prefix_chars, middle_chars, output)`` of every row.

    ``n`` is the number of units, ``form`` is ``psm`` (prefix, suffix, middle), ``spm``
    (suffix, prefix, middle) or ``plain``; of the texts that are not plain for another
    reason, ``percent`` are transformed, and ``spm_percent`` of these are ``spm``. The
    two lengths are null for ``plain``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = (text == "") | (drawn(F.col(id_col), seed, 2) % 100 >= percent)
    for mark in sentinels.all():
        whole = whole | F.contains(text, F.lit(mark))
    form = F.when(whole, "plain").when(drawn(F.col(id_col), seed, 3) % 100 < spm_percent, "spm")
    before, between, after = (mark.encode() for mark in sentinels.all())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "_text"):
            units = Units(texts, unit)
            places = [batch.column(k).to_numpy() % (units.counts + 1) for k in (2, 3)]
            first = units.end_of(np.minimum(*places))
            second = units.end_of(np.maximum(*places))
            forms = batch.column(4).to_pylist()
            raw, out = texts.data.tobytes(), []
            cuts = zip(forms, units.begins.tolist(), first.tolist(), second.tolist(), units.ends.tolist(), strict=True)
            for kind, a, b, c, d in cuts:
                if kind == "psm":
                    out.append(b"".join((before, raw[a:b], between, raw[c:d], after, raw[b:c])))
                elif kind == "spm":
                    out.append(b"".join((between, raw[c:d], before, raw[a:b], after, raw[b:c])))
                else:
                    out.append(raw[a:d])
            plain = np.array([kind == "plain" for kind in forms], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(units.counts, pa.int64()),
                    batch.column(4),
                    pa.array(units.length(units.begins, first), pa.int64(), mask=plain),
                    pa.array(units.length(first, second), pa.int64(), mask=plain),
                    pa.array(out, pa.string()),
                ],
                names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = documents.schema[id_col].dataType.simpleString()
    drawn_ = documents.select(
        F.col(id_col).alias("_id"),
        text.alias("_text"),
        drawn(F.col(id_col), seed, 0).alias("_h1"),
        drawn(F.col(id_col), seed, 1).alias("_h2"),
        F.coalesce(form, F.lit("psm")).alias("_form"),
    )
    schema = "n long, form string, prefix_chars long, middle_chars long, output string"
    return drawn_.mapInArrow(run, f"_id {kind}, {schema}").withColumnRenamed("_id", id_col)


def restored(output: Column, form: Column, sentinels: Sentinels = Sentinels()) -> Column:
    """The text an output was made of. A transformed text holds no sentinel, and none
    can begin within one, so that each occurs once."""
    marks = "|".join(rf"\Q{mark}\E" for mark in sentinels.all())

    def joined(parts: Column) -> Column:
        one, two, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
        return F.when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))

    return F.when(form == "plain", output).otherwise(once(F.split(output, marks, -1), joined))
