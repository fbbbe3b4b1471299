"""Quality rules from repetition coverage.

Every text's words are hashed, rolled into hashes of several n-gram lengths, and the
characters inside n-grams and lines that occur more than once in the text are
measured, all with numpy over the bytes of many texts at once.

Defined results: a null or empty text has no words and fails the word count; texts
are judged one by one, so repeated rows get equal results; the table may be empty;
of extra columns nothing is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechprep.llm.spans import Texts, grams, mix, pieces

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Largest shares that a kept text may have.

    ``ngram_chars``: by n-gram length, the share of a text's word characters inside
    n-grams found twice or more; all occurrences count, the first too, so the limits
    are twice those used where only later ones count. ``line_chars``, ``lines``: the share of characters
    and of lines (with a word) in lines equal to an earlier one.
    """

    least_words: int = 50
    repeat_words: float = 0.5
    lines: float = 0.3
    line_chars: float = 0.2
    ngram_chars: dict[int, float] = field(
        default_factory=lambda: {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
    )


DEFAULT = Limits()


def _repeated(hashes: np.ndarray) -> np.ndarray:
    """Which hashes occur more than once."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = np.zeros(len(ranked) + 1, dtype=bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.empty(len(ranked), dtype=bool)
    out[order] = same[1:] | same[:-1]
    return out


def _later(hashes: np.ndarray) -> np.ndarray:
    """Which hashes equal an earlier one."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = np.zeros(len(ranked), dtype=bool)
    same[1:] = ranked[1:] == ranked[:-1]
    out = np.empty(len(ranked), dtype=bool)
    out[order] = same
    return out


def _covered(firsts: np.ndarray, n: int, count: int) -> np.ndarray:
    """Which of ``count`` words lie in a run of ``n`` that starts at ``firsts``."""
    change = np.zeros(count + 1, dtype=np.int64)
    np.add.at(change, firsts, 1)
    np.add.at(change, firsts + n, -1)
    return np.cumsum(change[:-1]) > 0


def measure(texts: Texts, limits: Limits) -> dict[str, np.ndarray]:
    """The measures of each text, as arrays."""
    n = len(texts)
    starts, ends = texts.words()
    owners = texts.owners(starts)
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    position = texts.characters()
    chars = position[ends] - position[starts]

    def by_text(of: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of, weights, minlength=n).astype(np.int64)

    out = {"n_words": by_text(owners), "word_chars": by_text(owners, chars)}
    marks = np.flatnonzero(SYMBOLS[texts.data])
    out["n_symbols"] = by_text(texts.owners(marks))

    # lines that have a word, known by the first word at or after their start
    line_starts, line_ends = texts.lines()
    if len(starts):
        first = np.searchsorted(starts, line_starts)
        has_word = (first < len(starts)) & (
            starts[np.minimum(first, len(starts) - 1)] < line_ends
        )
        line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    else:
        line_starts = line_ends = np.zeros(0, np.int64)
    line_owner = texts.owners(line_starts)
    again = _later(texts.hashes(line_starts, line_ends) ^ salt[line_owner])
    line_chars = position[line_ends] - position[line_starts]
    out["n_lines"] = by_text(line_owner)
    out["n_dup_lines"] = by_text(line_owner[again])
    out["line_chars"] = by_text(line_owner, line_chars)
    out["dup_line_chars"] = by_text(line_owner[again], line_chars[again])

    words = texts.hashes(starts, ends)
    hashes, firsts = grams(words, owners, 3)
    firsts = firsts[_repeated(hashes ^ salt[owners[firsts]])]
    covered = _covered(firsts, 3, len(words))
    out["n_repeat_words"] = by_text(owners[covered])
    # a longer n-gram can only be repeated where a shorter one is
    known = np.zeros(len(words), dtype=bool)
    known[firsts] = True
    for length in sorted(limits.ngram_chars):
        hashes, firsts = grams(words, owners, length)
        open_ = known[firsts]
        hashes, firsts = hashes[open_], firsts[open_]
        firsts = firsts[_repeated(hashes ^ salt[owners[firsts]])]
        covered = _covered(firsts, length, len(words))
        out[f"dup_chars_{length}"] = by_text(owners[covered], chars[covered])
        known[:] = False
        known[firsts] = True
    return out


def judge(m: dict[str, np.ndarray], limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """``(base_failed, kept)`` of measured texts."""
    failed = (m["n_words"] < limits.least_words) | (
        m["n_repeat_words"] > limits.repeat_words * m["n_words"]
    )
    bad = m["n_dup_lines"] > limits.lines * m["n_lines"]
    bad |= m["dup_line_chars"] > limits.line_chars * m["line_chars"]
    for length, share in limits.ngram_chars.items():
        bad |= m[f"dup_chars_{length}"] > share * m["word_chars"]
    return failed, ~failed & ~bad


def quality(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = DEFAULT
) -> DataFrame:
    """Per row of ``documents``: its id, the measures, ``base_failed`` and ``kept``."""
    names = [
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "dup_line_chars",
        *(f"dup_chars_{n}" for n in sorted(limits.ngram_chars)),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "_text"):
            measured = measure(texts, limits)
            failed, kept = judge(measured, limits)
            columns = [batch.column(0), *(pa.array(measured[n], pa.int64()) for n in names)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(failed), pa.array(kept)],
                names=["_id", *names, "base_failed", "kept"],
            )

    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, " + "".join(f"{n} long, " for n in names)
    return (
        documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .mapInArrow(run, schema + "base_failed boolean, kept boolean")
        .withColumnRenamed("_id", id_col)
    )


def keep_good(
    documents: DataFrame, text_col: str = "text", limits: Limits = DEFAULT
) -> DataFrame:
    """The rows of ``documents`` whose text is kept, with all their columns."""
    at = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, f"c{at}"):
            _, kept = judge(measure(texts, limits), limits)
            yield batch.filter(pa.array(kept))

    numbered = documents.toDF(*(f"c{i}" for i in range(len(documents.columns))))
    return numbered.mapInArrow(run, numbered.schema).toDF(*documents.columns)
