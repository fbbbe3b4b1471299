"""Corpus error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import edits


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Add edit and length counts to ``reference`` / ``hypothesis`` rows. Whole
    texts are compared."""
    ref, hyp = F.col("reference"), F.col("hypothesis")
    return pairs.withColumns(
        {
            "word_edits": edits.word_edits(ref, hyp),
            "ref_words": edits.word_count(ref),
            "char_edits": edits.char_edits(ref, hyp),
            "ref_chars": edits.char_count(ref),
        }
    )


def _rate(scored: DataFrame, by: list[str], edit: str, total: str, name: str) -> DataFrame:
    sums = scored.groupBy(*by).agg(
        F.count("*").alias("n_pairs"),
        F.sum(edit).cast("bigint").alias("edits"),
        F.sum(total).cast("bigint").alias(total),
    )
    rate = F.when(F.col(total) > 0, F.col("edits") / F.col(total))
    return sums.withColumn(name, F.round(rate, 6))


def word_error_rate(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Word edits over reference words, summed before dividing."""
    return _rate(score_pairs(pairs), by or [], "word_edits", "ref_words", "wer")


def char_error_rate(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    return _rate(score_pairs(pairs), by or [], "char_edits", "ref_chars", "cer")
