"""Greedy CTC decoding of frame scores, inside one row per utterance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.values import once
from .vocab import ids_to_text


def best_classes(frames: Column) -> Column:
    """Index of the highest score of each frame; the first one on ties."""
    return F.transform(
        frames, lambda s: (F.array_position(s, F.array_max(s)) - 1).cast("int")
    )


def collapse(ids: Column, blank: Column | int) -> Column:
    """Runs of one id become one, then blanks go. Order matters: a blank between
    two equal ids keeps them apart."""
    kept = lambda all_ids: F.filter(
        all_ids,
        lambda x, i: (x != blank) & ((i == 0) | (F.get(all_ids, i - 1) != x)),
    )
    return once(ids, kept)


def decode(frames: Column, chars: Column, blank: Column | int) -> Column:
    """Frame scores (one array per frame) to text; ``chars`` is the vocabulary in
    id order."""
    return ids_to_text(collapse(best_classes(frames), blank), chars)
