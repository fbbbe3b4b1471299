"""Batch inference: run a user's model over chunk samples."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ctc
from .batches import scaled

Scorer = Callable[[np.ndarray], np.ndarray]


def score(
    chunks: DataFrame,
    make_scorer: Callable[[], Scorer],
    samples: str = "samples",
    best_only: bool = False,
    scale: bool = True,
) -> DataFrame:
    """Add the model's scores for a chunk: ``frames``, one array per frame, or with
    ``best_only`` just ``ids``, the best class of each frame.

    ``make_scorer`` builds the model once per task, on the worker; the scorer maps
    samples to a ``[frames, classes]`` array. It gets them scaled the way training rows
    are, or with ``scale=False`` as they are. Chunks are one row each and
    seconds long, so a batch stays small.
    """
    kept = [f for f in chunks.schema if f.name != samples]
    if best_only:
        added = T.StructField("ids", T.ArrayType(T.IntegerType()))
    else:
        added = T.StructField("frames", T.ArrayType(T.ArrayType(T.FloatType())))

    def run(batches):
        scorer, prepare = make_scorer(), scaled if scale else np.asarray
        for batch in batches:
            scored = [
                np.asarray(scorer(prepare(s.values.to_numpy(zero_copy_only=False))), np.float32)
                for s in batch[samples]
            ]
            if best_only:
                ids = [s.argmax(axis=1) if s.size else [] for s in scored]
                result = pa.array(ids, pa.list_(pa.int32()))
            else:
                result = _nested(scored)
            yield pa.RecordBatch.from_arrays(
                [*(batch[f.name] for f in kept), result], [*(f.name for f in kept), added.name]
            )

    return chunks.mapInArrow(run, T.StructType([*kept, added]))


def _nested(matrices: list[np.ndarray]) -> pa.Array:
    """``[frames, classes]`` arrays as lists of lists, without Python objects."""
    frames = [len(m) for m in matrices]
    widths = [n for m in matrices for n in [m.shape[1] if m.ndim == 2 else 0] * len(m)]
    flat = np.concatenate([m.reshape(-1) for m in matrices]) if matrices else np.zeros(0, np.float32)
    ends = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    rows = pa.ListArray.from_arrays(ends(widths), pa.array(flat, pa.float32()))
    return pa.ListArray.from_arrays(ends(frames), rows)


def transcribe(
    chunks: DataFrame,
    make_scorer: Callable[[], Scorer],
    chars: Column,
    blank: Column | int,
    scale: bool = True,
) -> DataFrame:
    """Score chunks and decode the scores: adds ``prediction`` and ``n_samples``.
    Only the best class of each frame leaves the scoring task."""
    sized = chunks.withColumn("n_samples", F.size("samples").cast("bigint"))
    scored = score(sized, make_scorer, best_only=True, scale=scale)
    text = ctc.ids_to_text(ctc.collapse(F.col("ids"), blank), chars)
    return scored.withColumn("prediction", text).drop("ids")
