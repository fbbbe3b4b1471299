"""Segmentation of recordings on silence.

The audio is looked at tile by tile, each with the short overlap its rolling
window needs. What a tile gives is a few runs of silent window starts; ranges
that cross tiles, and the chunks between them, are put together from those.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values as v
from ..session import settle
from . import running
from .manifest import SAMPLE_RATE
from .signal import loudness

# ---------------------------------------------------------------- fixed values
MIN_SILENCE_MS = 500
SILENCE_OFFSET_DB = 10
# -----------------------------------------------------------------------------

TILE_MS = 60_000
# silences and cuts are numbered in blocks of about an hour
EDGE_BLOCK_MS = 1 << 22

RUN = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])


def silent_runs(
    energy: np.ndarray,
    begin: int,
    starts: int,
    length: int,
    min_silence: int,
    per_ms: int,
    threshold: float,
) -> list[dict]:
    """Runs of silent window starts in ``begin .. begin + starts - 1``, given the
    1 ms energies from ``begin`` on. Starts no further apart than the window are
    one run."""
    last = min(begin + starts - 1, length - min_silence)
    if last < begin:
        return []
    needed = np.zeros(last - begin + min_silence, np.int64)
    known = energy[: len(needed)]
    needed[: len(known)] = known
    total = np.concatenate([[0], np.cumsum(needed)])
    rms = np.floor(np.sqrt((total[min_silence:] - total[:-min_silence]) / (min_silence * per_ms)))
    silent = np.flatnonzero(rms <= threshold) + begin
    if not len(silent):
        return []
    new = np.flatnonzero(np.diff(silent) > min_silence)
    los = silent[np.concatenate([[0], new + 1])]
    his = silent[np.concatenate([new, [len(silent) - 1]])]
    return [{"lo": int(lo), "hi": int(hi)} for lo, hi in zip(los, his)]


def tile_length(min_silence: int, block_ms: int, tile_ms: int) -> int:
    """Tiles are whole blocks and no shorter than the silence looked for."""
    return block_ms * max(ceil(tile_ms / block_ms), ceil(min_silence / block_ms))


def thresholds(loud: DataFrame, offset_db: float, tile_ms: int) -> DataFrame:
    """``recording, tile, length_ms, threshold``: a recording's limit, spread over
    its tiles so that it meets them on a key no single recording can dominate.
    Further columns of ``loud`` are carried along."""
    last = v.div(F.col("length_ms") - 1, tile_ms)
    kept = [c for c in loud.columns if c not in ("n_samples", "rms", "dbfs")]
    return loud.filter(F.col("length_ms") > 0).select(
        *kept,
        (F.col("rms") * F.lit(10.0 ** (-offset_db / 20.0))).alias("threshold"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("tile"),
    )


def find_runs(
    energy: DataFrame,
    loud: DataFrame,
    block_ms: int,
    min_silence: int = MIN_SILENCE_MS,
    offset_db: float = SILENCE_OFFSET_DB,
    rate: int = SAMPLE_RATE,
    tile_ms: int = TILE_MS,
) -> DataFrame:
    """Silent runs ``recording, tile, length_ms, no, lo, hi`` of energy blocks."""
    keys = ["recording", "tile"]
    # a block belongs to its tile, and to the one before if that looks into it
    ms = F.col("block_no") * block_ms
    own = v.div(ms, tile_ms)
    into = (own > 0) & (F.pmod(ms, F.lit(tile_ms)) < min_silence)
    tiles = F.when(into, F.array(own, own - 1)).otherwise(F.array(own))
    tiled = energy.select("recording", "block_no", "energy", F.explode(tiles).alias("tile"))
    ordered = F.array_sort(F.collect_list(F.struct("block_no", "energy")))
    assembled = tiled.groupBy(*keys).agg(
        F.flatten(F.transform(ordered, lambda b: b["energy"])).alias("energy")
    )
    per_ms = rate // 1000

    @F.arrow_udf(T.ArrayType(RUN))
    def runs(tile: pa.Array, energies: pa.Array, length: pa.Array, limit: pa.Array) -> pa.Array:
        found = [
            silent_runs(
                e.values.to_numpy(zero_copy_only=False), t.as_py() * tile_ms, tile_ms,
                n.as_py(), min_silence, per_ms, x.as_py(),
            )
            for t, e, n, x in zip(tile, energies, length, limit)
        ]
        return pa.array(found, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))

    # non-deterministic: see signal.py
    found = runs.asNondeterministic()(
        F.col("tile"), F.col("energy"), F.col("length_ms"), F.col("threshold")
    )
    return (
        assembled.join(thresholds(loud, offset_db, tile_ms), keys)
        .select(*keys, "length_ms", found.alias("runs"))
        .select(*keys, "length_ms", F.posexplode("runs").alias("no", "run"))
        .select(*keys, "length_ms", "no", "run.lo", "run.hi")
    )


def silence_ranges(
    energy: DataFrame,
    block_ms: int,
    min_silence: int = MIN_SILENCE_MS,
    offset_db: float = SILENCE_OFFSET_DB,
    rate: int = SAMPLE_RATE,
    tile_ms: int = TILE_MS,
    loud: DataFrame | None = None,
) -> DataFrame:
    """Silent ranges ``recording, range_no, length_ms, start_ms, end_ms``. Numbers
    count from 1 in order; a range at the very start of a recording is number 0.

    A window of ``min_silence`` is silent when its whole-number RMS is at most
    the recording's RMS lowered by ``offset_db``; windows whose starts are no
    further apart than ``min_silence`` form one range.
    """
    tile_ms = tile_length(min_silence, block_ms, tile_ms)
    loud = loudness(energy, rate) if loud is None else loud
    return merge_runs(
        find_runs(energy, loud, block_ms, min_silence, offset_db, rate, tile_ms), min_silence
    )


def merge_runs(runs: DataFrame, min_silence: int) -> DataFrame:
    """Merge runs that meet at tile edges into ranges. A tile is at least as long
    as the minimum silence, so only a neighbour's last run can be close enough."""
    # runs are few, and read several times below: do not redo the audio for it
    runs = settle(runs)
    previous = runs.groupBy("recording", (F.col("tile") + 1).alias("tile")).agg(
        F.max("hi").alias("previous_hi")
    )
    near = (F.col("no") == 0) & (F.col("lo") - F.col("previous_hi") <= min_silence)
    # a range at the very start opens nothing, so ranges after it count from 1
    flagged = runs.join(previous, ["recording", "tile"], "left").withColumn(
        "opens", F.when(near | (F.col("lo") == 0), 0).otherwise(1)
    )
    numbered = running.before(
        flagged, ["recording"], "lo", {"_opened": ("sum", F.col("opens"))}, EDGE_BLOCK_MS
    )
    return numbered.groupBy(
        "recording", (F.col("_opened") + F.col("opens")).cast("bigint").alias("range_no")
    ).agg(
        F.max("length_ms").alias("length_ms"),
        F.min("lo").alias("start_ms"),
        (F.max("hi") + min_silence).alias("end_ms"),
    )


def chunks(ranges: DataFrame, recordings: DataFrame) -> DataFrame:
    """Chunks ``recording, chunk_no, start_ms, end_ms`` that tile a recording.

    Every silence inside a recording is cut in its middle; silence at either end
    stays with its chunk. A recording that is one silence has no chunk.
    ``recordings`` lists ``recording, length_ms`` (see :func:`loudness`).
    """
    start, end, length = F.col("start_ms"), F.col("end_ms"), F.col("length_ms")
    number, cut = F.col("range_no"), v.div(start + end, 2)
    nothing = F.lit(None).cast("bigint")

    def bound(chunk_no: Column, begins: Column, ends: Column, silent: bool = False) -> Column:
        return F.struct(
            chunk_no.cast("bigint").alias("chunk_no"),
            begins.cast("bigint").alias("start_ms"),
            ends.cast("bigint").alias("end_ms"),
            F.lit(silent).alias("silent"),
        )

    # a cut ends one chunk and starts the next; silence throughout voids the first
    bounds = F.when(
        (start > 0) & (end < length),
        F.array(bound(number - 1, nothing, cut), bound(number, cut, nothing)),
    ).when(
        (start == 0) & (end == length), F.array(bound(number, nothing, nothing, True))
    )
    first = F.array(bound(F.lit(0), F.lit(0), nothing))
    rows = ranges.select("recording", "length_ms", F.inline(bounds)).unionByName(
        recordings.filter(length > 0).select("recording", "length_ms", F.inline(first))
    )
    return (
        rows.groupBy("recording", "chunk_no")
        .agg(
            F.max("start_ms").alias("start_ms"),
            F.coalesce(F.min("end_ms"), F.max("length_ms")).alias("end_ms"),
            F.bool_or("silent").alias("silent"),
        )
        .filter(~F.col("silent"))
        .drop("silent")
    )


def segment(
    energy: DataFrame,
    block_ms: int,
    min_silence: int = MIN_SILENCE_MS,
    offset_db: float = SILENCE_OFFSET_DB,
    rate: int = SAMPLE_RATE,
    tile_ms: int = TILE_MS,
) -> DataFrame:
    """Energy blocks to chunks in one call."""
    loud = settle(loudness(energy, rate))  # one row per recording, read twice
    ranges = silence_ranges(energy, block_ms, min_silence, offset_db, rate, tile_ms, loud)
    return chunks(ranges, loud)
