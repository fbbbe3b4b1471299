"""Audio operators over sample blocks.

A recording is a set of rows ``recording, block_no, samples``: equal blocks of
16-bit samples, the last one possibly shorter. Nothing here brings a whole
recording together. Work that looks past a block (rolling loudness, resampling)
runs on tiles that carry a short overlap with their neighbours, and what spans
tiles is joined up afterwards from a few small rows.

UDFs here are declared non-deterministic although they are not: Catalyst would
otherwise copy a call into the filter it infers below an explode, and run it
twice.
"""

from __future__ import annotations

from math import ceil, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values as v
from .manifest import SAMPLE_RATE, clip_windows

# ---------------------------------------------------------------- fixed values
FULL_SCALE = 32_768
CHUNK_SECONDS = 25
# band-limited interpolation: zero crossings each side, and roll-off
FILTER_ZEROS = 6
FILTER_ROLLOFF = 0.99
# -----------------------------------------------------------------------------

# ------------------------------------------------------------------- channels


def downmix(channels: Column, mode: str = "mean") -> Column:
    """One channel from an array of channels: their mean, or the first."""
    first = F.get(channels, F.lit(0))
    if mode == "first":
        return first
    total = F.aggregate(
        F.slice(channels, 2, F.greatest(F.size(channels) - 1, F.lit(0))),
        first.cast("array<double>"),
        lambda acc, c: F.zip_with(acc, c.cast("array<double>"), lambda a, b: a + b),
    )
    n = F.size(channels)
    return F.transform(total, lambda x: x / n)


def truncate(samples: Column, rate: int = SAMPLE_RATE, seconds: int = CHUNK_SECONDS) -> Column:
    """The part of a chunk that is scored."""
    return F.slice(samples, 1, rate * seconds)


# -------------------------------------------------------------------- loudness


def millisecond_energies(samples: np.ndarray, per_ms: int) -> np.ndarray:
    """Sum of squares of every ``per_ms`` samples; the last may have fewer."""
    if not len(samples):
        return np.zeros(0, np.int64)
    wide = samples.astype(np.int64)
    return np.add.reduceat(wide * wide, np.arange(0, len(wide), per_ms))


def energy_blocks(blocks: DataFrame, rate: int = SAMPLE_RATE) -> DataFrame:
    """Blocks of 1 ms energies. Sixteen times fewer values than samples; write
    this relation out when several silence settings are to be tried."""
    per_ms = rate // 1000

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def energies(samples: pa.Array) -> pa.Array:
        arrays = [
            millisecond_energies(s.values.to_numpy(zero_copy_only=False), per_ms)
            if s.is_valid
            else None
            for s in samples
        ]
        return pa.array(arrays, pa.list_(pa.int64()))

    return blocks.select(
        "recording",
        "block_no",
        F.size("samples").alias("n_samples"),
        energies.asNondeterministic()(F.col("samples")).alias("energy"),
    )


def frame_energy(energy: DataFrame, block_ms: int) -> DataFrame:
    """The same energies as rows: ``recording, ms, energy``."""
    rows = energy.select("recording", "block_no", F.posexplode("energy").alias("pos", "energy"))
    return rows.select(
        "recording", (F.col("block_no") * block_ms + F.col("pos")).alias("ms"), "energy"
    )


def loudness(energy: DataFrame, rate: int = SAMPLE_RATE) -> DataFrame:
    """Per recording: length, whole-number RMS and loudness relative to full
    scale (null for digital silence). Sums are exact."""
    total = F.aggregate("energy", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return loudness_of(energy.select("recording", "n_samples", total.alias("squares")), rate)


def loudness_of(sums: DataFrame, rate: int = SAMPLE_RATE) -> DataFrame:
    """The same from partial sums ``recording, n_samples, squares``."""
    sums = sums.groupBy("recording").agg(
        F.sum("n_samples").alias("n_samples"),
        F.sum(F.col("squares").cast("decimal(28,0)")).alias("squares"),
    )
    rms = F.floor(F.sqrt(F.col("squares").cast("double") / F.col("n_samples")))
    return sums.withColumn("rms", rms).select(
        "recording",
        "n_samples",
        F.rint(F.col("n_samples") * 1000 / rate).cast("bigint").alias("length_ms"),
        "rms",
        F.when(F.col("rms") > 0, 20 * F.log10(F.col("rms") / FULL_SCALE)).alias("dbfs"),
    )


# --------------------------------------------------------------------- slicing


def cut_samples(
    windows: DataFrame, blocks: DataFrame, block_samples: int, key: str = "path"
) -> DataFrame:
    """Samples of ``recording, start_sample, end_sample`` windows of a block table.

    A window asks for the blocks it covers and meets them on (recording,
    block_no); only the pieces it needs are shuffled again. Windows are seconds
    long, so a result row stays small. Windows past the end of a recording give
    no row. A block table bucketed by (recording, block_no) is not shuffled.
    """
    start, end = F.col("start_sample"), F.col("end_sample")
    wanted = windows.filter(end > start).select(
        "recording",
        key,
        "start_sample",
        "end_sample",
        F.explode(
            F.sequence(v.div(start, block_samples), v.div(end - 1, block_samples))
        ).alias("block_no"),
    )
    begin = F.col("block_no") * block_samples
    skip = F.greatest(start - begin, F.lit(0)).cast("int")
    take = (F.least(end - begin, F.lit(block_samples)) - skip).cast("int")
    pieces = wanted.join(blocks, ["recording", "block_no"]).select(
        "recording", key, "block_no", F.slice("samples", skip + 1, take).alias("piece")
    )
    ordered = F.array_sort(F.collect_list(F.struct("block_no", "piece")))
    return (
        pieces.groupBy("recording", key)
        .agg(F.flatten(F.transform(ordered, lambda p: p["piece"])).alias("samples"))
        .filter(F.size("samples") > 0)
    )


def cut_clips(
    manifest: DataFrame, blocks: DataFrame, block_samples: int, rate: int = SAMPLE_RATE, **window
) -> DataFrame:
    """Samples of every manifest row, tail included."""
    return cut_samples(clip_windows(manifest, rate, **window), blocks, block_samples)


def chunk_windows(
    segmented: DataFrame, rate: int = SAMPLE_RATE, seconds: int = CHUNK_SECONDS
) -> DataFrame:
    """Sample bounds of chunks, cut to the scored length: an hour without a pause
    is never brought together."""
    start = F.col("start_ms") * (rate // 1000)
    end = F.col("end_ms") * (rate // 1000)
    return segmented.select(
        "recording",
        "chunk_no",
        start.alias("start_sample"),
        F.least(end, start + rate * seconds).alias("end_sample"),
    )


# ------------------------------------------------------------------ resampling


_KERNELS: dict[tuple[int, int], tuple] = {}


def resampling_kernel(source: int, target: int) -> tuple[np.ndarray, int, int, int]:
    """Polyphase windowed-sinc kernel ``[phases, taps]`` with its half width and
    the reduced rates. Kept for the life of a task."""
    if (source, target) not in _KERNELS:
        _KERNELS[source, target] = _make_kernel(source, target)
    return _KERNELS[source, target]


def _make_kernel(source: int, target: int) -> tuple[np.ndarray, int, int, int]:
    """Windowed-sinc interpolation (Smith and Gossett, 1984) for a rational ratio, one
    filter per output phase, with a squared-cosine (Hann) window over the zero
    crossings kept."""
    common = gcd(source, target)
    source, target = source // common, target // common
    base = min(source, target) * FILTER_ROLLOFF
    width = ceil(FILTER_ZEROS * source / base)
    taps = np.arange(-width, width + source) / source
    phases = -np.arange(target)[:, None] / target
    t = np.clip((taps[None, :] + phases) * base, -FILTER_ZEROS, FILTER_ZEROS)
    window = np.cos(t * np.pi / FILTER_ZEROS / 2) ** 2
    return np.sinc(t) * window * (base / source), width, source, target


def resample_piece(
    left: np.ndarray, own: np.ndarray, right: np.ndarray, source: int, target: int
) -> np.ndarray:
    """Resample ``own`` given what comes before and after it (zeros if nothing)."""
    kernel, width, step, phases = resampling_kernel(source, target)
    groups = -(-len(own) // step)
    padded = np.zeros(2 * width + (groups + 1) * step)
    left = left[-width:]
    padded[width - len(left) : width] = left
    padded[width : width + len(own)] = own
    after = right[: len(padded) - width - len(own)]
    padded[width + len(own) : width + len(own) + len(after)] = after
    windows = np.lib.stride_tricks.sliding_window_view(padded, kernel.shape[1])[::step][:groups]
    return (windows @ kernel.T).reshape(-1)[: -(-phases * len(own) // step)]


def resample(
    blocks: DataFrame, source: int, target: int = SAMPLE_RATE, block_samples: int | None = None
) -> DataFrame:
    """Resample a block table: ``recording, block_no, samples`` (doubles).

    Blocks send the few samples their neighbours look at, and each block is then
    filtered by itself. A block must be a multiple of the reduced source rate
    and longer than the filter, so output blocks line up too.
    """
    _, width, step, _ = resampling_kernel(source, target)
    reach = width + step
    size = block_samples or source
    if size % step or size < reach:
        raise ValueError(f"blocks of {size} samples do not fit a {source}->{target} filter")
    samples = F.col("samples")
    none = F.lit(None).cast(blocks.schema["samples"].dataType)
    tail = F.slice(samples, F.greatest(F.size(samples) - width + 1, F.lit(1)), width)
    edges = F.array(
        F.struct(
            (F.col("block_no") + 1).alias("block_no"), tail.alias("left"), none.alias("right")
        ),
        F.struct(
            (F.col("block_no") - 1).alias("block_no"),
            none.alias("left"),
            F.slice(samples, 1, reach).alias("right"),
        ),
    )
    keys = ["recording", "block_no"]
    # only edges are grouped; a block table bucketed by the keys stays in place
    sides = (
        blocks.select("recording", F.inline(edges))
        .groupBy(*keys)
        .agg(F.max("left").alias("left"), F.max("right").alias("right"))
    )
    neighbours = blocks.withColumnRenamed("samples", "own").join(sides, keys, "left")

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def filtered(left: pa.Array, own: pa.Array, right: pa.Array) -> pa.Array:
        values = lambda a: np.asarray(a.values if a.is_valid else [], float)
        out = [
            resample_piece(values(a), values(b), values(c), source, target)
            for a, b, c in zip(left, own, right)
        ]
        return pa.array(out, pa.list_(pa.float64()))

    resampled = filtered.asNondeterministic()(F.col("left"), F.col("own"), F.col("right"))
    return neighbours.select("recording", "block_no", resampled.alias("samples"))
