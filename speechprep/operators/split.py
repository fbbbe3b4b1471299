"""Train / valid / test split by recording, so no recording is in two splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "valid", "test")
# ---------------------------------------------------------------- fixed values
SEED = 42
HELD_OUT = 0.1  # share of recordings in valid, and again in test
CLIP_SUFFIX = r"_S[0-9]+[^\n]*\.wav$"
# -----------------------------------------------------------------------------

# Recordings are ranked by hash through buckets of the first hex digits, so no
# task ever orders more than one bucket. The buckets themselves are few.
_BUCKET_DIGITS = 4  # 65 536 buckets at most


def recording_key(path: Column) -> Column:
    """Recording of a clip, from the clip's name."""
    return F.regexp_replace(path, CLIP_SUFFIX, "")


def _shuffle_key(recording: Column, seed: int) -> Column:
    """Sorts recordings in a seeded random order; ties are broken by name."""
    digest = F.md5(F.concat(recording, F.lit(f":{seed}")).cast("binary"))
    return F.concat(digest, F.lit(":"), recording)


def split_cuts(recordings: DataFrame, seed: int = SEED) -> DataFrame:
    """One row: the last shuffle key of train and of valid.

    ``recordings`` has a ``recording`` column of distinct names. The split sizes
    are ``n - 2b``, ``b``, ``b`` with ``b = floor(n / 10)``; with no held-out
    recordings both cuts are the last key.
    """
    keys = recordings.select(_shuffle_key(F.col("recording"), seed).alias("key")).withColumn(
        "bucket", F.substring("key", 1, _BUCKET_DIGITS)
    )
    counts = keys.groupBy("bucket").agg(F.count("*").alias("n_bucket"))
    # at most 16 ** _BUCKET_DIGITS rows, whatever the number of recordings
    in_order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    held = F.floor(F.col("n") * HELD_OUT).cast("bigint")
    buckets = (
        counts.withColumn("n_before", F.coalesce(F.sum("n_bucket").over(in_order), F.lit(0)))
        .withColumn("n", F.sum("n_bucket").over(everything))
        .withColumn("train_end", F.col("n") - 2 * held)
        .withColumn("valid_end", F.col("n") - held)
    )
    # only the buckets that hold a cut are ranked
    holds = lambda rank: (F.col("n_before") < rank) & (
        rank <= F.col("n_before") + F.col("n_bucket")
    )
    wanted = buckets.filter(holds(F.col("train_end")) | holds(F.col("valid_end")))
    rank = F.col("n_before") + F.row_number().over(
        Window.partitionBy("bucket").orderBy("key")
    )
    ranked = keys.join(F.broadcast(wanted), "bucket").withColumn("rank", rank)
    return ranked.agg(
        F.max(F.when(F.col("rank") == F.col("train_end"), F.col("key"))).alias("train_cut"),
        F.max(F.when(F.col("rank") == F.col("valid_end"), F.col("key"))).alias("valid_cut"),
    )


def assign_splits(clips: DataFrame, seed: int = SEED, key: str = "path") -> DataFrame:
    """Add ``split`` to clip rows.

    The recording comes from the clip name, or from the ``recording`` column
    with ``key="recording"``. Clips compare their recording's shuffle key with
    the two cuts, so they are neither shuffled nor joined: one recording may
    hold most of the clips.
    """
    recording = F.col("recording") if key == "recording" else recording_key(F.col("path"))
    keyed = clips.withColumn("split_recording", recording)
    cuts = split_cuts(
        keyed.select(F.col("split_recording").alias("recording")).distinct(), seed
    )
    mine = _shuffle_key(F.col("split_recording"), seed)
    cut = cuts.select(F.struct("train_cut", "valid_cut")).scalar()
    split = (
        F.when(mine <= cut["train_cut"], "train")
        .when(mine <= cut["valid_cut"], "valid")
        .otherwise("test")
    )
    return keyed.withColumn("split", split)


def split_summary(assigned: DataFrame) -> DataFrame:
    """Recordings and clips per split; a split without rows is listed with 0."""
    spark = assigned.sparkSession
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, SPLITS))).alias("split"))
    per_recording = assigned.groupBy("split", "split_recording").agg(
        F.count("*").alias("n_clips")
    )
    counts = per_recording.groupBy("split").agg(
        F.count("*").alias("n_recordings"), F.sum("n_clips").alias("n_clips")
    )
    return names.join(counts, "split", "left").select(
        "split",
        F.coalesce("n_recordings", F.lit(0)).alias("n_recordings"),
        F.coalesce("n_clips", F.lit(0)).alias("n_clips"),
    )


def leaked_recordings(assigned: DataFrame, recording: str) -> DataFrame:
    """Values of ``recording`` whose clips ended up in more than one split."""
    return (
        assigned.groupBy(F.col(recording).alias("recording"))
        .agg(
            F.min("split").alias("first_split"),
            F.max("split").alias("last_split"),
            F.count("*").alias("n_clips"),
        )
        .filter(F.col("first_split") != F.col("last_split"))
    )
