"""Audio kept as a table from which training rows are made without moving samples.

A recording is cut into tiles of a fixed number of blocks. The table has the blocks of a
tile and, as a margin, those that follow it, as many as the longest clip may reach into,
so that every clip lies whole in the tile it starts in. The table is bucketed by
(recording, tile). What moves for a set of clips are their bounds and labels: they are
dealt to the buckets, and the task that reads a bucket puts clips together, scales and
pads them. A margin costs its share of a tile once, when the table is written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values as v
from ..operators import batches
from ..operators.manifest import MAX_SECONDS, SAMPLE_RATE, TAIL_SECONDS
from ..operators.vocab import IGNORED_LABEL, Alphabet
from ..session import shared_folder

#: Blocks of a tile and samples of the longest clip, for blocks of one second.
TILE_BLOCKS = 120
LONGEST_CLIP = int((MAX_SECONDS + TAIL_SECONDS) * SAMPLE_RATE)


@dataclass(frozen=True)
class Tiles:
    """A stored table of tiles and how it was cut."""

    name: str
    block_samples: int
    tile_blocks: int
    longest: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def drop(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def write_tiles(
    blocks: DataFrame,
    buckets: int,
    block_samples: int = SAMPLE_RATE,
    tile_blocks: int = TILE_BLOCKS,
    longest: int = LONGEST_CLIP,
    name: str | None = None,
    folder: str | None = None,
) -> Tiles:
    """Keep ``recording, block_no, samples`` blocks as a table of tiles. One file per
    bucket, in the order of the tiles; ``folder`` is a new one in the shared folder
    unless given."""
    spark = blocks.sparkSession
    made = Tiles(name or f"tiles_{uuid.uuid4().hex}", block_samples, tile_blocks, longest)
    margin = -(-longest // block_samples)
    # a block belongs to its own tile and to those before it whose margin reaches it
    first = F.greatest(v.div(F.col("block_no") - margin, tile_blocks), F.lit(0))
    tiled = blocks.select(
        "recording",
        "block_no",
        F.size("samples").alias("n_samples"),
        "samples",
        F.explode(F.sequence(first, v.div(F.col("block_no"), tile_blocks))).alias("tile"),
    )
    (
        tiled.repartition(buckets, "recording", "tile")
        .write.option("path", folder or f"{shared_folder(spark)}/{made.name}")
        .bucketBy(buckets, "recording", "tile")
        .sortBy("recording", "tile", "block_no")
        .saveAsTable(made.name)
    )
    return made


def _bounded(clips: DataFrame, table: DataFrame, tiles: Tiles) -> DataFrame:
    """Clips within their recordings, with their tile. A clip longer than the table was
    made for is an error: its end may lie beyond the margin."""
    # a block counts in the tile it lies in
    own = table.filter(F.col("tile") == v.div(F.col("block_no"), tiles.tile_blocks))
    ends = own.groupBy("recording").agg(
        F.max(F.col("block_no") * tiles.block_samples + F.col("n_samples")).alias("_end")
    )
    inside = clips.join(ends, "recording").withColumn("end_sample", F.least("end_sample", "_end"))
    length = F.col("end_sample") - F.col("start_sample")
    message = F.concat("path", F.lit(f" is longer than {tiles.longest} samples"))
    fits = F.when(length <= tiles.longest, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    tile = v.div(F.col("start_sample"), tiles.tile_blocks * tiles.block_samples)
    return inside.drop("_end").filter((length > 0) & fits).withColumn("tile", tile)


def _padded(samples: Column, length: Column) -> Column:
    """Scaled samples, filled up with zeros."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def pad(rows: pa.Array, lengths: pa.Array) -> pa.Array:
        out = []
        for row, n in zip(rows, lengths.to_pylist()):
            filled = np.zeros(n, np.float32)
            own = row.values.to_numpy(zero_copy_only=False)
            filled[: len(own)] = batches.scaled(own)
            out.append(filled)
        return pa.array(out, pa.list_(pa.float32()))

    return pad.asNondeterministic()(samples, length)


def training_rows(
    clips: DataFrame, tiles: Tiles, alphabet: Alphabet, batch_size: int = batches.BATCH_SIZE
) -> DataFrame:
    """``path, shard, batch_no, input_values, labels, attention_mask`` of the clips
    ``path, sentence, recording, start_sample, end_sample``.

    Batches and padded lengths come from the bounds alone. Samples are read, put
    together, scaled and padded in the tasks that read the buckets; rows of a batch have
    equal lengths and its number, and may lie in several files.
    """
    table = tiles.read(clips.sparkSession)
    bounded = _bounded(clips, table.drop("samples"), tiles)
    length = F.col("end_sample") - F.col("start_sample")
    batched = batches.length_batches(bounded, "path", length, batch_size, clips)
    labelled = batched.withColumn("labels", alphabet.encode(F.col("sentence")))
    batch = Window.partitionBy("shard", "batch_no")
    missing = F.max(F.size("labels")).over(batch) - F.size("labels")
    narrow = labelled.select(
        "recording",
        "tile",
        "path",
        "shard",
        "batch_no",
        "start_sample",
        "end_sample",
        F.max(length).over(batch).cast("int").alias("n_values"),
        F.concat("labels", F.array_repeat(F.lit(IGNORED_LABEL), missing)).alias("labels"),
    )
    begin = F.col("block_no") * tiles.block_samples
    meets = (begin < F.col("end_sample")) & (begin + F.col("n_samples") > F.col("start_sample"))
    skip = F.greatest(F.col("start_sample") - begin, F.lit(0)).cast("int")
    take = (F.least(F.col("end_sample") - begin, F.col("n_samples")) - skip).cast("int")
    pieces = (
        narrow.join(table, ["recording", "tile"])
        .filter(meets)
        .withColumn("piece", F.struct("block_no", F.slice("samples", skip + 1, take).alias("samples")))
    )
    keys = ["recording", "tile", "path", "shard", "batch_no", "n_values", "labels"]
    whole = pieces.groupBy(*keys).agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    samples = F.flatten(F.transform("pieces", lambda p: p["samples"]))
    made = whole.withColumn("samples", samples)
    own = F.size("samples")
    mask = F.concat(F.array_repeat(F.lit(1), own), F.array_repeat(F.lit(0), F.col("n_values") - own))
    return made.select(
        "path",
        "shard",
        "batch_no",
        _padded(F.col("samples"), F.col("n_values")).alias("input_values"),
        "labels",
        mask.alias("attention_mask"),
    )
