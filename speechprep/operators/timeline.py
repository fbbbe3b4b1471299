"""Prediction tables: chunk durations and their running timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as v
from . import running
from .signal import CHUNK_SECONDS


def cap_length(df: DataFrame, length: str, per_second: int, seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Limit a length column (samples, or milliseconds) to the scored part."""
    return df.withColumn(length, F.least(F.col(length), F.lit(seconds * per_second)))


def timeline(
    chunks: DataFrame, length: str, per_second: int, block: int = running.BLOCK
) -> DataFrame:
    """Add ``start_s``, ``end_s`` and ``duration_s`` by adding up chunk lengths.

    Chunks are in ``chunk_no`` order within ``recording``; lengths are whole
    units, so the sums are exact and the start of a chunk is the end of the one
    before it.
    """
    summed = running.before(
        chunks, ["recording"], "chunk_no", {"_offset": ("sum", F.col(length))}, block
    )
    return timed_by(summed, "_offset", length, per_second)


def timed_by(chunks: DataFrame, offset: str, length: str, per_second: int) -> DataFrame:
    """The three columns from ``offset``, the length of all chunks before."""
    per = F.lit(float(per_second))
    return chunks.withColumns(
        {
            "start_s": F.col(offset) / per,
            "end_s": (F.col(offset) + F.col(length)) / per,
            "duration_s": F.col(length) / per,
        }
    ).drop(offset)


def source_times(chunks: DataFrame) -> DataFrame:
    """The same columns from the chunk's own bounds in the recording, which do
    not drift when a chunk was cut before scoring."""
    return chunks.withColumns(
        {
            "start_s": F.col("start_ms") / 1000.0,
            "end_s": F.col("end_ms") / 1000.0,
            "duration_s": (F.col("end_ms") - F.col("start_ms")) / 1000.0,
        }
    )


def chunk_file(chunk_no: Column) -> Column:
    return v.numbered("chunk_%06d.wav", chunk_no)


def prediction_table(timed: DataFrame) -> DataFrame:
    """The five published columns plus ``recording``; a missing text is empty."""
    return timed.select(
        "recording",
        chunk_file(F.col("chunk_no")).alias("Chunk"),
        F.coalesce("prediction", F.lit("")).alias("Prediction"),
        F.col("start_s").alias("Start"),
        F.col("end_s").alias("End"),
        F.col("duration_s").alias("Duration"),
    )


def non_empty(df: DataFrame, column: str = "prediction") -> DataFrame:
    """Rows with a text. White space counts as text."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def result_path(path: Column, root: str, extension: str) -> Column:
    """Where results of a recording go: ``<root>_result`` mirrors ``<root>``."""
    base = root.rstrip("/")
    relative = F.substr(v.parent(path), F.lit(len(base) + 1))
    return F.concat(
        F.lit(f"{base}_result"), relative, F.lit("/"), v.stem(path), F.lit(f".{extension}")
    )
