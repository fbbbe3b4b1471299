"""Tables as delimited text, and the vocabulary file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.split import SPLITS


def _write(df: DataFrame, path: str, sep: str, *partition: str) -> None:
    (
        df.write.mode("overwrite")
        .partitionBy(*partition)
        .option("sep", sep)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    _write(manifest.select("path", "sentence", "duration", "recording"), path, "\t")


def write_splits(assigned: DataFrame, directory: str) -> None:
    """One table per split in one pass: ``<directory>/split=<name>``."""
    rows = assigned.filter(assigned["split"].isin(*SPLITS))
    _write(rows.select("path", "sentence", "split"), directory, "\t", "split")


def write_predictions(table: DataFrame, directory: str) -> None:
    """Prediction tables, one folder per recording, in timeline order. Rows are
    range-partitioned, so a long recording is written by several tasks; its part
    files in name order are the table."""
    ordered = table.repartitionByRange("recording", "Start", "Chunk").sortWithinPartitions(
        "recording", "Start", "Chunk"
    )
    _write(ordered, directory, ",", "recording")


def write_vocabulary(json: DataFrame, path: str) -> None:
    """The one-row result of ``vocabulary_json`` as a text file."""
    json.coalesce(1).write.mode("overwrite").text(path)
