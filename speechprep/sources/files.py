"""Listings and tables: recordings, annotation documents, manifests, predictions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import values as v
from ..session import saved, stored
from .listing import register

# Strings that some CSV readers take for a missing value.
NA_STRINGS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def is_recording(path, recursive: bool):
    """The flat scan takes any case of ``.wav`` but no temporary files; the
    recursive scan takes ``.wav`` exactly."""
    if recursive:
        return F.endswith(path, F.lit(".wav"))
    return (F.lower(v.suffix(path)) == ".wav") & ~F.startswith(v.file_name(path), F.lit("_tmp"))


def _level(spark: SparkSession, folders: DataFrame, suffix: str = "") -> DataFrame:
    """The folders in folders, and the files whose names end in ``suffix``, as ``path,
    name, directory, length``."""
    register(spark)
    options = {"folders": saved(folders.select("path")), "suffix": suffix}
    return spark.read.format("folder_level").options(**options).load()


def _root(spark: SparkSession, directory: str) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.lit(directory.rstrip("/")).alias("path"))


def list_files(
    spark: SparkSession, directory: str, recursive: bool = False, suffix: str = ""
) -> DataFrame:
    """``path, length`` of the files of a directory whose names end in ``suffix``,
    hidden ones included (Spark's file sources skip names that start with ``_`` or
    ``.``). A recursive listing goes level by level: every folder of a level is listed
    in parallel, once."""
    level = _root(spark, directory)
    if not recursive:
        return _level(spark, level, suffix).filter(~F.col("directory")).select("path", "length")
    levels = []
    while True:
        found = stored(_level(spark, level, suffix))
        levels.append(found.filter("not directory").select("path", "length"))
        level = found.filter("directory")
        if level.isEmpty():
            return reduce(DataFrame.union, levels)


def scan_recordings(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """``path, stem, length`` of the recordings in a directory."""
    listed = list_files(spark, directory, recursive, ".wav" if recursive else "")
    return _with_stem(listed.filter(is_recording(F.col("path"), recursive)))


def scan_annotations(spark: SparkSession, directory: str) -> DataFrame:
    """``path, stem, length`` of the annotation documents in a directory."""
    return _with_stem(list_files(spark, directory, suffix=".xml"))


def _with_stem(listed: DataFrame) -> DataFrame:
    return listed.select("path", v.stem(F.col("path")).alias("stem"), "length")


def table_options(sep: str) -> dict[str, str]:
    """How fields are written and read: only as much quoting as needed, white space
    kept."""
    return {
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "multiLine": "true",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def _read_table(spark: SparkSession, path: str, schema, sep: str, na_values: str | None) -> DataFrame:
    table = spark.read.schema(schema).options(header=True, **table_options(sep)).csv(path)
    if na_values == "pandas":
        text = [f.name for f in schema if f.dataType.simpleString() == "string"]
        table = table.withColumns(
            {c: F.when(~F.col(c).isin(*NA_STRINGS), F.col(c)) for c in text}
        )
    return table


def read_manifest(spark: SparkSession, path: str, na_values: str | None = None) -> DataFrame:
    """A manifest (tab separated, with a header)."""
    return _read_table(spark, path, schemas.MANIFEST, "\t", na_values)


def read_split(spark: SparkSession, path: str, na_values: str | None = None) -> DataFrame:
    """One split of a manifest (tab separated, with a header)."""
    return _read_table(spark, path, schemas.SPLIT, "\t", na_values)


def read_predictions(spark: SparkSession, path: str, na_values: str | None = None) -> DataFrame:
    """A prediction table (comma separated, with a header). Predictions are text,
    also where they look like numbers."""
    return _read_table(spark, path, schemas.PREDICTIONS, ",", na_values)


def list_checkpoints(spark: SparkSession, directory: str, run: str = "run") -> DataFrame:
    """``run, name`` of the checkpoint folders of a training output folder."""
    entries = _level(spark, _root(spark, directory))
    named = entries.filter("directory").filter(F.startswith("name", F.lit("checkpoint-")))
    return named.select(F.lit(run).alias("run"), "name")
