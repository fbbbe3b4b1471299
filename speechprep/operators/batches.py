"""Model input rows: feature scaling, batches of similar length, padding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import values as v
from .vocab import IGNORED_LABEL

# ---------------------------------------------------------------- fixed values
VARIANCE_FLOOR = 1e-7
BATCH_SIZE = 8
MEGABATCH = 50  # batches sorted by length together
# -----------------------------------------------------------------------------


def unit_range(values: np.ndarray) -> np.ndarray:
    """Samples as doubles; 16-bit ones are brought to -1..1."""
    if values.dtype == np.int16:
        return values / 32_768
    return values.astype(np.float64)


def scaled(values: np.ndarray) -> np.ndarray:
    """Zero mean and unit (population) variance, of samples in -1..1."""
    x = unit_range(values)
    return (x - x.mean()) / np.sqrt(x.var() + VARIANCE_FLOOR) if len(x) else x


def scale_features(values: Column, element: T.DataType | None = None) -> Column:
    """Zero mean and unit (population) variance per row, as doubles or another
    floating ``element`` type; 16-bit samples are brought to -1..1 first. Arrow UDF: on
    rows of audio length, a transform over the array takes about ten times as long."""
    kind = T.ArrayType(element or T.DoubleType())
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def scale(rows: pa.Array) -> pa.Array:
        out = [
            scaled(row.values.to_numpy(zero_copy_only=False)) if row.is_valid else None
            for row in rows
        ]
        return pa.array(out, arrow)

    return scale.asNondeterministic()(values)


def length_batches(
    rows: DataFrame,
    id_col: str,
    length: Column,
    batch_size: int = BATCH_SIZE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Group rows of similar length: add ``shard`` and ``batch_no``.

    Rows fall at random (by hash of their unique id) into shards of about
    ``MEGABATCH`` batches; inside a shard they are sorted by length, longest
    first, and cut. No window sees more than one shard.
    The number of shards comes from a count of the rows, or of ``counted``, a
    cheaper relation of about as many.
    """
    shard_rows = batch_size * MEGABATCH
    shards = (
        (rows if counted is None else counted)
        .agg(F.greatest(F.ceil(F.count("*") / shard_rows), F.lit(1)).alias("n"))
        .scalar()
    )
    digest = F.md5(F.col(id_col).cast("string").cast("binary"))
    hashed = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    in_shard = Window.partitionBy("shard").orderBy(F.col("_length").desc(), F.col(id_col))
    return (
        rows.withColumns({"shard": hashed % shards, "_length": length})
        .withColumn("batch_no", v.div(F.row_number().over(in_shard) - 1, batch_size))
        .drop("_length")
    )


def _target_length(length: Column, batch: list[str], maximum: int | None, multiple: int | None):
    longest = F.max(length).over(Window.partitionBy(*batch))
    if maximum is not None:
        longest = F.greatest(longest, F.lit(maximum))
    if multiple:
        longest = (F.ceil(longest / multiple) * multiple).cast("int")
    return longest


def pad_batches(
    rows: DataFrame,
    batch: list[str],
    inputs: str = "input_values",
    labels: str = "labels",
    min_inputs: int | None = None,
    min_labels: int | None = None,
    inputs_multiple: int | None = None,
    labels_multiple: int | None = None,
) -> DataFrame:
    """Pad every row of a batch to the longest one.

    Inputs are padded with 0.0 and get ``attention_mask``; labels are padded
    with the label that loss functions ignore. Lengths may be raised to a fixed
    length or to a multiple.
    """
    n_in, n_lab = F.size(inputs), F.size(labels)
    sized = rows.withColumns(
        {
            "_inputs": _target_length(n_in, batch, min_inputs, inputs_multiple),
            "_labels": _target_length(n_lab, batch, min_labels, labels_multiple),
        }
    )
    fill = lambda value, have, want: F.array_repeat(value, want - have)
    ones = F.array_repeat(F.lit(1), n_in)
    return sized.withColumns(
        {
            "attention_mask": F.concat(ones, fill(F.lit(0), n_in, F.col("_inputs"))),
            inputs: F.concat(inputs, fill(F.lit(0.0), n_in, F.col("_inputs"))),
            labels: F.concat(labels, fill(F.lit(IGNORED_LABEL), n_lab, F.col("_labels"))),
        }
    ).drop("_inputs", "_labels")
