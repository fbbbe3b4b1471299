"""Schemas of the relations that cross a module or a file boundary."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


ENTRIES = _schema(("path", _S), ("name", _S), ("directory", T.BooleanType()), ("length", _L))
# One row per node of an annotation document; ``reason`` is null for spans.
NODES = _schema(
    ("recording", _S), ("pos", _L), ("sent_id", _S), ("text", _S),
    ("start", _S), ("end", _S), ("reason", _S),
)
MANIFEST = _schema(("path", _S), ("sentence", _S), ("duration", _S), ("recording", _S))
SPLIT = _schema(("path", _S), ("sentence", _S))
PREDICTIONS = _schema(
    ("Chunk", _S), ("Prediction", _S), ("Start", _D), ("End", _D), ("Duration", _D)
)
WAV_HEADERS = _schema(
    ("path", _S), ("stem", _S), ("sr", _I), ("channels", _I), ("sample_width", _I),
    ("floating", T.BooleanType()), ("data_offset", _L), ("frames", _L), ("error", _S),
)
# 16-bit samples in rows of a fixed length, so no recording is ever one row.
BLOCKS = _schema(
    ("recording", _S), ("block_no", _L), ("sr", _I), ("samples", T.ArrayType(T.ShortType(), False)),
)
# Parts of a document in the shared folder, before they are put together.
PART_FILES = _schema(("file", _S), ("section", _I), ("part_no", _L), ("part", _S))
ENERGIES = _schema(
    ("recording", _S), ("block_no", _L), ("n_samples", _L), ("energy", T.ArrayType(_L, False)),
)
TRAINING_ROWS = _schema(
    ("path", _S), ("shard", _L), ("batch_no", _L), ("input_values", T.ArrayType(T.FloatType(), False)),
    ("labels", T.ArrayType(_I, False)), ("attention_mask", T.ArrayType(_I, False)),
)
WRITTEN = _schema(("file", _S), ("bytes", _L))
# Files written under staged names, and the same after they were published.
STAGED = _schema(("file", _S), ("staged", _S), ("bytes", _L), ("md5", _S))
PUBLISHED = _schema(("file", _S), ("bytes", _L), ("md5", _S))
