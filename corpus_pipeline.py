"""Documents to training tokens in five stages, each one an operator of ``speechprep.llm``.

Every stage works on all rows that the one before it kept, read back from a table in
the shared folder. All but the last return the columns of ``documents``:

1. quality rules: a rejected document goes;
2. line dedup: later occurrences of three-line windows are taken out of the texts, and
   a document of which no word is left goes;
3. near duplicates, on shingles of five words at a similarity of 0.8: of each group the
   document with the smallest id stays;
4. decontamination: a document with a passage of a benchmark item goes;
5. BPE: the documents' token ids, with digests of them and of their decoded text.

Null ids, repeated rows and empty tables: as each operator says.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from speechprep.llm import bpe, decontam, linededup, neardup, quality  # noqa: E402
from speechprep.llm.common import digest, discard, fresh_folder, temporary  # noqa: E402
from speechprep.llm.queries import vocabulary  # noqa: E402

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.drop_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs, how=neardup.Similarity(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = vocabulary(VOCABULARY)
    return bpe.round_trip(docs, path).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", bpe_tokens),
]

#: SQL cannot express the encoding; the tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. Each but the last is written as Parquet to the
    shared folder and read back, so that nothing before it is computed again. What a stage
    has stored besides goes when it is written, and its result when the next one is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, name.replace(" ", "-"))
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return STAGES[-1][1](spark, docs, sf_dir)
