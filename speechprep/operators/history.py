"""Choices read off a training run's history: best step, early stop, resume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import running

# ---------------------------------------------------------------- fixed values
PATIENCE = 10
CHECKPOINT = r"^checkpoint-([0-9]+)$"
# -----------------------------------------------------------------------------


def best_step(history: DataFrame) -> DataFrame:
    """First step with the lowest error rate, per run."""
    best = F.min(F.struct("wer", "step"))
    return history.groupBy("run").agg(best.alias("b")).select(
        "run", F.col("b.step").alias("best_step"), F.col("b.wer").alias("best_wer")
    )


def early_stop(
    history: DataFrame, patience: int = PATIENCE, block: int = running.BLOCK
) -> DataFrame:
    """Step at which a run stops: the last of ``patience`` evaluations in a row
    that are not strictly better than the best before them. Null if none."""
    wer = F.col("wer")
    seen = running.first_least(history, ["run"], "step", wer, "evals", "best", block)
    best = F.col("best")
    improved = best.isNull() | (wer < best["value"])
    stops = ~improved & (F.col("evals") - best["at"] >= patience)
    return seen.groupBy("run").agg(
        F.count("*").alias("n_evals"),
        F.min(F.when(stops, F.col("step"))).alias("stop_step"),
    )


def latest_checkpoint(names: DataFrame) -> DataFrame:
    """Checkpoint with the highest number per run; numbers, not text, compare."""
    number = F.regexp_extract("name", CHECKPOINT, 1)
    numbered = names.filter(number != "").withColumn("number", number.cast("bigint"))
    return numbered.groupBy("run").agg(
        F.max("number").alias("number"), F.max_by("name", "number").alias("checkpoint")
    )
