"""Positions in a total order, without one task that sees all rows.

Rows are cut into ranges of the order, whose bounds Spark samples, and sorted within
them. A row's number within its range comes with the sort, and the ranges' sizes, one
number per range, give the offset of each. Rows with equal keys are told apart by a
number of their own before the bounds are sampled, so that a key of a third of all
rows is cut as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Rows of one range, as far as the sampled bounds are even.
ROWS_PER_RANGE = 1_000_000
# A task's number and its row's number share 64 bits in Spark's increasing ids.
_ROW_BITS = 33


def in_ranges(df: DataFrame, order: list[Column], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``df`` cut into ranges of ``order`` and sorted within them. Rows that are equal
    in ``order`` may come in any order."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-df.count() // rows_per_range))
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    by = [*order, F.col("_tie")]
    return tied.repartitionByRange(ranges, *by).sortWithinPartitions(*by).drop("_tie")


def _placed(df: DataFrame, order: list[Column], rows_per_range: int) -> DataFrame:
    """``df`` in ranges, stored, with ``_at``: the range and the place within it."""
    ranged = in_ranges(df, order, rows_per_range)
    return stored(ranged.withColumn("_at", F.monotonically_increasing_id()))


def _offset(placed: DataFrame, weight: Column) -> DataFrame:
    """``placed`` with ``_range`` and ``_before``, the weight of all ranges before."""
    ranged = placed.withColumn("_range", F.shiftright("_at", _ROW_BITS))
    sums = ranged.groupBy("_range").agg(F.sum(weight).alias("_weight"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: as many as the shuffle has partitions
    before = sums.select("_range", F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), "_range")


def numbered(
    df: DataFrame,
    order: list[Column],
    name: str = "pos",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``name``, each row's place in ``order``, from 0 on, without gaps. The rows
    are shuffled once and written to the shared folder, ``df`` is read three times."""
    placed = _offset(_placed(df, order, rows_per_range), F.lit(1))
    own = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return placed.select(*df.columns, (F.col("_before") + own).alias(name))


def summed_before(
    df: DataFrame,
    order: list[Column],
    weight: Column,
    name: str,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``name``, the sum of the whole numbers ``weight`` over all rows before each
    one in ``order``."""
    placed = _offset(_placed(df, order, rows_per_range), weight)
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn(
        name, F.col("_before") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    ).select(*df.columns, name)


def packed(
    df: DataFrame,
    order: list[Column],
    weight: Column,
    per_task: int,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``df`` dealt to tasks in ``order``: each gets a stretch of rows whose weights sum
    up to ``per_task``, and at most the last row's weight more; to less, if that keeps
    more cores busy. Rows are sorted within a task."""
    sums = stored(summed_before(df, order, weight, "_sum", rows_per_range))
    top = sums.agg(F.max("_sum")).first()[0] or 0
    per_task = min(per_task, top // df.sparkSession.sparkContext.defaultParallelism + 1)
    tasks = 1 + top // per_task
    task = F.call_function("div", F.col("_sum"), F.lit(per_task).cast("bigint")).cast("int")
    return sums.repartitionById(tasks, task).sortWithinPartitions(*order).drop("_sum")
