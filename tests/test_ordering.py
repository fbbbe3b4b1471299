"""Positions in a total order: exact, and no task holds a hot key's rows."""

import pytest
from pyspark.sql import functions as F

from speechprep.operators import ordering

ROWS = 30_000


def hot(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 0, None)
    return spark.range(ROWS).repartition(7).select(
        key.otherwise(F.concat(F.lit("k"), (F.col("id") * 7919 % 500).cast("string"))).alias("k"), "id"
    )


@pytest.mark.parametrize("rows_per_range", [1_000_000, 2_000])
def test_numbered(spark, rows_per_range):
    order = [F.col("k").asc_nulls_last(), F.col("id").desc()]
    got = ordering.numbered(hot(spark), order, rows_per_range=rows_per_range).collect()
    want = sorted(((r.k is None, r.k or "", -r.id) for r in got))
    assert len(got) == ROWS
    placed = {r.pos: (r.k is None, r.k or "", -r.id) for r in got}
    assert [placed[i] for i in range(ROWS)] == want


def test_ties_get_positions_of_their_own(spark):
    got = ordering.numbered(hot(spark), [F.col("k")]).select("k", "pos").collect()
    assert sorted(r.pos for r in got) == list(range(ROWS))
    keys = [r.k for r in sorted(got, key=lambda r: r.pos)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or ""))


def test_a_hot_key_is_cut(spark):
    cut = ordering.in_ranges(hot(spark), [F.col("k")], rows_per_range=1_000)
    sizes = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4 * ROWS / len(sizes)


def test_empty(spark):
    assert ordering.numbered(hot(spark).limit(0), [F.col("k")]).collect() == []
