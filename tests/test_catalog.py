"""Every query against its SQL, on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from speechprep.catalog.oracle import all_oracles
from speechprep.catalog.queries import all_queries

SF = "/root/testdata/sf0.001"
TABLES = "customer documents embeddings events pages conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    # further queries may have none, where SQL cannot express them
    assert set(all_queries()) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["path", "sentence", "duration", "recording"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, name):
    df = all_queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    answer = duck.sql(all_oracles()[name])
    assert sorted(answer.columns) == columns
    order = [answer.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in order) for r in answer.fetchall()), key=repr)


SHARDED = ["q_chunks", "q_eaf_doc", "q_early_stop", "q_split_rows", "q_pad_batches", "q_clip_samples"]


@pytest.mark.parametrize("name", SHARDED)
def test_results_do_not_depend_on_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(repr, all_queries()[name](spark, SF).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_joins(spark, name):
    plan = all_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
