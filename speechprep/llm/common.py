"""What the operators share: the cluster's shared folder, cutting lineage, and
joins on keys of which one may hold a third of all rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechprep.session import shared_folder

#: At most this many keys can hold more than one of this many parts of all rows,
#: which is what bounds the broadcast of the heavy keys.
HEAVY_KEYS = 1024
#: Keys, of at most some ten bytes, that are broadcast at once.
BROADCAST_KEYS = 1_000_000
#: Below this many rows a key is no burden for one task.
HEAVY_ROWS = 256


def fresh_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a table of the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: The tables that each open ``temporary`` is to delete, innermost last.
_HELD: ContextVar[tuple[list[str], ...]] = ContextVar("held", default=())


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that are settled inside are deleted at the end, but for those that are
    kept for the context around. What leaves must not read them any more."""
    own: list[str] = []
    token = _HELD.set((*_HELD.get(), own))
    try:
        yield
    finally:
        _HELD.reset(token)
        for folder in own:
            discard(spark, folder)


def settled(df: DataFrame, keep: bool = False) -> DataFrame:
    """The rows as a table in the shared folder, read from there: what follows does not
    compute them again, lost executors lose nothing, and their true size is known to
    the joins that follow. (``checkpoint()`` keeps the estimate of the plan it cuts,
    and that estimate grows with every join of an iteration.) The table stays until the
    ``temporary`` around ends, or with ``keep`` the one around that; without one, until
    the folder is cleared."""
    folder = fresh_folder(df.sparkSession, "table")
    open_ = _HELD.get()[: -1 if keep else None]
    if open_:
        open_[-1].append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def join_facts(
    rows: DataFrame, facts: DataFrame, key: str, count: str, total: int, merge: bool = False
) -> DataFrame:
    """Left join of ``rows`` with ``facts``, one row of facts per ``key``.

    ``count`` is the column of ``facts`` with the key's number of rows in ``rows``
    and ``total`` their sum. Keys with more than ``total / HEAVY_KEYS`` rows, of
    which there are at most ``HEAVY_KEYS``, are looked up in a broadcast table and
    then dealt out evenly; the others meet by shuffle. Rows without a key get nulls.
    With ``merge`` they meet by a sorted merge, which spills, also where the facts would
    fit into a broadcast. The salt of the facts is a zero that is computed from the key: a literal would be
    folded, and the join would no longer shuffle by the salt.
    """
    names = [c for c in facts.columns if c != key]
    least = max(total // HEAVY_KEYS, HEAVY_ROWS)
    heavy = facts.filter(F.col(count) > least).select(
        F.col(key).alias("_heavy"), F.struct(*names).alias("_known")
    )
    # equal rows are told apart by the task that holds them
    salt = 1 + F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(1 << 20))
    spread = F.when(F.col("_heavy").isNotNull() | F.col(key).isNull(), salt).otherwise(0)
    left = rows.join(F.broadcast(heavy), F.col(key) == F.col("_heavy"), "left").withColumn(
        "_spread", spread
    )
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    right = facts.select(F.col(key), zero.alias("_spread"), F.struct(*names).alias("_fact"))
    joined = left.join(right.hint("merge") if merge else right, [key, "_spread"], "left")
    fact = F.coalesce("_known", "_fact")
    return joined.select(*rows.columns, *(fact[n].alias(n) for n in names))


def without(rows: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` is not in the one column of ``gone``; nulls are equal.
    Up to ``BROADCAST_KEYS`` keys are broadcast, more meet by shuffle."""
    gone = settled(gone.distinct().toDF("gone"))
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    # the rows within a struct, so that none of their columns can clash
    inside = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), key.alias("key"))
    left = inside.join(gone, F.col("key").eqNullSafe(F.col("gone")), "left_anti")
    return left.select(*(F.col("row").getField(c).alias(c) for c in rows.columns))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def lower_az(text: Column) -> Column:
    """A-Z lower-cased, all other letters kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a, b)``: ``(node, root)`` for every node of
    an edge, ``root`` the component's smallest node.

    Each round hooks every node to its smallest neighbour and contracts the edges,
    until none is left; at the end the hooks of all rounds are followed. Nodes are
    hashes, so that the number of rounds grows with the logarithm of the longest path.
    """
    with temporary(edges.sparkSession):
        return settled(_followed(edges), keep=True)


def _followed(edges: DataFrame) -> DataFrame:
    edges = settled(edges.select("a", "b").filter("a <> b").distinct())
    rounds = []
    while (total := edges.count()) > 0:
        both = edges.union(edges.select("b", "a"))
        hooks = settled(
            both.groupBy("a")
            .agg(F.min("b").alias("least"), F.count("*").alias("degree"))
            .select(F.col("a").alias("node"), F.least("a", "least").alias("parent"), "degree")
        )
        rounds.append(hooks)
        for end in ("a", "b"):
            step = hooks.select(F.col("node").alias(end), "parent", "degree")
            other = "b" if end == "a" else "a"
            edges = join_facts(edges, step, end, "degree", total).select(
                F.col("parent").alias(end), other
            )
        edges = settled(
            edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .filter("a <> b")
            .distinct()
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    names = rounds[0].select("node", F.col("parent").alias("root"))
    nodes = rounds[0].count()
    for hooks in rounds[1:]:
        sizes = names.groupBy("root").agg(F.count("*").alias("held"))
        moved = hooks.select(F.col("node").alias("root"), "parent").join(sizes, "root")
        names = settled(
            join_facts(names, moved, "root", "held", nodes).select(
                "node", F.coalesce("parent", "root").alias("root")
            )
        )
    return names
