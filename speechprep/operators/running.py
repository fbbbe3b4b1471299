"""Running aggregates that hold up when one recording is most of the table.

``sum(x) over (partition by recording order by pos)`` sends a whole recording
to one task. Here positions are cut into fixed ranges of ``block`` positions:
a window runs inside each (recording, block), so it never sees more than
``block`` rows, and the totals of the blocks before it (one row per block) are
carried in through a join on the same key, in two levels.

Positions must be integers that are unique within their group. They may have
gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as v

BLOCK = 65_536
WIDE = 4_096  # blocks that are carried over one by one

_REDUCE = {"sum": F.sum, "min": F.min, "max": F.max}


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
    # least and greatest skip nulls
    return (F.least if kind == "min" else F.greatest)(carried, local)


def block_col(block: int = BLOCK) -> str:
    return f"_block_{block}"


def with_block(df: DataFrame, pos: str, block: int = BLOCK) -> DataFrame:
    """Add the block of each position, unless it is there already."""
    if block_col(block) in df.columns:
        return df
    return df.withColumn(block_col(block), v.div(F.col(pos), block))


def _carried(
    totals: DataFrame, keys: list[str], at: str, kinds: dict[str, str]
) -> DataFrame:
    """For each block the aggregates of the blocks before it, as ``_carried_*``.

    Positions may be sparse, so that blocks are nearly as many as rows. Hence two
    levels: a window inside each stretch of ``WIDE`` blocks, and one over the totals
    of the stretches."""
    stretch = totals.withColumn("_stretch", v.div(F.col(at), WIDE))

    def over(rows: DataFrame, by: list[str], order: str, prefix: str) -> DataFrame:
        earlier = Window.partitionBy(*by).orderBy(order)
        earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(
            *(c for c in rows.columns if c not in kinds),
            *(_REDUCE[kind](n).over(earlier).alias(prefix + n) for n, kind in kinds.items()),
        )

    sums = stretch.groupBy(*keys, "_stretch").agg(
        *(_REDUCE[kind](n).alias(n) for n, kind in kinds.items())
    )
    outer = over(sums, keys, "_stretch", "_outer_")
    inner = over(stretch, [*keys, "_stretch"], at, "_inner_")
    return inner.join(outer, [*keys, "_stretch"], "left").select(
        *keys,
        at,
        *(
            _combine(kind, F.col(f"_outer_{n}"), F.col(f"_inner_{n}")).alias(f"_carried_{n}")
            for n, kind in kinds.items()
        ),
    )


def before(
    df: DataFrame,
    keys: list[str],
    pos: str,
    outputs: dict[str, tuple[str, Column]],
    block: int = BLOCK,
) -> DataFrame:
    """Add, for every row, aggregates over the rows *before* it.

    ``outputs`` maps a new column to ``(kind, expression)`` with kind ``sum``,
    ``min`` or ``max``. The first row of a group gets 0 for sums and null
    otherwise. The block column stays in the result: another running aggregate,
    or a grouping, by the same block needs no further shuffle.
    """
    blocked = with_block(df, pos, block)
    block_keys = [*keys, block_col(block)]

    totals = blocked.groupBy(*block_keys).agg(
        *[_REDUCE[kind](expr).alias(name) for name, (kind, expr) in outputs.items()]
    )
    carried = _carried(totals, keys, block_col(block), {n: kind for n, (kind, _) in outputs.items()})

    inside = (
        Window.partitionBy(*block_keys)
        .orderBy(pos)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = blocked.select(
        "*",
        *[
            _REDUCE[kind](expr).over(inside).alias(f"_local_{name}")
            for name, (kind, expr) in outputs.items()
        ],
    )
    return local.join(carried, block_keys, "left").select(
        *[local[c] for c in blocked.columns],
        *[
            _combine(kind, F.col(f"_carried_{name}"), F.col(f"_local_{name}")).alias(name)
            for name, (kind, _) in outputs.items()
        ],
    )


def _shifted(least: Column, by: Column) -> Column:
    """A least value found ``by`` rows further on."""
    moved = F.struct(least["value"].alias("value"), (least["at"] + by).alias("at"))
    return F.when(least.isNotNull(), moved)


def first_least(
    df: DataFrame, keys: list[str], pos: str, value: Column, number: str, least: str, block: int = BLOCK
) -> DataFrame:
    """Add, for every row, ``number``, how many rows of its group come before it, and
    ``least``, the least of their values that are not null, as ``value``, with ``at``, the
    number of the first row that has it; null where there is none.

    One pass: what a block hands on is how many rows it has, and its least value with its
    number within the block, which the rows before move. Rows are read twice, for the
    blocks' totals and for themselves, and totals are carried over once.
    """
    blocked = with_block(df, pos, block)
    at = block_col(block)
    inside = Window.partitionBy(*keys, at).orderBy(pos)
    before_ = inside.rowsBetween(Window.unboundedPreceding, -1)
    own = F.struct(value.alias("value"), F.col("_n").alias("at"))
    counted = blocked.withColumn("_n", (F.row_number().over(inside) - 1).cast("bigint")).withColumn(
        "_own", F.when(value.isNotNull(), own)
    )
    local = counted.withColumn("_local", F.min("_own").over(before_))

    def totals(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*keys, *by).agg(F.sum("_rows").alias("_rows"), F.min("_least").alias("_least"))

    def carried(rows: DataFrame, by: list[str], order: str, prefix: str) -> DataFrame:
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        moved = rows.withColumn(f"{prefix}_rows", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        moved = moved.withColumn("_least", _shifted(F.col("_least"), F.col(f"{prefix}_rows")))
        return moved.withColumn(f"{prefix}_least", F.min("_least").over(earlier))

    blocks = counted.groupBy(*keys, at).agg(F.count("*").alias("_rows"), F.min("_own").alias("_least"))
    stretched = blocks.withColumn("_stretch", v.div(F.col(at), WIDE))
    inner = carried(stretched, [*keys, "_stretch"], at, "_in")
    outer = carried(totals(inner, ["_stretch"]), keys, "_stretch", "_out").drop("_rows", "_least")
    known = inner.drop("_rows", "_least").join(outer, [*keys, "_stretch"], "left").select(
        *keys,
        at,
        (F.col("_in_rows") + F.col("_out_rows")).alias("_offset"),
        F.least("_out_least", _shifted(F.col("_in_least"), F.col("_out_rows"))).alias("_carried"),
    )
    joined = local.join(known, [*keys, at], "left")
    return joined.select(
        *(local[c] for c in blocked.columns),
        (F.col("_offset") + F.col("_n")).alias(number),
        F.least("_carried", _shifted(F.col("_local"), F.col("_offset"))).alias(least),
    )
