"""Mixing sources to target weights by hash thresholds.

Every document has a size and a hash of its id and text. A source's target is its share
of the budget by weight, at most ``repeats`` times its own size; what a source cannot
take is shared among the others. A target of ``k`` whole sizes and a rest takes every
document ``k`` times, and once more those whose hash lies below a threshold. The
thresholds come from histograms: sizes are summed by source and the hash's leading bits,
and the running sums name the bucket in which the budget is used up. Only that bucket is
cut further, by the next bits, until it holds one hash. Then every row decides for
itself; no documents are sorted. Thresholds grow with the budget, so a smaller mix is
part of a larger one.

Defined results: a null text has size 0, and so has one without words; a document of
size 0 is taken as a whole or not, with 0 words either way; null sources are one source;
a source that ``weights`` does not name, or names with null or 0, gets nothing, and one
without words has target 0. Rows equal in source, id and text share a hash: of such a group
at the threshold as many rows are taken once more as come nearest to the target, and it
does not matter which. Null ids are told apart by their texts. The table may be empty; of
extra columns nothing is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speechprep.llm.common import join_facts, settled
from speechprep.operators.ordering import numbered

#: Bits of a document's hash, and of one level of its histogram.
HASH_BITS, LEVEL_BITS = 60, 10
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(id_: Column, text: Column, seed: int) -> Column:
    """60 bits of the MD5 of ``seed:id:text``."""
    shown = F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
    )
    return F.conv(F.substring(F.md5(shown.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def cycled_weights(sources: DataFrame, column: str, cycle: tuple[float, ...]) -> DataFrame:
    """``(source, weight)``: the distinct sources by code point, null last, with the
    weights of ``cycle`` in turn."""
    distinct = sources.select(F.col(column).alias("source")).distinct()
    ranked = numbered(distinct, [F.col("source").asc_nulls_last()], "_rank")
    weights = F.array(*(F.lit(float(w)) for w in cycle))
    at = F.pmod("_rank", F.lit(len(cycle))).cast("int")
    return ranked.select("source", F.get(weights, at).alias("weight"))


def _targets(sources: DataFrame, share: float, repeats: float) -> DataFrame:
    """``sources (.., source_size, weight)`` with ``target``.

    A source at its limit takes ``repeats`` sizes, the others ``budget / weights`` per
    weight. With each round more sources are at their limit, until no share exceeds it;
    only three sums leave the cluster.
    """
    most = F.col("source_size") * F.lit(float(repeats))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    budget, weights, limited = total, None, F.lit(False)
    while True:
        open_ = F.when(limited, 0.0).otherwise(F.col("weight"))
        shut = F.when(limited, most).otherwise(0.0)
        weighed, fixed = sources.agg(F.sum(open_), F.sum(shut)).first()
        if weights is not None and (weighed, total - (fixed or 0.0)) == (weights, budget):
            break
        weights, budget = weighed or 0.0, total - (fixed or 0.0)
        if weights == 0:
            return sources.withColumn("target", F.least(most, most * F.sign("weight")))
        limited = most * weights < F.col("weight") * budget
    fair = F.col("weight") * F.lit(budget) / F.lit(weights)
    return sources.withColumn("target", F.when(limited, most).otherwise(fair))


def _prefix(value: Column, level: int) -> Column:
    """The leading bits of a hash down to ``level``."""
    return F.shiftright(value, HASH_BITS - LEVEL_BITS * (level + 1))


def _edges(histogram: DataFrame, prefix: str) -> DataFrame:
    """Of ``histogram (_source, _rest, _below, <prefix>, held, least, most)`` the bucket
    in which a source's rest is used up, and with ``_below`` what lies before it. There
    are at most ``2 ** LEVEL_BITS`` buckets of a source."""
    upto = Window.partitionBy("_source").orderBy(prefix).rowsBetween(Window.unboundedPreceding, 0)
    summed = histogram.withColumn("_upto", F.col("_below") + F.sum("held").over(upto))
    first = summed.filter(F.col("_upto") > F.col("_rest")).groupBy("_source").agg(
        F.min_by(F.struct(*(c for c in summed.columns if c != "_source")), prefix).alias("_edge")
    )
    return first.select("_source", "_edge.*").withColumn("_below", F.col("_upto") - F.col("held"))


def _thresholds(rows: DataFrame, sources: DataFrame, rows_total: int) -> DataFrame:
    """``sources`` with ``_limit``, the hash at which the rest is used up, and
    ``_more``, how much of the rest is left for the rows of that hash."""
    facts = ["_rest", "_below"]

    def histogram(docs: DataFrame, prefix: str) -> DataFrame:
        return docs.groupBy("_source", prefix).agg(
            *(F.first(c).alias(c) for c in facts if c in docs.columns),
            F.sum("size").alias("held"),
            F.min("_hash").alias("least"),
            F.max("_hash").alias("most"),
        )

    first = histogram(rows.withColumn("_bucket", _prefix(F.col("_hash"), 0)), "_bucket")
    rests = sources.select("_source", "_rest", F.lit(0).cast("long").alias("_below"))
    edges = settled(_edges(first.join(rests, "_source"), "_bucket"))
    inside = rows
    for level in range(1, HASH_BITS // LEVEL_BITS):
        if edges.filter("least < most").isEmpty():
            break
        counted = inside.groupBy("_source").agg(F.count("*").alias("_rows"))
        bounds = edges.select("_source", F.col("_bucket").alias("_edge"), *facts).join(counted, "_source")
        found = join_facts(inside.select("_source", "size", "_hash"), bounds, "_source", "_rows", rows_total)
        inside = settled(
            found.filter(_prefix(F.col("_hash"), level - 1) == F.col("_edge"))
            .groupBy("_source", "_hash")
            .agg(F.sum("size").alias("size"), *(F.first(c).alias(c) for c in facts))
        )
        finer = histogram(inside.withColumn("_bucket", _prefix(F.col("_hash"), level)), "_bucket")
        edges = settled(_edges(finer, "_bucket"))
        inside = inside.drop(*facts)
    limits = edges.select(
        "_source", F.col("least").alias("_limit"), (F.col("_rest") - F.col("_below")).alias("_more")
    )
    return sources.join(limits, "_source", "left")


def mix(
    documents: DataFrame,
    weights: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.0,
    repeats: int = 3,
    seed: int = 7,
) -> DataFrame:
    """``(id_col, source_col, size, source_size, target, taken)`` of every row.

    ``weights (source, weight)`` has one row per source. The targets share ``share`` of
    all sizes; ``taken`` is a multiple of ``size``, at most ``repeats`` times it.
    """
    text = F.col(text_col)
    # a null source is a key like any other
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    rows = settled(
        documents.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("_shown"),
            key.alias("_source"),
            words(text).alias("size"),
            document_hash(F.col(id_col), text, seed).alias("_hash"),
        )
    )
    sizes = rows.groupBy("_source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows")
    )
    named = weights.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")).alias("_source"),
        F.col("weight").cast("double").alias("_weight"),
    )
    known = settled(
        sizes.join(named, "_source", "left").select(
            "_source", "source_size", "_rows", F.coalesce("_weight", F.lit(0.0)).alias("weight")
        )
    )
    total = known.agg(F.sum("_rows")).first()[0] or 0
    target, size = F.col("target"), F.col("source_size")
    full = F.when(size > 0, F.least(F.floor(target / size), F.lit(repeats))).otherwise(0)
    aimed = (
        _targets(known, share, repeats)
        .withColumn("_full", full.cast("long"))
        .withColumn("_rest", F.when(F.col("_full") < repeats, target - F.col("_full") * size).otherwise(0.0))
    )
    facts = settled(_thresholds(rows, settled(aimed), total)).drop("weight", "_rest")
    placed = join_facts(rows, facts, "_source", "_rows", total)
    shown = [F.col("_id").alias(id_col), F.col("_shown").alias(source_col), "size", "source_size", "target"]
    below = F.col("_hash") < F.col("_limit")
    plain = placed.filter("_limit is null or _hash <> _limit").select(
        *shown, (F.col("size") * (F.col("_full") + F.coalesce(below, F.lit(False)).cast("long"))).alias("taken")
    )
    return plain.union(
        _at_limit(placed.filter("_hash = _limit")).select(
            *shown, (F.col("size") * (F.col("_full") + F.col("_extra"))).alias("taken")
        )
    )


def _at_limit(rows: DataFrame) -> DataFrame:
    """Rows whose hash is their source's threshold, with ``_extra`` 1 for as many as
    come nearest to what is left of the rest. They are equal, so they are counted, by
    task first, and written out again by those counts."""
    by = ["_id", "_shown", "_source", "size", "source_size", "target", "_full", "_more"]
    parts = rows.groupBy(*by, F.spark_partition_id().alias("_part")).agg(F.count("*").alias("_copies"))
    earlier = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.when(F.col("size") > 0, F.round(F.col("_more") / F.col("size"))).otherwise(0).cast("long")
    parts = parts.withColumn("_before", F.coalesce(F.sum("_copies").over(earlier), F.lit(0)))
    spread = parts.repartition("_source", "_part")
    copies = F.sequence(F.lit(1).cast("long"), F.col("_copies"))
    return spread.withColumn("_number", F.explode(copies)).withColumn(
        "_extra", (F.col("_before") + F.col("_number") <= wanted).cast("long")
    )


def oracle(cycle: tuple[int, ...], repeats: int, seed: int) -> str:
    """The mix of ``documents`` as SQL, with documents in order of their hashes."""
    listed = ", ".join(map(str, cycle))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS s,
    ([{listed}])[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(cycle)})::INT]::BIGINT AS w
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, sum(s) OVER ()::BIGINT AS total,
    coalesce(sum({repeats} * s) OVER before, 0)::BIGINT AS fixed, (sum(w) OVER ()
      - coalesce(sum(w) OVER before, 0))::BIGINT AS open
  FROM sources
  WINDOW before AS (ORDER BY {repeats} * s::DOUBLE / w, source
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT total - fixed AS budget, open FROM ranked
  WHERE {repeats} * s * open >= w * (total - fixed) ORDER BY fixed LIMIT 1
), targets AS (
  SELECT source, s, CASE WHEN {repeats} * s * open < w * budget THEN ({repeats} * s)::DOUBLE
    ELSE (w * budget)::DOUBLE / open END AS target
  FROM sources, level
), summed AS (
  SELECT doc_id, d.source, size, s, target, least(floor(target / nullif(s, 0)), {repeats}) AS f,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM sized d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, source, size, s AS source_size, target,
  (size * (coalesce(f, 0) + CASE WHEN f < {repeats} AND below < target - f * s
    AND (below + size <= target - f * s OR round((target - f * s - below) / size) >= 1)
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
