"""Line deduplication by overlapping windows of three lines, in DataFrame functions.

Lines with a word are numbered within their text; each three consecutive ones are a
window, known by a hash of its lines. Windows found more than once in all texts are
kept where they come first, by document id and place, and every later occurrence
covers its three lines. A text loses the lines that some later occurrence covers.

Defined results: a null text is one empty line; texts with fewer than three lines
with a word have no window and stay as they are, and so do lines without a word.
Null ids come after all others. Rows with equal ids and texts are one row twice:
neither is later than the other, and both get the same result. The number of windows
of one text is bounded by its length alone. The table may be empty; of extra columns
nothing is read by ``deduplicate``, and ``drop_repeats`` hands them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechprep.functions.values import once
from speechprep.llm.common import join_facts, settled

WINDOW = 3
HAS_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _places(lines: Column) -> Column:
    """Places of the lines that have a word."""
    return F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(HAS_WORD)
    )


def _hashes(text: Column) -> Column:
    """Two independent hashes of each line with a word: lines are deleted by them, and of
    10^12 windows some would share one hash of 64 bits."""
    worded = F.filter(_lines(text), lambda line: line.rlike(HAS_WORD))
    return F.transform(
        worded, lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))
    )


def _without(text: Column, gone: Column) -> Column:
    """``text`` without the lines with a word numbered in ``gone``. Each step is bound
    once; Spark would otherwise copy it into the loop that reads it."""

    def joined(lines: Column, removed: Column) -> Column:
        stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
        return F.array_join(F.transform(stays, lambda i: F.get(lines, i)), "\n")

    def cut(lines: Column) -> Column:
        removed = once(_places(lines), lambda at: F.transform(gone, lambda j: F.get(at, j)))
        return once(removed, lambda r: joined(lines, r))

    return once(_lines(text), cut)


def _later_lines(texts: DataFrame) -> DataFrame:
    """``(_key, copies, gone)`` of ``(_id, _text)``: by id and text, the rows that have
    it, and the numbers, among a text's lines with a word, of those to remove."""
    listed = (
        texts.withColumn("_hash", F.xxhash64("_text"))
        .select("_id", "_hash", _hashes(F.col("_text")).alias("hashes"))
        .filter(F.size("hashes") >= WINDOW)
    )
    windows = listed.select(
        "_id",
        "_hash",
        "hashes",
        F.explode(F.sequence(F.lit(0), F.size("hashes") - WINDOW)).alias("at"),
    ).select(
        "_id",
        "_hash",
        "at",
        F.struct(
            *(
                F.xxhash64(*(F.get("hashes", F.col("at") + k)[half] for k in range(WINDOW))).alias(half)
                for half in ("a", "b")
            )
        ).alias("window"),
    )
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash", "at")
    repeated = settled(
        windows.groupBy("window")
        .agg(F.min(order).alias("first"), F.count("*").alias("held"))
        .filter("held > 1")
    )
    total = repeated.agg(F.sum("held")).first()[0] or 0
    later = join_facts(windows, repeated, "window", "held", total).filter(order > F.col("first"))
    return (
        later.groupBy("_id", "_hash")
        .agg(F.collect_set("at").alias("starts"), F.count("*").alias("later"))
        .select(
            F.struct(F.col("_id").alias("id"), F.col("_hash").alias("hash")).alias("_key"),
            # every copy has each of these starts
            F.floor(F.col("later") / F.size("starts")).alias("copies"),
            F.array_distinct(
                F.flatten(
                    F.transform("starts", lambda s: F.sequence(s, s + F.lit(WINDOW - 1)))
                )
            ).alias("gone"),
        )
    )


def deduplicate(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, n_lines, n_removed, text)`` of every row, text without the lines
    that are later occurrences."""
    cleaned = _cleaned(documents, id_col, text_col)
    return cleaned.select(
        F.col("_row")[id_col].alias(id_col),
        F.size(_lines(F.col("_row")[text_col])).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("left_text", F.col("_row")[text_col], F.lit("")).alias("text"),
    )


def _cleaned(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col("_row")[text_col]
    rows = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row"),
        F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash")).alias("_key"),
    )
    gone = settled(
        _later_lines(documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")))
    )
    total = gone.agg(F.sum("copies")).first()[0] or 0
    joined = join_facts(rows, gone, "_key", "copies", total, merge=True)
    left = F.when(F.col("gone").isNotNull(), _without(text, F.col("gone")))
    return joined.withColumn("left_text", left)


def drop_repeats(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``documents`` with later occurrences taken out of the texts. A text of which no
    word is left goes."""
    cleaned = _cleaned(documents, id_col, text_col).filter(
        F.col("left_text").isNull() | F.col("left_text").rlike(HAS_WORD)
    )
    return cleaned.select(
        *(
            (F.coalesce("left_text", F.col("_row")[c]) if c == text_col else F.col("_row")[c]).alias(c)
            for c in documents.columns
        )
    )


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM texts
), worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS j
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT doc_id, j, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
  FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY j)
), ranked AS (
  SELECT doc_id, j, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, j) AS nth
  FROM windows WHERE c IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, j + k AS j
  FROM ranked CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1
)
SELECT lines.doc_id, count(*) AS n_lines, count(gone.j) AS n_removed,
  coalesce(string_agg(lines.line, chr(10) ORDER BY lines.pos) FILTER (WHERE gone.j IS NULL), '')
    AS text
FROM lines
LEFT JOIN worded ON worded.doc_id = lines.doc_id AND worded.pos = lines.pos
LEFT JOIN gone ON gone.doc_id = worded.doc_id AND gone.j = worded.j
GROUP BY lines.doc_id
"""
