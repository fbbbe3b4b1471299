"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions.

An item's windows are its runs of ``window`` words; a window's set are its shingles
of up to three words. A window is contained in a text only if all of its shingles
are, so the necessary prefix is one shingle, and the rarest one is taken.

1. One pass over the documents finds where shingles of the benchmark occur. They are
   looked up in broadcast tables of bounded size; a larger benchmark is looked up in
   several passes. What is found is written with the words around it.
2. Counting these occurrences orders the shingles by rarity, and every window is
   joined by its rarest one.
3. Places where the window would begin before the text or end after it are left out
   (positional and length bounds), and the words themselves are compared.

Defined results: a null text, of a document or an item, has no words; an item of
fewer words than a window is one window, an item without words none; items with
equal windows are all named; an item without id is named by an empty string. Every
row of ``documents`` gives one row; rows with equal ids and texts give equal ones.
Tables may be empty; of extra columns nothing is read.
``drop_contaminated`` judges every row by its id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechprep.llm.common import digest, join_facts, lower_az, settled, without

WINDOW = 10
SHINGLE = 3
#: Shingles of one broadcast table: 8 bytes each and the table's overhead.
BROADCAST_SHINGLES = 1_000_000
#: Windows, of at most some hundred bytes, that one row of anchors holds on average.
ROW_WINDOWS = 64
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def _shingle(words: Column, at: Column, length: int) -> Column:
    """Hash of the ``length`` words from ``at`` on; null where the text ends before."""
    value = F.xxhash64(F.lit(length), *(F.get(words, at + k) for k in range(length)))
    return F.when((at >= 0) & (at + length <= F.size(words)), value)


def _windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``(words, items)``: the different windows and the ids of their items."""
    cut = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        _words(F.col(text_col)).alias("all"),
    ).filter(F.size("all") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0)))
    return (
        cut.select("item", "all", F.explode(starts).alias("at"))
        .select("item", F.slice("all", F.col("at") + 1, window).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
    )


def _window_shingles(windows: DataFrame) -> DataFrame:
    """``(words, items, offset, shingle)`` of every window."""
    out = None
    for length in range(1, SHINGLE + 1):
        of_length = F.size("words") == length if length < SHINGLE else F.size("words") >= length
        own = windows.filter(of_length).select(
            "words",
            "items",
            F.lit(length).alias("length"),
            F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("offset"),
        ).withColumn("shingle", _shingle(F.col("words"), F.col("offset"), length))
        out = own if out is None else out.union(own)
    return out


def _occurrences(
    documents: DataFrame, id_col: str, text_col: str, shingles: DataFrame, window: int
) -> DataFrame:
    """Step 1: ``(_id, _hash, n, at, shingle, first, around)``, and a row with ``at``
    -1 for every document."""
    lengths = sorted(r.length for r in shingles.select("length").distinct().collect())
    wanted = settled(shingles.select("shingle").distinct())
    passes = -(-wanted.count() // BROADCAST_SHINGLES) or 1
    texts = documents.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text_col).alias("_hash"),
        _words(F.col(text_col)).alias("words"),
    )
    # -1 is the document's own row
    placed = texts.select(
        "*", F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("at")
    )
    hashes = [_shingle(F.col("words"), F.col("at"), n) for n in lengths]
    if len(hashes) == 1:
        placed = placed.withColumn("shingle", hashes[0])
    else:
        found = F.filter(F.array(*hashes), lambda h: h.isNotNull()) if hashes else F.array()
        placed = placed.withColumn("shingle", F.explode_outer(found.cast("array<bigint>")))
    around = F.greatest(F.col("at") - (window - 1), F.lit(0))
    out = None
    for k in range(passes):
        part = wanted.filter(F.pmod("shingle", F.lit(passes)) == k).withColumnRenamed(
            "shingle", "_wanted"
        )
        hit = F.col("_wanted").isNotNull()
        own = placed.join(F.broadcast(part), F.col("shingle") == F.col("_wanted"), "left").filter(
            (hit | (F.col("at") == -1)) if k == 0 else hit
        )
        own = own.select(
            "_id",
            "_hash",
            F.size("words").cast("long").alias("n"),
            "at",
            "shingle",
            around.alias("first"),
            F.when(hit, F.slice("words", around + 1, 2 * window)).alias("around"),
        )
        out = own if out is None else out.union(own)
    return settled(out)


def _anchored(found: DataFrame, windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``found`` with ``windows``, the windows whose rarest shingle is found there, a
    bounded number per row: more windows of one shingle are further rows."""
    total = counts.agg(F.sum("held")).first()[0] or 0
    # a window with a shingle that never occurs cannot occur itself
    rarest = F.min(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "offset", "shingle"))
    anchors = (
        windows.join(counts, "shingle", "left")
        .groupBy("words")
        .agg(rarest.alias("rarest"), F.first("items").alias("items"))
        .filter("rarest.held > 0")
        .select("rarest.shingle", "rarest.held", F.struct("rarest.offset", "words", "items").alias("window"))
    )
    anchors = settled(anchors)
    parts = anchors.groupBy("shingle").agg(
        F.first("held").alias("held"), F.ceil(F.count("*") / ROW_WINDOWS).cast("int").alias("parts")
    )
    parts = settled(parts)
    placed = join_facts(found.filter("at >= 0"), parts, "shingle", "held", total)
    numbers = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    placed = placed.filter("parts is not null").withColumn("part", numbers)
    placed = placed.withColumn("anchor", F.xxhash64("shingle", "part")).drop("part")
    part = F.pmod(F.xxhash64("window.words"), "parts").cast("int")
    listed = (
        anchors.join(parts.drop("held"), "shingle")
        .groupBy("shingle", part.alias("part"))
        .agg(F.first("held").alias("held"), F.collect_list("window").alias("windows"))
        .select(F.xxhash64("shingle", "part").alias("anchor"), "held", "windows")
    )
    placings = parts.agg(F.sum(F.col("held") * F.col("parts"))).first()[0] or 0
    met = join_facts(placed.drop("held", "parts"), settled(listed), "anchor", "held", placings)
    return met.filter("windows is not null")


def contamination(
    documents: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``(id_col, n_words, n_hit, items array<string>)`` of every row of ``documents``:
    how many of its words lie in an occurrence of a window, and of which items."""
    judged = _judged(documents, items, id_col, text_col, item_col, item_text_col, window)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return judged.withColumn("_copy", copies).select(
        F.col("_id").alias(id_col), "n_words", "n_hit", "items"
    )


def _judged(
    documents: DataFrame,
    items: DataFrame,
    id_col: str,
    text_col: str,
    item_col: str,
    item_text_col: str,
    window: int,
) -> DataFrame:
    """``(_id, _hash, copies, n_words, n_hit, items)`` of every id and text."""
    windows = _windows(items, item_col, item_text_col, window)
    shingles = settled(_window_shingles(windows))
    found = _occurrences(documents, id_col, text_col, shingles, window)
    counts = settled(
        found.filter("at >= 0").groupBy("shingle").agg(F.count("*").alias("held"))
    )
    met = _anchored(found, shingles, counts)
    start = F.col("at") - F.col("window.offset")
    size = F.size("window.words")
    same = F.slice("around", F.col("start") - F.col("first") + 1, size) == F.col("window.words")
    hits = (
        met.select("_id", "_hash", "n", "at", "first", "around", F.explode("windows").alias("window"))
        .withColumn("start", start)
        .filter((F.col("start") >= 0) & (F.col("start") + size <= F.col("n")))
        .filter(same)
        .select(
            "_id",
            "_hash",
            "n",
            F.struct("start", (F.col("start") + size).alias("end")).alias("span"),
            F.col("window.items").alias("items"),
        )
    )
    none = found.filter("at = -1").select(
        "_id",
        "_hash",
        "n",
        F.lit(None).cast("struct<start:int,end:int>").alias("span"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    by_text = (
        none.union(hits)
        .groupBy("_id", "_hash", "n")
        .agg(
            F.count_if(F.col("span").isNull()).alias("copies"),
            F.sort_array(F.collect_set("span")).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    # spans in order: each adds what lies behind the end so far
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda so, s: F.struct(
            F.greatest(so.end, s.end).alias("end"),
            (so.total + F.greatest(s.end - F.greatest(so.end, s.start), F.lit(0))).alias("total"),
        ),
        lambda so: so.total,
    )
    return by_text.select(
        "_id", "_hash", "copies", F.col("n").alias("n_words"), covered.alias("n_hit"), "items"
    )


def with_digest(found: DataFrame) -> DataFrame:
    """``contamination`` with its items counted and digested."""
    return found.select(
        *found.columns[:3],
        F.size("items").cast("long").alias("n_items"),
        digest(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``documents`` without a contaminated word, with all their columns.
    Rows with equal ids and texts stay or go together."""
    bad = _judged(documents, items, id_col, text_col, "item_id", "text", WINDOW).filter("n_hit > 0")
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    return without(
        documents, key, bad.select(F.struct(F.col("_id").alias("id"), F.col("_hash").alias("hash")))
    )


ORACLE = r"""
WITH item_words AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size,
    array_to_string(ws[s + 1:s + least(len(ws), 10)], ' ') AS win
  FROM (SELECT *, unnest(range(greatest(len(ws) - 9, 1))) AS s FROM item_words WHERE len(ws) > 0)
), doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
), doc_windows AS (
  SELECT doc_id, size, s, array_to_string(ws[s + 1:s + size], ' ') AS win
  FROM (SELECT *, unnest(range(len(ws) - size + 1)) AS s
        FROM doc_words CROSS JOIN (SELECT DISTINCT size FROM item_windows)
        WHERE len(ws) >= size)
), hits AS (
  SELECT d.doc_id, d.s, d.size, i.item_id
  FROM doc_windows d JOIN item_windows i ON d.win = i.win AND d.size = i.size
), words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM (SELECT DISTINCT doc_id, s, size FROM hits))
  GROUP BY doc_id
), items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
  coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words w LEFT JOIN words_hit h ON h.doc_id = w.doc_id
LEFT JOIN items_hit i ON i.doc_id = w.doc_id
"""
