"""URL filters: given rules, and rules mined from labelled urls.

A url's tokens are all labels of its host, all segments of its path and all names in
its query, each with its kind, digits written as ``0``. FP-growth over the tokens of
labelled urls, with one more item for a bad label, gives association rules; those
with that item as consequent and enough support and confidence are kept. They are
matched by an inverted index: each rule stands under its rarest item, and a url is
held against the rules under its own items only.

Rules are bounded by their support, not by the length of a url. Only tokens that have
the least support among bad urls can be in a rule; there are at most
``mean tokens of a url / least_support`` of them, which is what is broadcast and what
FP-growth keeps on the driver. Tokens that stand in exactly the same labelled urls are
one item, since any of them makes the same rule: the parts of a template that always
come together count once instead of doubling the item sets each. Up to
``BROADCAST_RULES`` mined rules, those under heavy items are broadcast; more meet the
urls by shuffle, and the urls of a heavy item are spread over copies of its rules. The
item sets of ``n`` items that do vary, and are frequent together, are still ``2 ** n``.

Defined results: a null url, or one without ``://``, has an empty host and path, no
tokens and no rule. Without labels, with labels of one kind only, or without frequent
items there are no mined rules. Rows are judged one by one: ties and repeated rows get
equal results. Tables may be empty; of extra columns nothing is read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechprep.llm import common
from speechprep.llm.common import join_facts, lower_az, settled

BAD = "bad"
#: Mined rules whose index may be broadcast; more meet by shuffle, in lists of about
#: so many rules.
BROADCAST_RULES, LISTED_RULES = 100_000, 1000
#: First ``://``, then host, path and query.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Mining:
    """Rules need ``least_support`` of the labelled urls, ``least_count`` of them at
    least whatever their number, and ``least_confidence``."""

    least_support: float = 0.005
    least_count: int = 5
    least_confidence: float = 0.8


def host_of(url: Column) -> Column:
    return lower_az(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def given_rule(host: Column, path: Column, rules: list[Rule], value: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, else null. A rule fits
    its host and all subdomains, where the path begins with the rule's."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.lit(getattr(rule, value))
        out = F.when(fits, chosen) if out is None else out.when(fits, chosen)
    return F.lit(None).cast("string") if out is None else out


def tokens(url: Column) -> Column:
    """The distinct tokens of a url, of all its labels, segments and query names."""

    def marked(mark: str, parts: Column) -> Column:
        return F.transform(
            F.filter(parts, lambda p: p != ""),
            lambda p: F.concat(F.lit(mark), F.regexp_replace(p, r"\d+", "0")),
        )

    query = F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit(""))
    names = F.transform(F.split(query, "&", -1), lambda p: F.substring_index(p, "=", 1))
    return F.array_distinct(
        F.concat(
            marked("host ", F.split(host_of(url), r"\.", -1)),
            marked("path ", F.split(path_of(url), "/", -1)),
            marked("query ", names),
        )
    )


def _items(transactions: DataFrame, least: int) -> DataFrame:
    """``(item, tokens)``: the tokens of at least ``least`` bad urls, those that stand
    in the same urls together, named by the smallest."""
    return settled(
        transactions.select("_bad", "_n", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(
            F.count_if("_bad").alias("bad"),
            F.count("*").alias("held"),
            F.bit_xor(F.xxhash64("_n")).alias("urls"),
            F.bit_xor(F.xxhash64("_n", F.lit(1))).alias("urls_too"),
        )
        .filter(F.col("bad") >= least)
        .groupBy("held", "urls", "urls_too")
        .agg(F.sort_array(F.collect_list("token")).alias("tokens"))
        .select(F.get("tokens", F.lit(0)).alias("item"), "tokens")
    )


def _mine(labelled: DataFrame, how: Mining) -> tuple[DataFrame, DataFrame]:
    """``(antecedent, confidence, support)``, antecedents made of items, and the
    items as ``(item, tokens)``."""
    transactions = settled(
        labelled.filter("_bad is not null")
        .select("_bad", tokens(F.col("_url")).alias("tokens"))
        .filter((F.size("tokens") > 0) | F.col("_bad"))
        .withColumn("_n", F.monotonically_increasing_id())
    )
    total = transactions.count()
    least = max(math.ceil(how.least_support * total), how.least_count, 1)
    items = _items(transactions, least)
    if items.isEmpty():
        none = items.select(
            F.col("tokens").alias("antecedent"),
            F.lit(0.0).alias("confidence"),
            F.lit(0.0).alias("support"),
        )
        return none, items
    baskets = settled(
        transactions.select("_n", "_bad", F.explode("tokens").alias("item"))
        .join(F.broadcast(items.select("item")), "item", "left_semi")
        .groupBy("_n", "_bad")
        .agg(F.collect_list("item").alias("items"))
        .select(F.when(F.col("_bad"), F.array_append("items", BAD)).otherwise(F.col("items")).alias("items"))
    )
    # urls without an item are not in the baskets, but count for the support
    held = baskets.count()
    model = FPGrowth(
        itemsCol="items", minSupport=(least - 0.5) / held, minConfidence=how.least_confidence
    ).fit(baskets)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD)))
    support = F.col("support") * held / total
    return settled(rules.select("antecedent", "confidence", support.alias("support"))), items


def mine(labelled: DataFrame, how: Mining) -> DataFrame:
    """``(antecedent array<string>, confidence, support)`` from ``(_url, _bad)``: one
    row for every choice of one token per item. Rules with two tokens of an item are
    left out: they say no more than those with either."""
    rules, items = _mine(labelled, how)
    chosen = F.aggregate(
        "choices",
        F.array(F.array().cast("array<string>")),
        lambda done, some: F.flatten(
            F.transform(done, lambda d: F.transform(some, lambda t: F.array_append(d, t)))
        ),
    )
    return (
        rules.withColumn("item", F.explode("antecedent"))
        .join(items, "item")
        .groupBy("antecedent", "confidence", "support")
        .agg(F.collect_list("tokens").alias("choices"))
        .select(F.explode(chosen).alias("antecedent"), "confidence", "support")
    )


def _index(rules: DataFrame, used: DataFrame, lists: int) -> DataFrame:
    """``(item, held, rules)``: the rules under their rarest item, in up to ``lists``
    rows per item; ``used`` has the number of urls with each item."""
    numbered = rules.select("antecedent", "confidence", F.explode("antecedent").alias("item"))
    return (
        numbered.join(used, "item")
        .groupBy("antecedent", "confidence")
        .agg(F.min(F.struct("held", "item")).alias("rarest"), F.count("*").alias("known"))
        .filter(F.col("known") == F.size("antecedent"))
        .withColumn("list", F.pmod(F.xxhash64("antecedent"), F.lit(lists)))
        .groupBy("rarest.item", "rarest.held", "list")
        .agg(F.collect_list(F.struct("antecedent", "confidence")).alias("rules"))
        .drop("list")
    )


def _candidates(found: DataFrame, rules: DataFrame) -> DataFrame:
    """``(_url, copies, items, rules)``: the rules under the items of each url of
    ``found (_url, copies, items)``."""
    spread_out = found.select("*", F.explode("items").alias("item"))
    used = settled(spread_out.groupBy("item").agg(F.count("*").alias("held")))
    total = used.agg(F.sum("held")).first()[0] or 0
    mined = rules.count()
    if mined <= BROADCAST_RULES:
        index = _index(rules, used, 1)
        return join_facts(spread_out, index, "item", "held", total).filter("rules is not null")
    index = _index(rules, used, mined // LISTED_RULES + 1)
    least = max(total // common.HEAVY_KEYS, common.HEAVY_ROWS)
    heavy = F.broadcast(
        used.filter(F.col("held") > least).select("item", F.ceil(F.col("held") / least).alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    urls = spread_out.join(heavy, "item", "left").withColumn(
        "part", F.pmod(F.xxhash64("_url"), parts)
    )
    copies = index.join(heavy, "item", "left").select(
        "item", "rules", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    )
    return urls.drop("parts").join(copies, ["item", "part"])


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: list[Rule],
    how: Mining = Mining(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``(id_col, host, path, rule, verdict, confidence)`` of every row of ``pages``;
    ``labelled`` is ``(_url, _bad boolean)``. ``confidence`` is that of the best mined
    rule, null without one."""
    url = F.col("_url")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    mined, items = _mine(labelled, how)
    ruled = items.join(
        F.broadcast(mined.select(F.explode("antecedent").alias("item")).distinct()), "item", "left_semi"
    ).select("item", F.explode("tokens").alias("token"))
    # equal urls are judged once, by the items that stand in a rule
    found = settled(
        rows.filter(url.isNotNull())
        .groupBy("_url")
        .agg(F.count("*").alias("copies"))
        .select("_url", "copies", F.explode(tokens(url)).alias("token"))
        .join(F.broadcast(ruled), "token")
        .groupBy("_url", "copies")
        .agg(F.collect_set("item").alias("items"))
    )
    matched = (
        _candidates(found, mined)
        .select("_url", "copies", "items", F.explode("rules").alias("rule"))
        .filter(F.size(F.array_except("rule.antecedent", "items")) == 0)
        .groupBy("_url", "copies")
        .agg(F.max("rule.confidence").alias("confidence"))
    )
    judged = join_facts(rows, matched, "_url", "copies", rows.count())
    host, path = host_of(url), path_of(url)
    given = given_rule(host, path, rules, "verdict")
    own = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return judged.select(
        F.col("_id").alias(id_col),
        host.alias("host"),
        path.alias("path"),
        given_rule(host, path, rules, "name").alias("rule"),
        F.coalesce(given, own).alias("verdict"),
        "confidence",
    )
