"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechprep.llm import (
    bpe,
    chat,
    codes,
    decontam,
    fim,
    linededup,
    lm,
    mixing,
    neardup,
    quality,
    tokencount,
    urlrules,
    warc,
)
from speechprep.llm.common import digest
from speechprep.llm.oracles import all_oracles


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A public vocabulary file that is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = lm.crc_fold(F.col("doc_id"), 7, 2)
    return lm.score_texts(_table(spark, sf_dir, "documents"), held_out)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.deduplicate(_table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.read_back(chat.format_conversations(rows.union(own)))
    turns = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    learnt = F.array_join("learnt", "")
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(F.array_join(turns, "")).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        digest(learnt).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    return tokencount.token_counts(_table(spark, sf_dir, "documents"), path, limit=2048)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = neardup.Similarity(words=2, percent=80)
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), how=how)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


#: The url rules of the contract (fixed values).
URL_RULES = [
    urlrules.Rule("allow", "com", "/"),
    urlrules.Rule("block", "example.com", "/en/"),
    urlrules.Rule("allow", "www.example.com", "/en/"),
    urlrules.Rule("block", "net", "/es/"),
    urlrules.Rule("block", "net", "/fr/"),
]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label with the id of a page is that page's; bad quality and toxic are bad."""
    pages, labels = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labelled = pages.join(
        labels.select(F.col("doc_id").alias("page_id"), bad.alias("_bad")), "page_id"
    ).select(F.col("url").alias("_url"), "_bad")
    return urlrules.judge(pages, labelled, URL_RULES)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return decontam.with_digest(found)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources in order of their code points weigh 1, 2, 3, 1, .., and share the size
    of the whole table."""
    documents = _table(spark, sf_dir, "documents")
    weights = mixing.cycled_weights(documents, "source", (1.0, 2.0, 3.0))
    return mixing.mix(documents, weights, repeats=3)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(_table(spark, sf_dir, "documents"), unit="line", percent=100, spm_percent=50, seed=7)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(
        _table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024
    )
    return codes.with_label_errors(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.books_digest(books)).alias("codebooks_sha256")
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_bpe,
        op2_warc,
        op3_lm_scores,
        op4_line_dedup,
        op5_chat,
        op6_token_counts,
        op7_near_duplicates,
        op8_quality,
        op9_url_filters,
        op10_decontamination,
        op11_mixing,
        op12_fill_in_middle,
        op13_vector_codes,
    )
    return {f.__name__: f for f in every}


def llm_oracles() -> dict[str, str]:
    return all_oracles()
