"""The operators over the given tables, each with its SQL if there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    classifier,
    collocations,
    html,
    katz,
    lexical,
    mixing,
    neardup,
    quality_rules,
    secrets,
    substrings,
    topk,
    warc,
)
from ..scratch import new_folder, stored
from .texts import remainder

#: Rank file of the tokenizer.
RANKS = "byte_bpe_multi_50k.tiktoken"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the session and the tables' folder."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op5_mixing", mixing.SQL)
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op2_quality_rules", quality_rules.SQL)
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(
        table(spark, folder, "documents"),
        quality_rules.trusted_ids(table(spark, folder, "labels")),
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.tokenize(
        table(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


@query("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    model = classifier.train(documents, labels.where(~classifier.held_out(F.col("doc_id"))))
    scored = classifier.classify(documents, model)
    return scored.select(
        "doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query("op7_top_k", topk.SQL)
def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op4_near_duplicates")
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.link(table(spark, folder, "documents"))


@query("op9_katz_scores")
def op9_katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 1
    scored = katz.score(documents, ~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query("op13_lexical_search", lexical.SQL)
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_warc", warc.SQL)
def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = new_folder(spark, "archives")
    stored(warc.write(table(spark, folder, "pages"), archives), "places")
    return warc.read(spark, archives).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op11_phrase_collocations", collocations.SQL)
def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))
