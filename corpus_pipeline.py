"""Corpus pipeline: from raw documents to token IDs, stage by stage.

``STAGES`` lists the stages. Each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written and read again as the next one's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindery.llm import bpe, mixing, neardup, quality_rules, secrets
from bindery.llm.queries import RANKS
from bindery.llm.texts import words
from bindery.scratch import stored


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[Column]]:
    """The rows with all but the needed columns under private names, and the way back."""
    private = {
        c: c if c in needed else f"other column {i}" for i, c in enumerate(docs.columns)
    }
    inner = docs.select([docs[f"`{c.replace('`', '``')}`"].alias(p) for c, p in private.items()])
    return inner, [F.col(f"`{p}`").alias(c) for c, p in private.items()]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all their columns.

    A null or empty text is rejected; no rows give no rows.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    inner, columns = set_aside(docs, "doc_id", "text")
    judged = quality_rules.judge(inner, quality_rules.trusted_ids(labels))
    return judged.where("kept").select(columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, and one row of repeated rows of an ID.

    Rows of one ID are repeated if their texts are equal; different texts of one ID are
    documents of their own. Rows without an ID are linked with nothing and stay.
    """
    inner, columns = set_aside(docs, "doc_id", "text")
    linked = neardup.link(inner.select("doc_id", "text"))
    kept = linked.where("chosen AND doc_id IS NOT NULL").select("doc_id", "text_key").distinct()
    rest = inner.where("doc_id IS NULL")
    own = inner.withColumn("text_key", neardup.text_key())
    whole = own.join(kept, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    return whole.drop("text_key").unionByName(rest).select(columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without secrets: each is replaced by a mark."""
    inner, columns = set_aside(docs, "text", "n_chars")
    return secrets.redact(inner).select(columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it whole, with all its columns.

    Rows of equal ID, source and size are told apart by a number.
    """
    inner, columns = set_aside(docs, "doc_id", "source", "text")
    same = ["id", "mixed_source", "size"]
    number = F.row_number().over(Window.partitionBy(*same).orderBy("copies"))
    copies = (
        mixing.mix(inner.select("doc_id", "source", "text"))
        .select(F.col("doc_id").alias("id"), F.col("source").alias("mixed_source"), "size", "copies")
        .withColumn("number", number)
        .where("copies > 0")
    )
    size = F.size(words(F.col("text"))).cast("long")
    own = F.row_number().over(
        Window.partitionBy("doc_id", "source", "own_size").orderBy(F.xxhash64("text"))
    )
    joined = inner.withColumn("own_size", size).withColumn("own", own).join(
        copies,
        F.col("doc_id").eqNullSafe(F.col("id"))
        & F.col("source").eqNullSafe(F.col("mixed_source"))
        & (F.col("own_size") == F.col("size"))
        & (F.col("own") == F.col("number")),
    )
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token IDs of the documents, with their digests."""
    path = public_tokenizers.path(RANKS)
    coded = bpe.tokenize(docs, path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "source", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("mixing", mix_sources),
    ("byte BPE", tokenize),
]

#: Signatures, guess costs and tokenizer merges are not SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
