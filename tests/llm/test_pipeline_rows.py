"""Rows of one ID in the pipeline's near-duplicate stage."""

import random

import corpus_pipeline
from pyspark.sql import functions as F


def prose(seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdehilnorst") for _ in range(r.randint(2, 7))) for _ in range(80))


def test_different_texts_of_one_id_stay(spark):
    a, b, c = prose(1), prose(2), prose(3)
    near = a.rsplit(" ", 1)[0] + " other"
    rows = [(5, a), (5, b), (5, b), (7, near), (8, c), (9, None), (9, None), (9, ""), (None, c), (None, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1).cast("long"), "kept": F.lit("x")}
    )
    found = corpus_pipeline.near_duplicates(spark, docs, "")
    assert found.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in found.collect()), key=str)
    wanted = [(5, a), (5, b), (8, c), (9, None), (9, ""), (None, c), (None, c)]
    assert got == sorted(wanted, key=str)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0
