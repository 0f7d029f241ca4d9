"""Pipeline stages keep columns whose names clash with their own, and edge rows."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

CLASHING = "w n bits total lines score kept size id number own own_size copy copies".split()
NAMES = ("doc_id", "text", "source", *CLASHING)
FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("stage", ["quality", "near_duplicates", "secret_scan", "mix_sources"])
def test_clashing_columns_stay(spark, stage):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source")
    edges = spark.createDataFrame(
        [(None, None, None), (None, "", "s"), (None, None, None)], documents.schema
    )
    docs = documents.limit(30).union(edges)
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i} of "), F.coalesce("doc_id", F.lit(-1))))
    docs = docs.select(*NAMES).withColumn("a.b`c", F.lit("odd"))
    found = getattr(corpus_pipeline, stage)(spark, docs, FOLDER)
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows
    for row in rows:
        of = -1 if row.doc_id is None else row.doc_id
        assert [row[name] for name in CLASHING] == [f"{i} of {of}" for i in range(len(CLASHING))]
        assert row["a.b`c"] == "odd"
    assert getattr(corpus_pipeline, stage)(spark, docs.limit(0), FOLDER).count() == 0
