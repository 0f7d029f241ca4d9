"""Properties of physical plans that matter at scale."""

import re

from conftest import BASE, image_group, manifest
from pyspark.sql import functions as F

from bindery import schemas
from bindery.operators import (
    auditing,
    fetching,
    manifests,
    merging,
    outcomes,
    routing,
)
from bindery.plans import publication, runs
from bindery.sources import archives, lists


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"[ +]Exchange (\w+)", physical(df))


def docs(spark):
    return spark.createDataFrame(
        [("1", BASE + "1", manifest([image_group(2)]))],
        "binding_id string, dc_identifier string, xml string",
    )


def archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    frame = spark.createDataFrame(
        [("s", "1", "12", 1, "1/12/12/alto/00001.xml", 3, b"abc", "r", "t", "alto")],
        schemas.ARCHIVE,
    )
    frame.write.partitionBy("run_id", "target", "kind").parquet(path)
    return spark.read.schema(schemas.ARCHIVE).parquet(path)


def test_each_document_is_parsed_once(spark):
    parsed = manifests.parse_manifests(docs(spark))
    for found in (
        manifests.faulty_manifests(parsed),
        manifests.manifest_files(parsed, on_error="reject"),
        manifests.manifest_files(parsed),
    ):
        assert optimized(found).count("from_xml(") == 1
    dated = manifests.issued_between(manifests.date_issued(docs(spark)), "1900", "1950")
    assert optimized(dated).count("XPathStringEvaluator") == 1


def test_routing_by_a_list_does_not_shuffle(spark):
    routed = routing.route(docs(spark), routing.PRODUCTION_PREFIXES)
    assert exchanges(routed) == []


def test_small_updates_do_not_shuffle_content(spark, tmp_path):
    held = archive(spark, tmp_path)
    keys = spark.createDataFrame([("x", "9")], "path string, binding_id string")
    new = held.limit(0)
    updated = merging.apply_changes(held, new, keys, measure=True)
    # The only shuffle is that of the deleted IDs' distinct.
    plan = physical(updated)
    scans = [part for part in plan.split("FileScan") if "content" in part]
    assert scans and "SortMergeJoin" not in plan
    assert all("content" not in line for line in plan.splitlines() if "Exchange hash" in line)


def test_updates_do_not_read_held_content(spark, tmp_path):
    held = archive(spark, tmp_path).withColumns({"file": F.lit("f"), "row": F.lit(0).cast("long")})
    deleted = spark.createDataFrame([("1", "9")], "subset_id string, binding_id string")
    found = physical(publication.bitmaps(publication.removed_places(held, held, deleted)))
    schemas_read = re.findall(r"ReadSchema: struct<([^>]*)", found)
    assert schemas_read and not any("content" in s for s in schemas_read)


def test_queries_on_names_do_not_read_content(spark, tmp_path):
    held = archive(spark, tmp_path)
    for found in (
        archives.mets_ids(archives.as_entries(held)),
        archives.present_paths(held),
        auditing.classified_entries(archives.as_entries(held)),
    ):
        schema = re.search(r"ReadSchema: struct<([^>]*)", physical(found)).group(1)
        assert "content" not in schema


def test_partition_filters_prune_kinds(spark, tmp_path):
    found = archives.select_files(archive(spark, tmp_path), kind="mets")
    assert re.search(r"PartitionFilters: \[[^]]*kind", physical(found))


def test_partition_filters_prune_lists(spark, tmp_path):
    root = str(tmp_path)
    sets = spark.createDataFrame([("a",)], "set_id string")
    rows = spark.createDataFrame([("a", "added", "u")], "set_id string, kind string, dc_identifier string")
    lists.write_binding_lists(rows, sets, "2024-01-31", root)
    one = lists.read_binding_lists(spark, root).where((F.col("set_id") == "a") & (F.col("kind") == "added"))
    assert re.search(r"PartitionFilters: \[[^]]*set_id[^]]*kind", physical(one))


def test_directories_are_pruned_in_one_pass(spark):
    entries = spark.createDataFrame([("1/", "a")], "path string, note string")
    for found in (merging.empty_directories(entries), merging.prune_empty_directories(entries)):
        assert len(exchanges(found)) == 1 and physical(found).count("Scan ExistingRDD") <= 2
        assert "Join" not in physical(found)


def test_manifest_order_does_not_shuffle(spark):
    parsed = manifests.parse_manifests(docs(spark))
    assert exchanges(manifests.in_manifest_order(manifests.manifest_files(parsed))) == []


def test_rows_of_one_set_are_not_shuffled_for_its_last_run(spark):
    held = spark.createDataFrame([("a", "2024-01-01")], "set_id string, datestamp string")
    last = spark.createDataFrame([("a", "2024-01-01")], "set_id string, last_run string")
    assert exchanges(runs.since_last_run(held, last)) == []


def test_number_of_fetch_tasks_is_fixed(spark):
    plan = spark.range(10).select(
        F.col("id").cast("string").alias("path"), F.col("id").cast("string").alias("download_url")
    )
    fetched = fetching.fetch(plan, lambda url: (200, b""), partitions=7)
    assert "REPARTITION_BY_NUM" in physical(fetched)
    assert fetched.rdd.getNumPartitions() == 7


def test_aggregates_combine_before_the_shuffle(spark):
    log = spark.createDataFrame(
        [("1", "alto", 1, "ok")], "binding_id string, kind string, attempt int, outcome string"
    )
    for found in (
        outcomes.outcome_counts(log),
        outcomes.latest_attempts(log, ["binding_id"]),
        outcomes.failures(log, ["binding_id"]),
    ):
        plan = physical(found)
        assert "partial_" in plan and "Window" not in plan
        assert len(exchanges(found)) == 1
