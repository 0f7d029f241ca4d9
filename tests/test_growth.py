"""What tasks and the driver hold stays bounded as tables grow, with the same rows."""

import datetime
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from bindery.functions import ids
from bindery.operators import auditing, fetching, manifests
from bindery.plans import auditing as audit_plan
from bindery.plans import publication
from bindery.sources import archives
from workload import audits, registry


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    lines = [(n % 40 + 1, n % 3 + 1, "ANR"[n % 3]) for n in range(300)] + [(None, 1, "N")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    return registry.Tables(spark, str(tmp_path))


def test_a_task_gets_a_bounded_number_of_line_items(tables, monkeypatch):
    monkeypatch.setattr(registry, "LINES_PER_TASK", 3)
    assert tables.page_tasks == 101
    assert tables.flagged_pages.rdd.getNumPartitions() == 101
    pages = rows(tables.flagged_pages.where("l_orderkey IS NOT NULL"))
    assert pages == sorted({(n % 40 + 1, n % 3 + 1, "ANR"[n % 3]) for n in range(300)})
    # Pages of a binding are in one task, so nothing moves to bring them together.
    assert physical(tables.pages_of_bindings).count("Exchange") == 1


def test_images_are_not_computed_twice_for_their_texts(tables):
    both = manifests.altos_for_images(tables.page_images)
    assert "Union" not in physical(both)
    found = both.where("binding_id = '4'").select("kind", "page_number", "location_xlink")
    images = rows(tables.page_images.where("binding_id = '4'").select("kind", "page_number", "location_xlink"))
    texts = [("alto", n, None) for _, n, _ in images]
    assert sorted(map(str, found.collect())) == sorted(map(str, found.sparkSession.createDataFrame(
        images + texts, found.schema).collect()))


def test_archives_are_not_sought_where_line_items_are_read(tables):
    plan = physical(tables.page_images.transform(audits.in_archives))
    assert all("StartsWith" not in line for line in plan.splitlines() if "Filter" in line)


def test_present_paths_are_dealt_before_copies_are_sought(spark):
    held = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 0), ("c", None), (None, 3), (None, 4), ("d", 5)], "path string, size long"
    )
    found = archives.present_paths(held, 9)
    assert physical(found).count("Exchange") == 1 and found.rdd.getNumPartitions() == 9
    assert sorted(map(str, found.collect())) == sorted(map(str, archives.present_paths(held).collect()))


def test_many_differing_bindings_are_not_joined_first(monkeypatch):
    """To pick their paths would move them all by their bindings, before they are compared."""
    given = []
    monkeypatch.setattr(audit_plan, "small_broadcast", lambda keys: None)
    monkeypatch.setattr(audit_plan, "stored", lambda df, path: df)
    for name in ("expected_files", "binding_faults"):
        monkeypatch.setattr(auditing, name, lambda *args: args[0])
    monkeypatch.setattr(auditing, "integrity_errors", lambda *args: given.append(args))
    frame = SimpleNamespace(columns=["archive"])
    for name in ("select", "distinct", "where"):
        setattr(frame, name, lambda *args: frame)
    audit_plan.audit(frame, frame, frame, "base", "staging")
    assert given[0][-1] is None


def test_many_new_paths_are_not_sent_through_the_driver(spark):
    place = {"run_id": "r", "target": "t", "kind": "k", "file": "f"}

    def placed(file, paths):
        data = [(p, p, n) for n, p in enumerate(paths)]
        made = spark.createDataFrame(data, "path string, binding_id string, row long")
        return made.withColumns({c: F.lit(v) for c, v in {**place, "file": file}.items()})

    held, new = placed("old", ["a", "b", "c", "c"]), placed("new", ["b", "c", "d", "d"])
    deleted = spark.createDataFrame([("d",)], "binding_id string")
    few = publication.removed_places(held, new, deleted)
    many = publication.removed_places(held, new, deleted, broadcast_bytes=0)
    assert "SortMergeJoin" in physical(many)
    assert rows(few) == rows(many)
    assert rows(many.select("file", "row")) == [("new", 2), ("new", 3), ("old", 1), ("old", 2), ("old", 3)]


def test_planned_columns_pass_a_fetch_as_they_are(spark):
    row = ("p", "u", datetime.date(2024, 1, 2), None, [1, None])
    plan = spark.createDataFrame([row], "path string, download_url string, day date, n int, list array<int>")
    found = fetching.fetch(plan, lambda url: (200, url.encode()), 1)
    assert "MapInArrow" in physical(found)
    got = found.first()
    assert tuple(got[:5]) == row and (got["status"], bytes(got["content"]), got["n_bytes"]) == (200, b"u", 1)


def test_directories_of_short_and_long_ids_are_alike(spark):
    given = ["", "1", "12", "é1", "1234567890", "12345678901", None]
    found = spark.createDataFrame([(i,) for i in given], "id string").select(
        "id", ids.binding_dir("id"), ids.binding_dir("id", F.lit(0))
    )
    for id_, short, any_depth in found.collect():
        assert short == any_depth
        assert not id_ or short == "/".join([id_[:n] for n in range(1, len(id_) + 1)] + [id_])


def test_plain_names_and_bindings_of_paths(spark):
    cases = [
        ("x/1/alto/al-1.xml", "1", "x/1/alto/1.xml", True),
        ("alto/al-1.xml", None, "alto/1.xml", False),
        ("x/1/access_img/pr-1.jp2", "1", "x/1/access_img/1.jp2", True),
        ("x/alto/al-2/access_img/pr-1.jp2", "al-2", "x/alto/al-2/access_img/pr-1.jp2", True),
        ("x/1/alto/pr-1", "1", "x/1/alto/pr-1", True),
        ("1/xalto/al-1", "1", "1/xalto/al-1", False),
        ("a/1/alto/", "1", "a/1/alto/", False),
        ("a//b", "a", "a//b", False),
        ("a/b", None, "a/b", False),
    ]
    found = spark.createDataFrame([(c[0],) for c in cases], "path string").select(
        "path", ids.binding_of_entry("path"), auditing.plain_name("path"), auditing.is_page_file("path")
    )
    assert [tuple(r) for r in found.collect()] == cases
