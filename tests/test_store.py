"""The published store: numbered commits, positional deletes, markers of versions."""

import re
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_jobs import archive_rows

from bindery import commits
from bindery.plans import publication


class Store:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        publication.create_store(spark, root)

    def deleted(self, ids):
        return self.spark.createDataFrame([("1", i) for i in ids], "subset_id string, binding_id string")

    def prepare(self, run, *paths, gone=(), set_id="s", day="2024-01-31"):
        new = archive_rows(self.spark, *paths)
        return publication.prepare_update(self.spark, self.root, set_id, run, day, new, self.deleted(gone))

    def add(self, run, *paths, **kwargs):
        return publication.publish(self.prepare(run, *paths, **kwargs))

    def version(self, name, day="2024-01-31"):
        publication.create_version(self.spark, self.root, name, day)

    def marker(self):
        both = (f(self.spark, self.root) for f in (publication.read_pointers, publication.read_versions))
        return publication.current_version(*both).first()[0]

    def held(self, **kwargs):
        found = publication.read_published(self.spark, self.root, **kwargs)
        return rows(found.select("path", F.decode("content", "utf-8")))

    def paths(self):
        return [path for path, _ in self.held()]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_one_of_many_writers_gets_a_number(spark, tmp_path):
    log = str(tmp_path / "log")
    won = []

    def write(name):
        if commits.commit(spark, log, 7, [{"name": name}] * 100):
            won.append(name)

    threads = [threading.Thread(target=write, args=(f"w{i}",)) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = commits.read(spark, log, "name string")
    assert len(won) == 1 and rows(found) == [(won[0],)] * 100
    assert not list((tmp_path / "log").glob(".*.json*"))


def test_both_of_two_racing_updates_count_once(store):
    """The later one was prepared before the earlier one was published."""
    store.add("r0", "11/a", "12/a")
    early = store.prepare("early", "11/a", "13/x", gone=["12"])
    late = store.prepare("late", "11/a", "13/x")
    assert (early.seen, late.seen) == (1, 1)
    assert [publication.publish(u) for u in (early, late)] == [2, 3]
    assert store.paths() == ["11/a", "13/x"]
    attempts = publication.read_published(store.spark, store.root).select("run_id").distinct()
    assert [a.startswith("s.late.") for (a,) in rows(attempts)] == [True]
    # What the loser had found before is not used.
    log = publication.read_pointers(store.spark, store.root)
    assert rows(log.where("run_id = 'late'").select("removed")) == [(f"{late.attempt}.1",)]


def test_the_loser_of_a_number_is_not_published(store, monkeypatch):
    update = store.prepare("mine", "11/a")
    commit = commits.commit

    def beaten(spark, log, number, entries):
        if entries and entries[0]["run_id"] == "mine":
            assert commit(spark, log, number, [dict(entries[0], run_id="other", set_id="t", location=None, removed=None)])
        return commit(spark, log, number, entries)

    monkeypatch.setattr(publication.commits, "commit", beaten)
    monkeypatch.setattr(publication, "TRIES", 3)
    with pytest.raises(RuntimeError, match="not published"):
        publication.publish(update)
    monkeypatch.undo()
    assert store.paths() == []
    log = publication.read_pointers(store.spark, store.root)
    assert rows(log.select("seq", "set_id")) == [(1, "t"), (2, "t"), (3, "t")]
    # Other sets do not change what an update takes away.
    assert publication.publish(update) == 4
    assert rows(publication.read_pointers(store.spark, store.root).where("set_id = 's'").select("removed")) == [
        (f"{update.attempt}.0",)
    ]
    assert store.paths() == ["11/a"]


def test_a_run_that_is_published_twice_at_once_counts_once(store):
    first, second = store.prepare("r1", "11/a"), store.prepare("r1", "12/a")
    publication.publish(first)
    with pytest.raises(ValueError, match="already published"):
        publication.publish(second)
    assert store.paths() == ["11/a"]


def test_a_compaction_starts_again_after_an_update(store, monkeypatch):
    store.add("r1", "11/a", "12/a")
    store.add("r2", "11/a", gone=["12"])
    late = store.prepare("r3", "13/a", gone=["11"])
    write, done = publication.write_rows, []

    def interrupted(root, attempt, set_id, found):
        written = write(root, attempt, set_id, found)
        if not done:
            done.append(publication.publish(late))
        return written

    monkeypatch.setattr(publication, "write_rows", interrupted)
    publication.compact(store.spark, store.root, "s")
    monkeypatch.undo()
    assert done == [3] and store.paths() == ["13/a"]
    # An update prepared against files that a compaction replaced finds the new ones.
    late = store.prepare("r4", "13/a", "14/a")
    publication.compact(store.spark, store.root, "s")
    publication.publish(late)
    assert store.paths() == ["13/a", "14/a"]


def test_a_compaction_of_some_subsets_leaves_the_others(spark, store):
    def rows_of(subset, *paths):
        return archive_rows(spark, *paths).withColumn("subset_id", F.lit(subset))

    def update(run, added, gone=()):
        deleted = spark.createDataFrame(list(gone), "subset_id string, binding_id string")
        publication.apply_update(spark, store.root, "s", run, "2024-01-31", added, deleted)

    none = archive_rows(spark, "11/a").limit(0)
    first = rows_of("1", "11/a", "12/a").unionByName(rows_of("2", "21/a", "22/a", "23/a", "24/a"))
    update("r1", first)
    update("r2", rows_of("2", "25/a"), [("1", "12"), ("2", "21")])
    update("r3", none, [("2", "21")])  # gone before
    found = {r["subset_id"]: r[1:] for r in publication.waste(spark, store.root, "s").collect()}
    assert found == {"1": (1, 2, 1), "2": (2, 5, 1)}
    store.version("v1")
    held, marker = store.held(), store.marker()
    untouched = set(publication.read_published(spark, store.root, "s", ["2"]).inputFiles())
    assert publication.compact(spark, store.root, "s", least_removed=0.5) == ["1"]
    assert (store.held(), store.marker()) == (held, marker)
    assert set(publication.read_published(spark, store.root, "s", ["2"]).inputFiles()) == untouched
    found = {r["subset_id"]: r[1:] for r in publication.waste(spark, store.root, "s").collect()}
    assert found == {"1": (1, 1, 0), "2": (2, 5, 1)}
    assert publication.compact(spark, store.root, "s", least_removed=0.5) == []
    assert publication.compact(spark, store.root, "s", least_removed=0.5, most_folders=1) == ["2"]
    found = {r["subset_id"]: r[1:] for r in publication.waste(spark, store.root, "s").collect()}
    assert found == {"1": (1, 1, 0), "2": (1, 4, 0)} and store.held() == held
    assert publication.read_version(spark, store.root, "v1").count() == len(held)
    assert publication.waste(spark, store.root, "t").count() == 0
    assert publication.compact(spark, store.root, "t", least_removed=0.5) == []


def test_the_marker_follows_the_order_of_entries(store):
    assert store.marker() is None
    store.version("empty", "2024-05-01")
    assert store.marker() == "empty"
    assert publication.read_version(store.spark, store.root, "empty").count() == 0
    store.add("r1", "11/a", day="2024-02-10")
    assert store.marker() is None
    store.version("v1", "2024-02-01")  # an earlier date than the update's
    assert store.marker() == "v1"
    store.add("r2", "12/a", day="2024-01-01")
    assert store.marker() is None
    publication.compact(store.spark, store.root, "s")
    assert store.marker() is None
    store.version("v2", "2024-02-01")  # the same date as the version before
    assert store.marker() == "v2"
    publication.compact(store.spark, store.root, "s")
    assert store.marker() == "v2"
    store.add("r1", "11/a", set_id="t", day="2023-01-01")  # a set that no version has
    assert store.marker() is None
    versions = publication.read_versions(store.spark, store.root)
    assert publication.latest_version(versions).first()["version_id"] == "v2"
    assert publication.read_version(store.spark, store.root).count() == 2


def test_times_are_those_of_the_session(store):
    store.add("r1", "11/a", day="2024-01-31 12:30:00.000001")
    log = publication.read_pointers(store.spark, store.root)
    assert log.where("published_at = TIMESTAMP '2024-01-31 12:30:00.000001'").count() == 1


def test_removed_rows_of_large_files(store):
    """Bits of several buckets, and rows that updates take away one after the other."""
    n = 3 * publication.BITMAP_ROWS + 5
    new = store.spark.range(n, numPartitions=1).select(
        F.lit("1").alias("subset_id"),
        F.col("id").cast("string").alias("binding_id"),
        F.lit("mets").alias("kind"),
        F.lit(None).cast("int").alias("page_number"),
        F.format_string("%d/a", "id").alias("path"),
        F.lit(1).cast("bigint").alias("size"),
        F.encode(F.lit("x"), "utf-8").alias("content"),
    )
    none = store.deleted([])
    publication.apply_update(store.spark, store.root, "s", "r1", "2024-01-31", new, none)
    gone = set()
    for run, some in (("r2", range(0, n, 7)), ("r3", (0, 1, 8, 32_767, 32_768, 65_535, 65_536, n - 1))):
        gone |= set(some)
        store.add(run, gone=[str(i) for i in some])
    found = publication.read_published(store.spark, store.root).select(F.col("binding_id").cast("long"))
    assert {r[0] for r in found.collect()} == set(range(n)) - gone


def test_groups_of_bitmaps_are_read_with_their_own_files(store):
    for i in range(6):
        store.add(f"r{i}", f"1{i}/a", f"1{i}/b")
    store.add("last", "10/a", "13/a", gone=["11"])
    log = publication.read_pointers(store.spark, store.root)
    wanted = sorted([f"1{i}/{x}" for i in (0, 2, 3, 4, 5) for x in "ab"])
    for limit in (publication.BROADCAST_BYTES, 1, 10_000):
        found = publication.read_placed(store.spark, store.root, log, limit)
        assert sorted(r.path for r in found.select("path").collect()) == wanted
    one = publication.read_placed(store.spark, store.root, log, 1)
    joins = re.findall(r"BroadcastHashJoin", one._jdf.queryExecution().executedPlan().toString())
    folders = [r.removed for r in log.select("removed").distinct().collect()]
    removed = publication.read_removed(store.spark, store.root, folders, ["s_1"])
    assert len(joins) == removed.count() > 1  # a group for each bitmap


def test_reading_moves_no_content(store, tmp_path):
    store.add("r1", "11/a", "12/a", "13/a")
    store.add("r2", "11/a", gone=["12"])
    store.version("v1")
    spark = store.spark
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (
            publication.read_published(spark, store.root),
            publication.read_version(spark, store.root, "v1"),
            publication.select_binding(spark, store.root, "s", "11"),
        ):
            plan = found._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            )
            assert "SortMergeJoin" not in plan
            nodes = re.split(r"\n\n+", plan)
            moved = [n for n in nodes if re.match(r"\(\d+\) (Broadcast)?Exchange", n)]
            assert moved and not any("content" in n for n in moved)
            assert found.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
