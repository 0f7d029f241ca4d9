"""The index of landed pages, and the stream of net changes."""

import os

from conftest import BASE, rows
from pyspark.sql import functions as F
from test_jobs import landed
from test_sources import header

from bindery.plans import listing
from bindery.sources import lists, page_index
from bindery.streaming import changes
from bindery.streaming import listing as stream


def names(headers):
    return sorted({os.path.basename(f) for f in headers.inputFiles()})


def runs_of(spark, *runs):
    found = spark.createDataFrame(list(runs), "set_id string, day string")
    return found.select("set_id", F.to_date("day").alias("last_run"))


def sets_of(spark, *sets):
    return spark.createDataFrame([(s,) for s in sets], "set_id string")


def test_only_pages_that_reach_the_last_run_are_read(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "index")
    one, other = landing / "set_id=a b%3Ac+d", landing / "set_id=e"
    landed(one, "1.xml", header(1, "2024-01-01T00:00:00Z", ["x"]), header(2, "2024-01-31T10:00:00Z", ["x"]))
    landed(one, "2.xml", header(3, "2024-03-01T00:00:00Z", ["x"]))
    landed(one, "3.xml")
    landed(other, "4.xml", header(4, "2020-01-01T00:00:00Z", ["x"]))
    path, of = str(landing), page_index.requested_set()
    sets = sets_of(spark, "a b:c+d", "e")
    runs = runs_of(spark, ("a b:c+d", "2024-01-31"), ("e", "2024-01-01"))

    def read(sets, runs=None):
        return page_index.headers_since(spark, path, root, sets, of, runs)

    assert names(read(sets, runs)) == ["1.xml", "2.xml"]
    assert names(read(sets, runs_of(spark, ("a b:c+d", "2024-02-01")))) == ["2.xml", "4.xml"]
    assert names(read(sets)) == ["1.xml", "2.xml", "4.xml"]
    assert names(read(sets_of(spark, "e"))) == ["4.xml"]
    assert read(sets_of(spark, "unknown")).count() == 0
    found = read(sets, runs).select("set_id", "identifier")
    assert rows(found) == [("a b:c+d", f"oai:host:{i}") for i in (1, 2, 3)]

    # Only what has landed since is parsed, a page without headers not again.
    landed(one, "5.xml", header(5, "2024-05-01T00:00:00Z", ["x"]))
    assert page_index.update_index(spark, path, root, of) == 1
    assert page_index.update_index(spark, path, root, of) == 0
    assert names(read(sets, runs_of(spark, ("a b:c+d", "2024-04-01"), ("e", "2024-01-01")))) == ["5.xml"]
    # A page that is landed anew has its new zone besides the old one.
    landed(other, "4.xml", header(4, "2024-04-02T00:00:00Z", ["x"]), header(6, "2020-01-01T00:00:00Z", ["x"]))
    late = runs_of(spark, ("a b:c+d", "2024-06-01"), ("e", "2024-04-01"))
    assert names(read(sets, late)) == ["4.xml"]
    assert read(sets, late).count() == 2


def test_deleted_pages_are_found_by_the_sets_they_name(spark, tmp_path):
    landing, root = tmp_path / "gone", str(tmp_path / "index")
    folder = landing / "set_id=deleted"
    landed(folder, "1.xml", header(1, "2024-01-01T00:00:00Z", ["a", "b"], True), header(2, "2024-05-01T00:00:00Z", ["b"], True))
    landed(folder, "2.xml", header(3, "2024-05-01T00:00:00Z", ["c"], True))
    landed(folder, "3.xml", header(4, "2024-05-01T00:00:00Z", [], True))

    def read(sets, runs=None):
        found = page_index.headers_since(spark, str(landing), root, sets, page_index.named_sets(), runs)
        return names(found)

    assert read(sets_of(spark, "a", "b")) == ["1.xml"]
    assert read(sets_of(spark, "a"), runs_of(spark, ("a", "2024-02-01"))) == []
    assert read(sets_of(spark, "b", "c"), runs_of(spark, ("b", "2024-02-01"), ("c", "2024-06-01"))) == ["1.xml"]


def test_indexed_and_plain_listing_agree(spark, tmp_path):
    landing, deleted = tmp_path / "landing", tmp_path / "deleted"
    for i in range(12):
        stamp = f"2024-{i + 1:02d}-01T00:00:00Z"
        landed(landing / f"set_id={'ab'[i % 2]}", f"{i}.xml", header(i, stamp, ["x"]))
        landed(deleted / "set_id=gone", f"{i}.xml", header(100 + i, stamp, ["a", "b", "x"], True))
    runs = spark.createDataFrame(
        [("a", "r1", "success", "2024-06-15 10:00:00"), ("b", "r2", "failed", "2024-06-15 10:00:00")],
        "set_id string, run_id string, state string, t string",
    ).withColumn("execution_date", F.col("t").cast("timestamp"))
    found = []
    for index in (None, str(tmp_path / "index"), str(tmp_path / "index")):
        root = str(tmp_path / f"lists{len(found)}")
        listing.run_listing(
            spark, str(landing), str(deleted), sets_of(spark, "a", "b"), BASE, "2025-01-01", root, runs, index
        )
        found.append(rows(lists.read_binding_lists(spark, root).select("set_id", "kind", "dc_identifier")))
    assert found[0] == found[1] == found[2] and len(found[0]) == 3 + 6 + 6 + 12


def test_an_identifier_has_its_net_change_once(spark, tmp_path):
    landing, gone, root = tmp_path / "landing", tmp_path / "gone", str(tmp_path / "lists")
    sets = sets_of(spark, "a", "quiet")

    def run(day):
        streams = [stream.stream_headers(spark, str(p)) for p in (landing, gone)]
        query = changes.write_changes(
            changes.header_changes(*streams, BASE), sets, day, root, str(tmp_path / "progress")
        )
        query.awaitTermination(120)
        assert query.exception() is None
        found = lists.read_binding_lists(spark, root).where(F.col("list_date") == day)
        return rows(found.select("set_id", "kind", F.replace("dc_identifier", F.lit(BASE), F.lit(""))))

    (gone / "set_id=gone").mkdir(parents=True)
    first = [header(i, "2024-01-10T00:00:00Z", ["a"]) for i in range(1, 5)]
    landed(landing / "set_id=a", "1.xml", *first)
    # 4 is deleted at the time it is listed for; 9 belongs to a set that is not wanted.
    landed(gone / "set_id=gone", "1.xml", header(4, "2024-01-10T00:00:00Z", ["a", "a"], True),
           header(9, "2024-01-10T00:00:00Z", ["z"], True))
    assert run("2024-02-01") == [("a", "added", str(i)) for i in (1, 2, 3)] + [("a", "deleted", "4")]

    # The page again, an older header of 1, a newer one of 2, the deletion of 3, a new 5.
    landed(landing / "set_id=a", "2.xml", *first, header(1, "2023-01-01T00:00:00Z", ["a"]),
           header(2, "2024-02-10T00:00:00Z", ["a"]), header(5, "2024-02-10T00:00:00Z", ["a"]))
    landed(gone / "set_id=gone", "2.xml", header(3, "2024-02-10T00:00:00Z", ["a"], True),
           header(1, "2023-06-01T00:00:00Z", ["a"], True))
    second = [("a", "added", "2"), ("a", "added", "5"), ("a", "deleted", "3")]
    assert run("2024-03-01") == second
    # More of the same day: the day's list is made of all its batches.
    landed(landing / "set_id=a", "3.xml", header(5, "2024-02-11T00:00:00Z", ["a"]))
    landed(gone / "set_id=gone", "3.xml", header(2, "2024-02-12T00:00:00Z", ["a"], True))
    assert run("2024-03-01") == [("a", "added", "5"), ("a", "deleted", "2"), ("a", "deleted", "3")]
    # A deleted identifier comes back.
    landed(landing / "set_id=a", "4.xml", header(3, "2024-04-01T00:00:00Z", ["a"]))
    assert run("2024-05-01") == [("a", "added", "3")]
    latest = lists.latest_lists(lists.read_binding_lists(spark, root), lists.read_list_markers(spark, root))
    assert rows(latest.select("kind", "dc_identifier")) == [("added", BASE + "3")]
    quiet = lists.read_list_markers(spark, root).where("set_id = 'quiet'").select("n_rows")
    assert {r.n_rows for r in quiet.collect()} == {0}
