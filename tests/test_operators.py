import itertools

import pytest
from conftest import BASE, image_group, manifest, rows
from pyspark.sql import functions as F

from bindery.functions import ids
from bindery.operators import auditing, changes, fetching, merging, outcomes
from bindery.partitioning import broadcast_if_small
from bindery.plans import runs

LOG = (
    "binding_id string, kind string, page_number int, position int, attempt int, "
    "status int, n_bytes long, skipped boolean"
)


def log(spark, *lines):
    return outcomes.with_outcomes(spark.createDataFrame(list(lines), LOG))


def test_outcomes(spark):
    cases = [
        (None, "alto", None, "no_response"),
        (404, "alto", None, "not_found"),
        (401, "alto", None, "unauthorized"),
        (500, "alto", None, "error"),
        (403, "mets", None, "error"),
        (200, "alto", 0, "ok"),
        (200, "mets", 0, "empty"),
        (200, "mets", 9, "ok"),
    ]
    frame = spark.createDataFrame(
        [(i, s, k, n, e) for i, (s, k, n, e) in enumerate(cases)],
        "i int, status int, kind string, n_bytes long, expected string",
    )
    found = frame.withColumn("outcome", outcomes.outcome("status", "kind", "n_bytes"))
    assert found.where("outcome <> expected").count() == 0


def test_other_statuses_stop_a_binding(spark):
    lines = log(
        spark,
        ("1", "alto", 1, 0, 1, 404, None, False),
        ("1", "alto", 2, 1, 1, None, None, False),
        ("1", "alto", 3, 2, 1, 500, None, False),
        ("1", "alto", 4, 3, 1, 200, 5, False),
        ("1", "access_img", 4, 4, 1, 200, 5, False),
        ("2", "alto", 1, 0, 1, None, None, True),
        ("2", "alto", 2, 1, 1, 401, None, False),
    )
    stopped = outcomes.stop_at_errors(lines)
    found = rows(stopped.select("binding_id", "kind", "position", "outcome"))
    assert ("1", "alto", 3, "not_attempted") in found
    assert ("1", "access_img", 4, "ok") in found
    counts = outcomes.outcome_counts(stopped)
    assert rows(counts) == [
        # total, 404, 401, no response, other, skipped, failed
        ("1", "access_img", 1, 0, 0, 0, 0, 0, False),
        ("1", "alto", 3, 1, 0, 1, 1, 0, True),
        ("2", "alto", 2, 0, 1, 0, 0, 1, True),
    ]
    assert [r["line"] for r in outcomes.report_lines(counts).orderBy("line").collect()] == [
        "When downloading alto files for binding 1, 1/3 files failed with a 404",
        "When downloading alto files for binding 2, 1/2 files failed with a 401",
        "When downloading alto files for binding 2, 1/2 were skipped as already downloaded",
    ]


def test_batch_verdicts(spark):
    schema = "batch int, attempt int, outcome string"
    lines = spark.createDataFrame(
        [
            (0, 1, "ok"),
            (1, 1, "not_found"), (1, 2, "ok"),
            (2, 1, "ok"), (2, 2, "no_response"), (2, 2, "ok"),
            (3, 1, "error"), (3, 2, "error"), (3, 3, "error"),
            (4, 3, "ok"),
        ],
        schema,
    )
    leftovers = outcomes.temporary_files(
        spark.createDataFrame([(4, "a/1.jp2.tmp"), (0, "a/1.jp2")], "batch int, path string"),
        ["batch"],
    )
    assert rows(outcomes.batch_verdicts(lines, ["batch"], leftovers)) == [
        (0, 1, False, "proceed"),
        (1, 2, False, "proceed"),
        (2, 2, True, "fail"),
        (3, 3, True, "proceed"),
        (4, 3, False, "fail"),
    ]
    assert rows(outcomes.failures(lines, ["batch"]))[1] == (1, True)
    assert rows(outcomes.latest_attempts(lines.where("batch = 1"), ["batch"])) == [(1, 2, 2, "ok")]


def test_presence_joins(spark):
    plan = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    present = spark.createDataFrame([("a", 5), ("b", 0)], "path string, size long")
    assert rows(fetching.not_present(plan, present)) == [("b",), ("c",)]
    assert rows(fetching.already_present(plan, present)) == [("a",)]
    pages = spark.createDataFrame([("1",), ("2",), ("3",)], "binding_id string")
    arrived = spark.createDataFrame([("1", 9), ("2", 0)], "binding_id string, n_bytes long")
    assert rows(fetching.with_manifest(pages, arrived)) == [("1",)]


def test_direct_downloads(spark):
    frame = spark.createDataFrame(
        [(BASE + "9", "alto", "00001.xml", None), (BASE + "9", "access_img", "00001.jp2", "x.jp2")],
        "dc_identifier string, kind string, filename string, location_xlink string",
    )
    found = fetching.direct_downloads(frame, "/data").select("output_path", "message")
    assert [tuple(r) for r in found.collect()] == [
        ("/data/9/alto/00001.xml", None),
        (None, "No download URL available for file x.jp2"),
    ]


def archive(spark, *lines):
    return spark.createDataFrame(list(lines), "path string, binding_id string, v int")


def test_adds_are_merged_before_deletions(spark):
    old = archive(spark, ("p1", "1", 0), ("p2", "2", 0), ("p3", "3", 0))
    new = archive(spark, ("p1", "1", 1), ("p4", "4", 1), ("p5", "5", 1))
    gone = spark.createDataFrame([("2",), ("5",), ("99",)], "binding_id string")
    expected = [("p1", "1", 1), ("p3", "3", 0), ("p4", "4", 1)]
    columns = ["path", "binding_id", "v"]
    for measure in (False, True):
        found = merging.apply_changes(old, new, gone, measure=measure)
        assert rows(found.select(columns)) == expected


def test_broadcast_only_below_the_limit(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("path"))
    data = spark.range(10).select(F.col("id").cast("string").alias("path"))
    small = data.join(broadcast_if_small(keys), "path", "left_anti")
    assert "ResolvedHint (strategy=broadcast)" in _analyzed(small)
    large = data.join(broadcast_if_small(keys, limit=100), "path", "left_anti")
    assert "ResolvedHint" not in _analyzed(large)


def _analyzed(df):
    return df._jdf.queryExecution().analyzed().toString()


ENTRIES = ["1/", "1/12/", "1/12/12/", "1/12/12/mets/", "1/12/12/mets/12_METS.xml",
           "1/12/123/", "1/12/123/123/", "1/12/123/123/alto/", "1/12/123/123/alto/00001.xml",
           "2/", "2/21/", "note.txt", "./3/", "./3/f"]


def empty_directories(entries):
    files = [e for e in entries if not e.endswith("/")]
    return sorted(
        (e for e in entries if e.endswith("/") and not any(f.startswith(e) for f in files)),
        reverse=True,
    )


def test_empty_directories_against_the_definition(spark):
    frame = spark.createDataFrame([(e,) for e in ENTRIES], "path string")
    found = merging.deepest_first(merging.empty_directories(frame))
    assert [r["path"] for r in found.collect()] == empty_directories(ENTRIES) == ["2/21/", "2/"]


@pytest.mark.parametrize("gone", [["123"], ["12"], ["12", "123"], ["1"], []])
def test_deletion_leaves_and_prunes_empty_directories(spark, gone):
    frame = spark.createDataFrame([(e,) for e in ENTRIES], "path string")
    deleted = spark.createDataFrame([(g,) for g in gone], "binding_id string")
    inside = tuple(
        "/".join([*(g[:i] for i in range(1, len(g) + 1)), g]) + "/" for g in gone
    )
    left = [e for e in ENTRIES if not (inside and e.startswith(inside))]
    found = merging.delete_entries(frame, deleted)
    assert rows(found) == sorted((e,) for e in left)
    empty = empty_directories(left)
    pruned = merging.prune_empty_directories(found)
    assert rows(pruned) == sorted((e,) for e in left if e not in empty)


def test_integrity_audit(spark):
    base = "1/12/12"
    held = [
        "1/", "1/12/",
        f"{base}/mets/12_METS.xml",
        f"{base}/alto/al-00001.xml", f"{base}/alto/00002.xml",
        f"{base}/access_img/pr-00001.jp2",
        "1/13/13/mets/13_METS.xml",
        "1/14/14/alto/00001.xml", "1/14/14/alto/00002.xml",
        "alto/00001.xml",
    ]
    entries = spark.createDataFrame(
        [("set_1.zip", p, p.endswith("/")) for p in held],
        "archive string, path string, is_dir boolean",
    )
    docs = spark.createDataFrame(
        [
            ("set_1.zip", f"{base}/mets/12_METS.xml", manifest([image_group(2)])),
            ("set_1.zip", "1/13/13/mets/13_METS.xml", manifest([])),
        ],
        "archive string, path string, xml string",
    )
    expected = spark.createDataFrame([("12",), ("15",), ("25",), ("15",)], "binding_id string")
    errors = auditing.integrity_errors(
        entries,
        auditing.expected_files(docs, BASE),
        auditing.binding_faults(entries, expected),
    )
    assert sorted(errors.collect(), key=str) == sorted(
        [
            ("set_1.zip", None, "malformed_path", "alto/00001.xml"),
            ("set_1.zip", "12", "missing_image", "00002.jp2"),
            ("set_1.zip", "14", "unlisted_file", "1/14/14/alto/00001.xml"),
            ("set_1.zip", "14", "unlisted_file", "1/14/14/alto/00002.xml"),
            ("set_1.zip", "15", "missing_mets", None),
            ("set_1.zip", "13", "extra_mets", None),
        ],
        key=str,
    )
    counts = {(r[0], r[1]): r[2] for r in auditing.error_counts(errors).collect()}
    assert counts[(None, None)] == counts[("set_1.zip", None)] == 6
    assert counts[("set_1.zip", "unlisted_file")] == 2
    pairs = auditing.expected_bindings(expected, entries)
    assert rows(auditing.expected_counts(pairs)) == [("set_1.zip", 2)]


def test_archives_without_prefix_expect_everything(spark):
    archives = spark.createDataFrame([("a.zip",), ("a_2.zip",)], "archive string")
    expected = spark.createDataFrame([("12",), ("25",)], "binding_id string")
    assert rows(auditing.expected_bindings(expected, archives)) == [
        ("a.zip", "12"), ("a.zip", "25"), ("a_2.zip", "25"),
    ]


def test_audit_of_several_sets(spark):
    archives = spark.createDataFrame(
        [("a_13.zip", "a"), ("b_13.zip", "b"), ("b.zip", "b")], "archive string, set_id string"
    )
    expected = spark.createDataFrame(
        [("131", "a"), ("132", "b"), ("21", "b")], "binding_id string, set_id string"
    )
    assert rows(auditing.expected_bindings(expected, archives)) == [
        ("a_13.zip", "131"), ("b.zip", "132"), ("b.zip", "21"), ("b_13.zip", "132"),
    ]
    whole = auditing.expected_bindings(expected, archives, guess_prefix=False)
    assert ("b_13.zip", "21") in rows(whole) and whole.count() == 5
    held = [("a_13.zip", "1/131/131/mets/131_METS.xml"), ("b_13.zip", "1/132/132/mets/132_METS.xml")]
    entries = spark.createDataFrame([(*e, False) for e in held], "archive string, path string, is_dir boolean")
    assert auditing.binding_faults(entries, expected, archives.where("archive <> 'b.zip'")).count() == 0


def test_change_listings(spark):
    wanted = spark.createDataFrame(
        [("added", "1"), ("added", "1"), ("added", "2"), ("deleted", "3"), ("deleted", "4"),
         ("added", "5"), ("deleted", "5")],
        "kind string, binding_id string",
    )
    present = spark.createDataFrame([("1",), ("4",), ("9",), ("1",)], "binding_id string")
    listings = changes.change_listings(wanted, present)
    assert rows(listings) == [
        ("added_bindings", "1"),
        ("added_bindings_FAILED", "2"),
        ("added_bindings_FAILED", "5"),
        ("deleted_bindings", "3"),
        ("deleted_bindings", "5"),
        ("deleted_bindings_FAILED", "4"),
    ]
    assert dict(rows(changes.listing_counts(listings)))["added_bindings_FAILED"] == 2
    added = changes.ids_of_kind(wanted, "added")
    assert rows(changes.present_of(added, present)) == [("1",)]
    assert rows(changes.absent_of(added, present)) == [("2",), ("5",)]


def test_listing_files(spark, tmp_path):
    schema = "listing string, binding_id string"
    found = spark.createDataFrame([("added_bindings", "1"), ("added_bindings", "2")], schema)
    changes.write_listings(found, "2024-05-01", str(tmp_path / "l"))
    changes.write_listings(found.limit(0), "2024-06-01", str(tmp_path / "l"))
    days = {p.name for p in (tmp_path / "l").iterdir() if p.is_dir()}
    assert days == {"run_date=2024-05-01"}
    folder = tmp_path / "l" / "run_date=2024-05-01"
    assert [p.name for p in folder.iterdir()] == ["listing=added_bindings"]
    lines = spark.read.text(str(folder / "listing=added_bindings"))
    assert rows(lines) == [("1",), ("2",)]
    # A repeated run leaves nothing of the first one.
    again = found.limit(1).withColumn("listing", F.lit("deleted_bindings"))
    changes.write_listings(again, "2024-05-01", str(tmp_path / "l"))
    assert [p.name for p in folder.iterdir() if p.is_dir()] == ["listing=deleted_bindings"]


def test_runs_and_gate(spark):
    history = spark.createDataFrame(
        [
            ("a", "r1", "success", "2024-01-31 10:00:00"),
            ("a", "r2", "success", "2024-02-29 10:00:00"),
            ("a", "r3", "failed", "2024-03-31 10:00:00"),
            ("a", "r4", "running", "2024-04-30 10:00:00"),
            ("b", "r1", "failed", "2024-01-31 10:00:00"),
        ],
        "set_id string, run_id string, state string, t string",
    ).withColumn("execution_date", F.col("t").cast("timestamp"))
    last = runs.last_successful_runs(history)
    assert [(r[0], r[1], str(r[2])) for r in last.collect()] == [("a", "r2", "2024-02-29")]
    assert rows(runs.newest_running(history).select("set_id", "run_id")) == [("a", "r4")]
    assert runs.newest_first(history).first()["run_id"] == "r4"
    stamps = spark.createDataFrame(
        [("a", "2024-02-28T23:59:59Z"), ("a", "2024-02-29T00:00:00Z"), ("b", "2020-01-01T00:00:00Z")],
        "set_id string, s string",
    ).withColumn("datestamp", F.col("s").cast("timestamp"))
    assert rows(runs.since_last_run(stamps, last).select("set_id", "s")) == [
        ("a", "2024-02-29T00:00:00Z"), ("b", "2020-01-01T00:00:00Z"),
    ]
    cases = list(itertools.product([0, 2], [0, 1], [True, False], [1, 3], [3]))
    sets = spark.createDataFrame(
        [(str(i), ok, t, m) for i, (_, _, ok, t, m) in enumerate(cases)],
        "set_id string, source_ok boolean, try_number int, max_tries int",
    )
    latest = spark.createDataFrame(
        [(str(i), kind) for i, c in enumerate(cases) for kind, n in (("added", c[0]), ("deleted", c[1])) for _ in range(n)],
        "set_id string, kind string",
    )
    found = dict(rows(runs.update_gates(sets, latest).select("set_id", "decision")))
    for i, (added, deleted, ok, tries, limit) in enumerate(cases):
        nothing = not added and not deleted
        expected = "cancel" if nothing else "begin" if ok else "retry" if tries < limit else "cancel"
        assert found[str(i)] == expected


def test_entry_paths_name_their_binding(spark):
    frame = spark.createDataFrame([("1234",)], "binding_id string")
    path = fetching.entry_path("binding_id", F.lit("alto"), F.lit("00001.xml"))
    found = frame.select(path.alias("p")).select("p", ids.binding_of_entry("p"), ids.binding_of_path("p"))
    assert tuple(found.first()) == ("1/12/123/1234/1234/alto/00001.xml", "1234", "1234")
