import pytest
from conftest import BASE, rows
from pyspark.sql import functions as F

from bindery.operators import batching, routing
from bindery.sources import lists


def bindings(spark, ids, kind="added"):
    return spark.createDataFrame(
        [(i, BASE + i, kind) for i in ids], "binding_id string, dc_identifier string, kind string"
    )


def forms(spark, prefixes):
    """Both ways to give prefixes: a list, and a split table."""
    return [prefixes, lists.split_table(spark, "s", prefixes)]


def routed(spark, ids, prefixes, **kwargs):
    found = [
        dict(rows(routing.route(bindings(spark, ids), p, **kwargs).select("binding_id", "subset_id")))
        for p in forms(spark, prefixes)
    ]
    assert found[0] == found[1]
    return found[0]


def test_first_match_wins(spark):
    assert routed(spark, ["123", "13"], ["1", "12"]) == {"123": "1", "13": "1"}
    assert routed(spark, ["123", "13"], ["12", "1"]) == {"123": "12", "13": "1"}
    assert routed(spark, ["379973"], ["36", "37"]) == {"379973": "37"}
    assert routed(spark, ["379973"], ["", "37"]) == {"379973": ""}


def test_unroutable_bindings(spark):
    for prefixes in forms(spark, ["12", "13"]):
        ids = bindings(spark, ["379973", "120"])
        with pytest.raises(Exception, match="binding 379973 matches no prefix"):
            routing.route(ids, prefixes).collect()
        kept = routing.route(ids, prefixes, on_error="reject")
        assert rows(kept.select("binding_id")) == [("120",)]
        assert rows(routing.unrouted(ids, prefixes).select("binding_id")) == [("379973",)]
    production = routing.unrouted(bindings(spark, ["1", "012", "10", "9"]), routing.PRODUCTION_PREFIXES)
    assert rows(production.select("binding_id")) == [("012",), ("1",)]


def test_long_prefix_lists(spark):
    prefixes = [str(i) for i in range(100, 1000)]
    assert len(prefixes) > routing.MAX_INLINE_PREFIXES
    assert routed(spark, ["1234", "999", "45600"], prefixes) == {
        "1234": "123", "999": "999", "45600": "456",
    }


def test_update_keeps_only_prefixes_that_got_rows(spark):
    prefixes = ["0", "1", *[str(i) for i in range(20, 30)], *[str(i) for i in range(3, 10)]]
    ids = bindings(spark, ["201000", "212000", "302000", "900000"])
    members, counts = routing.update_subsets(ids, prefixes)
    assert rows(counts) == [("20", 1, 0), ("21", 1, 0), ("3", 1, 0), ("9", 1, 0)]
    more = bindings(spark, [f"44{i}" for i in range(10)]).union(
        bindings(spark, ["4464", "4465"], "deleted")
    )
    _, counts = routing.update_subsets(more, prefixes)
    assert rows(counts) == [("4", 10, 2)]
    assert rows(routing.subsets_to_fill(counts)) == [("4", 10, 2)]
    _, only = routing.update_subsets(bindings(spark, ["44"], "deleted"), prefixes)
    assert routing.subsets_to_fill(only).count() == 0


def test_initial_load_keeps_all_prefixes_and_ignores_deletions(spark):
    changes = bindings(spark, ["11", "12"]).union(bindings(spark, ["9"], "deleted"))
    split = lists.split_table(spark, "s", ["1", "2", "3"])
    members, counts = routing.initial_subsets(changes, split)
    assert rows(counts.select("subset_id", "n_added", "n_deleted")) == [
        ("1", 2, 0), ("2", 0, 0), ("3", 0, 0),
    ]
    assert members.count() == 2


def brute_force(ids):
    ordered = sorted(ids, key=lambda i: (len(i), i))
    n = len(ordered)
    size = min(n, 10) if n < 500 else 30 if n < 50000 else 100
    return [(i, p, p // size) for p, i in enumerate(ordered)]


@pytest.mark.parametrize(
    "ids",
    [
        [str(i) for i in range(50)],
        [str(i * 7919) for i in range(600)],
        [str(10**k + i * 37) for k in (0, 3, 4, 5, 8, 9, 13) for i in range(40)],
        ["5"] * 25 + ["41", "5000123456789", ""],
    ],
)
def test_batches_against_brute_force(spark, ids):
    frame = bindings(spark, ids).withColumn("subset_id", F.lit("s"))
    found = batching.assign_batches(frame).select("binding_id", "position", "batch_index")
    assert sorted(rows(found)) == sorted(brute_force(ids))


def test_batches_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(batching, "COPIES_PER_ROW", 7)
    ids = ["5"] * 30 + ["6"]
    frame = bindings(spark, ids).withColumn("subset_id", F.lit("s"))
    found = batching.assign_batches(frame).select("binding_id", "position", "batch_index")
    assert sorted(rows(found)) == sorted(brute_force(ids))
    first = batching.first_batches(batching.number_bindings(frame))
    assert rows(first.select("binding_id", "copies", "batch_index")) == [("5", 30, 0), ("6", 1, 3)]


def test_batch_lists_and_counts(spark):
    frame = bindings(spark, [str(i) for i in range(50)]).withColumn("subset_id", F.lit("s"))
    found = rows(batching.batch_lists(batching.assign_batches(frame)))
    assert [(s, i, len(b)) for s, i, b in found] == [("s", i, 10) for i in range(5)]
    assert found[1][2] == [BASE + str(i) for i in range(10, 20)]
    assert rows(batching.batch_counts(frame)) == [("s", 50, 10, 5)]
    assert batching.assign_batches(frame.limit(0)).count() == 0


@pytest.mark.parametrize("longest", [1, 4, 8, 12, 20])
def test_levels_do_not_change_the_numbers(spark, longest):
    ids = [str(10**k + i * 370_001) for k in (0, 7, 12, 18) for i in range(30)]
    frame = bindings(spark, ids).withColumn("subset_id", F.lit("s"))
    found = batching.number_bindings(frame, longest=longest)
    expected = sorted((i, p) for i, p, _ in brute_force(ids))
    assert rows(found.select("binding_id", "position")) == expected


def test_no_window_over_a_whole_subset(spark):
    frame = bindings(spark, ["1"]).withColumn("subset_id", F.lit("s"))
    plan = batching.number_bindings(frame)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    by_binding = [w for w in windows if "binding_id" in w]
    assert by_binding and all("_without_4" in w for w in by_binding)


def test_routing_by_a_table_moves_no_bindings(spark):
    prefixes = ["123", "1", "45", "9", "1", ""]
    split = spark.createDataFrame(list(enumerate(prefixes)), "priority int, prefix string")
    ids = bindings(spark, ["1234", "19", "45", "4", "999", "12"])
    found = routing.route(ids, split)
    assert dict(rows(found.select("binding_id", "subset_id"))) == {
        "1234": "123", "19": "1", "45": "45", "4": "", "999": "9", "12": "1",
    }
    assert found.columns == [*ids.columns, "subset_id"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Generate" not in plan
    # The first of the list wins, not the longest.
    turned = spark.createDataFrame([(0, "1"), (1, "123")], "priority int, prefix string")
    assert {r.subset_id for r in routing.route(ids.where("binding_id LIKE '1%'"), turned).collect()} == {"1"}
    empty = routing.unrouted(ids, split.limit(0))
    assert empty.count() == 6
