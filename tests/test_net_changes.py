from conftest import rows

from bindery.streaming import changes


def test_headers_that_count(spark):
    """Compared with what is known, for null keys too, in one aggregation without Python."""
    new = spark.createDataFrame(
        [
            ("s", "a", "added", 5), ("s", "a", "deleted", 5), ("s", "a", "added", 4),
            ("s", "b", "added", 7), ("s", "c", "added", 7), ("s", "d", "deleted", 7),
            ("s", "e", "added", 7), (None, "a", "added", 1), ("s", None, "added", 1),
        ],
        changes.CHANGE,
    )
    known = spark.createDataFrame(
        [
            ("s", "b", "added", 7), ("s", "c", "added", 8), ("s", "d", "added", 7),
            ("s", "e", "added", 3), ("s", "e", "deleted", 7), (None, "a", "added", 1),
            ("s", "f", "added", 9),
        ],
        changes.CHANGE,
    )
    found = changes.net_changes(new, known)
    assert sorted(map(str, rows(found.fillna("-")))) == sorted(
        map(str, [("s", "a", "deleted", 5), ("s", "d", "deleted", 7), ("s", "-", "added", 1)])
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Join" not in plan
    assert rows(changes.net_changes(new).where("set_id = 's'").select("dc_identifier").na.drop()) == [
        (c,) for c in "abcde"
    ]
