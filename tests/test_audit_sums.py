"""Page files compared by sums of hashes before any path is."""

import random
import re

from conftest import rows
from pyspark.sql import functions as F

from bindery.operators import auditing

NAMES = [f"0000{i}.{s}" for i in range(1, 7) for s in ("xml", "jp2")]
ENTRY = "archive string, path string, is_dir boolean"
EXPECTED = "archive string, binding_id string, base_path string, filename string"


def path(id_, name, prefixed=False):
    if name.endswith(".xml"):
        return f"x/{id_}/alto/{'al-' if prefixed else ''}{name}"
    return f"x/{id_}/access_img/{'pr-' if prefixed else ''}{name}"


def tables(spark, seed):
    """Bindings with random names expected and held, some of them twice or under both names."""
    r = random.Random(seed)
    held, expected, apart, missing = [], [], set(), set()
    for i in range(60):
        id_ = str(i)
        wanted = [n for n in NAMES if r.random() < 0.7]
        there = [n for n in wanted if r.random() < 0.9] if i % 3 else list(wanted)
        if i % 5 == 0:
            wanted += wanted[:1]  # a page listed twice
        if i % 7 == 0:
            there.append("00099.jp2")  # a page that no manifest has
        held += [("a", path(id_, n, r.random() < 0.5), False) for n in there]
        held += [("a", f"x/{id_}/mets/{id_}_METS.xml", False), ("a", f"x/{id_}/", True)]
        expected += [("a", id_, f"x/{id_}", n) for n in wanted]
        if wanted and sorted(wanted) != sorted(there):
            apart.add(("a", id_))
        missing |= {("a", id_, n) for n in wanted if n not in there}
    return (
        spark.createDataFrame(held, ENTRY).repartition(5),
        spark.createDataFrame(expected, EXPECTED).repartition(3),
        sorted(apart),
        sorted(missing),
    )


def states(spark, entries, expected):
    pairs = spark.createDataFrame([], "archive string, binding_id string")
    return auditing.binding_states(auditing.classified_entries(entries), pairs, expected)


def test_sums_tell_bindings_apart(spark):
    for seed in range(3):
        entries, expected, apart, missing = tables(spark, seed)
        differing = states(spark, entries, expected).where("differs").select("archive", "binding_id")
        assert rows(differing) == apart
        found = auditing.missing_files(expected, entries, differing)
        assert sorted({(r.archive, r.binding_id, r.detail) for r in found.collect()}) == missing
        plain = auditing.missing_files(expected, entries)
        assert rows(plain) == rows(found)


def test_files_that_replace_each_other_do_not_cancel_out(spark):
    held = [("a", path("1", n), False) for n in ("00001.xml", "00001.xml", "00002.xml")]
    wanted = [("a", "1", "x/1", n) for n in ("00001.xml", "00002.xml", "00002.xml")]
    entries, expected = spark.createDataFrame(held, ENTRY), spark.createDataFrame(wanted, EXPECTED)
    found = states(spark, entries, expected)
    assert rows(found.select("seen", "other", "differs")) == [(False, True, True)]
    # The same file of another archive or binding is another file.
    other = expected.withColumn("archive", F.lit("b"))
    assert {r.differs for r in states(spark, entries, other).collect()} == {True, False}
    empty = states(spark, entries.limit(0), expected.limit(0))
    assert empty.count() == 0


def test_paths_of_agreeing_bindings_are_not_moved(spark):
    entries, expected, *_ = tables(spark, 1)
    differing = F.broadcast(spark.createDataFrame([("a", "4")], "archive string, binding_id string"))
    found = auditing.missing_files(expected, entries, differing)
    plan = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    nodes = re.split(r"\n\n+", plan)
    moved = [n for n in nodes if re.match(r"\(\d+\) Exchange", n) and "REPARTITION" not in n]
    assert moved and not any(re.search(r"\bpath#", n) for n in moved)
    # Each side is cut down to the differing bindings before it is hashed and moved.
    assert plan.count("BroadcastHashJoin LeftSemi") >= 2 or plan.count("LeftSemi") >= 2
