"""Jobs move and keep little beside what they have to."""

import time

import pytest
from conftest import BASE, image_group, manifest, rows
from pyspark.sql import functions as F
from test_growth import physical

from bindery.functions import mets
from bindery.operators import fetching, manifests
from bindery.partitioning import CLEARED_SHUFFLES
from bindery.plans import download
from bindery.plans.stages import stored

PLAN = (
    "subset_id string, binding_id string, kind string, position int, path string, download_url string"
)
PLANNED = [
    ("s", "1", "alto", 0, "1/a", "u1"),
    ("s", "1", "alto", 1, "1/b", "u503"),
    ("s", "1", "alto", 2, "1/c", "u2"),
    ("s", "1", "alto", 3, "1/d", "u503"),
    ("s", "1", "alto", None, "1/e", "u2"),
    ("s", "1", "alto", 4, "1/f", None),
    ("s", "1", "img", 5, "1/g", "u2"),
    ("s", "1", "img", 6, "1/h", None),
    ("s", "1", "img", 7, "1/i", "u404"),
    ("t", "1", "alto", 8, "1/a", "u1"),
    # A path thrice in two groups, and twice after a stop; nulls in keys are alike.
    ("s", "2", "alto", 0, "2/a", "u404"),
    ("s", "2", "alto", 1, "2/a", "u1"),
    ("s", "2", "img", 2, "2/a", "u2"),
    ("s", None, "img", 0, None, "u500"),
    ("s", None, "img", 1, None, "u1"),
    ("s", None, "img", -1, None, "u9"),
    (None, "3", "img", 0, "3/a", "u1"),
    (None, "3", "img", 1, "3/a", "u2"),
    # All positions of the failing ones are null, so nothing stops.
    ("s", "4", "img", None, "4/a", "u503"),
    ("s", "4", "img", 1, "4/b", "u1"),
]
LANDED = {"u1": (200, b"x"), "u2": (301, b""), "u404": (404, b""), "u503": (503, b"?"), "u500": (500, None), "u7": (200, b"z")}


def expected():
    """Rows of ``PLANNED`` with what ``from_responses`` has to find, one by one."""

    def ends(url):
        return url in ("u503", "u500")

    found = []
    for row in PLANNED:
        subset, binding, kind, position, path, url = row
        stops = [r[3] for r in PLANNED if r[:3] == row[:3] and ends(r[5]) and r[3] is not None]
        stop = min(stops, default=None)
        attempted = True if stop is None else None if position is None else position <= stop
        copies = sorted(
            (r for r in PLANNED if (r[0], r[4]) == (subset, path)),
            key=lambda r: -99 if r[3] is None else r[3],
        )
        status, content = LANDED.get(url, (None, None))
        arrived = status is not None and status < 400
        again = copies.index(row) > 0
        skipped = bool(arrived and again) if attempted else attempted
        if attempted is None and not (arrived and again):
            skipped = False
        asked = bool(attempted and not skipped)
        new = asked and arrived
        found.append((
            *row,
            status if asked else None,
            "no response" if asked and url not in LANDED else None,
            len(content) if new else None,
            content if new else None,
            skipped,
            attempted,
        ))
    return sorted(map(str, found))


@pytest.mark.parametrize("broadcast", [True, False])
def test_stops_and_copies_of_landed_responses(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(fetching, "small_broadcast", lambda keys: None)
    plan = spark.createDataFrame(PLANNED, PLAN)
    answers = [(u, *a) for u, a in LANDED.items()] + [(None, 200, b"n")]
    responses = spark.createDataFrame(answers, "url string, status int, content binary")
    got = fetching.from_responses(plan, responses).collect()
    assert sorted(str(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r)) for r in got) == expected()


def test_plan_and_responses_move_once(spark, tmp_path, monkeypatch):
    plan = stored(spark.createDataFrame(PLANNED, PLAN), str(tmp_path / "plan"))
    answers = [(u, *a) for u, a in LANDED.items() if u not in ("u503", "u500")]
    responses = stored(
        spark.createDataFrame(answers, "url string, status int, content binary"), str(tmp_path / "landed")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alone = plan.where("binding_id <> '2' AND binding_id <> '3'")  # each path once
        found = physical(fetching.from_responses(alone, responses))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found.count("Exchange") == 2 and "Sort" not in found


def test_shuffle_files_of_a_stored_step_are_deleted(spark, tmp_path):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f.getName() for f in _listed(manager) if f.getName().startswith("shuffle_")}

    def _listed(m):
        files = m.getAllFiles()
        return [files.apply(i) for i in range(files.size())]

    before = shuffled()
    numbers = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("n")).count()
    found = stored(numbers, str(tmp_path / "n"))
    fetching.write_fetched(numbers, str(tmp_path / "f"))
    for _ in range(100):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert rows(found) == rows(numbers)
    assert spark.conf.get(CLEARED_SHUFFLES, "false") == "false"


def test_dealt_responses_do_not_move(spark, tmp_path):
    plan = stored(spark.createDataFrame(PLANNED, PLAN), str(tmp_path / "plan"))
    answers = [(u, *a) for u, a in LANDED.items()] + [(None, 200, b"n")]
    responses = spark.createDataFrame(answers, "url string, status int, content binary")
    dealt = fetching.deal_responses(responses, str(tmp_path / "landed"), 3)
    assert dealt.rows.count() == len(LANDED)  # those without an address answer nothing
    got = fetching.from_responses(plan, dealt).collect()
    assert sorted(str(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r)) for r in got) == expected()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alone = plan.where("path = '1/i'")
        assert physical(fetching.from_responses(alone, dealt)).count("Exchange") == 1
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("responses_")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    none = fetching.from_responses(plan.where("kind = 'none'"), dealt)
    assert none.count() == 0 and none.schema.names == fetching.from_responses(plan, dealt).schema.names


def landed_manifest(pages):
    group = image_group(pages)
    return manifest([group]).encode()


def test_stowing_dealt_responses_is_stowing_a_fetch(spark, tmp_path):
    """Of two attempts and more, the second ones ask for what is not held only."""
    answers = {}
    for id_, n in (("11", 2), ("21", 3), ("22", 1)):
        answers[f"{BASE}{id_}/mets.xml?full=true"] = (200, landed_manifest(n))
        for i in range(1, n + 1):
            answers[f"{BASE}{id_}/image/{i}"] = (200, b"i") if i % 2 else (404, None)
            answers[f"{BASE}{id_}/page-{i}.xml"] = (200, b"" if i == 3 else b"t")
    answers[f"{BASE}23/mets.xml?full=true"] = (200, b"")
    answers[f"{BASE}24/mets.xml?full=true"] = (200, b"<mets>")

    def fetch(url):
        status, content = answers[url]
        return status, content or b""

    given = [("s", i // 2, b, BASE + b) for i, b in enumerate(["11", "21", "22", "23", "24", "25"])]
    bindings = spark.createDataFrame(
        given, "subset_id string, batch_index int, binding_id string, dc_identifier string"
    )
    responses = spark.createDataFrame(
        [(u, *a) for u, a in answers.items()], "url string, status int, content binary"
    )
    dealt = fetching.deal_responses(responses, str(tmp_path / "landed"), 3)
    found = []
    for name, source in (("fetch", fetch), ("dealt", dealt)):
        staged = download.stow_with_retries(bindings, source, str(tmp_path / name))
        log = staged.log.drop("error", "n_bytes")  # a fetch has its own words for errors
        found.append([
            sorted(str(tuple(r)) for r in part.collect())
            for part in (log, staged.verdicts, staged.content)
        ])
        written = spark.read.parquet(str(tmp_path / name / "attempt_1" / "pages" / "alto"))
        assert not {"path", "download_url", "location_xlink"} & set(written.columns)
        assert not (tmp_path / name / "attempt_1" / "page_log").exists()
    assert found[0] == found[1]
    asked = staged.log.where("path IS NOT NULL").groupBy("path").count()
    assert {r["count"] for r in asked.collect()} == {1, 3}


def test_held_files_are_left_out_without_moving_files(spark):
    elements = [("ACIMGGRP", "reference", i != 2, i, 1, f"x/{i}.jp2") for i in (1, 2, 3)]
    parsed = spark.createDataFrame(
        [("s", 0, b, BASE + b, elements, None) for b in ("12", "13")],
        "subset_id string, batch_index int, binding_id string, dc_identifier string, "
        f"elements {mets.ELEMENTS}, manifest_error string",
    )
    held = spark.createDataFrame(
        [("1/12/12/access_img/00001.jp2", 5), ("1/12/12/alto/00003.xml", 0), ("1/12/12/alto/00001.xml", None),
         ("1/13/13/mets/13_METS.xml", 9), ("1/12/12/alto/00001.xml", 1), (None, 1), ("a", 2)],
        "path string, size long",
    )
    plan = fetching.page_plan(manifests.manifest_files(parsed))
    wanted = rows(fetching.not_present(plan, held).select("path", "position"))
    listed = download._with_held(parsed, held)
    left = download._not_held(fetching.page_plan(manifests.manifest_files(listed)))
    assert left.columns == plan.columns
    assert rows(left.select("path", "position")) == wanted and len(wanted) == 6
    shown = physical(left)
    assert shown.index("Generate") < shown.index("Exchange")  # files are made above all moves
