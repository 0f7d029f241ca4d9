"""Requests end at an unexpected status, in the fetch itself."""

import collections
import uuid

from conftest import rows
from pyspark.sql import functions as F

from bindery.operators import fetching, outcomes

PLAN = "subset_id string, binding_id string, kind string, position int, path string, download_url string"


def plan_of(spark):
    """Thirty bindings with twenty files of two kinds each; positions are not path order."""
    found = []
    for b in range(30):
        for kind in ("alto", "access_img"):
            for i in range(20):
                path = f"{b}/{kind}/{(i * 7) % 20:02d}" if i else f"{b}/{kind}/{7:02d}"
                found.append((str(b % 3), str(b), kind, i, path, f"u/{path}/{i}"))
    return spark.createDataFrame(found, PLAN).repartition(6)


def provider():
    """Functions of a URL, without a module that tasks would have to import."""

    def status_of(url):
        """404, 401, no answer and an unexpected status, by binding, kind and place."""
        _, b, kind, name, i = url.split("/")
        n = int(b) * 31 + int(i) * 17 + len(kind)
        if int(i) == int(b) % 25 and kind == "alto":
            return 503
        return {0: 404, 1: 401, 2: None, 3: 0}.get(n % 9, 200)

    def answer(url):
        status = status_of(url)
        if status is None:
            raise TimeoutError("no answer")
        return (status, b"x") if status != 0 else (200, b"")

    return status_of, answer


def test_nothing_is_requested_after_an_unexpected_status(spark, tmp_path):
    folder = str(tmp_path)
    status_of, answer = provider()

    def counted(url):
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
            out.write(url)
        return answer(url)

    plan = plan_of(spark)
    got = fetching.fetch(plan, counted, 5)
    found = rows(outcomes.with_outcomes(got).select("binding_id", "kind", "position", "outcome"))
    requested = collections.Counter(p.read_text() for p in tmp_path.iterdir())
    assert set(requested.values()) == {1}

    # All files requested, and the rule applied to the log afterwards.
    wanted, asked = [], set()
    for r in sorted(plan.collect(), key=lambda r: (r.binding_id, r.kind, r.position)):
        if r.position == 0:
            stopped, present = False, set()
        status = status_of(r.download_url)
        if stopped:
            name = "not_attempted"
        elif r.path in present:
            name = "skipped"
        else:
            asked.add(r.download_url)
            name = {404: "not_found", 401: "unauthorized", None: "no_response", 503: "error"}.get(status, "ok")
            stopped = status == 503
            if status == 200:
                present.add(r.path)
        wanted.append((r.binding_id, r.kind, r.position, name))
    assert found == sorted(wanted) and set(requested) == asked
    assert {name for *_, name in found} >= {"not_attempted", "skipped", "error", "ok"}
    # The rule on the log has nothing to add.
    again = outcomes.stop_at_errors(outcomes.with_outcomes(got))
    assert rows(again.select("binding_id", "kind", "position", "outcome")) == found


def test_landed_responses_stop_alike(spark):
    plan = plan_of(spark).where("position > 0")  # each path once
    status_of, _ = provider()
    answers = []
    for r in plan.select("download_url").collect():
        status = status_of(r.download_url)
        if status is not None:
            answers.append((r.download_url, status or 200, b"" if status != 200 else b"x"))
    responses = spark.createDataFrame(answers, "url string, status int, content binary")

    def landed(url):
        status = status_of(url)
        if status is None:
            raise TimeoutError
        return (status or 200), b"x" if status == 200 else b""

    columns = ["path", "position", "status", "n_bytes", "content", "skipped", "attempted"]
    found = fetching.from_responses(plan, responses).select(columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, fetching.fetch(plan, landed, 3).select(columns).collect()))
    assert found.where("NOT attempted").count() > 0
    assert found.where("NOT attempted AND content IS NOT NULL").count() == 0


def test_groups_are_whole_in_one_task(spark):
    got = fetching.fetch(plan_of(spark), provider()[1], 7).select(
        "binding_id", "kind", F.spark_partition_id().alias("task")
    )
    tasks = got.groupBy("binding_id", "kind").agg(F.count_distinct("task").alias("n"))
    assert {r.n for r in tasks.collect()} == {1}
    assert got.select("task").distinct().count() > 3
