"""Fetch jobs: planned files to content and outcome rows.

The fetcher is given by the caller: a function from a URL to
``(status, content)``; raising an exception means there was no response. Results
go straight from the task to Parquet, because content must neither be shuffled
nor be fetched twice by a second evaluation. Rows are keyed by path, so a task
that is run again writes the same rows. Turn speculation off for fetch jobs.

A binding's files of one kind are requested one after the other, in their order. After
an unexpected status the rest of them are not requested; 404, 401 and timeouts go on.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindery.functions import files, ids
from bindery.partitioning import (
    shuffles_cleared,
    small_broadcast,
    spread,
    unsorted_partition_writes,
)
from bindery.scratch import stored

Fetcher = Callable[[str], tuple[int, bytes]]

MAX_BATCH_BYTES = 32 * 1024 * 1024
MAX_BATCH_ROWS = 10_000
#: Planned rows or responses that one task joins.
ROWS_PER_TASK = 500_000
#: Planned rows that a task may hold in memory to look up responses in.
MAX_HELD_ROWS = 1_000_000

_RESULT = [
    T.StructField("status", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("skipped", T.BooleanType()),
    T.StructField("attempted", T.BooleanType()),
]
#: Files that one task requests in order.
GROUP = ["subset_id", "binding_id", "kind"]


def manifest_plan(bindings: DataFrame) -> DataFrame:
    """Manifest of each binding as a planned file."""
    return bindings.withColumns(
        {
            "kind": F.lit(files.METS),
            "page_number": F.lit(None).cast("int"),
            "position": F.lit(-1),
            "filename": ids.mets_file_name("dc_identifier"),
            "download_url": ids.mets_url("dc_identifier"),
            "path": entry_path("binding_id", F.lit(files.METS), ids.mets_file_name("dc_identifier")),
        }
    )


def page_plan(page_files: DataFrame) -> DataFrame:
    """Page files with the path they get in the archive.

    Their binding's ``directory`` may come with them, made once for all of its files.
    """
    directory = "directory" if "directory" in page_files.columns else None
    return page_files.withColumn("path", entry_path("binding_id", "kind", "filename", directory))


def entry_path(binding_id, kind, filename, directory=None):
    if directory is None:
        directory = ids.binding_dir(binding_id)
    return F.concat_ws("/", ids.col(directory), ids.col(kind), ids.col(filename))


def not_present(plan: DataFrame, present: DataFrame) -> DataFrame:
    """Planned files whose path is not held yet; ``present`` has ``path, size``."""
    held = present.where(files.is_present("size")).select("path")
    return plan.join(held, "path", "left_anti")


def already_present(plan: DataFrame, present: DataFrame) -> DataFrame:
    held = present.where(files.is_present("size")).select("path")
    return plan.join(held, "path", "left_semi")


def with_manifest(page_files: DataFrame, fetched_manifests: DataFrame) -> DataFrame:
    """Page files of bindings whose manifest arrived and is not empty."""
    arrived = fetched_manifests.where(files.is_present("n_bytes")).select("binding_id")
    return page_files.join(arrived, "binding_id", "left_semi")


def group_of(plan: DataFrame) -> list[str]:
    """Columns that name a binding's files of one kind; none for plans without those."""
    if not {"binding_id", "kind"} <= set(plan.columns):
        return []
    return [c for c in GROUP if c in plan.columns]


def fetch(plan: DataFrame, fetcher: Fetcher, partitions: int | None = None) -> DataFrame:
    """Fetch ``download_url`` of every row; adds the columns of ``_RESULT``.

    Rows are range-partitioned by binding and kind, so that a task covers neighbouring
    bindings of one or few subsets, each group whole, and sorted by ``position``. A path
    that has arrived for its group is not requested again (``skipped``), and nothing
    after an unexpected status is (``attempted`` is false). Plans without a binding or a
    kind are dealt by path and have no such stop. The number of tasks is fixed (by
    default that of shuffle partitions): plan rows are small, and left to itself Spark
    would pack very many files into one task. Write the result before using it.
    """
    group = group_of(plan)
    keys = group or [c for c in ("subset_id", "path") if c in plan.columns]
    order = keys + [c for c in ("position", "path") if c in plan.columns and c not in keys]
    plan = spread(plan, partitions, *keys).sortWithinPartitions(*order)
    schema = T.StructType(plan.schema.fields + _RESULT)

    def fetch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, present, stopped = None, set(), False
        for batch in batches:
            start, held, results = 0, 0, []
            read = {c: batch.column(c).to_pylist() for c in {*keys, "path", "download_url"}}
            names = zip(*(read[c] for c in keys))
            for name, path, url in zip(names, read["path"], read["download_url"]):
                if name != current:
                    current, present, stopped = name, set(), False
                if stopped:
                    result = _STOPPED
                elif path in present:
                    result = _SKIPPED
                else:
                    result = _fetch_one(fetcher, url)
                    if result[2]:
                        present.add(path)
                    stopped = bool(group) and is_unexpected(result[0])
                results.append(result)
                held += result[2] or 0
                if held >= MAX_BATCH_BYTES or len(results) >= MAX_BATCH_ROWS:
                    yield _with_results(batch, start, results)
                    start, held, results = start + len(results), 0, []
            if results:
                yield _with_results(batch, start, results)

    return plan.mapInArrow(fetch_rows, schema)


_SKIPPED = (None, None, None, None, True)
#: Not requested at all, so neither skipped nor not.
_STOPPED = (None, None, None, None, None)


def is_unexpected(status: int | None) -> bool:
    """Whether a status ends a binding's files of a kind, as ``outcomes.outcome`` has it."""
    return status is not None and status >= 400 and status not in (404, 401)


def _fetch_one(fetcher: Fetcher, url: str | None) -> tuple:
    if url is None:
        return None, "no download URL", None, None, False
    try:
        status, content = fetcher(url)
    except Exception as e:  # any failure of one file is an outcome of that file
        return None, f"{type(e).__name__}: {e}", None, None, False
    if status >= 400:
        return status, None, None, None, False
    return status, None, len(content), content, False


def _result_arrays(results: list[tuple]) -> list[pa.Array]:
    """What was found, as the columns of ``_RESULT``."""
    status, error, n_bytes, content, skipped = zip(*results)
    return [
        pa.array(status, pa.int32()),
        pa.array(error, pa.string()),
        pa.array(n_bytes, pa.int64()),
        pa.array(content, pa.binary()),
        pa.array([bool(s) for s in skipped], pa.bool_()),
        pa.array([s is not None for s in skipped], pa.bool_()),
    ]


def _with_results(batch, start: int, results: list[tuple]):
    """Planned rows as they came, with what was found for them; of a frame, a frame."""
    if not isinstance(batch, pa.RecordBatch):
        return _with_results(pa.RecordBatch.from_pandas(batch), start, results).to_pandas()
    part = batch.slice(start, len(results))
    names = [*part.schema.names, *[f.name for f in _RESULT]]
    return pa.RecordBatch.from_arrays([*part.columns, *_result_arrays(results)], names)


def same_url(left: str, right: str) -> Column:
    """Equality of two addresses, by their hashes first.

    Rows are sorted by the first key, and addresses share their beginnings.
    """
    return (F.xxhash64(left) == F.xxhash64(right)) & (F.col(left) == F.col(right))


@dataclass(frozen=True)
class DealtResponses:
    """Landed responses that are stored by address, in as many buckets as ``tasks``."""

    rows: DataFrame
    tasks: int


def deal_responses(responses: DataFrame, folder: str, tasks: int | None = None) -> DealtResponses:
    """Store landed responses by address, once for all the steps that look them up.

    A step then moves its plan only. The files are a bucketed table's, whose name is
    taken back at once. Responses without an address answer nothing and are left out.
    """
    spark = responses.sparkSession
    tasks = tasks or join_tasks(responses)
    name = f"responses_{uuid.uuid4().hex}"
    dealt = responses.where(F.col("url").isNotNull()).repartition(tasks, "url")
    # A task has one bucket, which it need not sort its rows for.
    with shuffles_cleared(spark), unsorted_partition_writes(spark):
        (
            dealt.write.bucketBy(tasks, "url")
            .option("path", folder)
            .option("compression", "zstd")
            .saveAsTable(name)
        )
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return DealtResponses(rows, tasks)


def from_responses(plan: DataFrame, responses: DataFrame | DealtResponses) -> DataFrame:
    """Results as those of ``fetch``, from landed responses.

    ``responses`` has ``url, status, content``, one row per URL, and is matched by
    equality. A URL without a row had no response. A path that is planned again
    counts as skipped when it did arrive.

    The plan and the responses meet once, and what decides about a file comes to it
    from short tables: paths that are planned more than once, and stops of a binding's
    files of a kind. Give a stored plan, which is read several times.
    """
    n_planned = plan.count()
    if n_planned == 0:
        return plan.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in _RESULT])
    dealt = isinstance(responses, DealtResponses)
    tasks = responses.tasks if dealt else join_tasks(plan, responses)
    responses = responses.rows if dealt else responses
    group = group_of(plan)
    planned = _numbered(plan, tasks)
    stops = _stops(plan, responses, group, tasks) if group else None
    stop = F.lit(None).cast("int")
    with_url = planned.where(F.col("download_url").isNotNull())
    if stops is None:
        without = planned.where(F.col("download_url").isNull()).withColumn("_stop", stop)
        with_url = with_url.withColumn("_stop", stop).repartition(tasks, "download_url")
    elif (few := small_broadcast(stops)) is not None:
        planned = _with_stops(planned, few, group)
        without = planned.where(F.col("download_url").isNull())
        with_url = planned.where(F.col("download_url").isNotNull()).repartition(tasks, "download_url")
    else:
        without = _with_stops(planned.where(F.col("download_url").isNull()), stops, group)
        # By address alone, like the responses, so that planned rows move once.
        late = _late(plan, stops, group).repartition(tasks, "_late_url").hint("shuffle_hash")
        with_url = with_url.repartition(tasks, "download_url")
        with_url = with_url.join(late, F.col("download_url") == F.col("_late_url"), "left")
        own = F.filter(
            "_late", lambda s: reduce(and_, [s[c].eqNullSafe(F.col(c)) for c in group])
        )
        with_url = with_url.withColumn("_stop", F.get(own, F.lit(0))["_stop"]).drop(
            "_late_url", "_late"
        )
    # Planned rows are held in memory, so that content is neither sorted nor spilled.
    held = with_url.hint("shuffle_hash") if n_planned <= MAX_HELD_ROWS * tasks else with_url
    landed = responses.where(F.col("url").isNotNull()).select(
        F.col("url").alias("_url"),
        F.col("status").cast("int").alias("_status"),
        F.col("content").alias("_content"),
    )
    if not dealt:
        landed = landed.repartition(tasks, "_url")
    met = held.join(landed, F.col("download_url") == F.col("_url"), "left")
    got = met.unionByName(without, allowMissingColumns=True)
    status = F.col("_status")
    attempted = F.col("_stop").isNull() | (F.col("position") <= F.col("_stop"))
    arrived = F.coalesce(status < 400, F.lit(False))
    skipped = attempted & arrived & (F.col("_number") > 1)
    asked = attempted & ~skipped
    return got.select(
        *plan.columns,
        F.when(asked, status).alias("status"),
        F.when(asked & F.col("_url").isNull(), F.lit("no response")).alias("error"),
        F.when(asked & arrived, F.octet_length("_content").cast("bigint")).alias("n_bytes"),
        F.when(asked & arrived, F.col("_content")).alias("content"),
        skipped.alias("skipped"),
        attempted.alias("attempted"),
    )


def join_tasks(*tables: DataFrame) -> int:
    """Number of tasks for a join of these tables, so that what one holds does not grow."""
    most = max(t.count() for t in tables)
    shuffled = int(tables[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffled, -(-most // ROWS_PER_TASK))


def _kept(rows: DataFrame, name: str) -> DataFrame:
    """A short table, stored, without the shuffle files that led to it."""
    with shuffles_cleared(rows.sparkSession):
        return stored(rows, name)


def _numbered(plan: DataFrame, tasks: int) -> DataFrame:
    """The plan with ``_number``, the place of a file among those of its path.

    Few paths are planned more than once, so these are sought by 64-bit hashes, and only
    the rows of hashes that repeat are moved to be numbered.
    """
    keys = [c for c in ("subset_id", "path") if c in plan.columns]
    copies = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy("position")
    number = F.row_number().over(copies)
    place = F.xxhash64(*keys)
    counts = plan.select(place.alias("_place")).repartition(tasks, "_place").groupBy("_place")
    repeated = _kept(
        counts.agg(F.count("*").alias("_n")).where("_n > 1").select("_place"), "repeated"
    )
    if repeated.isEmpty():
        return plan.withColumn("_number", F.lit(1))
    few = small_broadcast(repeated)
    if few is None:
        return plan.withColumn("_number", number)
    same = place == F.col("_place")
    once = plan.join(few, same, "left_anti").withColumn("_number", F.lit(1))
    return once.unionByName(plan.join(few, same, "left_semi").withColumn("_number", number))


def _stops(plan: DataFrame, responses: DataFrame, group: list[str], tasks: int) -> DataFrame | None:
    """Position at which requests for a binding's files of a kind end; None if none do."""
    status = F.col("status").cast("int")
    ended = responses.where(
        (status >= 400) & ~status.isin(404, 401) & F.col("url").isNotNull()
    ).select(F.col("url").alias("_url"))
    ended = _kept(ended, "ended")
    if ended.isEmpty():
        return None
    asked = plan.where(F.col("download_url").isNotNull()).select("download_url", *group, "position")
    few = small_broadcast(ended)
    if few is None:
        asked, few = asked.repartition(tasks, "download_url"), ended.repartition(tasks, "_url")
    stops = (
        asked.join(few, F.col("download_url") == F.col("_url"))
        .groupBy(*group)
        .agg(F.min("position").alias("_stop"))
        .where(F.col("_stop").isNotNull())
    )
    stops = _kept(stops, "stops")
    return None if stops.isEmpty() else stops


def _with_stops(rows: DataFrame, stops: DataFrame, group: list[str]) -> DataFrame:
    """Rows with the ``_stop`` of their group, null where it has none."""
    names = [f"_of_{c}" for c in group]
    of = stops.select(*[F.col(c).alias(n) for c, n in zip(group, names)], "_stop")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(group, names)])
    return rows.join(of, same, "left").drop(*names)


def _late(plan: DataFrame, stops: DataFrame, group: list[str]) -> DataFrame:
    """Addresses of files that are not known to come before their group's stop.

    These are few beside the plan, so they are moved to it instead of moving it. An
    address has the groups that ask for it, with their stops.
    """
    asked = plan.where(F.col("download_url").isNotNull()).select("download_url", *group, "position")
    before = F.coalesce(F.col("position") <= F.col("_stop"), F.lit(False))
    late = _with_stops(asked, stops, group).where(F.col("_stop").isNotNull() & ~before)
    groups = F.collect_set(F.struct(*group, "_stop"))
    return _kept(
        late.groupBy(F.col("download_url").alias("_late_url")).agg(groups.alias("_late")), "late"
    )


# Images are compressed already.
CODECS = {files.ACCESS_IMAGE: "uncompressed"}


def write_fetched(fetched: DataFrame, path: str, kind: str | None = None) -> DataFrame:
    """Write fetch results, and return them as read back.

    Files of one ``kind`` get the compression that suits it. There are no partition
    folders: writing those would sort the content of each task. What ``fetch`` found is
    in path order, which lets row groups be skipped instead.
    """
    codec = CODECS.get(kind, "zstd")
    with shuffles_cleared(fetched.sparkSession):
        fetched.write.mode("errorifexists").option("compression", codec).parquet(path)
    return fetched.sparkSession.read.schema(fetched.schema).parquet(path)


def folder_fetcher(root: str) -> Fetcher:
    """Fetcher that reads URLs from a mirror folder: the URL without its scheme."""

    def read(url: str) -> tuple[int, bytes]:
        path = os.path.join(root, url.split("://", 1)[-1].replace("?", "_"))
        try:
            with open(path, "rb") as f:
                return 200, f.read()
        except FileNotFoundError:
            return 404, b""

    return read


def direct_downloads(page_files: DataFrame, base_path: str | None = None) -> DataFrame:
    """Where the files of a manifest go in a direct download.

    Only ALTO files have a default directory. The others are reported as having
    no download URL, with no ``output_path``.
    """
    located = page_files.withColumn(
        "output_path",
        files.file_download_location("dc_identifier", "kind", "filename", base_path),
    )
    # Fixed value: the text of the report.
    message = F.concat(
        F.lit("No download URL available for file "), F.col("location_xlink")
    )
    return located.withColumn(
        "message", F.when(F.col("output_path").isNull(), message)
    )


def direct_contents(located: DataFrame, responses: DataFrame) -> DataFrame:
    """Direct downloads with the ``status`` and ``content`` of their landed response.

    ``responses`` are those of ``from_responses``. Files without an output path are
    not downloaded.
    """
    landed = responses.select(F.col("url").alias("_url"), "status", "content")
    wanted = F.col("output_path").isNotNull() & same_url("download_url", "_url")
    return located.join(landed, wanted, "left").drop("_url")
