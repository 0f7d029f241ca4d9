"""How rows are spread over tasks and small tables are broadcast."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
FILES_PER_TASK = 2_000
#: Partitions of one shuffle that a driver can still track.
MAX_FETCH_TASKS = 20_000
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
CLEARED_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def spread(rows: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """Range partitioning with a number of tasks that AQE leaves alone."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, *keys)


def fetch_tasks(plan: DataFrame) -> int:
    """Number of tasks for a fetch, from the number of planned files.

    Beyond ``MAX_FETCH_TASKS`` a task fetches more files; it holds one batch at a time.
    """
    return max(1, min(MAX_FETCH_TASKS, -(-plan.count() // FILES_PER_TASK)))


def broadcast_if_small(keys: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a key table whose measured size is below the limit."""
    found = small_broadcast(keys, limit)
    return keys if found is None else found


def small_broadcast(keys: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame | None:
    """A key table to broadcast; None if its measured size is above the limit.

    Runs one aggregation over the keys, so give it stored ones.
    """
    row = reduce(
        lambda a, b: a + b,
        [
            F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16
            for c in keys.columns
        ],
    )
    size = keys.agg(F.sum(row.cast("bigint"))).first()[0] or 0
    return F.broadcast(keys) if size <= limit else None


@contextmanager
def _setting(spark: SparkSession, name: str, value):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def unsorted_partition_writes(spark: SparkSession, writers: int = 16):
    """Let a task keep several partition folders open.

    Otherwise Spark sorts the rows of each task by folder before writing, which
    for rows with content means spilling it all. Beyond the number of open
    writers the rest of a task is sorted as usual.
    """
    return _setting(spark, OPEN_WRITERS, writers)


def shuffles_cleared(spark: SparkSession):
    """Let Spark delete a query's shuffle files when the query ends.

    For tables that are written between steps: nothing reads those files again, and
    left alone they stay until the driver's garbage is collected, so that the disk
    holds all steps of a job at once.
    """
    return _setting(spark, CLEARED_SHUFFLES, "true")
