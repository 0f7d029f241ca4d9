"""Run history and the decision whether an update begins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions.ids import col
from bindery.partitioning import broadcast_if_small


def last_successful_runs(runs: DataFrame) -> DataFrame:
    """Newest successful run of each set and its day."""
    return (
        runs.where(F.col("state") == "success")
        .groupBy("set_id")
        .agg(
            F.max_by("run_id", "execution_date").alias("run_id"),
            F.to_date(F.max("execution_date")).alias("last_run"),
        )
    )


def newest_running(runs: DataFrame) -> DataFrame:
    return (
        runs.where(F.col("state") == "running")
        .groupBy("set_id")
        .agg(
            F.max_by("run_id", "execution_date").alias("run_id"),
            F.max("execution_date").alias("execution_date"),
        )
    )


def newest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("execution_date"))


def since_last_run(
    rows: DataFrame, last_runs: DataFrame, datestamp: str = "datestamp"
) -> DataFrame:
    """Rows at or after the day of their set's last run; all rows of new sets."""
    start = F.col("last_run").cast("timestamp")
    # One row per set, while one set may hold nearly all rows.
    days = broadcast_if_small(last_runs.select("set_id", "last_run"))
    return (
        rows.join(days, "set_id", "left")
        .where(F.col("last_run").isNull() | (F.col(datestamp) >= start))
        .drop("last_run")
    )


def gate(
    n_added: Column | str,
    n_deleted: Column | str,
    source_ok: Column | str,
    try_number: Column | str,
    max_tries: Column | str,
) -> Column:
    """``cancel`` when nothing changed or the source stays down, ``retry``, ``begin``."""
    nothing = (col(n_added) == 0) & (col(n_deleted) == 0)
    return (
        F.when(nothing, F.lit("cancel"))
        .when(col(source_ok), F.lit("begin"))
        .when(col(try_number) < col(max_tries), F.lit("retry"))
        .otherwise(F.lit("cancel"))
    )


def update_gates(sets: DataFrame, latest: DataFrame) -> DataFrame:
    """Decision for every set from the numbers of rows of its newest lists.

    ``sets`` has ``set_id, source_ok, try_number, max_tries``.
    """
    counts = latest.groupBy("set_id").agg(
        F.count_if(F.col("kind") == "added").alias("n_added"),
        F.count_if(F.col("kind") == "deleted").alias("n_deleted"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        sets.join(counts, "set_id", "left")
        .withColumn("n_added", F.coalesce("n_added", zero))
        .withColumn("n_deleted", F.coalesce("n_deleted", zero))
        .withColumn(
            "decision", gate("n_added", "n_deleted", "source_ok", "try_number", "max_tries")
        )
    )
