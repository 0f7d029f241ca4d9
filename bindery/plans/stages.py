"""Tables between the stages of a job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bindery.partitioning import shuffles_cleared


def stored(
    rows: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None
) -> DataFrame:
    """Write a stage's result as Parquet and go on with what was written.

    The stages behind it do not recompute it, and a lost executor costs no more
    than its current tasks. Of what led to it, no shuffle files are kept.
    """
    writer = rows.write.mode(mode)
    if compression is not None:
        writer = writer.option("compression", compression)
    with shuffles_cleared(rows.sparkSession):
        writer.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
