"""The listing job: one pass over the landed pages gives the lists of all sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.functions import ids
from bindery.plans import runs as run_history
from bindery.sources import listings, lists, page_index


def listed_changes(
    headers: DataFrame,
    deleted_headers: DataFrame,
    base_url: str,
    last_runs: DataFrame | None = None,
) -> DataFrame:
    """Added and deleted DC identifiers of every set since its last run.

    Without ``last_runs`` everything is listed, as for an initial load. Added
    headers belong to the set they were requested for, deleted ones to each set
    they name.
    """
    dc = ids.dc_identifier("identifier", base_url).alias("dc_identifier")
    added = headers.select("set_id", "datestamp", dc, F.lit("added").alias("kind"))
    deleted = deleted_headers.select(
        F.explode(F.array_distinct("setSpec")).alias("set_id"),
        "datestamp",
        dc,
        F.lit("deleted").alias("kind"),
    )
    changes = added.unionByName(deleted)
    if last_runs is not None:
        changes = run_history.since_last_run(changes, last_runs)
    return changes.select("set_id", "kind", "dc_identifier")


def run_listing(
    spark: SparkSession,
    landing: str,
    deleted_landing: str,
    sets: DataFrame,
    base_url: str,
    list_date: str,
    root: str,
    runs: DataFrame | None = None,
    index: str | None = None,
) -> None:
    """Read the landed pages and write the day's lists of the configured sets.

    ``runs`` is the run history of an incremental listing; None lists all. With a folder
    for the ``index`` of pages, only those are read that reach the last runs.
    """
    last_runs = None if runs is None else run_history.last_successful_runs(runs)
    if index is None:
        added, deleted = (listings.read_headers(spark, p) for p in (landing, deleted_landing))
    else:
        added, deleted = (
            page_index.headers_since(spark, path, f"{index}/{name}", sets, of, last_runs)
            for path, name, of in (
                (landing, "added", page_index.requested_set()),
                (deleted_landing, "deleted", page_index.named_sets()),
            )
        )
    changes = listed_changes(added, deleted, base_url, last_runs)
    wanted = changes.join(sets.select("set_id").distinct(), "set_id", "left_semi")
    lists.write_binding_lists(wanted, sets, list_date, root)
