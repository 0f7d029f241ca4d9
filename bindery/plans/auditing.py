"""The integrity audit as a job, on entry rows or on the published table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.functions import files, names
from bindery.operators import auditing
from bindery.partitioning import small_broadcast
from bindery.plans.stages import stored
from bindery.sources import archives
from bindery.sources.manifests import decoded


def audit(
    entries: DataFrame,
    docs: DataFrame,
    expected_ids: DataFrame,
    base_url: str,
    staging: str,
    archives: DataFrame | None = None,
    guess_prefix: bool = True,
) -> DataFrame:
    """Integrity errors of archives given as entry rows and manifest documents.

    With a ``set_id`` in ``archives`` and ``expected_ids``, sets are told apart.

    ``entries`` should be a stored table, as they are read several times. What
    goes into several joins is written to ``staging``: the names of the archives
    and the faulty bindings, so that the planner knows that they are few, and the
    files that the manifests ask for, so that each manifest is parsed once. Paths are
    compared for the bindings whose sums of path hashes differ, if these are few enough to
    broadcast: paths of others stay where they are read. If they are more, all paths are
    compared by their hashes, with the same result: to pick some, both sides would be moved
    by their bindings first, with paths that are longer than the hashes.
    """
    named = entries if archives is None else archives
    named = named.select([c for c in ("archive", "set_id") if c in named.columns]).distinct()
    named = stored(named, f"{staging}/archives")
    wanted = stored(auditing.expected_files(docs, base_url), f"{staging}/expected")
    faults = stored(
        auditing.binding_faults(entries, expected_ids, named, guess_prefix, wanted),
        f"{staging}/faults",
    )
    differing = small_broadcast(faults.where("differs").select("archive", "binding_id"))
    return auditing.integrity_errors(entries, wanted, faults, differing)


def audit_archive(
    archive: DataFrame, expected_ids: DataFrame, base_url: str, staging: str
) -> DataFrame:
    """Integrity errors of an archive table, each subset as one archive.

    ``expected_ids`` may have a ``set_id``, as an archive of several sets needs it.
    """
    name = names.target_name("set_id", "subset_id").alias("archive")
    docs = archive.where(F.col("kind") == files.METS).select(
        name,
        "path",
        decoded("content", "utf-8").alias("xml"),
    )
    entries = archives.as_entries(archive)
    named = archive.select(name, "set_id")
    return audit(entries, docs, expected_ids, base_url, staging, named)
