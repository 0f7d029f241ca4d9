"""Changes to an archive: upsert, deletion, empty directories.

Keys are joined; content rides along. ``broadcast_if_small`` keeps content rows
where they are while the key side is small, which it measures. Beyond the limit
the join is an ordinary shuffle join, which AQE splits on skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions import ids
from bindery.partitioning import broadcast_if_small


def upsert(
    old: DataFrame, new: DataFrame, key: str = "path", measure: bool = False
) -> DataFrame:
    """Old rows not named by the new ones, and all new ones.

    With ``measure`` the keys' size is measured for a broadcast, which is for old
    rows with content.
    """
    keys = new.select(key)
    if measure:
        keys = broadcast_if_small(keys)
    return old.join(keys, key, "left_anti").unionByName(new)


def delete_bindings(
    archive: DataFrame, deleted: DataFrame, measure: bool = False
) -> DataFrame:
    """Archive without the deleted bindings; IDs that are not there are no error."""
    gone = deleted.select("binding_id").distinct()
    if measure:
        gone = broadcast_if_small(gone)
    return archive.join(gone, "binding_id", "left_anti")


def apply_changes(
    archive: DataFrame, added: DataFrame, deleted: DataFrame, measure: bool = False
) -> DataFrame:
    """Adds are merged before deletions, so a binding in both ends up deleted."""
    merged = upsert(archive, added, measure=measure)
    return delete_bindings(merged, deleted, measure=measure)


def delete_entries(entries: DataFrame, deleted: DataFrame) -> DataFrame:
    """Entries without the directories of the deleted bindings.

    Works on listings with directory entries: everything inside the binding
    directory goes, directories included; directories above it stay.
    """
    inside = F.regexp_extract("path", r"^((?:.*?/)?([^/]+)/\2/)", 1)
    gone = deleted.select(
        F.concat(ids.binding_dir("binding_id"), F.lit("/")).alias("_dir")
    ).distinct()
    return (
        entries.withColumn("_dir", inside).join(gone, "_dir", "left_anti").drop("_dir")
    )


def empty_directories(entries: DataFrame) -> DataFrame:
    """Directory entries without any file below them, each once.

    One pass: listed directories and the directories above files are marks of
    their paths, which are combined before the only shuffle.
    """
    path = F.col("path")
    listed = F.array(
        F.struct(path.alias("path"), F.lit(True).alias("listed"), F.lit(False).alias("above"))
    )
    above = F.transform(
        ids.ancestors(_parent(path)),
        lambda p: F.struct(p.alias("path"), F.lit(False).alias("listed"), F.lit(True).alias("above")),
    )
    marks = F.when(path.endswith("/"), listed).when(F.contains(path, F.lit("/")), above)
    return (
        entries.select(F.inline(marks))
        .groupBy("path")
        .agg(F.bool_or("listed").alias("listed"), F.bool_or("above").alias("above"))
        .where("listed AND NOT above")
        .select("path")
    )


def _parent(path: Column) -> Column:
    """Directory of a file, with its slash."""
    name = F.substring_index(path, "/", -1)
    return path.substr(F.lit(1), F.length(path) - F.length(name))


def deepest_first(directories: DataFrame) -> DataFrame:
    """Reverse lexical order: a directory comes after those below it."""
    return directories.orderBy(F.desc("path"))


def prune_empty_directories(entries: DataFrame) -> DataFrame:
    """Entries without the empty directories, in one pass and one shuffle.

    Entries are grouped by path together with marks of the directories above files.
    A group holds the entries of one path, which are as many as its repetitions.
    """
    path = F.col("path")
    row = F.struct(*entries.columns)
    none = F.lit(None).cast(entries.schema)
    own = F.array(F.struct(path.alias("_path"), row.alias("_row"), F.lit(False).alias("_above")))
    above = F.transform(
        ids.ancestors(_parent(path)),
        lambda p: F.struct(p.alias("_path"), none.alias("_row"), F.lit(True).alias("_above")),
    )
    is_file = ~path.endswith("/") & F.contains(path, F.lit("/"))
    grouped = (
        entries.select(F.inline(F.when(is_file, F.concat(own, above)).otherwise(own)))
        .groupBy("_path")
        .agg(F.collect_list("_row").alias("_rows"), F.bool_or("_above").alias("_above"))
    )
    kept = grouped.where(~F.col("_path").endswith("/") | F.col("_above"))
    return kept.select(F.inline("_rows"))
