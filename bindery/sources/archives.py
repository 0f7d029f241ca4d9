"""Entry rows of archives, and selections from the archive table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.functions import files, ids, names


def with_directories(entries: DataFrame) -> DataFrame:
    """Entry rows of files, and a row for each directory that holds one of them."""
    path = F.col("path")
    name = F.substring_index(path, "/", -1)
    directories = (
        entries.where(F.contains(path, F.lit("/")))
        .select("archive", path.substr(F.lit(1), F.length(path) - F.length(name)).alias("path"))
        .distinct()
        .select("archive", "path", F.lit(True).alias("is_dir"), F.lit(0).cast("bigint").alias("size"))
    )
    return entries.select("archive", "path", "is_dir", "size").unionByName(directories)


def mets_ids(entries: DataFrame) -> DataFrame:
    """Distinct binding IDs whose manifest is among the entries."""
    return (
        entries.select(F.regexp_extract("path", "([0-9]+)_METS", 1).alias("binding_id"))
        .where(F.col("binding_id") != "")
        .distinct()
    )


def present_paths(archive: DataFrame, partitions: int | None = None) -> DataFrame:
    """Distinct paths already held, empty files not counted.

    With ``partitions`` paths are dealt to that many tasks before copies are looked for.
    Otherwise each task first looks among its own paths, all of which it holds, and their
    number grows with the archive.
    """
    paths = archive.where(files.is_present("size")).select("path")
    if partitions is not None:
        paths = paths.repartition(partitions, "path")
    return paths.distinct()


def binding_ids(archive: DataFrame) -> DataFrame:
    return archive.select("binding_id").distinct()


def select_files(
    archive: DataFrame,
    binding_id: str | None = None,
    kind: str | None = None,
    subset_ids: list[str] | None = None,
) -> DataFrame:
    """Files of one binding, of one kind, or of some subsets.

    A binding alone does not prune the ``subset_id`` partitions; give the
    subsets as well, or use ``plans.publication.select_binding``.
    """
    if subset_ids is not None:
        archive = archive.where(F.col("subset_id").isin(subset_ids))
    if binding_id is not None:
        archive = archive.where(F.col("binding_id") == binding_id)
    if kind is not None:
        archive = archive.where(F.col("kind") == kind)
    return archive


def matching(
    archive: DataFrame, include: str | None = None, exclude: str | None = None
) -> DataFrame:
    """Rows whose path matches one pattern and not the other."""
    if include:
        archive = archive.where(F.col("path").rlike(include))
    if exclude:
        archive = archive.where(~F.col("path").rlike(exclude))
    return archive


def local_issues(spark: SparkSession, root: str) -> DataFrame:
    """Issue directories below a local collection, from their manifests' paths."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*_METS.xml")
        .load(root)
        .select(ids.mets_base_path("path").alias("directory"))
        .distinct()
    )


def as_entries(archive: DataFrame) -> DataFrame:
    """Archive table as entry rows, named after the targets of its subsets."""
    return archive.select(
        names.target_name("set_id", "subset_id").alias("archive"),
        "path",
        F.lit(False).alias("is_dir"),
        "size",
    )
