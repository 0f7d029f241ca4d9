"""Zone map of landed listing pages, so that a listing reads only what it needs.

Pages are landed once and stay. The index has, for every page and every set that its
headers belong to, the smallest and the largest date stamp. A page is parsed when it is
first seen, and again only if its file has changed. A listing since the last runs then
opens the pages that reach them, and no others.

Paths of pages to read go through the driver, as the listing of their files does anyway.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery import schemas
from bindery.sources.listings import HEADER_ROWS

#: What tells one state of a landed file from another.
PAGE = ["page", "size", "modified"]
INDEX = (
    "page STRING, size BIGINT, modified TIMESTAMP, set_id STRING, n_headers BIGINT, "
    "first_stamp TIMESTAMP, last_stamp TIMESTAMP"
)


def landed_pages(spark: SparkSession, landing: str) -> DataFrame:
    """``page, size, modified, uri`` of the files below a landing; no content is read.

    The URI is the path as rows of a file have it, with blanks and the like encoded.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    )
    return files.select(
        F.col("path").alias("page"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        F.col("_metadata.file_path").alias("uri"),
    )


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """Zones of all pages indexed so far; none before the first."""
    try:
        return spark.read.schema(INDEX).parquet(f"{root}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], INDEX)


def read_pages(spark: SparkSession, landing: str, pages: list[str]) -> DataFrame:
    """Headers of some landed pages, with ``set_id`` from the folder, and ``uri``."""
    if not pages:
        return spark.createDataFrame([], f"{schemas.HEADERS}, set_id STRING, uri STRING")
    return (
        spark.read.format("xml")
        .options(**HEADER_ROWS, basePath=landing)
        .schema(f"{schemas.HEADERS}, set_id STRING")
        .load(pages)
        .select("*", F.col("_metadata.file_path").alias("uri"))
    )


def zones(headers: DataFrame, sets: Column) -> DataFrame:
    """Per page and set: number of headers and their date stamps' range.

    ``sets`` is the array of sets that a header belongs to.
    """
    return (
        headers.select("uri", "datestamp", F.explode(F.array_distinct(sets)).alias("set_id"))
        .groupBy("uri", "set_id")
        .agg(
            F.count("*").alias("n_headers"),
            F.min("datestamp").alias("first_stamp"),
            F.max("datestamp").alias("last_stamp"),
        )
    )


def requested_set() -> Column:
    """Added headers belong to the set that they were requested for."""
    return F.array("set_id")


def named_sets() -> Column:
    """Deleted headers belong to each set that they name."""
    return F.coalesce(F.col("setSpec"), F.array().cast("array<string>"))


def update_index(spark: SparkSession, landing: str, root: str, sets: Column) -> int:
    """Add the pages that have landed since the last call; returns their number.

    Each call that finds any adds one folder, so a call that is broken off or repeated
    leaves nothing half done; pages that two calls add at once are read as one.
    """
    known = read_index(spark, root).select(PAGE).distinct()
    new = landed_pages(spark, landing).join(known, PAGE, "left_anti")
    found = new.select(*PAGE, "uri").collect()
    if not found:
        return 0
    seen = spark.createDataFrame(found, "page STRING, size BIGINT, modified TIMESTAMP, uri STRING")
    read = zones(read_pages(spark, landing, [r["page"] for r in found]), sets)
    # A page without headers has a row, too, or it would be read every time.
    seen.join(read, "uri", "left").select(
        *PAGE,
        "set_id",
        F.coalesce("n_headers", F.lit(0).cast("bigint")).alias("n_headers"),
        "first_stamp",
        "last_stamp",
    ).write.parquet(f"{root}/{uuid.uuid4().hex}")
    return len(found)


def pages_since(index: DataFrame, sets: DataFrame, last_runs: DataFrame | None = None) -> list[str]:
    """Pages with headers of the given sets at or after the day of their last runs.

    All pages of a set without a run. ``last_runs`` has ``set_id, last_run``.
    """
    zone = index.join(sets.select("set_id").distinct(), "set_id", "left_semi")
    if last_runs is not None:
        start = F.col("last_run").cast("timestamp")
        zone = zone.join(last_runs.select("set_id", "last_run"), "set_id", "left").where(
            F.col("last_run").isNull() | (F.col("last_stamp") >= start)
        )
    return sorted(r["page"] for r in zone.select("page").distinct().collect())


def headers_since(
    spark: SparkSession,
    landing: str,
    root: str,
    sets: DataFrame,
    of: Column,
    last_runs: DataFrame | None = None,
) -> DataFrame:
    """Headers of the landed pages that a listing of the sets needs, index brought up to date.

    Holds all headers since the last runs, and others of the same pages.
    """
    update_index(spark, landing, root, of)
    # A page that was landed anew is read as it is now.
    pages = pages_since(read_index(spark, root), sets, last_runs)
    return read_pages(spark, landing, pages).drop("uri")
