"""What an update really added and deleted."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the four listings.
ADDED = "added_bindings"
ADDED_FAILED = "added_bindings_FAILED"
DELETED = "deleted_bindings"
DELETED_FAILED = "deleted_bindings_FAILED"


def ids_of_kind(changes: DataFrame, kind: str) -> DataFrame:
    return changes.where(F.col("kind") == kind).select("binding_id").distinct()


def present_of(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Wanted IDs that are present."""
    return wanted.join(present, "binding_id", "left_semi")


def absent_of(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Wanted IDs that are not present."""
    return wanted.join(present, "binding_id", "left_anti")


def change_listings(changes: DataFrame, present: DataFrame) -> DataFrame:
    """The four listings as rows ``listing, binding_id``.

    ``changes`` has ``kind, binding_id``, ``present`` the IDs whose manifest is
    in the published data. One aggregation over flags takes the place of two
    intersections and two differences, and combines copies before the shuffle.
    """
    no = F.lit(False)
    flags = changes.select(
        "binding_id",
        (F.col("kind") == "added").alias("added"),
        (F.col("kind") == "deleted").alias("deleted"),
        no.alias("present"),
    ).unionByName(
        present.select(
            "binding_id",
            no.alias("added"),
            no.alias("deleted"),
            F.lit(True).alias("present"),
        )
    )
    merged = flags.groupBy("binding_id").agg(
        F.bool_or("added").alias("added"),
        F.bool_or("deleted").alias("deleted"),
        F.bool_or("present").alias("present"),
    )
    listings = F.array(
        F.when(
            F.col("added"),
            F.when(F.col("present"), F.lit(ADDED)).otherwise(F.lit(ADDED_FAILED)),
        ),
        F.when(
            F.col("deleted"),
            F.when(F.col("present"), F.lit(DELETED_FAILED)).otherwise(F.lit(DELETED)),
        ),
    )
    return merged.select(
        F.explode(F.array_compact(listings)).alias("listing"), "binding_id"
    )


def listing_counts(listings: DataFrame) -> DataFrame:
    return listings.groupBy("listing").agg(F.count("*").alias("n_bindings"))


def write_listings(listings: DataFrame, run_date: str, root: str) -> None:
    """Write the listings of a day as text, one folder each; empty ones get none.

    A repeated run replaces the day as a whole.
    """
    spark = listings.sparkSession
    rows = listings.select("listing", F.col("binding_id").alias("value")).hint(
        "rebalance", "listing"
    )
    day = f"{root}/run_date={run_date}"
    try:
        spark.read.text(day)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        dated = rows.withColumn("run_date", F.lit(run_date))
        dated.write.mode("append").partitionBy("run_date", "listing").text(root)
    else:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("listing")
            .text(day)
        )
