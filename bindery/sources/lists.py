"""Binding lists, subset splits and plain ID lists.

A binding list exists as a table partitioned by set, kind and day, or as text
files ``<set>/<prefix>_YYYY-MM-DD``. An empty list has no rows but does count as
the latest list, so the table form keeps one marker row per written list.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery import schemas
from bindery.functions import ids, names
from bindery.partitioning import broadcast_if_small


def write_binding_lists(
    lists: DataFrame, sets: DataFrame, list_date: str, root: str
) -> None:
    """Write one day's added and deleted lists of the given sets, empty ones too.

    A list written again on the same day replaces the first one: its rows and
    its marker carry the same run ID, and readers match the two, so rows left
    behind by a list that is now empty are not seen.
    """
    spark = lists.sparkSession
    run_id = uuid.uuid4().hex
    day = F.lit(list_date).cast("date")
    lists = lists.select(
        "set_id",
        "kind",
        day.alias("list_date"),
        "dc_identifier",
        F.lit(run_id).alias("run_id"),
    )
    _overwrite_partitions(lists, f"{root}/lists")
    written = (
        read_binding_lists(spark, root)
        .where((F.col("list_date") == day) & (F.col("run_id") == run_id))
        .groupBy("set_id", "kind")
        .agg(F.count("*").alias("n_rows"))
    )
    kinds = F.explode(F.array(F.lit("added"), F.lit("deleted"))).alias("kind")
    wanted = sets.select("set_id").distinct().select("set_id", kinds)
    markers = wanted.join(written, ["set_id", "kind"], "left").select(
        "set_id",
        "kind",
        day.alias("list_date"),
        F.lit(run_id).alias("run_id"),
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
    )
    _overwrite_partitions(markers, f"{root}/markers")


def _overwrite_partitions(rows: DataFrame, path: str) -> None:
    # A few files per list, several for a large one.
    (
        rows.hint("rebalance", "set_id", "kind")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("set_id", "kind", "list_date")
        .parquet(path)
    )


def read_binding_lists(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.BINDING_LIST).parquet(f"{root}/lists")


def read_list_markers(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.LIST_MARKERS).parquet(f"{root}/markers")


def latest_list_dates(markers: DataFrame) -> DataFrame:
    """Newest list day of each set, over both kinds."""
    return markers.groupBy("set_id").agg(F.max("list_date").alias("list_date"))


def latest_lists(lists: DataFrame, markers: DataFrame) -> DataFrame:
    """Rows of each set's lists of its newest day.

    The day is the newest over both kinds, so a kind without a list on that day
    has no rows, even when it has an older list.
    """
    newest = markers.join(
        latest_list_dates(markers), ["set_id", "list_date"], "left_semi"
    )
    keys = ["set_id", "kind", "list_date"]
    if "run_id" in markers.columns and "run_id" in lists.columns:
        keys.append("run_id")
    # One row per set and kind.
    return lists.join(broadcast_if_small(newest.select(keys)), keys, "left_semi")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names, prefixes and days of the text lists of one set's folder.

    A list is a file or a folder of part files. Reading passes over empty files, and
    an empty list does count, so the names are those of the input files. There are
    two lists a month. A name that does not end in a date is an error.
    """
    try:
        text = spark.read.option("recursiveFileLookup", "true").text(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no binding list in {folder}") from missing
    inside = f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/"
    found = {unquote(f).rpartition(inside)[2].split("/")[0] for f in text.inputFiles()}
    undated = F.raise_error(F.concat(F.lit("no date in the name of the list "), "name"))
    return (
        spark.createDataFrame([(name,) for name in sorted(found)], "name STRING")
        .where(~F.col("name").endswith(".swp"))
        .select(
            "name",
            F.regexp_extract("name", r"^(.*)_[^_]*$", 1).alias("file_prefix"),
            F.coalesce(names.list_date("name"), undated).alias("list_date"),
        )
    )


def read_latest_list(
    spark: SparkSession, root: str, set_id: str, file_prefix: str
) -> DataFrame:
    """DC identifiers of a set's newest text list of one kind.

    The newest day is taken over all files of the set; it is an error when the
    set has no list, or none of the wanted kind on that day.
    """
    folder = f"{root}/{set_id.replace(':', '_')}"
    newest = list_files(spark, folder).groupBy("list_date").agg(
        F.max(F.when(F.col("file_prefix") == file_prefix, F.col("name"))).alias("name")
    )
    wanted = newest.agg(F.max_by(F.struct("name"), "list_date")["name"]).first()[0]
    if wanted is None:
        raise FileNotFoundError(f"no {file_prefix} list found for set {set_id}")
    return spark.read.text(f"{folder}/{wanted}").select(
        F.col("value").alias("dc_identifier"),
        ids.binding_id("value").alias("binding_id"),
    )


def read_id_list(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Distinct IDs of a plain text list; see ``expected_ids``."""
    return expected_ids(spark.read.text(path), "value", prefix)


def expected_ids(lines: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Distinct trimmed IDs of list lines that start with the prefix.

    The prefix is tested on the line as written, before trimming.
    """
    line = F.col(column)
    return (
        lines.where(line.startswith(prefix))
        .select(F.regexp_replace(line, r"^\s+|\s+$", "").alias("binding_id"))
        .distinct()
    )


def split_table(spark: SparkSession, set_id: str, prefixes: list[str]) -> DataFrame:
    """Subset split of a set as rows; the order of the prefixes is their priority."""
    rows = [(set_id, i, p) for i, p in enumerate(prefixes)]
    return spark.createDataFrame(rows, schemas.SUBSET_SPLIT)


def split_folder(root: str, set_id: str) -> str:
    """Folder of a set's split; other set IDs have other folders."""
    name = re.sub(r"[^A-Za-z0-9.-]", lambda found: f"_{ord(found[0]):x}_", set_id)
    return f"{root}/{name}_subsets"


def save_subset_split(split: DataFrame, root: str, set_id: str) -> None:
    """Write a set's split once; an existing one is left as it is."""
    split.select("set_id", "priority", "prefix").write.mode("ignore").parquet(
        split_folder(root, set_id)
    )


def read_subset_split(spark: SparkSession, root: str, set_id: str) -> DataFrame:
    return spark.read.schema(schemas.SUBSET_SPLIT).parquet(split_folder(root, set_id))
