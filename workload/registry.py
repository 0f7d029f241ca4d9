"""Registry of queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.scratch import new_folder

BASE = "https://library.example/item/"
#: Line items that one task groups.
LINES_PER_TASK = 300_000
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def image_location(page_number, flag):
    """Location of a page's image: its suffix follows from the flag."""
    suffix = (
        F.when(flag == "A", F.lit(".tif"))
        .when(flag == "R", F.lit(".tar.gz"))
        .otherwise(F.lit(".jp2"))
    )
    return F.concat(F.lit("file://./img/pr-"), F.format_string("%05d", page_number), suffix)


class Tables:
    """The given tables, and the collection they stand for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def bindings(self) -> DataFrame:
        """Orders as bindings; fulfilled ones are deleted, the others added."""
        id_ = F.col("o_orderkey").cast("string")
        return self.orders.select(
            id_.alias("binding_id"),
            F.concat(F.lit(BASE), id_).alias("dc_identifier"),
            F.when(F.col("o_orderstatus") == "F", F.lit("deleted"))
            .otherwise(F.lit("added"))
            .alias("kind"),
            "o_orderstatus",
            "o_orderdate",
            "o_custkey",
        )

    @property
    def pages(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/pages.parquet")

    @property
    def page_images(self) -> DataFrame:
        """Distinct pages of bindings as access images, located by their flag."""
        id_ = F.col("l_orderkey").cast("string")
        return self.flagged_pages.select(
            id_.alias("binding_id"),
            F.concat(F.lit(BASE), id_).alias("dc_identifier"),
            F.lit("access_img").alias("kind"),
            F.col("l_linenumber").alias("page_number"),
            image_location(F.col("l_linenumber"), F.col("flag")).alias("location_xlink"),
            "flag",
        )

    @property
    def page_tasks(self) -> int:
        """Number of tasks for line items, so that what one task holds does not grow.

        Several times that of cores: making and parsing documents costs far more than
        moving their pages, by whose bytes Spark would deal them.
        """
        shuffled = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        least = max(shuffled, 4 * self.spark.sparkContext.defaultParallelism)
        # Counted from the files' footers.
        return max(least, -(-self.lineitem.count() // LINES_PER_TASK))

    @property
    def flagged_pages(self) -> DataFrame:
        """Distinct pages with their flag, dealt to tasks by binding."""
        # As a number: hash aggregation cannot hold the maximum of a string.
        lines = self.lineitem.select(
            "l_orderkey", "l_linenumber", F.ascii("l_returnflag").alias("_flag")
        )
        return (
            lines.repartition(self.page_tasks, "l_orderkey")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.chr(F.max("_flag")).alias("flag"))
        )

    @property
    def pages_of_bindings(self) -> DataFrame:
        """Bindings with their pages ``p`` (number and flag) in order.

        Grouped by the key as it is, before texts are made of it: their pages are in one
        task already.
        """
        id_ = F.col("l_orderkey").cast("string")
        members = F.struct(F.col("l_linenumber").alias("page_number"), "flag")
        pages = self.flagged_pages.groupBy("l_orderkey").agg(
            F.sort_array(F.collect_list(members)).alias("p")
        )
        return pages.select(
            id_.alias("binding_id"), F.concat(F.lit(BASE), id_).alias("dc_identifier"), "p"
        )

    def spread(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows over all cores.

        For rows that are turned into documents: parsing them costs far more than
        moving a few columns.
        """
        return rows.repartition(self.spark.sparkContext.defaultParallelism, key)

    def scratch(self, name: str) -> str:
        """New folder in the shared scratch space that the cluster names."""
        return new_folder(self.spark, name)


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with its SQL if it has one."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# SQL of the collection that ``Tables`` derives.
BINDINGS_SQL = f"""bindings AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS binding_id,
         '{BASE}' || CAST(o_orderkey AS VARCHAR) AS dc_identifier,
         CASE WHEN o_orderstatus = 'F' THEN 'deleted' ELSE 'added' END AS kind,
         o_orderstatus, o_orderdate, o_custkey
  FROM orders)"""

PAGE_IMAGES_SQL = f"""page_images AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS binding_id,
         '{BASE}' || CAST(l_orderkey AS VARCHAR) AS dc_identifier,
         l_linenumber AS page_number,
         max(l_returnflag) AS flag,
         CASE max(l_returnflag) WHEN 'A' THEN '.tif' WHEN 'R' THEN '.tar.gz'
              ELSE '.jp2' END AS suffix
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""

# All page files: each image and its text file.
PAGE_FILES_SQL = f"""{PAGE_IMAGES_SQL},
page_files AS (
  SELECT binding_id, dc_identifier, page_number, 'access_img' AS kind,
         printf('%05d', page_number) || suffix AS filename,
         dc_identifier || '/image/' || page_number AS download_url
  FROM page_images
  UNION ALL
  SELECT binding_id, dc_identifier, page_number, 'alto',
         printf('%05d', page_number) || '.xml',
         dc_identifier || '/page-' || page_number || '.xml'
  FROM page_images)"""


def subset_sql(id_: str) -> str:
    """SQL of the production subset of an ID; null if it has none."""
    return (
        f"CASE WHEN regexp_matches({id_}, '^1[0-9]') THEN left({id_}, 2) "
        f"WHEN regexp_matches({id_}, '^[2-9]') THEN left({id_}, 1) END"
    )


def binding_dir_sql(id_: str) -> str:
    return (
        f"(array_to_string(list_transform(range(1, length({id_}) + 1), "
        f"lambda i: {id_}[1:i]), '/') || '/' || {id_})"
    )
