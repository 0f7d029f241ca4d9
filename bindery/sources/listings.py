"""Landed listing pages: identifier headers, deleted records and sets.

Pages are landed by whoever talks to the provider, one XML file per response
page below ``set_id=<id>/``, so that a set's pages are one partition and all
pages of a listing read as one result. Pages kept as text in a table column are
parsed by the ``parse_*`` functions into the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery import schemas
from bindery.functions import dates, ids

_XML = {"ignoreNamespace": "true"}
#: Options of the XML source for rows that are headers.
HEADER_ROWS = {"rowTag": "header", **_XML}


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Headers of all landed pages, with ``set_id`` from the partition folder."""
    schema = schemas.HEADERS + ", set_id STRING"
    return (
        spark.read.format("xml")
        .options(**HEADER_ROWS)
        .schema(schema)
        .load(path)
    )


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("xml")
        .options(rowTag="set", **_XML)
        .schema(schemas.SETS)
        .load(path)
        .select(F.col("setSpec").alias("set_id"), F.col("setName").alias("set_name"))
    )


def read_page_tokens(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("xml")
        .options(rowTag="resumptionToken", **_XML)
        .schema(schemas.RESUMPTION_TOKEN + ", set_id STRING")
        .load(path)
        .select(
            "set_id",
            F.col("_VALUE").alias("token"),
            F.col("_completeListSize").alias("complete_list_size"),
            F.col("_cursor").alias("cursor"),
        )
    )


def _parsed(pages: DataFrame, column: str) -> DataFrame:
    return pages.withColumn(
        "_page", F.from_xml(F.col(column), schemas.LISTING_PAGE, _XML)
    )


def parse_headers(pages: DataFrame, column: str = "xml") -> DataFrame:
    """Headers of response pages held as text, other columns kept."""
    keep = [c for c in pages.columns if c != column]
    none = F.array().cast(f"array<{_header_type()}>")
    headers = F.concat(
        F.coalesce(F.col("_page.ListIdentifiers.header"), none),
        F.coalesce(F.col("_page.ListRecords.record.header"), none),
    )
    return (
        _parsed(pages, column)
        .select(*keep, F.explode(headers).alias("_header"))
        .select(*keep, "_header.*")
    )


def _header_type() -> str:
    return (
        "struct<identifier:string,datestamp:timestamp,"
        "setSpec:array<string>,_status:string>"
    )


def parse_sets(pages: DataFrame, column: str = "xml") -> DataFrame:
    return (
        _parsed(pages, column)
        .select(F.explode("_page.ListSets.set").alias("s"))
        .select(F.col("s.setSpec").alias("set_id"), F.col("s.setName").alias("set_name"))
    )


def parse_page_tokens(pages: DataFrame, column: str = "xml") -> DataFrame:
    """Resumption tokens of response pages held as text, other columns kept."""
    keep = [c for c in pages.columns if c != column]
    token = F.coalesce(
        F.col("_page.ListIdentifiers.resumptionToken"),
        F.col("_page.ListRecords.resumptionToken"),
    )
    return (
        _parsed(pages, column)
        .select(*keep, token.alias("t"))
        .where(F.col("t").isNotNull())
        .select(
            *keep,
            F.col("t._VALUE").alias("token"),
            F.col("t._completeListSize").alias("complete_list_size"),
            F.col("t._cursor").alias("cursor"),
        )
    )


def list_identifiers(
    headers: DataFrame, base_url: str, from_date: str | None = None
) -> DataFrame:
    """DC identifiers of listed headers since a date (inclusive)."""
    keep = [c for c in ("set_id",) if c in headers.columns]
    return headers.where(dates.since("datestamp", from_date)).select(
        *keep, ids.dc_identifier("identifier", base_url).alias("dc_identifier")
    )


def list_deleted(
    headers: DataFrame,
    base_url: str,
    set_id: str | None = None,
    from_date: str | None = None,
) -> DataFrame:
    """DC identifiers of deleted records, by exact set membership.

    With a ``set_id`` only its records; without one, one row per record and set
    it names, so that all sets are listed in one job. The time stamp is tested
    here because the provider's own filter is not dependable for deletions.
    """
    dc = ids.dc_identifier("identifier", base_url).alias("dc_identifier")
    kept = headers.where(dates.since("datestamp", from_date))
    if set_id is not None:
        return kept.where(F.array_contains("setSpec", set_id)).select(
            F.lit(set_id).alias("set_id"), dc
        )
    return kept.select(
        F.explode(F.array_distinct("setSpec")).alias("set_id"), dc
    )


def incomplete_listings(
    headers: DataFrame, tokens: DataFrame, by: list[str]
) -> DataFrame:
    """Listings whose number of headers differs from the announced total."""
    found = headers.groupBy(*by).agg(F.count("*").alias("n_headers"))
    announced = tokens.groupBy(*by).agg(
        F.max("complete_list_size").alias("complete_list_size")
    )
    return (
        announced.join(found, by, "left")
        .withColumn("n_headers", F.coalesce("n_headers", F.lit(0).cast("bigint")))
        .where(F.col("n_headers") != F.col("complete_list_size"))
    )
