"""The listing job on newly landed pages only.

The file source's own log replaces the look-up of the last run: each landed page
is read once. ``availableNow`` makes it a scheduled batch, as before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bindery import schemas
from bindery.functions import ids


def stream_headers(spark: SparkSession, landing: str) -> DataFrame:
    """Headers of pages as they land below ``set_id=<id>/``."""
    return (
        spark.readStream.format("xml")
        .options(rowTag="header", ignoreNamespace="true")
        .schema(schemas.HEADERS + ", set_id STRING")
        .load(landing)
    )


def append_new_identifiers(
    headers: DataFrame, base_url: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Append the DC identifiers of new pages by set, then stop.

    A batch that is run again replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(
            "set_id",
            "datestamp",
            ids.dc_identifier("identifier", base_url).alias("dc_identifier"),
            F.col("_status").alias("status"),
        ).write.mode("overwrite").partitionBy("set_id").parquet(
            f"{target}/batch_id={batch_id}"
        )

    return (
        headers.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
