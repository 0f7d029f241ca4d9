"""Net changes of the collection as a stream of added and deleted headers.

Each identifier of a set has a state: what was heard of it last, and when. A header
counts if it is newer than that, a deletion also if it is as old as an addition. So a
page that is landed again, or one that comes late with older headers, changes nothing,
and an identifier that is added and deleted between two runs is deleted only.

State is what every micro-batch found that counts, a Parquet folder for each below the
checkpoint. A micro-batch compares its headers with those of all earlier ones in one
aggregation, so neither a process nor a task holds the state of many identifiers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bindery.functions import ids
from bindery.sources import lists

KEY = ["set_id", "dc_identifier"]
CHANGE = "set_id STRING, dc_identifier STRING, kind STRING, at BIGINT"
#: Time of headers without a date stamp: before all others.
OLDEST = -(2**63)


def header_changes(added: DataFrame, deleted: DataFrame, base_url: str) -> DataFrame:
    """``set_id, dc_identifier, kind, at`` of headers; ``at`` in microseconds.

    Added headers belong to the set they were requested for, deleted ones to each set
    they name.
    """
    at = F.coalesce(F.unix_micros("datestamp"), F.lit(OLDEST)).alias("at")
    dc = ids.dc_identifier("identifier", base_url).alias("dc_identifier")
    new = added.select("set_id", dc, F.lit("added").alias("kind"), at)
    gone = deleted.select(
        F.explode(F.array_distinct("setSpec")).alias("set_id"), dc, F.lit("deleted").alias("kind"), at
    )
    return new.unionByName(gone)


def net_changes(headers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The newest of each identifier's headers, if it is newer than what is ``known``.

    Both tables have the columns of ``CHANGE``, and so has the result.
    """
    deleted = F.col("kind") == "deleted"
    heard = F.struct("at", deleted.alias("deleted"))
    rows = headers.select(*KEY, heard.alias("new"), F.lit(None).cast("struct<at:bigint,deleted:boolean>").alias("old"))
    if known is not None:
        before = known.select(*KEY, F.lit(None).cast("struct<at:bigint,deleted:boolean>").alias("new"), heard.alias("old"))
        rows = rows.unionByName(before)
    last = rows.groupBy(*KEY).agg(F.max("new").alias("new"), F.max("old").alias("old"))
    counts = F.col("new").isNotNull() & (F.col("old").isNull() | (F.col("new") > F.col("old")))
    kind = F.when(F.col("new.deleted"), F.lit("deleted")).otherwise(F.lit("added"))
    return last.where(counts).select(*KEY, kind.alias("kind"), F.col("new.at").alias("at"))


def write_changes(
    changes: DataFrame,
    sets: DataFrame,
    list_date: str,
    root: str,
    checkpoint: str,
) -> StreamingQuery:
    """Write a day's lists, with markers, from what has landed since the last call.

    Each micro-batch has a folder of its own below ``root/changes`` and one below
    ``checkpoint/known``, which a batch that is run again replaces; what later batches
    found is not known to it. The day's lists are made of all batches of the day, by the
    last change of each identifier, so they are whole after any number of batches.
    """
    spark = changes.sparkSession
    wanted = sets.select("set_id").distinct()

    def write(batch: DataFrame, batch_id: int) -> None:
        state = f"{checkpoint}/known"
        known = None
        if batch_id > 0:
            read = batch.sparkSession.read.schema(f"{CHANGE}, batch_id BIGINT").parquet(state)
            known = read.where(F.col("batch_id") < batch_id)
        own = f"{state}/batch_id={batch_id}"
        net_changes(batch, known).write.mode("overwrite").parquet(own)
        spark.read.schema(CHANGE).parquet(own).write.mode("overwrite").parquet(
            f"{root}/changes/list_date={list_date}/batch_id={batch_id}"
        )
        of_day = spark.read.schema(f"{CHANGE}, batch_id BIGINT").parquet(
            f"{root}/changes/list_date={list_date}"
        )
        last = of_day.groupBy("set_id", "dc_identifier").agg(
            F.max_by("kind", "batch_id").alias("kind")
        )
        listed = last.join(wanted, "set_id", "left_semi").select("set_id", "kind", "dc_identifier")
        lists.write_binding_lists(listed, wanted, list_date, root)

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
