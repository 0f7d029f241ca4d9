"""Tables that a job writes between its steps, in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def local_root(application: str) -> str:
    return f"file://{tempfile.mkdtemp(prefix=f'{application}-')}"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Without the setting an application in local mode gets one folder of this machine,
    since the driver and its tasks are one process there. On a cluster it is an error.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        root = local_root(context.applicationId)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a folder below the scratch root that nothing has used."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet and read again, which cuts their lineage.

    What reads them needs no recomputation when an executor is lost. The files
    stay until the cluster clears its scratch folder.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, name)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
