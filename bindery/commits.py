"""Logs of numbered entries, of which each number has one writer.

An entry is a small file named by its number, which is created whole or not at all, and
never replaced. So of several writers that try the same number one succeeds, every
reader sees the same one, and the others know before anything of theirs counts.
"""

from __future__ import annotations

import datetime
import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text; False if there is one of that name already.

    A part is written first and then named: by a hard link on a local disk, elsewhere by
    a rename, which distributed file systems refuse where the name is taken.
    """
    folder, name = path.rsplit("/", 1)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, source = hadoop.Path(path), hadoop.Path(part)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if system.getScheme() == "file":
        here, there = source.toUri().getPath(), target.toUri().getPath()
        with open(here, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(here, there)
        except FileExistsError:
            return False
        finally:
            os.unlink(here)
        return True
    out = system.create(source, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        made = not system.exists(target) and system.rename(source, target)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error):
            raise
        made = False
    if not made:
        system.delete(source, False)
    return made


def commit(spark: SparkSession, log: str, number: int, rows: list[dict]) -> bool:
    """Write the entry of a number; False if another writer has written it."""
    text = "".join(json.dumps(row) + "\n" for row in rows)
    return create_file(spark, f"{log}/{number:020d}.json", text)


def read(spark: SparkSession, log: str, schema: str) -> DataFrame:
    """Rows of all entries that there are at this moment."""
    return spark.read.schema(schema).json(log)


def last_number(entries: DataFrame, column: str) -> int:
    return entries.agg(F.max(column)).first()[0] or 0


def utc_text(spark: SparkSession, time: str | None) -> str | None:
    """A time of the session's zone as text that every session reads alike."""
    micros = spark.sql("SELECT unix_micros(CAST(:t AS TIMESTAMP))", args={"t": time}).first()[0]
    if micros is None:
        return None
    start = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
    return (start + datetime.timedelta(microseconds=micros)).isoformat(timespec="microseconds")
