import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BASE = "https://library.example/item/"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("bindery-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate a column expression on one row of named string values."""

    def evaluate(expression, **columns):
        from pyspark.sql import functions as F

        row = spark.range(1).select(
            *[F.lit(v).alias(k) for k, v in columns.items()], F.lit(0).alias("_")
        )
        return row.select(expression).first()[0]

    return evaluate


def manifest(groups, prefix="", issued=None):
    """METS text of ``(group id, use, [(file attributes, [hrefs])])``."""
    ns = f'xmlns{":" + prefix if prefix else ""}="http://www.loc.gov/METS/"'
    p = f"{prefix}:" if prefix else ""
    parts = [f'<{p}mets {ns} xmlns:xlink="http://www.w3.org/1999/xlink" ']
    parts.append('xmlns:MODS="http://www.loc.gov/mods/v3">')
    if issued is not None:
        parts.append(f"<{p}dmdSec><MODS:mods><MODS:dateIssued>{issued}</MODS:dateIssued>")
        parts.append(f"<MODS:dateIssued>1.1.2000</MODS:dateIssued></MODS:mods></{p}dmdSec>")
    parts.append(f"<{p}fileSec>")
    for group_id, use, members in groups:
        attributes = f' ID="{group_id}"' if group_id is not None else ""
        attributes += f' USE="{use}"' if use is not None else ""
        parts.append(f"<{p}fileGrp{attributes}>")
        for file_attributes, hrefs in members:
            parts.append(f"<{p}file {file_attributes}>")
            for href in hrefs:
                parts.append(f'<{p}FLocat LOCTYPE="URL" xlink:href="{href}"/>')
            parts.append(f"</{p}file>")
        parts.append(f"</{p}fileGrp>")
    parts.append(f"</{p}fileSec></{p}mets>")
    return "".join(parts)


def image_group(n, group_id="IMGGRP", use="Images", suffix=".jp2"):
    return (
        group_id,
        use,
        [(f'ID="I{i}" SEQ="{i}"', [f"file://./img/pr-{i + 1:05}{suffix}"]) for i in range(1, n + 1)],
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())
