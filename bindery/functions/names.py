"""Names of sets, subsets, archives, lists and versions, and the batch size rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bindery.functions.ids import col


def folder_name(set_id: Column | str) -> Column:
    """Set id usable as a folder name."""
    return F.replace(col(set_id), F.lit(":"), F.lit("_"))


def subset_name(set_id: Column | str, prefix: Column | str) -> Column:
    set_id, prefix = col(set_id), col(prefix)
    return F.when(prefix == "", set_id).otherwise(F.concat(set_id, F.lit("_"), prefix))


def target_name(set_id: Column | str, prefix: Column | str) -> Column:
    return F.concat(subset_name(set_id, prefix), F.lit(".zip"))


def list_date(file_name: Column | str) -> Column:
    """Date at the end of a list file name; null if it is not a date."""
    return F.try_to_date(F.substring_index(col(file_name), "_", -1), "yyyy-MM-dd")


def archive_prefix(archive: Column | str) -> Column:
    """ID prefix an archive covers, taken from its name; '' when there is none."""
    return F.regexp_extract(
        col(archive), r"^(?:(?!\.zip).)*_([0-9]+)\.zip[^_]*$", 1
    )


def batch_size(subset_size: Column | str) -> Column:
    """Bindings per download batch for a subset of the given size."""
    n = col(subset_size)
    # The steps of the batch size rule.
    return (
        F.when(n < 500, F.least(n, F.lit(10)))
        .when(n < 50000, F.lit(30))
        .otherwise(F.lit(100))
        .cast("int")
    )


def capitalized(text: Column | str) -> Column:
    """First letter in upper case, the rest kept; one-letter texts are an error."""
    text = col(text)
    return F.when(
        F.length(text) < 2,
        F.raise_error(F.lit("a file type needs at least two letters")),
    ).otherwise(F.concat(F.upper(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text))))


def snapshot_id(log_line: Column | str) -> Column:
    """Version id out of a backup log line; null for other lines."""
    return F.nullif(
        F.regexp_extract(col(log_line), r"snapshot ([^ ]+) saved", 1), F.lit("")
    )
