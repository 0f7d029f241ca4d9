"""Routing of bindings to subsets by the first matching ID prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions.ids import col
from bindery.partitioning import broadcast_if_small
from bindery.scratch import stored

# The production prefixes in their order, 10 to 19 and 2 to 9.
PRODUCTION_PREFIXES = [str(i) for i in range(10, 20)] + [str(i) for i in range(2, 10)]

# Longer lists are joined as a table: one branch per prefix makes big code.
MAX_INLINE_PREFIXES = 200


def has_prefix(binding_id: Column | str, prefix: str) -> Column:
    return col(binding_id).startswith(prefix)


def first_prefix(binding_id: Column | str, prefixes: list[str]) -> Column:
    """First prefix, in list order, that the ID starts with; null if none does."""
    id_ = col(binding_id)
    return F.coalesce(
        *[F.when(id_.startswith(p), F.lit(p)) for p in prefixes],
        F.lit(None).cast("string"),
    )


def route(
    bindings: DataFrame, prefixes: list[str] | DataFrame, on_error: str = "raise"
) -> DataFrame:
    """Add ``subset_id``, the first matching prefix of each binding.

    ``prefixes`` is an ordered list or a split table with ``priority`` and
    ``prefix``. A binding without a match fails the job, or is left out with
    ``on_error="reject"`` (``unrouted`` returns those).
    """
    if on_error not in ("raise", "reject"):
        raise ValueError(f"unknown on_error: {on_error}")
    routed = _with_prefix(bindings, prefixes)
    if on_error == "reject":
        return routed.where(F.col("subset_id").isNotNull())
    message = F.concat_ws(" ", F.lit("binding"), "binding_id", F.lit("matches no prefix"))
    return routed.withColumn(
        "subset_id", F.coalesce("subset_id", F.raise_error(message).cast("string"))
    )


def unrouted(bindings: DataFrame, prefixes: list[str] | DataFrame) -> DataFrame:
    return _with_prefix(bindings, prefixes).where(F.col("subset_id").isNull()).drop(
        "subset_id"
    )


def _with_prefix(bindings: DataFrame, prefixes: list[str] | DataFrame) -> DataFrame:
    if isinstance(prefixes, DataFrame):
        table = prefixes
    elif len(prefixes) <= MAX_INLINE_PREFIXES:
        return bindings.withColumn("subset_id", first_prefix("binding_id", prefixes))
    else:
        table = bindings.sparkSession.createDataFrame(
            list(enumerate(prefixes)), "priority INT, prefix STRING"
        )
    return _with_prefix_from_table(bindings, table)


def prefix_lengths(table: DataFrame, prefix: str = "prefix") -> list[int]:
    """Lengths that occur among the prefixes; at most one for each length of an ID."""
    found = table.select(F.length(prefix).alias("n")).distinct().collect()
    return sorted({r["n"] for r in found} - {None})


def _with_prefix_from_table(bindings: DataFrame, table: DataFrame) -> DataFrame:
    """Look-up form for split tables.

    For each length that occurs among the prefixes, the ID's head of that length is
    looked up, and of the matches that of lowest priority counts. The look-ups are joins
    with a broadcast of measured size, so bindings are not moved, however many share a
    head. A larger table is joined by Spark's choice.
    """
    table = stored(
        table.groupBy("prefix").agg(F.min("priority").alias("priority")), "prefixes"
    )
    best = F.lit(None).cast("struct<priority: int, prefix: string>")
    found = bindings
    for n in prefix_lengths(table):
        own = table.where(F.length("prefix") == n).select(
            F.col("prefix").alias("_head"),
            F.struct(F.col("priority").cast("int").alias("priority"), "prefix").alias(f"_match{n}"),
        )
        head = F.substring("binding_id", 1, n)
        found = found.withColumn("_head", head).join(
            broadcast_if_small(own), "_head", "left"
        ).drop("_head")
        best = F.least(best, F.col(f"_match{n}"))
    return found.withColumn("subset_id", best["prefix"]).select(*bindings.columns, "subset_id")


def subset_counts(changes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Numbers of added and deleted bindings per subset that has any.

    ``changes`` has ``subset_id`` and ``kind``. The member lists themselves stay
    rows; a subset's list has no bounded size.
    """
    by = by or ["subset_id"]
    return changes.groupBy(*by).agg(
        F.count_if(F.col("kind") == "added").alias("n_added"),
        F.count_if(F.col("kind") == "deleted").alias("n_deleted"),
    )


def initial_subsets(
    changes: DataFrame, split: DataFrame, on_error: str = "raise"
) -> tuple[DataFrame, DataFrame]:
    """Assignment for an initial load: (members, counts per prefix).

    Every prefix is kept, also without bindings; deletions are ignored.
    """
    added = changes.where(F.col("kind") == "added")
    members = route(added, split, on_error)
    counts = subset_counts(members)
    zero = F.lit(0).cast("bigint")
    per_prefix = (
        split.select(F.col("prefix").alias("subset_id"), "priority")
        .join(counts, "subset_id", "left")
        .select(
            "subset_id",
            "priority",
            F.coalesce("n_added", zero).alias("n_added"),
            F.coalesce("n_deleted", zero).alias("n_deleted"),
        )
    )
    return members, per_prefix


def update_subsets(
    changes: DataFrame, split: DataFrame | list[str], on_error: str = "raise"
) -> tuple[DataFrame, DataFrame]:
    """Assignment for an update: (members, counts), only prefixes that got rows."""
    members = route(changes, split, on_error)
    return members, subset_counts(members)


def subsets_to_fill(counts: DataFrame) -> DataFrame:
    """Subsets with bindings to add; the others need no download."""
    return counts.where(F.col("n_added") > 0)
