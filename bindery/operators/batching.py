"""Download batches: consecutive runs of a subset's bindings in numeric ID order.

A window over a whole subset would put it in one task, and one subset may hold
most of a collection. Positions are therefore summed up over the digits of the
ID, four at a time: lines are counted per ID without its last four digits, these
counts per ID without its last eight, and so on, and each count is accumulated
among its siblings. A window then sees at most 10,000 distinct digit strings,
whatever the size of the subset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.functions import names

DIGITS = 4
COPIES_PER_ROW = 10_000


def number_bindings(
    bindings: DataFrame, by: tuple[str, ...] = ("subset_id",), longest: int = 12
) -> DataFrame:
    """Position of each distinct binding in its subset, and the subset's batch size.

    Order: ID length, ID, DC identifier. Repeated list lines are counted in
    ``copies`` and take up ``copies`` consecutive positions from ``position``.
    The levels are laid out for IDs of up to ``longest`` digits; longer ones are
    numbered as well, in larger windows.
    """
    group = [*by, "_length"]
    starts = _starts(bindings, list(by), range(DIGITS, max(longest, DIGITS + 1), DIGITS))
    leaf = [*group, _head(DIGITS)]
    distinct = _with_heads(
        bindings.groupBy(*by, "binding_id", "dc_identifier").agg(
            F.count("*").alias("copies")
        ),
        [DIGITS],
    )
    within = _before("copies", leaf, ["binding_id", "dc_identifier"])
    return (
        distinct.withColumn("_within", within)
        .join(starts, leaf)
        .select(
            *by,
            "binding_id",
            "dc_identifier",
            "copies",
            (F.col("_start") + F.col("_within")).alias("position"),
            "subset_size",
            names.batch_size("subset_size").alias("batch_size"),
        )
    )


def _starts(bindings: DataFrame, by: list[str], cuts: range) -> DataFrame:
    """First position of every ID head of the first cut, and the subset's size."""
    group = [*by, "_length"]
    heads = [_head(cut) for cut in cuts]
    counts = [
        _with_heads(bindings, cuts)
        .groupBy(*group, *heads)
        .agg(F.count("*").alias("_copies"))
    ]
    for i in range(1, len(heads)):
        counts.append(
            counts[-1].groupBy(*group, *heads[i:]).agg(F.sum("_copies").alias("_copies"))
        )
    top = heads[-1]
    starts = counts[-1].select(
        *group,
        top,
        _before("_copies", by, ["_length", top]).alias("_start"),
        F.sum("_copies").over(Window.partitionBy(*by)).alias("subset_size"),
    )
    for i in range(len(heads) - 2, -1, -1):
        head, parent = heads[i], heads[i + 1]
        offset = _before("_copies", [*group, parent], [head])
        starts = (
            counts[i]
            .withColumn("_offset", offset)
            .join(starts, [*group, parent])
            .select(
                *group, head, (F.col("_start") + F.col("_offset")).alias("_start"), "subset_size"
            )
        )
    return starts


def _head(cut: int) -> str:
    return f"_without_{cut}"


def _with_heads(rows: DataFrame, cuts) -> DataFrame:
    """Add the ID's length and the ID without its last digits, for each cut."""
    length = F.length("binding_id")
    rows = rows.withColumn("_length", length)
    for cut in cuts:
        kept = F.greatest(length - cut, F.lit(0))
        rows = rows.withColumn(_head(cut), F.col("binding_id").substr(F.lit(1), kept))
    return rows


def _before(column: str, partition: list[str], order: list[str]) -> Column:
    window = (
        Window.partitionBy(*partition)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(column).over(window), F.lit(0).cast("bigint"))


def batch_index(position: str = "position", size: str = "batch_size") -> Column:
    return F.floor(F.col(position) / F.col(size)).cast("int")


def first_batches(numbered: DataFrame) -> DataFrame:
    """One row per distinct binding with the batch of its first copy.

    This is what a download needs: a repeated line finds its files present.
    """
    return numbered.withColumn("batch_index", batch_index())


def assign_batches(bindings: DataFrame, by: tuple[str, ...] = ("subset_id",)) -> DataFrame:
    """One row per list line with its position and ``batch_index``.

    Copies of one line are written out in pieces spread over tasks.
    """
    by = list(by)
    last = F.col("copies") - 1
    pieces = number_bindings(bindings, tuple(by)).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(COPIES_PER_ROW).cast("bigint")))
    )
    pieces = pieces.repartition(*by, "binding_id", "_from")
    to = F.least(F.col("_from") + COPIES_PER_ROW - 1, last)
    return (
        pieces.withColumn("_copy", F.explode(F.sequence("_from", to)))
        .withColumn("position", F.col("position") + F.col("_copy"))
        .withColumn("batch_index", batch_index())
        .drop("_from", "_copy", "copies")
    )


def batch_lists(batches: DataFrame, by: tuple[str, ...] = ("subset_id",)) -> DataFrame:
    """Batches as arrays in position order; a batch has at most 100 bindings."""
    members = F.sort_array(F.collect_list(F.struct("position", "dc_identifier")))
    return (
        batches.groupBy(*by, "batch_index")
        .agg(members.alias("_members"))
        .select(
            *by, "batch_index", F.col("_members.dc_identifier").alias("dc_identifiers")
        )
    )


def batch_counts(bindings: DataFrame, by: tuple[str, ...] = ("subset_id",)) -> DataFrame:
    """Size, batch size and number of batches of each subset."""
    size = F.col("subset_size")
    return (
        bindings.groupBy(*by)
        .agg(F.count("*").alias("subset_size"))
        .withColumn("batch_size", names.batch_size("subset_size"))
        .withColumn("n_batches", F.ceil(size / F.col("batch_size")).cast("bigint"))
    )
