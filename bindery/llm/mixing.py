"""Mix sources to target weights by exact token budgets.

Each document gets a random but fixed key, the MD5 of a seed and its ID. Sorted
by key, a source's documents are taken until its budget is spent, over and over
where the budget exceeds the source.

No source is sorted in one task. Keys are uniform, so a source is cut into ranges
of keys, as many as its rows need; each range is summed and sorted on its own, and
starts at the sum of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..partitioning import broadcast_if_small
from ..scratch import stored
from .texts import WORD_SQL, words

#: Rows of a range of keys, about. A task sorts a few ranges.
ROWS_PER_RANGE = 4096
SEED = "mix"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3


def allocate(sources: DataFrame, weights: Sequence[int], most_epochs: int) -> DataFrame:
    """Targets of sources, given ``source, n_rows, source_size``.

    Sources in code point order, null last, take the weights in turn and share the
    sum of all sizes by weight. A target stops at ``most_epochs`` times its source,
    and the rest is shared by weight again. In order of the share at which a source
    is full, it is full if the level without it and the fuller ones is beyond that.

    One row per source goes through one task.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sources.withColumn("rank", turn).withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(w) for w in weights]),
            ((F.col("rank") - 1) % len(weights) + 1).cast("int"),
        ).cast("long"),
    )
    ranked = ranked.withColumn("full", most_epochs * F.col("source_size"))
    by_level = Window.orderBy(F.col("full") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def sum_before(c: str) -> Column:
        return F.coalesce(F.sum(c).over(before), F.lit(0))

    left = F.sum("source_size").over(everything) - sum_before("full")
    level = left / (F.sum("weight").over(everything) - sum_before("weight"))
    capped = ranked.withColumn("capped", F.col("full") / F.col("weight") < level)
    kept_full = F.sum(F.when(F.col("capped"), F.col("full")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    share = (F.sum("source_size").over(everything) - kept_full).cast("double") / open_weight
    return capped.select(
        "source",
        "rank",
        "n_rows",
        "source_size",
        F.when(F.col("capped"), F.col("full").cast("double"))
        .otherwise(share * F.col("weight"))
        .alias("target"),
    )


def mix(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = SEED,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """What a mix takes of each document: one row per input row.

    Columns: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target``,
    ``taken`` (words, repeats counted; the words taken from a source are its target,
    rounded), ``copies`` (whole documents: the epochs, and one more if at least half
    of it falls into the last one).

    A null or empty text has size 0, takes nothing and has no effect on others. A
    null source is a source of its own, after the others. Rows of one ID have one
    key and are ordered by size; equal ones are interchangeable. An empty table
    gives an empty result, other columns are ignored.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = stored(
        documents.select(
            "doc_id",
            "source",
            F.size(words(F.col("text"))).cast("long").alias("size"),
            key.alias("key"),
        ),
        "sizes",
    )
    sources = stored(
        allocate(
            sized.groupBy("source").agg(
                F.count("*").alias("n_rows"), F.sum("size").alias("source_size")
            ),
            weights,
            most_epochs,
        ),
        "targets",
    )
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    ranges = F.ceil(F.col("n_rows") / rows_per_range)
    rows = sized.join(
        broadcast_if_small(sources), sized["source"].eqNullSafe(sources["source"])
    ).select(
        "doc_id",
        sized["source"],
        "size",
        "key",
        "rank",
        "source_size",
        "target",
        F.floor(place * ranges / F.lit(2**32)).alias("range"),
    )
    sums = rows.groupBy("rank", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "rank",
        "range",
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start"),
    )
    within = (
        Window.partitionBy("rank", "range")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.withColumn("end", F.sum("size").over(within)).join(starts, ["rank", "range"])
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(
        F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))
    ).otherwise(0)
    start = F.col("range_start") + F.col("end") - F.col("size")
    return (
        placed.withColumn("epochs", epochs)
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumn("part", F.greatest(F.lit(0), F.least("size", F.col("rest") - start)))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"),
            (F.col("epochs") + ((F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))).cast("int"))
            .cast("int")
            .alias("copies"),
        )
    )


SQL = f"""WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '{WORD_SQL}'))::BIGINT AS size,
         md5('{SEED}:' || doc_id::VARCHAR) AS key
  FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT source, source_size, weight, 3 * source_size AS full_size,
         3 * source_size / weight <
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS capped
  FROM ranked
  WINDOW earlier AS (ORDER BY 3 * source_size / weight, source COLLATE "binary" NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN full_size::DOUBLE ELSE
           (sum(source_size) OVER () - sum(CASE WHEN capped THEN full_size ELSE 0 END) OVER ())::DOUBLE
           / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE * weight END AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN
         budget // source_size * size
         + greatest(0, least(size, budget % source_size - start)) ELSE 0 END)::BIGINT AS taken
FROM placed"""
