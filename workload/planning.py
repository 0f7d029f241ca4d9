"""Routing, batching and the download plan over whole tables."""

from pyspark.sql import functions as F

from bindery.operators import batching, manifests, routing
from bindery.plans import download
from bindery.sources import lists
from workload.registry import (
    BINDINGS_SQL,
    PAGE_FILES_SQL,
    Tables,
    binding_dir_sql,
    query,
    subset_sql,
)

PREFIXES = routing.PRODUCTION_PREFIXES


def routed(t: Tables):
    return routing.route(t.bindings, PREFIXES, on_error="reject")


def nation_split(t: Tables):
    """Split table with overlapping prefixes, the longer ones first."""
    return t.nation.select(
        (100 - F.col("n_nationkey")).alias("priority"),
        F.col("n_nationkey").cast("string").alias("prefix"),
    )


ROUTED_SQL = f"""{BINDINGS_SQL}, routed AS (
  SELECT *, {subset_sql("binding_id")} AS subset_id FROM bindings
  WHERE {subset_sql("binding_id")} IS NOT NULL)"""

# The longest of the nation keys 0 to 24 that an ID starts with.
NATION_SQL = f"""{BINDINGS_SQL}, routed AS (
  SELECT *, CASE WHEN length(binding_id) > 1 AND left(binding_id, 1) <> '0'
                      AND CAST(left(binding_id, 2) AS INTEGER) <= 24
                 THEN left(binding_id, 2) ELSE left(binding_id, 1) END AS subset_id
  FROM bindings)"""


@query(
    "prefix_predicate",
    f"""WITH {BINDINGS_SQL}
        SELECT binding_id, left(binding_id, 1) = '2' AS in_2,
               left(binding_id, 2) = '13' AS in_13, true AS in_all FROM bindings""",
)
def _(t: Tables):
    return t.bindings.select(
        "binding_id",
        routing.has_prefix("binding_id", "2").alias("in_2"),
        routing.has_prefix("binding_id", "13").alias("in_13"),
        routing.has_prefix("binding_id", "").alias("in_all"),
    )


@query(
    "subset_routing",
    f"WITH {ROUTED_SQL} SELECT subset_id, binding_id FROM routed",
)
def _(t: Tables):
    return routed(t).select("subset_id", "binding_id")


@query(
    "subset_routing_by_table",
    f"WITH {NATION_SQL} SELECT subset_id, binding_id FROM routed",
)
def _(t: Tables):
    return routing.route(t.bindings, nation_split(t)).select("subset_id", "binding_id")


@query(
    "unrouted_bindings",
    f"""WITH {BINDINGS_SQL} SELECT binding_id, kind FROM bindings
        WHERE {subset_sql("binding_id")} IS NULL""",
)
def _(t: Tables):
    return routing.unrouted(t.bindings, PREFIXES).select("binding_id", "kind")


@query(
    "subset_added_deleted",
    f"""WITH {ROUTED_SQL}
        SELECT subset_id, count(*) FILTER (kind = 'added') AS n_added,
               count(*) FILTER (kind = 'deleted') AS n_deleted
        FROM routed GROUP BY subset_id""",
)
def _(t: Tables):
    _, counts = routing.update_subsets(t.bindings, PREFIXES, on_error="reject")
    return counts


@query(
    "initial_subsets",
    f"""WITH {NATION_SQL}
        SELECT CAST(n_nationkey AS VARCHAR) AS subset_id,
               count(*) FILTER (kind = 'added') AS n_added, 0::BIGINT AS n_deleted
        FROM nation LEFT JOIN routed ON CAST(n_nationkey AS VARCHAR) = subset_id
        GROUP BY n_nationkey""",
)
def _(t: Tables):
    _, counts = routing.initial_subsets(t.bindings, nation_split(t))
    return counts.select("subset_id", "n_added", "n_deleted")


@query(
    "initial_members",
    f"""WITH {NATION_SQL} SELECT subset_id, dc_identifier FROM routed
        WHERE kind = 'added'""",
)
def _(t: Tables):
    members, _ = routing.initial_subsets(t.bindings, nation_split(t))
    return members.select("subset_id", "dc_identifier")


@query(
    "update_members",
    f"""WITH {ROUTED_SQL} SELECT subset_id, kind, dc_identifier FROM routed""",
)
def _(t: Tables):
    planned = download.plan_subsets(t.bindings, PREFIXES, initial=False, on_error="reject")
    return planned.select("subset_id", "kind", "dc_identifier")


@query(
    "subsets_to_fill",
    f"""WITH {ROUTED_SQL}
        SELECT subset_id, count(*) FILTER (kind = 'added') AS n_added
        FROM routed GROUP BY subset_id HAVING count(*) FILTER (kind = 'added') > 0""",
)
def _(t: Tables):
    _, counts = routing.update_subsets(t.bindings, PREFIXES, on_error="reject")
    return routing.subsets_to_fill(counts).select("subset_id", "n_added")


@query(
    "saved_split",
    """SELECT 'all' AS set_id, 100 - n_nationkey AS priority,
              CAST(n_nationkey AS VARCHAR) AS prefix FROM nation""",
)
def _(t: Tables):
    """The split is saved once; a second attempt changes nothing."""
    root = t.scratch("split")
    split = nation_split(t).withColumn("set_id", F.lit("all"))
    lists.save_subset_split(split, root, "all")
    lists.save_subset_split(split.where("prefix = '1'"), root, "all")
    return lists.read_subset_split(t.spark, root, "all")


NUMBERED_SQL = f"""{ROUTED_SQL}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY subset_id
              ORDER BY length(binding_id), binding_id) - 1 AS position,
         count(*) OVER (PARTITION BY subset_id) AS n
  FROM routed WHERE kind = 'added'),
batched AS (
  SELECT *, CAST(position // CASE WHEN n < 500 THEN least(n, 10)
              WHEN n < 50000 THEN 30 ELSE 100 END AS INTEGER) AS batch_index
  FROM numbered)"""


@query(
    "download_batches",
    f"""WITH {NUMBERED_SQL}
        SELECT subset_id, batch_index, position, binding_id FROM batched""",
)
def _(t: Tables):
    added = routed(t).where("kind = 'added'")
    return batching.assign_batches(added).select(
        "subset_id", "batch_index", "position", "binding_id"
    )


@query(
    "batches_of_repeated_lines",
    """WITH numbered AS (
         SELECT CAST(l_orderkey AS VARCHAR) AS binding_id,
                CAST(l_returnflag AS VARCHAR) AS subset_id,
                row_number() OVER (PARTITION BY l_returnflag
                  ORDER BY length(CAST(l_orderkey AS VARCHAR)),
                           CAST(l_orderkey AS VARCHAR)) - 1 AS position,
                count(*) OVER (PARTITION BY l_returnflag) AS n
         FROM lineitem)
       SELECT subset_id, binding_id, position,
              CAST(position // CASE WHEN n < 500 THEN least(n, 10)
                   WHEN n < 50000 THEN 30 ELSE 100 END AS INTEGER) AS batch_index
       FROM numbered""",
)
def _(t: Tables):
    """Lists that name a binding several times; every line has its place."""
    id_ = F.col("l_orderkey").cast("string")
    listed = t.lineitem.select(
        F.col("l_returnflag").alias("subset_id"),
        id_.alias("binding_id"),
        id_.alias("dc_identifier"),
    )
    return batching.assign_batches(listed).select(
        "subset_id", "binding_id", "position", "batch_index"
    )


@query(
    "batch_lists",
    f"""WITH {NUMBERED_SQL}
        SELECT subset_id, batch_index, count(*) AS n_bindings,
               string_agg(dc_identifier, ' ' ORDER BY position) AS dc_identifiers
        FROM batched GROUP BY subset_id, batch_index""",
)
def _(t: Tables):
    """Batches as lists; a batch has at most 100 bindings."""
    added = routed(t).where("kind = 'added'")
    batches = batching.batch_lists(batching.assign_batches(added))
    return batches.select(
        "subset_id",
        "batch_index",
        F.size("dc_identifiers").cast("bigint").alias("n_bindings"),
        F.array_join("dc_identifiers", " ").alias("dc_identifiers"),
    )


@query(
    "batch_counts",
    """SELECT o_custkey, count(*) AS subset_size,
              CAST(least(count(*), 10) AS INTEGER) AS batch_size,
              CAST(ceil(count(*) / least(count(*), 10)) AS BIGINT) AS n_batches
       FROM orders GROUP BY o_custkey""",
)
def _(t: Tables):
    return batching.batch_counts(t.bindings, ("o_custkey",))


@query(
    "download_plan",
    f"""WITH {NUMBERED_SQL}, {PAGE_FILES_SQL}
        SELECT subset_id, batch_index, b.binding_id, kind, page_number, filename,
               download_url,
               {binding_dir_sql("b.binding_id")} || '/' || f.kind || '/' || filename AS path
        FROM (SELECT subset_id, batch_index, binding_id FROM batched) b
        JOIN page_files f ON b.binding_id = f.binding_id""",
)
def download_plan(t: Tables):
    """Flagship: from listed bindings and their pages to the files to fetch."""
    page_files = manifests.with_names(
        manifests.altos_for_images(t.page_images.drop("flag"))
    )
    return download.download_plan(download.batched_bindings(routed(t)), page_files)
