"""Archive changes, publication and versions over whole tables."""

from pyspark.sql import functions as F

from bindery.functions import files, ids
from bindery.operators import changes, fetching, merging
from bindery.plans import download, publication
from bindery.plans.stages import stored
from bindery.sources import archives
from workload.fetches import PLAN_SQL, page_plan
from workload.planning import NUMBERED_SQL, routed
from workload.registry import (
    BINDINGS_SQL,
    Tables,
    binding_dir_sql,
    query,
    subset_sql,
)

METS_PATH_SQL = f"{binding_dir_sql('binding_id')} || '/mets/' || binding_id || '_METS.xml'"


def mets_path(directory=None):
    return fetching.entry_path(
        "binding_id", F.lit(files.METS), ids.mets_file_name("binding_id"), directory
    )


def archive_of_manifests(t: Tables):
    """A manifest per routable order; its content is its path."""
    return (
        routed(t)
        .withColumn("path", mets_path())
        .select(
            F.lit("all").alias("set_id"),
            "subset_id",
            "binding_id",
            F.lit(files.METS).alias("kind"),
            F.lit(None).cast("int").alias("page_number"),
            "path",
            F.length("path").cast("bigint").alias("size"),
            F.encode("path", "utf-8").alias("content"),
            "o_orderstatus",
        )
    )


def archive_of_pages(t: Tables):
    """Page files as archive rows; those flagged R are empty."""
    return page_plan(t).select(
        "binding_id",
        "kind",
        "page_number",
        "path",
        F.when(F.col("flag") == "R", F.lit(0)).otherwise(F.lit(50)).alias("size"),
    )


@query(
    "apply_update",
    f"""WITH {BINDINGS_SQL}
        SELECT binding_id, {METS_PATH_SQL} AS path,
               CASE o_orderstatus WHEN 'F' THEN 'old' ELSE 'new' END AS state
        FROM bindings WHERE o_custkey >= 50""",
)
def _(t: Tables):
    """Old: status F and O. Added: O and P. Deleted: bindings of early customers."""
    rows = t.bindings.withColumn("path", mets_path())

    def state(name):
        return lambda df: df.select("path", "binding_id", F.lit(name).alias("state"))

    old = rows.where("o_orderstatus <> 'P'").transform(state("old"))
    new = rows.where("o_orderstatus <> 'F'").transform(state("new"))
    deleted = rows.where("o_custkey < 50").select("binding_id")
    return merging.apply_changes(old, new, deleted).select("binding_id", "path", "state")


@query(
    "merged_archives",
    f"""WITH {BINDINGS_SQL}
        SELECT binding_id, CASE o_orderstatus WHEN 'F' THEN 'old' ELSE 'new' END AS state
        FROM bindings""",
)
def _(t: Tables):
    """Same-named entries of the new archive replace the old ones."""
    old = t.bindings.where("o_orderstatus <> 'P'")
    new = t.bindings.where("o_orderstatus <> 'F'")
    merged = merging.upsert(
        old.select("binding_id", F.lit("old").alias("state")),
        new.select("binding_id", F.lit("new").alias("state")),
        key="binding_id",
    )
    return merged.select("binding_id", "state")


@query(
    "deleted_bindings",
    f"""WITH {PLAN_SQL} SELECT path FROM plan
        WHERE binding_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders
                                 WHERE o_orderstatus = 'F')""",
)
def _(t: Tables):
    deleted = t.bindings.where("kind = 'deleted'")
    return merging.delete_bindings(archive_of_pages(t), deleted).select("path")


def directory_entries(t: Tables):
    """Entry list with all directories of all bindings; only F and O have files."""
    directory = F.concat(ids.binding_dir("binding_id"), F.lit("/mets/"))
    directories = (
        t.bindings.select(directory.alias("directory"))
        .select(F.explode(ids.ancestors("directory")).alias("path"))
        .distinct()
    )
    held = t.bindings.where("o_orderstatus <> 'P'").select(mets_path().alias("path"))
    return directories.unionByName(held)


# Every prefix of an ID with its directory, the binding directory and its mets/.
DIRECTORIES_SQL = f"""{BINDINGS_SQL}, steps AS (
  SELECT binding_id, o_orderstatus, unnest(range(1, length(binding_id) + 1)) AS n
  FROM bindings),
owned AS (
  SELECT o_orderstatus, binding_id, array_to_string(list_transform(range(1, n + 1),
           lambda i: binding_id[1:i]), '/') || '/' AS path, false AS inside FROM steps
  UNION ALL
  SELECT o_orderstatus, binding_id, {binding_dir_sql("binding_id")} || '/', true FROM bindings
  UNION ALL
  SELECT o_orderstatus, binding_id, {binding_dir_sql("binding_id")} || '/mets/', true
  FROM bindings)"""


@query(
    "empty_directories",
    f"""WITH {DIRECTORIES_SQL}
        SELECT path FROM owned GROUP BY path HAVING bool_and(o_orderstatus = 'P')""",
)
def _(t: Tables):
    empty = merging.empty_directories(directory_entries(t))
    return merging.deepest_first(empty)


@query(
    "pruned_directories",
    f"""WITH {DIRECTORIES_SQL}
        SELECT path FROM owned GROUP BY path HAVING NOT bool_and(o_orderstatus = 'P')
        UNION ALL
        SELECT {METS_PATH_SQL} FROM bindings WHERE o_orderstatus <> 'P'""",
)
def _(t: Tables):
    return merging.prune_empty_directories(directory_entries(t))


@query(
    "deleted_entries",
    f"""WITH {DIRECTORIES_SQL}
        SELECT DISTINCT path FROM owned WHERE NOT (inside AND o_orderstatus = 'F')
        UNION ALL
        SELECT {METS_PATH_SQL} FROM bindings WHERE o_orderstatus = 'O'""",
)
def _(t: Tables):
    """Directories above the deleted bindings stay, even when they are empty."""
    deleted = t.bindings.where("kind = 'deleted'")
    return merging.delete_entries(directory_entries(t), deleted)


@query(
    "mets_ids",
    """SELECT CAST(o_orderkey AS VARCHAR) AS binding_id FROM orders
       WHERE o_orderstatus <> 'P'""",
)
def _(t: Tables):
    return archives.mets_ids(directory_entries(t))


@query(
    "present_paths",
    f"WITH {PLAN_SQL} SELECT path FROM plan WHERE flag <> 'R'",
)
def _(t: Tables):
    return archives.present_paths(archive_of_pages(t), t.page_tasks)


@query(
    "archive_bindings",
    "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS binding_id FROM lineitem",
)
def _(t: Tables):
    return archives.binding_ids(archive_of_pages(t))


@query(
    "archive_entries",
    f"""WITH {BINDINGS_SQL}
        SELECT 'all_' || {subset_sql("binding_id")} || '.zip' AS archive,
               {METS_PATH_SQL} AS path, false AS is_dir,
               CAST(length({METS_PATH_SQL}) AS BIGINT) AS size
        FROM bindings WHERE {subset_sql("binding_id")} IS NOT NULL""",
)
def _(t: Tables):
    return archives.as_entries(archive_of_manifests(t))


@query(
    "files_of_a_kind",
    f"WITH {PLAN_SQL} SELECT path FROM plan WHERE kind = 'alto'",
)
def _(t: Tables):
    return archives.select_files(archive_of_pages(t), kind=files.ALTO).select("path")


@query(
    "files_by_pattern",
    f"""WITH {PLAN_SQL} SELECT path FROM plan
        WHERE regexp_matches(path, '/access_img/') AND NOT regexp_matches(path, '\\.tif$')""",
)
def _(t: Tables):
    found = archives.matching(archive_of_pages(t), "/access_img/", r"\.tif$")
    return found.select("path")


def archived_batches(t: Tables):
    """An archive per download batch with the manifests of its bindings, as a table."""
    batches = download.batched_bindings(routed(t)).withColumn("path", mets_path())
    batch = F.concat_ws(".", "subset_id", F.col("batch_index").cast("string"), F.lit("zip"))
    content = F.concat(F.lit("<mets>"), "path", F.lit("</mets>"))
    rows = batches.select(
        F.concat(F.lit("set_"), batch).alias("archive"),
        "path",
        F.lit(False).alias("is_dir"),
        F.length(content).cast("bigint").alias("size"),
        F.encode(content, "utf-8").alias("content"),
    )
    return stored(rows, t.scratch("batches"))


ZIPPED_SQL = f"""{NUMBERED_SQL}, zipped AS (
  SELECT 'set_' || subset_id || '.' || batch_index || '.zip' AS archive,
         {METS_PATH_SQL} AS path, '<mets>' || {METS_PATH_SQL} || '</mets>' AS content
  FROM batched)"""


@query(
    "zip_entries",
    f"""WITH {ZIPPED_SQL}
        SELECT archive, path, false AS is_dir, CAST(length(content) AS BIGINT) AS size
        FROM zipped
        UNION ALL
        SELECT archive, regexp_replace(path, '[^/]*$', ''), true, 0::BIGINT FROM zipped""",
)
def _(t: Tables):
    """Entries of the batches' archives, with the directories of their files."""
    return archives.with_directories(archived_batches(t))


@query(
    "zip_members",
    f"WITH {ZIPPED_SQL} SELECT archive, path, content FROM zipped",
)
def _(t: Tables):
    """Manifests among the members of the batches' archives, by their entries."""
    batches = archived_batches(t)
    entries = archives.with_directories(batches)
    wanted = archives.matching(entries.where("NOT is_dir"), include="_METS[.]xml$", exclude="/$")
    return batches.join(wanted.select("archive", "path"), ["archive", "path"], "left_semi").select(
        "archive", "path", F.decode("content", "utf-8").alias("content")
    )


def published_store(t: Tables) -> str:
    """Store with two updates and a version after each.

    First the manifests of F and O are added, then those of P, while F goes.
    """
    root = t.scratch("store")
    rows = archive_of_manifests(t)
    none = routed(t).select("subset_id", "binding_id").limit(0)
    gone = routed(t).where("kind = 'deleted'").select("subset_id", "binding_id")
    publication.create_store(t.spark, root)
    publication.apply_update(
        t.spark, root, "all", "first", "2024-01-31", rows.where("o_orderstatus <> 'P'"), none
    )
    publication.create_version(t.spark, root, "aaaaaaaa", "2024-02-01")
    publication.apply_update(
        t.spark, root, "all", "second", "2024-02-29", rows.where("o_orderstatus = 'P'"), gone
    )
    publication.create_version(t.spark, root, "bbbbbbbb", "2024-03-01")
    return root


STORED_SQL = f"""{BINDINGS_SQL}, stored AS (
  SELECT {subset_sql("binding_id")} AS subset_id, binding_id, o_orderstatus,
         {METS_PATH_SQL} AS path
  FROM bindings WHERE {subset_sql("binding_id")} IS NOT NULL)"""


@query(
    "published_archive",
    f"""WITH {STORED_SQL} SELECT subset_id, binding_id, path, path AS content
        FROM stored WHERE o_orderstatus <> 'F'""",
)
def _(t: Tables):
    found = publication.read_published(t.spark, published_store(t))
    return found.select(
        "subset_id", "binding_id", "path", F.decode("content", "utf-8").alias("content")
    )


@query(
    "restored_version",
    f"""WITH {STORED_SQL} SELECT subset_id, binding_id, path
        FROM stored WHERE o_orderstatus <> 'P'""",
)
def _(t: Tables):
    """The first version is still there after the second update."""
    found = publication.read_version(t.spark, published_store(t), "aaaaaaaa")
    return found.select("subset_id", "binding_id", "path")


@query(
    "published_changes",
    f"""WITH {STORED_SQL}
        SELECT CASE o_orderstatus WHEN 'F' THEN 'deleted_bindings'
                    ELSE 'added_bindings' END AS listing, count(*) AS n_bindings
        FROM stored GROUP BY 1
        UNION ALL
        SELECT CASE o_orderstatus WHEN 'F' THEN 'deleted_bindings'
                    ELSE 'added_bindings_FAILED' END, count(*)
        FROM bindings WHERE {subset_sql("binding_id")} IS NULL AND o_orderstatus <> 'F'
        GROUP BY 1""",
)
def _(t: Tables):
    """Listings after the updates; bindings without a subset failed to be added."""
    published = publication.read_published(t.spark, published_store(t))
    present = archives.mets_ids(archives.as_entries(published))
    wanted = t.bindings.where(
        (F.col("kind") == "added") | F.col("binding_id").rlike("^(1[0-9]|[2-9])")
    ).select("kind", "binding_id")
    return changes.listing_counts(changes.change_listings(wanted, present))


@query(
    "published_at_one_time",
    f"""WITH {STORED_SQL} SELECT subset_id, binding_id, path FROM stored""",
)
def _(t: Tables):
    """Three updates of one day, the last one sent twice, and a compaction."""
    root = t.scratch("store")
    rows = archive_of_manifests(t)
    none = routed(t).select("subset_id", "binding_id").limit(0)
    publication.create_store(t.spark, root)
    for status in ("F", "O", "P", "P"):
        try:
            publication.apply_update(
                t.spark, root, "all", status, "2024-01-31",
                rows.where(F.col("o_orderstatus") == status), none,
            )
        except ValueError:
            publication.compact(t.spark, root, "all")
    found = publication.read_published(t.spark, root)
    return found.select("subset_id", "binding_id", "path")


@query(
    "compacted_subsets",
    f"""WITH {STORED_SQL}, counted AS (
          SELECT subset_id, count(*) AS n_rows,
                 count(*) FILTER (o_orderstatus = 'F') AS n_removed,
                 count(DISTINCT o_orderstatus = 'P') AS n_folders
          FROM stored GROUP BY subset_id)
        SELECT subset_id, n_folders, n_rows, n_removed,
               CASE WHEN 100 * n_removed >= 45 * n_rows THEN 1 ELSE n_folders END
                 AS folders_after,
               n_rows - CASE WHEN 100 * n_removed >= 45 * n_rows THEN n_removed ELSE 0 END
                 AS rows_after
        FROM counted WHERE n_rows > n_removed""",
)
def _(t: Tables):
    """Subsets before and after those were written anew that had lost 45 % of their rows."""
    root = published_store(t)
    before = publication.waste(t.spark, root, "all")
    before = stored(before.where("n_rows > n_removed"), t.scratch("waste"))
    publication.compact(t.spark, root, "all", least_removed=0.45)
    after = publication.waste(t.spark, root, "all").select(
        "subset_id",
        F.col("n_folders").alias("folders_after"),
        F.col("n_rows").alias("rows_after"),
    )
    return before.join(after, "subset_id")


@query(
    "sets_of_alike_names",
    f"""WITH {STORED_SQL}
        SELECT CASE o_orderstatus WHEN 'O' THEN 'a:b' ELSE 'a_b' END AS set_id,
               subset_id, binding_id
        FROM stored WHERE o_orderstatus <> 'P'""",
)
def _(t: Tables):
    root = t.scratch("store")
    rows = archive_of_manifests(t)
    none = routed(t).select("subset_id", "binding_id").limit(0)
    publication.create_store(t.spark, root)
    for set_id, status in (("a:b", "O"), ("a_b", "F")):
        publication.apply_update(
            t.spark, root, set_id, "first", "2024-01-31",
            rows.where(F.col("o_orderstatus") == status), none,
        )
    found = publication.read_published(t.spark, root)
    return found.select("set_id", "subset_id", "binding_id")


@query(
    "published_subset",
    f"""WITH {STORED_SQL} SELECT binding_id, path
        FROM stored WHERE o_orderstatus <> 'F' AND subset_id = '12'""",
)
def _(t: Tables):
    """One subset of the published archive, whatever it holds."""
    found = publication.read_published(t.spark, published_store(t), "all", ["12"])
    return found.select("binding_id", "path")


@query(
    "published_binding",
    f"""WITH {STORED_SQL} SELECT binding_id, path FROM stored
        WHERE binding_id = (SELECT max(binding_id) FROM stored WHERE o_orderstatus <> 'F')""",
)
def _(t: Tables):
    """The last of the published bindings, from the folders it may be in."""
    root = published_store(t)
    last = publication.read_published(t.spark, root).agg(F.max("binding_id")).first()[0]
    found = publication.select_binding(t.spark, root, "all", last)
    return found.select("binding_id", "path")


@query(
    "raced_updates",
    f"""WITH {STORED_SQL}
        SELECT binding_id, path, CASE o_orderstatus WHEN 'O' THEN 'late' ELSE 'early' END AS run
        FROM stored""",
)
def _(t: Tables):
    """Two updates prepared from one state, and published one after the other.

    Both hold the manifests of O. The one that lost its number replaces them.
    """
    root = t.scratch("store")
    rows = archive_of_manifests(t)
    none = routed(t).select("subset_id", "binding_id").limit(0)
    publication.create_store(t.spark, root)

    def prepared(run: str, statuses: str):
        content = F.encode(F.lit(run), "utf-8")
        wanted = rows.where(F.col("o_orderstatus").isin(*statuses)).withColumn("content", content)
        return publication.prepare_update(t.spark, root, "all", run, "2024-01-31", wanted, none)

    updates = [prepared("early", "FOP"), prepared("late", "O")]
    numbers = [publication.publish(update) for update in updates]
    if numbers != [1, 2]:
        raise RuntimeError(f"two updates got the numbers {numbers}")
    found = publication.read_published(t.spark, root)
    return found.select("binding_id", "path", F.decode("content", "utf-8").alias("run"))


@query(
    "version_markers",
    f"""WITH {STORED_SQL}
        SELECT marker, count(*) FILTER (contains(states, o_orderstatus)) AS n_bindings
        FROM stored, (VALUES ('F', 'F'), ('O', 'FO'), (NULL, 'FOP')) AS m(marker, states)
        GROUP BY marker""",
)
def _(t: Tables):
    """The marker, with the number of published bindings, after each of three updates.

    Updates and versions all have dates before those that came earlier. Versions follow
    the first two updates.
    """
    root = t.scratch("store")
    rows = archive_of_manifests(t)
    none = routed(t).select("subset_id", "binding_id").limit(0)
    publication.create_store(t.spark, root)
    states = []
    for number, status in enumerate("FOP"):
        publication.apply_update(
            t.spark, root, "all", status, f"2024-01-{20 - number}",
            rows.where(F.col("o_orderstatus") == status), none,
        )
        if status != "P":
            publication.create_version(t.spark, root, status, f"2024-01-{10 - number:02d}")
        marker = publication.current_version(
            publication.read_pointers(t.spark, root), publication.read_versions(t.spark, root)
        ).select(F.col("version_id").alias("marker"))
        held = publication.read_published(t.spark, root).agg(F.count("*").alias("n_bindings"))
        states.append((marker.first()["marker"], held.first()["n_bindings"]))
    return t.spark.createDataFrame(states, "marker string, n_bindings bigint")


def pointer_history(t: Tables):
    """Purchases as publications of a user's subset, sign-ups as versions."""
    pointers = t.events.where("event_type = 'purchase'").select(
        F.lit("all").alias("set_id"),
        F.col("user_id").cast("string").alias("subset_id"),
        F.format_string("run_id=%d", "event_id").alias("location"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seq"),
        F.lit(False).alias("whole"),
        F.col("ts").alias("published_at"),
    )
    versions = t.events.where("event_type = 'signup'").select(
        F.format_string("%08x", "event_id").alias("version_id"),
        F.col("ts").alias("created_at"),
        F.lit("all").alias("set_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seq"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("number"),
    )
    return pointers, versions


@query(
    "current_locations",
    """SELECT CAST(user_id AS VARCHAR) AS subset_id,
              'run_id=' || arg_max(event_id, ts) AS location
       FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
)
def _(t: Tables):
    pointers, _ = pointer_history(t)
    return publication.current_locations(pointers).select("subset_id", "location")


@query(
    "listed_versions",
    """SELECT printf('%08x', event_id) AS version_id,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at
       FROM events WHERE event_type = 'signup'""",
)
def _(t: Tables):
    _, versions = pointer_history(t)
    return publication.list_versions(versions).withColumn(
        "created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "versions_latest",
    """SELECT printf('%08x', arg_max(event_id, ts)) AS version_id
       FROM events WHERE event_type = 'signup'""",
)
def _(t: Tables):
    _, versions = pointer_history(t)
    return publication.latest_version(versions).select("version_id")


@query(
    "current_version",
    """SELECT CASE WHEN max(ts) FILTER (event_type = 'purchase')
                        <= max(ts) FILTER (event_type = 'signup')
              THEN printf('%08x', arg_max(event_id, ts) FILTER (event_type = 'signup'))
              END AS version_id
       FROM events""",
)
def _(t: Tables):
    return publication.current_version(*pointer_history(t))


@query(
    "logged_versions",
    """SELECT printf('%08x', event_id) AS version_id FROM events
       WHERE event_type = 'signup'""",
)
def _(t: Tables):
    line = F.when(
        F.col("event_type") == "signup",
        F.concat(F.lit("snapshot "), F.format_string("%08x", "event_id"), F.lit(" saved")),
    ).otherwise(F.col("props"))
    return publication.version_ids(t.events.select(line.alias("line")))
