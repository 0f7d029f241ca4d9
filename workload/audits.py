"""Integrity audit and change listings over whole tables."""

from pyspark.sql import functions as F

from bindery.functions import files, ids, names
from bindery.operators import auditing, changes, fetching, routing
from bindery.plans.auditing import audit, audit_archive
from bindery.plans.stages import stored
from workload.archives import mets_path
from workload.fetches import placed_plan
from workload.manifests import HEAD, manifest_docs
from workload.planning import PREFIXES
from workload.registry import (
    BASE,
    BINDINGS_SQL,
    PAGE_FILES_SQL,
    Tables,
    binding_dir_sql,
    query,
    subset_sql,
)


def archive_name():
    """Archive that holds a binding; null for the few that have no subset."""
    return names.target_name(F.lit("/data/all"), routing.first_prefix("binding_id", PREFIXES))


def held_entries(t: Tables):
    """Entries: manifests of F and O, pages not flagged R, and a note per binding.

    Files of pages flagged A have the prefixed names. Notes lie outside all
    binding directories.
    """
    prefixed = F.when(F.col("kind") == files.ALTO, F.lit("al-")).otherwise(F.lit("pr-"))
    name = F.when(F.col("flag") == "A", F.concat(prefixed, "filename")).otherwise(
        F.col("filename")
    )
    # Archives and directories are found once for each page and each binding.
    images = t.page_images.where("flag <> 'R'").transform(in_archives)
    of_pages = placed_plan(images).select(
        "archive", fetching.entry_path("binding_id", "kind", name, "directory").alias("path")
    )
    of_bindings = (
        t.bindings.transform(in_archives)
        .withColumn("directory", ids.binding_dir("binding_id"))
        .select(
            "archive",
            F.explode(
                F.array(
                    F.when(F.col("o_orderstatus") != "P", mets_path("directory")),
                    F.concat_ws("/", F.lit("notes"), F.concat("binding_id", F.lit(".txt"))),
                    F.concat("directory", F.lit("/")),
                )
            ).alias("path"),
        )
        .where(F.col("path").isNotNull())
    )
    return of_pages.unionByName(of_bindings).select(
        "archive", "path", F.col("path").endswith("/").alias("is_dir")
    )


def in_archives(rows):
    """Rows of bindings with the archive that holds them; those without one are left out.

    The filter would otherwise go down to the scan and make the ID anew for each prefix.
    """
    return ids.computed_once(rows, "archive", archive_name()).where(F.col("archive").isNotNull())


def stored_entries(t: Tables):
    """The entries as a table, for queries that read them more than once."""
    return stored(held_entries(t), t.scratch("entries"))


def expected_ids(t: Tables):
    """The list names O and P, so F is unlisted."""
    return t.bindings.where("o_orderstatus <> 'F'").select("binding_id")


def held_docs(t: Tables):
    """Manifests of F and O, as read from the archives."""
    docs = manifest_docs(t).join(
        t.bindings.where("o_orderstatus <> 'P'").select("binding_id"), "binding_id", "left_semi"
    )
    return (
        docs.transform(in_archives)
        .select("archive", mets_path().alias("path"), "xml")
    )


AUDIT_SQL = f"""{BINDINGS_SQL}, {PAGE_FILES_SQL}, b AS (
  SELECT binding_id, o_orderstatus AS s,
         '/data/all_' || {subset_sql("binding_id")} || '.zip' AS archive
  FROM bindings WHERE {subset_sql("binding_id")} IS NOT NULL),
f AS (
  SELECT b.archive, b.s, p.*, i.flag FROM b
  JOIN page_files p ON b.binding_id = p.binding_id
  JOIN page_images i ON p.binding_id = i.binding_id AND p.page_number = i.page_number),
errors AS (
  SELECT archive, NULL AS binding_id, 'malformed_path' AS error_class,
         'notes/' || binding_id || '.txt' AS detail FROM b
  UNION ALL
  SELECT archive, binding_id, CASE kind WHEN 'alto' THEN 'missing_alto' ELSE 'missing_image' END,
         filename FROM f WHERE s <> 'P' AND flag = 'R'
  UNION ALL
  SELECT archive, binding_id, 'unlisted_file',
         {binding_dir_sql("binding_id")} || '/' || kind || '/' ||
         CASE WHEN flag <> 'A' THEN '' WHEN kind = 'alto' THEN 'al-' ELSE 'pr-' END || filename
  FROM f WHERE s = 'F' AND flag <> 'R'
  UNION ALL
  SELECT archive, binding_id, 'missing_mets', NULL FROM b WHERE s = 'P'
  UNION ALL
  SELECT archive, binding_id, 'extra_mets', NULL FROM b WHERE s = 'F')"""


def errors(t: Tables):
    """The audit as a job, on a stored entry list."""
    staging = t.scratch("audit")
    entries = stored(held_entries(t), f"{staging}/entries")
    return audit(entries, held_docs(t), expected_ids(t), BASE, staging)


def of_class(name: str, columns: str) -> str:
    return f"""WITH {AUDIT_SQL} SELECT {columns} FROM errors
               WHERE error_class = '{name}'"""


@query(
    "integrity_errors",
    f"WITH {AUDIT_SQL} SELECT archive, binding_id, error_class, detail FROM errors",
)
def _(t: Tables):
    return errors(t)


def held_archive(t: Tables):
    """The held files as an archive table; bindings without pages have a bare manifest."""
    rows = held_entries(t).where("NOT is_dir").join(held_docs(t), ["archive", "path"], "left")
    of_mets = F.col("path").endswith("_METS.xml")
    xml = F.coalesce("xml", F.lit(f"{HEAD}</fileSec></mets>"))
    return rows.select(
        F.lit("/data/all").alias("set_id"),
        names.archive_prefix("archive").alias("subset_id"),
        F.when(of_mets, F.lit(files.METS)).otherwise(F.lit(files.ALTO)).alias("kind"),
        "path",
        F.lit(1).cast("bigint").alias("size"),
        F.when(of_mets, F.encode(xml, "utf-8")).alias("content"),
    )


@query(
    "audited_archive",
    f"WITH {AUDIT_SQL} SELECT archive, binding_id, error_class, detail FROM errors",
)
def _(t: Tables):
    """The audit of an archive table, whose manifests are read from its content."""
    staging = t.scratch("audit")
    held = stored(held_archive(t), f"{staging}/archive")
    return audit_archive(held, expected_ids(t), BASE, staging)


@query(
    "integrity_error_counts",
    f"""WITH {AUDIT_SQL} SELECT archive, error_class, count(*) AS n_errors
        FROM errors GROUP BY ROLLUP (archive, error_class)""",
)
def _(t: Tables):
    return auditing.error_counts(errors(t))


@query(
    "integrity_missing_files",
    f"""WITH {AUDIT_SQL} SELECT archive, binding_id, error_class, detail FROM errors
        WHERE error_class IN ('missing_alto', 'missing_image')""",
)
def _(t: Tables):
    expected = auditing.expected_files(held_docs(t), BASE)
    return auditing.missing_files(expected, held_entries(t))


@query(
    "differing_bindings",
    f"""WITH {AUDIT_SQL} SELECT DISTINCT archive, binding_id FROM f
        WHERE s <> 'P' AND flag = 'R'""",
)
def _(t: Tables):
    """Bindings whose page files are not those of their manifest, by sums of hashes."""
    entries = stored_entries(t)
    classified = auditing.classified_entries(entries)
    pairs = auditing.expected_bindings(expected_ids(t), entries)
    expected = auditing.expected_files(held_docs(t), BASE)
    states = auditing.binding_states(classified, pairs, expected)
    return states.where("differs").select("archive", "binding_id")


@query("malformed_paths", of_class("malformed_path", "archive, detail"))
def _(t: Tables):
    classified = auditing.classified_entries(held_entries(t))
    return auditing.malformed_paths(classified).withColumnRenamed("path", "detail")


@query("unlisted_files", of_class("unlisted_file", "archive, binding_id, detail"))
def _(t: Tables):
    entries = stored_entries(t)
    pairs = auditing.expected_bindings(expected_ids(t), entries)
    found = auditing.unlisted_files(auditing.classified_entries(entries), pairs)
    return found.withColumnRenamed("path", "detail")


@query("missing_mets", of_class("missing_mets", "archive, binding_id"))
def _(t: Tables):
    entries = stored_entries(t)
    pairs = auditing.expected_bindings(expected_ids(t), entries)
    seen = auditing.seen_bindings(auditing.classified_entries(entries))
    return auditing.missing_mets(pairs, seen)


@query("extra_mets", of_class("extra_mets", "archive, binding_id"))
def _(t: Tables):
    entries = stored_entries(t)
    pairs = auditing.expected_bindings(expected_ids(t), entries)
    seen = auditing.seen_bindings(auditing.classified_entries(entries))
    return auditing.extra_mets(seen, pairs)


@query(
    "expected_bindings",
    f"WITH {AUDIT_SQL} SELECT archive, binding_id FROM b WHERE s <> 'F'",
)
def _(t: Tables):
    return auditing.expected_bindings(expected_ids(t), held_entries(t))


@query(
    "expected_counts",
    f"""WITH {AUDIT_SQL} SELECT archive, count(*) AS n_expected FROM b
        WHERE s <> 'F' GROUP BY archive""",
)
def _(t: Tables):
    return auditing.expected_counts(
        auditing.expected_bindings(expected_ids(t), held_entries(t))
    )


@query(
    "seen_bindings",
    f"WITH {AUDIT_SQL} SELECT archive, binding_id FROM b WHERE s <> 'P'",
)
def _(t: Tables):
    return auditing.seen_bindings(auditing.classified_entries(held_entries(t)))


def wanted(t: Tables):
    return t.bindings.select("kind", "binding_id")


def present(t: Tables):
    """Bindings with a page that is not flagged R count as published."""
    return t.lineitem.where("l_returnflag <> 'R'").select(
        F.col("l_orderkey").cast("string").alias("binding_id")
    )


CHANGES_SQL = f"""{BINDINGS_SQL}, present AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS binding_id FROM lineitem
  WHERE l_returnflag <> 'R'),
listings AS (
  SELECT kind || '_bindings' || CASE
           WHEN (kind = 'added') = (binding_id IN (SELECT binding_id FROM present))
           THEN '' ELSE '_FAILED' END AS listing, binding_id
  FROM bindings)"""


@query("change_listings", f"WITH {CHANGES_SQL} SELECT listing, binding_id FROM listings")
def _(t: Tables):
    return changes.change_listings(wanted(t), present(t))


@query(
    "listing_counts",
    f"WITH {CHANGES_SQL} SELECT listing, count(*) AS n_bindings FROM listings GROUP BY listing",
)
def _(t: Tables):
    return changes.listing_counts(changes.change_listings(wanted(t), present(t)))


@query(
    "written_listings",
    f"WITH {CHANGES_SQL} SELECT listing, binding_id FROM listings",
)
def _(t: Tables):
    """The listings as text files by day, read back."""
    root = t.scratch("listings")
    changes.write_listings(changes.change_listings(wanted(t), present(t)), "2024-05-01", root)
    schema = "value STRING, run_date STRING, listing STRING"
    found = t.spark.read.schema(schema).text(root)
    return found.select("listing", F.col("value").alias("binding_id"))


@query(
    "added_present",
    f"""WITH {CHANGES_SQL} SELECT binding_id FROM listings
        WHERE listing = 'added_bindings'""",
)
def _(t: Tables):
    return changes.present_of(changes.ids_of_kind(wanted(t), "added"), present(t))


@query(
    "deleted_absent",
    f"""WITH {CHANGES_SQL} SELECT binding_id FROM listings
        WHERE listing = 'deleted_bindings'""",
)
def _(t: Tables):
    return changes.absent_of(changes.ids_of_kind(wanted(t), "deleted"), present(t))
