"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from bindery.functions import dates, files, ids, names
from bindery.operators import manifests
from workload.registry import BASE, PAGE_IMAGES_SQL, Tables, binding_dir_sql, query


@query(
    "binding_id_from_url",
    "SELECT url, string_split(url, '/')[-1] AS binding_id FROM pages",
)
def _(t: Tables):
    return t.pages.select("url", ids.binding_id("url").alias("binding_id"))


@query(
    "dc_identifier_from_oai",
    f"""SELECT 'oai:host:' || o_orderkey AS identifier,
               '{BASE}' || o_orderkey AS dc_identifier FROM orders""",
)
def _(t: Tables):
    oai = t.orders.select(
        F.concat(F.lit("oai:host:"), F.col("o_orderkey").cast("string")).alias("identifier")
    )
    return oai.withColumn("dc_identifier", ids.dc_identifier("identifier", BASE))


@query(
    "manifest_names",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS binding_id,
               o_orderkey || '_METS.xml' AS file_name,
               '{BASE}' || o_orderkey || '/mets.xml?full=true' AS url FROM orders""",
)
def _(t: Tables):
    return t.bindings.select(
        "binding_id",
        ids.mets_file_name("dc_identifier").alias("file_name"),
        ids.mets_url("dc_identifier").alias("url"),
    )


@query(
    "prefix_path",
    f"""WITH b AS (SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders)
        SELECT id AS binding_id, {binding_dir_sql("id")} AS path,
               id[1:1] || '/' || id[1:2] || '/' || id[1:3] || '/' || id AS path_of_3
        FROM b""",
)
def _(t: Tables):
    return t.bindings.select(
        "binding_id",
        ids.binding_dir("binding_id").alias("path"),
        ids.binding_dir("binding_id", 3).alias("path_of_3"),
    )


@query(
    "page_filename_url",
    f"""WITH {PAGE_IMAGES_SQL}
        SELECT binding_id, page_number, suffix AS extension,
               printf('%05d', page_number) || suffix AS image_name,
               printf('%05d', page_number) || '.xml' AS alto_name,
               dc_identifier || '/image/' || page_number AS image_url,
               dc_identifier || '/page-' || page_number || '.xml' AS alto_url
        FROM page_images""",
)
def _(t: Tables):
    extension = files.image_extension("location_xlink")
    named = t.page_images.withColumn("extension", extension).withColumn(
        "image_name", files.page_filename("page_number", "extension")
    )
    return named.select(
        "binding_id",
        "page_number",
        "extension",
        "image_name",
        files.page_filename("page_number", F.lit(".xml")).alias("alto_name"),
        files.image_url("dc_identifier", "image_name").alias("image_url"),
        files.alto_url("dc_identifier", "page_number").alias("alto_url"),
    )


@query(
    "output_locations",
    f"""WITH {PAGE_IMAGES_SQL}
        SELECT binding_id, page_number,
               'downloads/' || binding_id || '/alto/' || printf('%05d', page_number)
                 || '.xml' AS default_path,
               '/data/' || binding_id || '/alto/' || printf('%05d', page_number)
                 || '.xml' AS based_path,
               '/data/x/' || printf('%05d', page_number) || '.xml.tmp' AS tmp_path
        FROM page_images""",
)
def _(t: Tables):
    altos = manifests.with_names(t.page_images.withColumn("kind", F.lit(files.ALTO)))

    def at(**parts):
        return files.file_download_location("dc_identifier", "kind", "filename", **parts)

    return altos.select(
        "binding_id",
        "page_number",
        at().alias("default_path"),
        at(base_path="/data/").alias("based_path"),
        files.tmp_path(at(base_path="/data", file_dir="x")).alias("tmp_path"),
    )


@query(
    "paths_in_batch",
    f"""WITH b AS (SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders)
        SELECT id AS binding_id, '/' || {binding_dir_sql("id")} AS path FROM b""",
)
def _(t: Tables):
    held = F.concat(
        F.lit("/tmp/set_1/batch_"), F.col("o_custkey"), F.lit("/"), ids.binding_dir("binding_id")
    )
    return t.bindings.select("binding_id", files.path_in_target(held).alias("path"))


@query(
    "archive_prefixes",
    """SELECT '/data/' || c_mktsegment || '_' || c_custkey || '.zip' AS archive,
              CAST(c_custkey AS VARCHAR) AS prefix FROM customer
       UNION ALL
       SELECT '/data/' || c_mktsegment || '_' || c_name || '.zip', '' FROM customer""",
)
def _(t: Tables):
    def archives(column):
        return t.customer.select(
            F.concat(
                F.lit("/data/"), "c_mktsegment", F.lit("_"), F.col(column).cast("string"),
                F.lit(".zip"),
            ).alias("archive")
        )

    both = archives("c_custkey").unionByName(archives("c_name"))
    return both.withColumn("prefix", names.archive_prefix("archive"))


@query(
    "entry_bindings",
    f"""WITH {PAGE_IMAGES_SQL}, p AS (
          SELECT {binding_dir_sql("binding_id")} || '/alto/' || page_number AS path,
                 binding_id, {binding_dir_sql("binding_id")} AS base FROM page_images
          UNION ALL
          SELECT 'alto/' || binding_id || '-' || page_number, NULL, '' FROM page_images)
        SELECT path, binding_id, binding_id AS owner, base AS base_path FROM p""",
)
def _(t: Tables):
    page = F.col("page_number").cast("string")
    good = t.page_images.select(
        F.concat_ws("/", ids.binding_dir("binding_id"), F.lit("alto"), page).alias("path")
    )
    bad = t.page_images.select(
        F.concat(F.lit("alto/"), "binding_id", F.lit("-"), page).alias("path")
    )
    return good.unionByName(bad).select(
        "path",
        ids.binding_of_entry("path").alias("binding_id"),
        ids.binding_of_path("path").alias("owner"),
        ids.mets_base_path("path").alias("base_path"),
    )


def dated_text():
    """Order date as text in one of four forms, by status and customer."""
    return (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "d.M.yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd.MM.yyyy"))
        .when(F.col("o_custkey") > 100, F.date_format("o_orderdate", "yyyy"))
        .otherwise(F.date_format("o_orderdate", "'['yyyy']'"))
    )


DATED_SQL = """dated AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS binding_id,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%-d.%-m.%Y')
              WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%d.%m.%Y')
              WHEN o_custkey > 100 THEN strftime(o_orderdate, '%Y')
              ELSE strftime(o_orderdate, '[%Y]') END AS date_text,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE)
              WHEN o_custkey > 100 THEN make_date(year(o_orderdate), 1, 1)
              END AS date_issued
  FROM orders)"""


@query(
    "partial_dates",
    f"""WITH {DATED_SQL}
        SELECT binding_id, date_text, strftime(date_issued, '%Y-%m-%d') AS date_issued
        FROM dated""",
)
def _(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("binding_id"),
        dated_text().alias("date_text"),
    ).withColumn("date_issued", dates.partial_date("date_text").cast("string"))


@query(
    "list_file_dates",
    """SELECT DISTINCT o_orderpriority AS set_name,
              lower(o_orderstatus) || '_' || strftime(o_orderdate, '%Y-%m-%d') AS file_name,
              strftime(o_orderdate, '%Y-%m-%d') AS list_date
       FROM orders""",
)
def _(t: Tables):
    return (
        t.orders.select(
            F.col("o_orderpriority").alias("set_name"),
            F.concat(
                F.lower("o_orderstatus"), F.lit("_"), F.date_format("o_orderdate", "yyyy-MM-dd")
            ).alias("file_name"),
        )
        .distinct()
        .withColumn("list_date", names.list_date("file_name").cast("string"))
    )


@query(
    "subset_names",
    """SELECT c_mktsegment || ':' || c_nationkey AS set_id,
              c_mktsegment || '_' || c_nationkey AS folder,
              CASE WHEN c_acctbal < 0 THEN c_mktsegment || ':' || c_nationkey
                   ELSE c_mktsegment || ':' || c_nationkey || '_' || c_custkey END AS subset,
              CASE WHEN c_acctbal < 0 THEN c_mktsegment || ':' || c_nationkey
                   ELSE c_mktsegment || ':' || c_nationkey || '_' || c_custkey END
                || '.zip' AS target
       FROM customer""",
)
def _(t: Tables):
    sets = t.customer.select(
        F.concat_ws(":", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("set_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(""))
        .otherwise(F.col("c_custkey").cast("string"))
        .alias("prefix"),
    )
    return sets.select(
        "set_id",
        names.folder_name("set_id").alias("folder"),
        names.subset_name("set_id", "prefix").alias("subset"),
        names.target_name("set_id", "prefix").alias("target"),
    )


@query(
    "capitalized_types",
    """SELECT event_id, upper(left(event_type, 1)) || substr(event_type, 2) AS name
       FROM events""",
)
def _(t: Tables):
    return t.events.select("event_id", names.capitalized("event_type").alias("name"))


@query(
    "snapshot_ids",
    """SELECT event_id, CASE WHEN event_type = 'signup'
              THEN printf('%08x', CAST(event_id AS BIGINT)) END AS version_id
       FROM events""",
)
def _(t: Tables):
    line = F.when(
        F.col("event_type") == "signup",
        F.concat(F.lit("snapshot "), F.format_string("%08x", "event_id"), F.lit(" saved")),
    ).otherwise(F.col("event_type"))
    return t.events.select("event_id", names.snapshot_id(line).alias("version_id"))


@query(
    "batch_sizes",
    """SELECT c_custkey AS subset_size,
              CAST(CASE WHEN c_custkey < 500 THEN least(c_custkey, 10)
                   WHEN c_custkey < 50000 THEN 30 ELSE 100 END AS INTEGER) AS batch_size
       FROM customer
       UNION ALL
       SELECT c_custkey * 1000,
              CAST(CASE WHEN c_custkey * 1000 < 500 THEN least(c_custkey * 1000, 10)
                   WHEN c_custkey * 1000 < 50000 THEN 30 ELSE 100 END AS INTEGER)
       FROM customer""",
)
def _(t: Tables):
    sizes = t.customer.select(F.col("c_custkey").alias("subset_size"))
    sizes = sizes.union(sizes.select(F.col("subset_size") * 1000))
    return sizes.withColumn("batch_size", names.batch_size("subset_size"))
