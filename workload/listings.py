"""Listing scans, lists and runs over whole tables."""

from pyspark.sql import functions as F

from bindery.plans import listing, runs
from bindery.sources import listings, lists, page_index
from bindery.streaming import changes as stream_changes
from bindery.streaming import listing as stream
from workload.registry import BASE, Tables, query


def header(sets, status="''"):
    """Header element of each order, as text."""
    return F.concat(
        F.lit("<header"),
        F.expr(status),
        F.lit("><identifier>oai:host:"),
        F.col("o_orderkey").cast("string"),
        F.lit("</identifier><datestamp>"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("</datestamp>"),
        *[F.concat(F.lit("<setSpec>"), s, F.lit("</setSpec>")) for s in sets],
        F.lit("</header>"),
    )


def page(verb, body):
    return F.concat(
        F.lit(f'<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><{verb}>'),
        body,
        F.lit(f"</{verb}></OAI-PMH>"),
    )


def identifier_pages(t: Tables):
    """Response pages of the orders, requested by priority."""
    return t.spread(t.orders, "o_orderkey").select(
        F.col("o_orderpriority").alias("set_id"),
        page("ListIdentifiers", header([F.col("o_orderpriority"), F.col("o_orderstatus")])).alias("xml"),
    )


def deleted_pages(t: Tables):
    """Response pages of deleted records: each names its priority and a subset."""
    subset = F.concat_ws(":", "o_orderpriority", "o_orderstatus")
    body = header([F.col("o_orderpriority"), subset], "' status=\"deleted\"'")
    record = F.concat(F.lit("<record>"), body, F.lit("</record>"))
    return t.spread(t.orders, "o_orderkey").select(
        page("ListRecords", record).alias("xml")
    )


@query(
    "listed_identifiers",
    f"""SELECT o_orderpriority AS set_id, '{BASE}' || o_orderkey AS dc_identifier
        FROM orders WHERE o_orderdate >= TIMESTAMP '1997-07-01'""",
)
def _(t: Tables):
    headers = listings.parse_headers(identifier_pages(t))
    return listings.list_identifiers(headers, BASE, "1997-07-01")


@query(
    "landed_identifiers",
    f"""SELECT o_orderpriority AS set_id, '{BASE}' || o_orderkey AS dc_identifier
        FROM orders WHERE o_orderdate >= TIMESTAMP '1997-07-01'""",
)
def _(t: Tables):
    return listings.list_identifiers(
        listings.read_headers(t.spark, landed(t)), BASE, "1997-07-01"
    )


def landed(t: Tables) -> str:
    """Land the orders as listing files of their priority's set."""
    folder = t.scratch("landing")
    t.orders.select(
        F.col("o_orderpriority").alias("set_id"),
        F.concat(F.lit("oai:host:"), F.col("o_orderkey").cast("string")).alias("identifier"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datestamp"),
        F.array("o_orderpriority", "o_orderstatus").alias("setSpec"),
    ).write.format("xml").options(rootTag="ListIdentifiers", rowTag="header").partitionBy(
        "set_id"
    ).save(folder)
    return folder


@query(
    "streamed_identifiers",
    f"""SELECT o_orderpriority AS set_id, '{BASE}' || o_orderkey AS dc_identifier
        FROM orders""",
)
def _(t: Tables):
    target, checkpoint = t.scratch("identifiers"), t.scratch("progress")
    headers = stream.stream_headers(t.spark, landed(t))
    done = stream.append_new_identifiers(headers, BASE, target, checkpoint)
    done.awaitTermination()
    found = t.spark.read.schema("dc_identifier STRING, set_id STRING").parquet(target)
    return found.select("set_id", "dc_identifier")


def land(t: Tables, rows, folder: str, mode: str = "append") -> None:
    """Land orders as pages of their priority's set, or as deleted records."""
    rows.select(
        F.col("set_id"),
        F.concat(F.lit("oai:host:"), F.col("o_orderkey").cast("string")).alias("identifier"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datestamp"),
        F.array("o_orderpriority", "o_orderstatus").alias("setSpec"),
    ).write.mode(mode).format("xml").options(rootTag="ListIdentifiers", rowTag="header").partitionBy(
        "set_id"
    ).save(folder)


def priorities(t: Tables):
    return t.orders.select(F.col("o_orderpriority").alias("set_id")).distinct()


@query(
    "indexed_listing",
    f"""WITH last_runs AS (
          SELECT o_orderpriority AS set_id, CAST(max(o_orderdate) - INTERVAL 100 DAY AS DATE) AS last_run
          FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority)
        SELECT o_orderpriority AS set_id, CASE o_orderstatus WHEN 'F' THEN 'deleted' ELSE 'added' END AS kind,
               '{BASE}' || o_orderkey AS dc_identifier
        FROM orders LEFT JOIN last_runs ON o_orderpriority = set_id
        WHERE last_run IS NULL OR o_orderdate >= last_run""",
)
def _(t: Tables):
    """The listing job over pages of four landings, by an index that each one extends."""
    added, deleted, index, root = (
        t.scratch(name) for name in ("landing", "deleted", "index", "lists")
    )
    sets = priorities(t)
    of_set = F.col("o_orderpriority")
    old = F.col("o_orderdate") < "1995-01-01"
    for part in (old, ~old):
        rows = t.orders.where(part).repartitionByRange(4, "o_orderdate")
        land(t, rows.where("o_orderstatus <> 'F'").withColumn("set_id", of_set), added)
        land(t, rows.where("o_orderstatus = 'F'").withColumn("set_id", F.lit("gone")), deleted)
        page_index.update_index(t.spark, added, f"{index}/added", page_index.requested_set())
    last = F.max("o_orderdate") - F.expr("INTERVAL 100 DAYS")
    history = t.orders.where("o_orderpriority <> '5-LOW'").groupBy(of_set.alias("set_id")).agg(
        F.lit("r").alias("run_id"), F.lit("success").alias("state"), last.alias("execution_date")
    )
    listing.run_listing(
        t.spark, added, deleted, sets, BASE, "2024-05-01", root, history, index
    )
    found = lists.read_binding_lists(t.spark, root)
    return found.select("set_id", "kind", "dc_identifier")


@query(
    "streamed_changes",
    f"""SELECT '2024-05-01' AS list_date, o_orderpriority AS set_id, 'added' AS kind,
               '{BASE}' || o_orderkey AS dc_identifier
        FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
        UNION ALL
        SELECT '2024-06-01', o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'deleted' ELSE 'added' END,
               '{BASE}' || o_orderkey
        FROM orders WHERE o_orderstatus = 'F' OR o_orderdate >= TIMESTAMP '1996-01-01'""",
)
def _(t: Tables):
    """Two landings of the stream, a list of each.

    The second one lands the later orders, all of the first one again, and the deletion
    of fulfilled orders, of which some were not heard of before.
    """
    added, deleted, root, progress = (
        t.scratch(name) for name in ("landing", "deleted", "lists", "progress")
    )
    orders = t.orders.withColumn("set_id", F.col("o_orderpriority"))
    early = orders.where("o_orderdate < TIMESTAMP '1996-01-01'")
    late = orders.where("o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus <> 'F'")
    gone = orders.where("o_orderstatus = 'F'").withColumn("set_id", F.lit("gone"))
    for day, some, without in (("2024-05-01", early, gone.limit(0)), ("2024-06-01", late.unionByName(early), gone)):
        land(t, some, added)
        land(t, without, deleted)
        headers = (stream.stream_headers(t.spark, folder) for folder in (added, deleted))
        done = stream_changes.write_changes(
            stream_changes.header_changes(*headers, BASE), priorities(t), day, root, progress
        )
        done.awaitTermination()
    found = lists.read_binding_lists(t.spark, root)
    return found.select(
        F.date_format("list_date", "yyyy-MM-dd").alias("list_date"), "set_id", "kind", "dc_identifier"
    )


@query(
    "deleted_since",
    f"""SELECT o_orderpriority AS set_id, '{BASE}' || o_orderkey AS dc_identifier
        FROM orders WHERE o_orderpriority = '1-URGENT'
          AND o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def _(t: Tables):
    headers = listings.parse_headers(deleted_pages(t))
    return listings.list_deleted(headers, BASE, "1-URGENT", "1998-01-01")


@query(
    "deleted_of_all_sets",
    f"""SELECT o_orderpriority AS set_id, '{BASE}' || o_orderkey AS dc_identifier
        FROM orders
        UNION ALL
        SELECT o_orderpriority || ':' || o_orderstatus, '{BASE}' || o_orderkey
        FROM orders""",
)
def _(t: Tables):
    return listings.list_deleted(listings.parse_headers(deleted_pages(t)), BASE)


@query(
    "listed_sets",
    """SELECT r_name || ':' || n_name AS set_id, 'Set ' || n_nationkey AS set_name
       FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def _(t: Tables):
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    body = F.concat(
        F.lit("<set><setSpec>"),
        F.concat_ws(":", "r_name", "n_name"),
        F.lit("</setSpec><setName>Set "),
        F.col("n_nationkey").cast("string"),
        F.lit("</setName></set>"),
    )
    return listings.parse_sets(nations.select(page("ListSets", body).alias("xml")))


@query(
    "incomplete_listings",
    """SELECT o_custkey, count(*) AS complete_list_size,
              count(*) FILTER (o_orderstatus <> 'P') AS n_headers
       FROM orders GROUP BY o_custkey
       HAVING count(*) FILTER (o_orderstatus <> 'P') <> count(*)""",
)
def _(t: Tables):
    announced = t.orders.groupBy("o_custkey").count()
    token = F.concat(
        F.lit('<resumptionToken cursor="0" completeListSize="'),
        F.col("count").cast("string"),
        F.lit('">t</resumptionToken>'),
    )
    tokens = announced.select("o_custkey", page("ListIdentifiers", token).alias("xml"))
    orders = t.spread(t.orders.where("o_orderstatus <> 'P'"), "o_orderkey")
    listed = orders.select(
        "o_custkey", page("ListIdentifiers", header([F.col("o_orderstatus")])).alias("xml")
    )
    return listings.incomplete_listings(
        listings.parse_headers(listed), listings.parse_page_tokens(tokens), ["o_custkey"]
    )


def dated_lists(t: Tables):
    """Lists per customer and day of the order, with their markers."""
    found = t.bindings.select(
        F.col("o_custkey").cast("string").alias("set_id"),
        "kind",
        F.to_date("o_orderdate").alias("list_date"),
        "dc_identifier",
    )
    markers = found.groupBy("set_id", "kind", "list_date").agg(F.count("*").alias("n_rows"))
    return found, markers


LATEST_SQL = f"""lists AS (
  SELECT CAST(o_custkey AS VARCHAR) AS set_id, o_orderdate AS list_date,
         CASE WHEN o_orderstatus = 'F' THEN 'deleted' ELSE 'added' END AS kind,
         '{BASE}' || o_orderkey AS dc_identifier
  FROM orders),
latest AS (
  SELECT * FROM lists
  WHERE (set_id, list_date) IN (SELECT (set_id, max(list_date)) FROM lists GROUP BY set_id))"""


@query(
    "latest_list",
    f"WITH {LATEST_SQL} SELECT set_id, kind, dc_identifier FROM latest",
)
def _(t: Tables):
    found, markers = dated_lists(t)
    return lists.latest_lists(found, markers).select("set_id", "kind", "dc_identifier")


@query(
    "latest_list_dates",
    """SELECT CAST(o_custkey AS VARCHAR) AS set_id,
              strftime(max(o_orderdate), '%Y-%m-%d') AS list_date
       FROM orders GROUP BY o_custkey""",
)
def _(t: Tables):
    _, markers = dated_lists(t)
    return lists.latest_list_dates(markers).select(
        "set_id", F.col("list_date").cast("string").alias("list_date")
    )


@query(
    "stored_lists",
    f"""SELECT o_orderpriority AS set_id,
               CASE WHEN o_orderstatus = 'F' THEN 'deleted' ELSE 'added' END AS kind,
               '{BASE}' || o_orderkey AS dc_identifier
        FROM orders WHERE o_orderstatus <> 'O'""",
)
def _(t: Tables):
    """Two days' lists are written; the second day's are the latest."""
    root = t.scratch("lists")
    found = t.bindings.join(
        t.orders.select(F.col("o_orderkey").cast("string").alias("binding_id"), "o_orderpriority"),
        "binding_id",
    ).withColumn("set_id", F.col("o_orderpriority"))
    sets = t.orders.select(F.col("o_orderpriority").alias("set_id")).distinct()
    lists.write_binding_lists(found, sets, "2024-01-31", root)
    lists.write_binding_lists(
        found.where("o_orderstatus <> 'O'"), sets, "2024-02-29", root
    )
    latest = lists.latest_lists(
        lists.read_binding_lists(t.spark, root), lists.read_list_markers(t.spark, root)
    )
    return latest.select("set_id", "kind", "dc_identifier")


def run_history(t: Tables):
    """Events as runs of sets: a user is a set, the kind of event its state."""
    return t.events.select(
        F.col("user_id").cast("string").alias("set_id"),
        F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "purchase", F.lit("success"))
        .when(F.col("event_type") == "view", F.lit("running"))
        .otherwise(F.lit("failed"))
        .alias("state"),
        F.col("ts").alias("execution_date"),
    )


@query(
    "last_successful_runs",
    """SELECT CAST(user_id AS VARCHAR) AS set_id,
              CAST(arg_max(event_id, ts) AS VARCHAR) AS run_id,
              strftime(max(ts), '%Y-%m-%d') AS last_run
       FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
)
def _(t: Tables):
    return runs.last_successful_runs(run_history(t)).withColumn(
        "last_run", F.col("last_run").cast("string")
    )


@query(
    "newest_running",
    """SELECT CAST(user_id AS VARCHAR) AS set_id,
              CAST(arg_max(event_id, ts) AS VARCHAR) AS run_id
       FROM events WHERE event_type = 'view' GROUP BY user_id""",
)
def _(t: Tables):
    return runs.newest_running(run_history(t)).select("set_id", "run_id")


@query(
    "newest_run",
    """SELECT CAST(user_id AS VARCHAR) AS set_id, CAST(event_id AS VARCHAR) AS run_id
       FROM events ORDER BY ts DESC LIMIT 1""",
)
def _(t: Tables):
    """Newest first, take one."""
    return runs.newest_first(run_history(t)).select("set_id", "run_id").limit(1)


@query(
    "incremental_listing",
    f"""WITH last_runs AS (
          SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_run
          FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
        SELECT CAST(o.o_custkey AS VARCHAR) AS set_id, 'added' AS kind,
               '{BASE}' || o_orderkey AS dc_identifier
        FROM orders o LEFT JOIN last_runs r ON o.o_custkey = r.o_custkey
        WHERE o_orderstatus <> 'F' AND (last_run IS NULL OR o_orderdate >= last_run)
        UNION ALL
        SELECT CAST(o.o_custkey AS VARCHAR), 'deleted', '{BASE}' || o_orderkey
        FROM orders o LEFT JOIN last_runs r ON o.o_custkey = r.o_custkey
        WHERE o_orderstatus = 'F' AND (last_run IS NULL OR o_orderdate >= last_run)""",
)
def _(t: Tables):
    """Listing since each set's last run; a customer is a set."""
    set_id = F.col("o_custkey").cast("string")
    history = t.orders.select(
        set_id.alias("set_id"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.when(F.col("o_orderstatus") == "O", F.lit("success")).alias("state"),
        F.col("o_orderdate").alias("execution_date"),
    )

    def headers(where):
        pages = t.spread(t.orders.where(where), "o_orderkey").select(
            set_id.alias("set_id"),
            page("ListIdentifiers", header([set_id])).alias("xml"),
        )
        return listings.parse_headers(pages)

    return listing.listed_changes(
        headers("o_orderstatus <> 'F'"),
        headers("o_orderstatus = 'F'").drop("set_id"),
        BASE,
        runs.last_successful_runs(history),
    )


@query(
    "expected_id_list",
    """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS binding_id FROM lineitem""",
)
def _(t: Tables):
    lines = t.lineitem.select(
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit(" \t")).alias("value")
    )
    return lists.expected_ids(lines, "value")


GATE_SQL = f"""WITH {LATEST_SQL}, counts AS (
  SELECT set_id, count(*) FILTER (kind = 'added') AS n_added,
         count(*) FILTER (kind = 'deleted') AS n_deleted
  FROM latest GROUP BY set_id),
sets AS (
  SELECT CAST(c_custkey AS VARCHAR) AS set_id, c_acctbal >= 0 AS source_ok,
         c_nationkey AS try_number, 12 AS max_tries FROM customer)
SELECT s.set_id, coalesce(n_added, 0) AS n_added, coalesce(n_deleted, 0) AS n_deleted,
       CASE WHEN n_added IS NULL THEN 'cancel' WHEN source_ok THEN 'begin'
            WHEN try_number < max_tries THEN 'retry' ELSE 'cancel' END AS decision
FROM sets s LEFT JOIN counts c ON s.set_id = c.set_id"""


@query("update_gates", GATE_SQL)
def _(t: Tables):
    found, markers = dated_lists(t)
    sets = t.customer.select(
        F.col("c_custkey").cast("string").alias("set_id"),
        (F.col("c_acctbal") >= 0).alias("source_ok"),
        F.col("c_nationkey").alias("try_number"),
        F.lit(12).alias("max_tries"),
    )
    return runs.update_gates(sets, lists.latest_lists(found, markers)).select(
        "set_id", "n_added", "n_deleted", "decision"
    )


@query(
    "text_lists",
    f"""SELECT CASE o_orderstatus WHEN 'F' THEN 'deleted' ELSE 'added' END AS kind,
               '{BASE}' || o_orderkey AS dc_identifier,
               CAST(o_orderkey AS VARCHAR) AS binding_id
        FROM orders WHERE o_orderstatus <> 'P'""",
)
def _(t: Tables):
    """Text lists of two days; the newest of each kind is read."""
    root = t.scratch("text-lists")

    def write(name, condition):
        t.bindings.where(condition).select("dc_identifier").write.text(f"{root}/col_7/{name}")

    write("added_2024-01-31", "o_orderstatus = 'P'")
    write("added_2024-02-29", "o_orderstatus = 'O'")
    write("deleted_2024-02-29", "o_orderstatus = 'F'")
    found = [
        lists.read_latest_list(t.spark, root, "col:7", kind).withColumn("kind", F.lit(kind))
        for kind in ("added", "deleted")
    ]
    return found[0].unionByName(found[1])
