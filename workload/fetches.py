"""Fetch plans, the fetch job, and the fetch log over whole tables."""

from pyspark.sql import functions as F

from bindery.functions import files, ids
from bindery.operators import fetching, manifests, outcomes
from bindery.plans import download
from bindery.plans.stages import stored
from workload.manifests import landed_responses
from workload.planning import NUMBERED_SQL, routed
from workload.registry import (
    BASE,
    PAGE_FILES_SQL,
    PAGE_IMAGES_SQL,
    Tables,
    binding_dir_sql,
    query,
)


def placed_plan(images):
    """Page files of images with their path and their binding's directory."""
    placed = images.withColumn("directory", ids.binding_dir("binding_id"))
    return fetching.page_plan(manifests.with_names(manifests.altos_for_images(placed)))


def page_plan(t: Tables):
    """All page files with their path; ``flag`` of the page is kept."""
    return placed_plan(t.page_images).drop("directory")


PLAN_SQL = f"""{PAGE_FILES_SQL}, plan AS (
  SELECT f.*, i.flag, {binding_dir_sql("f.binding_id")} || '/' || f.kind || '/' || filename AS path
  FROM page_files f JOIN page_images i
    ON f.binding_id = i.binding_id AND f.page_number = i.page_number)"""


def held_files(t: Tables):
    """Held files: those of pages not flagged R; flag A left them empty."""
    size = F.when(F.col("flag") == "A", F.lit(0)).otherwise(F.lit(100))
    return page_plan(t).where("flag <> 'R'").select("path", size.alias("size"))


@query(
    "skip_existing",
    f"WITH {PLAN_SQL} SELECT path FROM plan WHERE flag <> 'N'",
)
def _(t: Tables):
    return fetching.not_present(page_plan(t), held_files(t)).select("path")


@query(
    "already_present",
    f"WITH {PLAN_SQL} SELECT path FROM plan WHERE flag = 'N'",
)
def _(t: Tables):
    return fetching.already_present(page_plan(t), held_files(t)).select("path")


@query(
    "skip_existing_manifests",
    f"""WITH b AS (SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders
                   WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
        SELECT id AS binding_id, {binding_dir_sql("id")} || '/mets/' || id || '_METS.xml' AS path,
               '{BASE}' || id || '/mets.xml?full=true' AS download_url FROM b""",
)
def _(t: Tables):
    """Manifests of the bindings that have pages are held already."""
    held = t.lineitem.select(F.col("l_orderkey").cast("string").alias("binding_id")).distinct()
    paths = fetching.entry_path(
        "binding_id", F.lit(files.METS), F.concat("binding_id", F.lit("_METS.xml"))
    )
    held = held.select(paths.alias("path"), F.lit(1).alias("size"))
    plan = fetching.manifest_plan(t.bindings)
    return fetching.not_present(plan, held).select("binding_id", "path", "download_url")


@query(
    "pages_with_manifest",
    f"""WITH {PLAN_SQL} SELECT path FROM plan
        WHERE binding_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders
                             WHERE o_orderstatus = 'F')""",
)
def _(t: Tables):
    """Manifests came for orders F and O, but those of O are empty."""
    arrived = t.bindings.where("o_orderstatus <> 'P'").select(
        "binding_id",
        F.when(F.col("o_orderstatus") == "F", F.lit(9)).otherwise(F.lit(0)).alias("n_bytes"),
    )
    return fetching.with_manifest(page_plan(t), arrived).select("path")


def flagged_response(url: str):
    """Answer to a URL that ends in its page's flag; the content is the URL."""
    flag = url[-1]
    if flag == "A":
        return 401, b""
    if flag == "R":
        return 404, b""
    return 200, url.encode()


@query(
    "fetched_files",
    f"""WITH {PLAN_SQL}
        SELECT path, CAST(CASE flag WHEN 'A' THEN 401 WHEN 'R' THEN 404 ELSE 200 END
                          AS INTEGER) AS status,
               CASE flag WHEN 'N' THEN CAST(length(download_url) + 2 AS BIGINT) END AS n_bytes,
               CASE flag WHEN 'N' THEN download_url || '?' || flag END AS content
        FROM plan""",
)
def _(t: Tables):
    """The fetch job, written and read back; the page's flag decides the answer."""
    plan = page_plan(t).withColumn(
        "download_url", F.concat_ws("?", "download_url", "flag")
    )
    # Stored, since partitioning by ranges reads the plan twice.
    plan = stored(plan, t.scratch("plan"))
    got = fetching.write_fetched(
        fetching.fetch(plan, flagged_response), t.scratch("fetched")
    )
    return got.select(
        "path", "status", "n_bytes", F.decode("content", "utf-8").alias("content")
    )


@query(
    "stowed_batches",
    f"""WITH {NUMBERED_SQL}, {PAGE_IMAGES_SQL}, logged AS (
          SELECT subset_id, 'mets' AS kind,
                 CASE WHEN p.binding_id IS NULL THEN 'no_response'
                      WHEN left(b.binding_id, 1) = '4' THEN 'empty' ELSE 'ok' END AS outcome
          FROM batched b LEFT JOIN (SELECT DISTINCT binding_id FROM page_images) p
            ON b.binding_id = p.binding_id
          UNION ALL
          SELECT subset_id, k.kind,
                 CASE WHEN k.kind = 'alto' OR flag = 'N' THEN 'ok'
                      WHEN flag = 'R' THEN 'not_found' ELSE 'unauthorized' END
          FROM batched b JOIN page_images p ON b.binding_id = p.binding_id,
               (VALUES ('alto'), ('access_img')) k(kind)
          WHERE left(b.binding_id, 1) <> '4')
        SELECT subset_id, kind, outcome, count(*) AS n_files,
               CAST(sum(CASE outcome WHEN 'ok' THEN 1 ELSE 3 END) AS BIGINT) AS n_requests
        FROM logged GROUP BY subset_id, kind, outcome""",
)
def _(t: Tables):
    """Whole download with retries: files and requests by final outcome."""
    bindings = download.batched_bindings(routed(t))
    responses = fetching.deal_responses(landed_responses(t), t.scratch("responses"), t.page_tasks)
    staged = download.stow_with_retries(bindings, responses, t.scratch("staging"))
    last = outcomes.latest_attempts(staged.log, ["subset_id", "kind", "path"])
    return last.groupBy("subset_id", "kind", F.col("last_outcome").alias("outcome")).agg(
        F.count("*").alias("n_files"), F.sum("n_attempts").alias("n_requests")
    )


@query(
    "stowed_texts",
    f"""WITH {NUMBERED_SQL}, {PAGE_IMAGES_SQL}
        SELECT subset_id, b.binding_id, page_number,
               p.dc_identifier || '/page-' || page_number || '.xml' AS content
        FROM batched b JOIN page_images p ON b.binding_id = p.binding_id
        WHERE left(b.binding_id, 1) <> '4'""",
)
def _(t: Tables):
    """One attempt at the text files alone."""
    bindings = stored(
        download.batched_bindings(routed(t)), t.scratch("bindings"), compression="zstd"
    )
    responses = fetching.deal_responses(landed_responses(t), t.scratch("responses"), t.page_tasks)
    staged = download.stow(bindings, responses, t.scratch("staging"), kinds=[files.ALTO])
    return staged.content.where(F.col("kind") == files.ALTO).select(
        "subset_id", "binding_id", "page_number", F.decode("content", "utf-8").alias("content")
    )


def request_log(t: Tables):
    """Line items as requests: R not found, A unauthorised; odd ones as marked."""
    flag, kind = F.col("l_returnflag"), F.col("l_linestatus")
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("binding_id"),
        F.when(kind == "F", F.lit("alto")).otherwise(F.lit("access_img")).alias("kind"),
        F.col("l_linenumber").alias("page_number"),
        F.col("l_linenumber").alias("position"),
        F.when((flag == "N") & (F.col("l_tax") >= 0.07), F.lit(None))
        .when(flag == "R", F.lit(404))
        .when((flag == "A") & (F.col("l_discount") >= 0.09), F.lit(503))
        .when(flag == "A", F.lit(401))
        .otherwise(F.lit(200))
        .alias("status"),
        F.lit(None).cast("bigint").alias("n_bytes"),
        (F.col("l_quantity") >= 45).alias("skipped"),
    )


LOG_SQL = """log AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS binding_id,
         CASE l_linestatus WHEN 'F' THEN 'alto' ELSE 'access_img' END AS kind,
         l_linenumber AS position,
         CASE WHEN l_quantity >= 45 THEN 'skipped'
              WHEN l_returnflag = 'N' AND l_tax >= 0.07 THEN 'no_response'
              WHEN l_returnflag = 'R' THEN 'not_found'
              WHEN l_returnflag = 'A' AND l_discount >= 0.09 THEN 'error'
              WHEN l_returnflag = 'A' THEN 'unauthorized' ELSE 'ok' END AS outcome
  FROM lineitem)"""

STOPPED_SQL = f"""{LOG_SQL}, stops AS (
  SELECT binding_id, kind, min(position) AS stop FROM log
  WHERE outcome = 'error' GROUP BY binding_id, kind),
stopped AS (
  SELECT l.binding_id, l.kind, position,
         CASE WHEN position > stop THEN 'not_attempted' ELSE outcome END AS outcome
  FROM log l LEFT JOIN stops s ON l.binding_id = s.binding_id AND l.kind = s.kind),
counts AS (
  SELECT binding_id, kind, count(*) FILTER (outcome <> 'not_attempted') AS n_total,
         count(*) FILTER (outcome = 'not_found') AS n_404,
         count(*) FILTER (outcome = 'unauthorized') AS n_401,
         count(*) FILTER (outcome = 'no_response') AS n_no_response,
         count(*) FILTER (outcome = 'error') AS n_error,
         count(*) FILTER (outcome = 'skipped') AS n_skipped,
         bool_or(outcome IN ('not_found', 'unauthorized', 'no_response', 'error')) AS failed
  FROM stopped GROUP BY binding_id, kind)"""


def logged(t: Tables):
    return outcomes.with_outcomes(request_log(t))


@query(
    "request_outcomes",
    f"WITH {LOG_SQL} SELECT binding_id, kind, position, outcome FROM log",
)
def _(t: Tables):
    return logged(t).select("binding_id", "kind", "position", "outcome")


@query(
    "stopped_fetches",
    f"WITH {STOPPED_SQL} SELECT binding_id, kind, position, outcome FROM stopped",
)
def _(t: Tables):
    return outcomes.stop_at_errors(logged(t)).select(
        "binding_id", "kind", "position", "outcome"
    )


@query(
    "stopped_downloads",
    f"""WITH {PLAN_SQL}, requests AS (
          SELECT binding_id, kind, page_number,
                 CASE WHEN kind = 'access_img' AND flag = 'A' AND page_number % 2 = 1 THEN 'error'
                      WHEN flag = 'A' THEN 'unauthorized'
                      WHEN flag = 'R' THEN 'not_found' ELSE 'ok' END AS outcome
          FROM plan),
        ends AS (SELECT binding_id, kind, min(page_number) AS stop FROM requests
                 WHERE outcome = 'error' GROUP BY binding_id, kind)
        SELECT r.binding_id, r.kind, page_number,
               CASE WHEN page_number > stop THEN 'not_attempted' ELSE outcome END AS outcome,
               outcome = 'ok' AND (stop IS NULL OR page_number < stop) AS has_content
        FROM requests r LEFT JOIN ends e ON r.binding_id = e.binding_id AND r.kind = e.kind""",
)
def _(t: Tables):
    """Page files from landed responses; images flagged A end theirs on odd pages."""
    # Stored, since the responses are made of it and it is read in several steps.
    plan = stored(
        page_plan(t)
        .withColumn("position", F.col("page_number"))
        .select("binding_id", "kind", "page_number", "position", "flag", "download_url", "path"),
        t.scratch("plan"),
        compression="zstd",
    )
    odd = (F.col("kind") == files.ACCESS_IMAGE) & (F.col("page_number") % 2 == 1)
    responses = plan.select(
        F.col("download_url").alias("url"),
        F.when((F.col("flag") == "A") & odd, F.lit(500))
        .when(F.col("flag") == "A", F.lit(401))
        .when(F.col("flag") == "R", F.lit(404))
        .otherwise(F.lit(200))
        .alias("status"),
        F.encode("path", "utf-8").alias("content"),
    )
    found = outcomes.with_outcomes(fetching.from_responses(plan, responses))
    return found.select(
        "binding_id", "kind", "page_number", "outcome", F.col("content").isNotNull().alias("has_content")
    )


@query("fetch_outcomes", f"WITH {STOPPED_SQL} SELECT * FROM counts")
def _(t: Tables):
    return outcomes.outcome_counts(outcomes.stop_at_errors(logged(t)))


@query(
    "fetch_reports",
    f"""WITH {STOPPED_SQL}, lines AS (
          SELECT binding_id, kind, n_total, n_404 AS n, 'files failed with a 404' AS text
          FROM counts
          UNION ALL
          SELECT binding_id, kind, n_total, n_401, 'files failed with a 401' FROM counts
          UNION ALL
          SELECT binding_id, kind, n_total, n_skipped, 'were skipped as already downloaded'
          FROM counts)
        SELECT binding_id, kind, 'When downloading ' || kind || ' files for binding '
               || binding_id || ', ' || n || '/' || n_total || ' ' || text AS line
        FROM lines WHERE n > 0""",
)
def _(t: Tables):
    counts = outcomes.outcome_counts(outcomes.stop_at_errors(logged(t)))
    return outcomes.report_lines(counts)


@query(
    "binding_failures",
    f"""WITH {LOG_SQL} SELECT binding_id,
               bool_or(outcome IN ('not_found', 'unauthorized', 'no_response', 'error')) AS failed
        FROM log GROUP BY binding_id""",
)
def _(t: Tables):
    return outcomes.failures(logged(t), ["binding_id"])


@query(
    "manifest_outcomes",
    """SELECT CAST(o_orderkey AS VARCHAR) AS binding_id,
              CASE WHEN o_orderstatus = 'F' THEN 'empty' WHEN o_orderstatus = 'O' THEN 'ok'
                   ELSE 'no_response' END AS outcome FROM orders""",
)
def _(t: Tables):
    """Fetched manifests of status F are empty, those of P never came."""
    status = F.col("o_orderstatus")
    log = t.bindings.select(
        "binding_id",
        F.lit(files.METS).alias("kind"),
        F.when(status != "P", F.lit(200)).alias("status"),
        F.when(status == "F", F.lit(0)).when(status == "O", F.lit(7)).alias("n_bytes"),
    )
    return outcomes.with_outcomes(log).select("binding_id", "outcome")


def attempts(t: Tables):
    """Events as attempts at a user's file; errors and views failed."""
    kind = F.col("event_type")
    return t.events.select(
        F.col("user_id").cast("string").alias("binding_id"),
        "ts",
        F.when(kind == "error", F.lit("error"))
        .when(kind == "view", F.lit("not_found"))
        .otherwise(F.lit("ok"))
        .alias("outcome"),
    )


@query(
    "latest_attempts",
    """SELECT CAST(user_id AS VARCHAR) AS binding_id, count(*) AS n_attempts,
              CASE arg_max(event_type, ts) WHEN 'error' THEN 'error'
                   WHEN 'view' THEN 'not_found' ELSE 'ok' END AS last_outcome
       FROM events GROUP BY user_id""",
)
def _(t: Tables):
    return outcomes.latest_attempts(attempts(t), ["binding_id"], order="ts").drop("last_ts")


@query(
    "batch_verdicts",
    """WITH a AS (
         SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_type IN ('error', 'view') AS bad
         FROM events),
       b AS (
         SELECT user_id, CAST(date_diff('day', DATE '2024-01-01', day) AS INTEGER) AS attempt,
                bool_or(bad) AS failed FROM a GROUP BY ALL),
       c AS (
         SELECT user_id, max(attempt) AS attempt, arg_max(failed, attempt) AS failed
         FROM b GROUP BY user_id)
       SELECT CAST(user_id AS VARCHAR) AS binding_id, attempt, failed,
              CASE WHEN failed AND attempt < 3 THEN 'fail' ELSE 'proceed' END AS verdict
       FROM c""",
)
def _(t: Tables):
    """Every day with events is an attempt, numbered from the first day."""
    log = attempts(t).withColumn(
        "attempt", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    )
    return outcomes.batch_verdicts(log, ["binding_id"])


@query(
    "attempt_verdicts",
    """SELECT CAST(user_id AS VARCHAR) AS binding_id,
              CASE WHEN arg_max(event_type, ts) IN ('error', 'view') AND count(*) < 3
                   THEN 'fail' ELSE 'proceed' END AS verdict
       FROM events GROUP BY user_id""",
)
def _(t: Tables):
    last = outcomes.latest_attempts(attempts(t), ["binding_id"], order="ts")
    verdict = outcomes.verdict(outcomes.is_failure("last_outcome"), "n_attempts")
    return last.select("binding_id", verdict.alias("verdict"))


@query(
    "temporary_files",
    """SELECT CAST(l_orderkey AS VARCHAR) AS binding_id,
              bool_or(l_returnflag = 'R') AS has_tmp
       FROM lineitem GROUP BY l_orderkey""",
)
def _(t: Tables):
    path = files.page_filename("l_linenumber", F.lit(".jp2"))
    found = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("binding_id"),
        F.when(F.col("l_returnflag") == "R", files.tmp_path(path)).otherwise(path).alias("path"),
    )
    return outcomes.temporary_files(found, ["binding_id"])
