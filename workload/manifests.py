"""Manifest documents made from the page rows, and what is read out of them."""

from pyspark.sql import functions as F

from bindery.functions import files, ids
from bindery.operators import fetching, manifests
from bindery.sources.manifests import manifests_of
from workload.identifiers import DATED_SQL, dated_text
from workload.registry import BASE, PAGE_IMAGES_SQL, Tables, image_location, query

HEAD = (
    '<mets xmlns="http://www.loc.gov/METS/" xmlns:xlink="http://www.w3.org/1999/xlink">'
    "<fileSec>"
)


def group(group_id, use, members):
    return F.concat(
        F.lit(f'<fileGrp ID="{group_id}" USE="{use}">'),
        F.array_join(members, ""),
        F.lit("</fileGrp>"),
    )


def element(attributes, *locations):
    parts = [F.lit("<file "), attributes, F.lit(">")]
    for location in locations:
        parts += [F.lit('<FLocat xlink:href="'), location, F.lit('"/>')]
    return F.concat(*parts, F.lit("</file>"))


def attribute(name, value):
    return F.concat(F.lit(f'{name}="'), value.cast("string"), F.lit('"'))


def manifest_docs(t: Tables, faulty: bool = False):
    """A manifest per binding: two image groups, the texts, and a target image.

    Pages flagged A are in the second group, with GROUPID for their number. The
    faulty form breaks some documents in one of three ways.
    """
    docs = t.pages_of_bindings

    def image(number):
        def build(page):
            location = image_location(page["page_number"], page["flag"])
            single = element(attribute(number, page["page_number"]), location)
            if not faulty:
                return single
            n, flag = page["page_number"], page["flag"]
            twice = element(attribute(number, n), location, F.lit("again"))
            return (
                F.when((n == 7) & (flag == "R"), twice)
                .when((n == 6) & (flag == "A"), element(F.lit('SEQ="vi"'), F.lit("a.jp2")))
                .otherwise(single)
            )

        return build

    first = F.filter("p", lambda p: p["flag"] != "A")
    second = F.filter("p", lambda p: p["flag"] == "A")
    text = F.transform(
        "p",
        lambda p: element(
            F.lit('ID="T"'), F.concat(F.lit("alto/"), p["page_number"].cast("string"))
        ),
    )
    target = F.array(element(F.lit('SEQ="1"'), F.lit("target.jp2")))
    tail = F.lit("</fileSec></mets>")
    if faulty:
        broken = F.exists("p", lambda p: (p["page_number"] == 5) & (p["flag"] == "N"))
        tail = F.when(broken, F.lit("</fileSec>")).otherwise(tail)
    xml = F.concat(
        F.lit(HEAD),
        group("IMGGRP", "Images", F.transform(first, image("SEQ"))),
        group("ACIMGGRP", "reference", F.transform(second, image("GROUPID"))),
        group("ALTOGRP", "Text", text),
        group("TARGETIMGGRP", "Target images", target),
        tail,
    )
    return docs.select("binding_id", "dc_identifier", xml.alias("xml"))


# Files of a manifest in its order: images by group and page, then their texts.
FILES_SQL = f"""{PAGE_IMAGES_SQL}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY binding_id
              ORDER BY flag = 'A', page_number) - 1 AS place,
         count(*) OVER (PARTITION BY binding_id) AS n
  FROM page_images),
manifest_files AS (
  SELECT binding_id, dc_identifier, CAST(place AS INTEGER) AS position,
         'access_img' AS kind, page_number,
         'file://./img/pr-' || printf('%05d', page_number) || suffix AS location_xlink,
         printf('%05d', page_number) || suffix AS filename,
         dc_identifier || '/image/' || page_number AS download_url
  FROM placed
  UNION ALL
  SELECT binding_id, dc_identifier, CAST(place + n AS INTEGER), 'alto', page_number, NULL,
         printf('%05d', page_number) || '.xml',
         dc_identifier || '/page-' || page_number || '.xml'
  FROM placed)"""


@query(
    "manifest_elements",
    f"""WITH {PAGE_IMAGES_SQL}, e AS (
          SELECT binding_id, flag = 'A' AS g, page_number AS p,
                 CASE WHEN flag = 'A' THEN 'ACIMGGRP' ELSE 'IMGGRP' END AS group_id,
                 'file://./img/pr-' || printf('%05d', page_number) || suffix AS location
          FROM page_images
          UNION ALL
          SELECT binding_id, 2, page_number, 'ALTOGRP', 'alto/' || page_number
          FROM page_images
          UNION ALL
          SELECT DISTINCT binding_id, 3, 1, 'TARGETIMGGRP', 'target.jp2' FROM page_images)
        SELECT binding_id, group_id, location,
               CAST(row_number() OVER (PARTITION BY binding_id ORDER BY g, p) - 1
                    AS INTEGER) AS position
        FROM e""",
)
def _(t: Tables):
    found = manifests.manifest_elements(manifests.parse_manifests(manifest_docs(t)))
    return found.select("binding_id", "position", "group_id", "location")


@query(
    "manifest_files",
    f"""WITH {FILES_SQL} SELECT binding_id, position, kind, page_number, location_xlink,
               filename, download_url FROM manifest_files""",
)
def _(t: Tables):
    found = manifests.manifest_files(manifests.parse_manifests(manifest_docs(t)))
    return found.drop("dc_identifier")


@query(
    "manifest_faults",
    f"""WITH {PAGE_IMAGES_SQL}
        SELECT binding_id, CASE
                 WHEN bool_or(page_number = 5 AND flag = 'N') THEN 'malformed'
                 WHEN bool_or(page_number = 7 AND flag = 'R') THEN 'location_count'
                 ELSE 'page_number' END AS manifest_error
        FROM page_images GROUP BY binding_id
        HAVING bool_or((page_number = 5 AND flag = 'N') OR (page_number = 7 AND flag = 'R')
                       OR (page_number = 6 AND flag = 'A'))""",
)
def _(t: Tables):
    parsed = manifests.parse_manifests(manifest_docs(t, faulty=True))
    return manifests.faulty_manifests(parsed).select("binding_id", "manifest_error")


@query(
    "files_of_good_manifests",
    f"""WITH {FILES_SQL}, faulty AS (
          SELECT DISTINCT binding_id FROM page_images
          WHERE (page_number = 5 AND flag = 'N') OR (page_number = 7 AND flag = 'R')
             OR (page_number = 6 AND flag = 'A'))
        SELECT binding_id, kind, filename FROM manifest_files
        WHERE binding_id NOT IN (SELECT binding_id FROM faulty)""",
)
def _(t: Tables):
    parsed = manifests.parse_manifests(manifest_docs(t, faulty=True))
    found = manifests.manifest_files(parsed, on_error="reject")
    return found.select("binding_id", "kind", "filename")


@query(
    "archived_manifests",
    f"""WITH {PAGE_IMAGES_SQL}
        SELECT binding_id, count(*) AS n_pages, max(page_number) AS last_page
        FROM page_images GROUP BY binding_id""",
)
def _(t: Tables):
    """Pages by the manifests of an archive table, which holds them as bytes."""
    held = manifest_docs(t).select(
        "binding_id",
        F.concat("binding_id", F.lit("_METS.xml")).alias("path"),
        F.lit(files.METS).alias("kind"),
        F.encode("xml", "utf-8").alias("content"),
    )
    docs = manifests_of(held).withColumn("dc_identifier", F.col("binding_id"))
    found = manifests.manifest_files(manifests.parse_manifests(docs))
    images = manifests.files_of_kind(found, files.ACCESS_IMAGE)
    return images.groupBy("binding_id").agg(
        F.count("*").alias("n_pages"), F.max("page_number").alias("last_page")
    )


@query(
    "text_files",
    f"""WITH {FILES_SQL} SELECT binding_id, page_number, filename
        FROM manifest_files WHERE kind = 'alto'""",
)
def _(t: Tables):
    found = manifests.manifest_files(manifests.parse_manifests(manifest_docs(t)))
    return manifests.files_of_kind(found, files.ALTO).select(
        "binding_id", "page_number", "filename"
    )


@query(
    "images_with_texts",
    f"""WITH {PAGE_IMAGES_SQL}
        SELECT binding_id, kind, page_number FROM page_images,
               (VALUES ('access_img'), ('alto')) k(kind)""",
)
def _(t: Tables):
    return manifests.altos_for_images(t.page_images).select(
        "binding_id", "kind", "page_number"
    )


@query(
    "download_urls",
    f"""WITH {FILES_SQL} SELECT binding_id, position, kind, page_number, download_url
        FROM manifest_files""",
)
def _(t: Tables):
    found = manifests.manifest_files(manifests.parse_manifests(manifest_docs(t)))
    return manifests.download_urls(manifests.in_manifest_order(found))


def landed_responses(t: Tables):
    """Responses to the requests for all manifests and page files, by URL.

    Manifests of bindings 4... are empty. Images flagged R are not found, and those
    flagged A may not be read. The content of a page file is its URL.
    """
    empty = F.col("binding_id").startswith("4")
    of_manifests = manifest_docs(t).select(
        ids.mets_url("dc_identifier").alias("url"),
        F.lit(200).alias("status"),
        F.encode(F.when(empty, F.lit("")).otherwise(F.col("xml")), "utf-8").alias("content"),
    )
    pages = manifests.with_names(manifests.altos_for_images(t.page_images))
    image, flag = F.col("kind") == files.ACCESS_IMAGE, F.col("flag")
    status = (
        F.when(image & (flag == "R"), F.lit(404))
        .when(image & (flag == "A"), F.lit(401))
        .otherwise(F.lit(200))
    )
    of_pages = pages.select(
        F.col("download_url").alias("url"),
        status.alias("status"),
        F.when(status == 200, F.encode("download_url", "utf-8")).alias("content"),
    )
    return of_manifests.unionByName(of_pages)


@query(
    "direct_downloads",
    f"""WITH {FILES_SQL}
        SELECT binding_id, position, CASE kind WHEN 'alto' THEN download_url END AS content,
               CASE kind WHEN 'alto' THEN 'downloads/' || binding_id || '/alto/' || filename
                    END AS output_path,
               CASE kind WHEN 'access_img' THEN 'No download URL available for file '
                    || location_xlink END AS message
        FROM manifest_files""",
)
def _(t: Tables):
    found = manifests.manifest_files(manifests.parse_manifests(manifest_docs(t)))
    got = fetching.direct_contents(fetching.direct_downloads(found), landed_responses(t))
    return got.select(
        "binding_id",
        "position",
        "output_path",
        "message",
        F.decode("content", "utf-8").alias("content"),
    )


def dated_docs(t: Tables):
    """A manifest per order with its date, and a later date that must not count."""
    xml = F.concat(
        F.lit('<m:mets xmlns:m="http://www.loc.gov/METS/" xmlns:d="http://www.loc.gov/mods/v3">'),
        F.lit("<m:dmdSec><d:dateIssued> "),
        dated_text(),
        F.lit("\n</d:dateIssued><d:dateIssued>1.1.2020</d:dateIssued></m:dmdSec></m:mets>"),
    )
    return t.spread(t.orders, "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("binding_id"), xml.alias("xml")
    )


@query(
    "issue_dates",
    f"""WITH {DATED_SQL}
        SELECT binding_id, date_text, strftime(date_issued, '%Y-%m-%d') AS date_issued
        FROM dated""",
)
def _(t: Tables):
    return manifests.date_issued(dated_docs(t)).withColumn(
        "date_issued", F.col("date_issued").cast("string")
    )


@query(
    "issue_date_range",
    f"""WITH {DATED_SQL}
        SELECT binding_id FROM dated
        WHERE date_issued BETWEEN DATE '1996-02-03' AND DATE '1999-01-01'""",
)
def _(t: Tables):
    dated = manifests.date_issued(dated_docs(t))
    return manifests.issued_between(dated, "3.2.1996", "1999").select("binding_id")


@query(
    "issues_since",
    f"""WITH {DATED_SQL}
        SELECT binding_id FROM dated WHERE date_issued >= DATE '1998-01-01'""",
)
def _(t: Tables):
    dated = manifests.date_issued(dated_docs(t))
    return manifests.issued_between(dated, start="1998").select("binding_id")
