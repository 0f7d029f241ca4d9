"""Manifest documents as page-file rows, and issue dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery import schemas
from bindery.functions import dates, files, mets
from bindery.functions.ids import computed_once

# Faults of a file element, the most serious first.
FAULTS = ["location_count", "missing_location", mets.GROUP_ATTRIBUTES, mets.PAGE_NUMBER]

_XML = {
    "ignoreNamespace": "true",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "wildcardColName": "xs_any",
}
_CHILDREN = ["FLocat", "xs_any"]
# The first href of each child of a file element, whatever the child's name.
_HREFS = (
    "/*/*[local-name()='fileSec']/*[local-name()='fileGrp']/*[local-name()='file']"
    "/*/@*[local-name()='href'][1]"
)


def parse_manifests(docs: DataFrame, column: str = "xml") -> DataFrame:
    """Replace manifest text by ``elements`` and ``manifest_error``.

    ``elements`` are all file elements of the document in order, with their
    group. One faulty element makes the whole document fail; ``manifest_error``
    names the fault: ``malformed``, ``location_count``, ``missing_location``,
    ``group_attributes`` or ``page_number``. Everything happens inside the row,
    so reading a manifest does not shuffle. Documents of the usual form are read by
    ``mets.usual_elements``, at a fraction of the cost; ``from_xml`` reads all others.
    Those are read once more only if a file element's single child is no ``FLocat`` with
    an href.
    """
    keep = [c for c in docs.columns if c != column]
    read = docs.withColumn("_read", mets.usual_elements(F.col(column)))
    # Stops filters, which would be pushed below with a call of their own.
    read = computed_once(read, "_u", F.col("_read")).drop("_read")
    other = F.col("_u.elements").isNull()
    parsed = computed_once(
        read, "_m", F.when(other, F.from_xml(F.col(column), schemas.MANIFEST, _XML))
    )
    malformed = F.col("_m").isNull() | F.col("_m._corrupt_record").isNotNull()
    elements = F.when(
        other,
        F.struct(
            _elements(F.col("_m.fileSec.fileGrp")).alias("elements"),
            malformed.alias("malformed"),
        ),
    )
    found = computed_once(parsed, "_e", elements).drop("_m")
    located = computed_once(found, "_l", F.when(other, _located(F.col(column))))
    error = F.when(~other, F.col("_u.manifest_error")).otherwise(
        F.when(F.col("_e.malformed"), F.lit("malformed")).otherwise(_fault(F.col("_l")))
    )
    return computed_once(located, "manifest_error", error).select(
        *keep, F.coalesce("_u.elements", "_l").alias("elements"), "manifest_error"
    )


def _elements(groups: Column) -> Column:
    def of_group(group: Column) -> Column:
        is_image = F.coalesce(
            group["_USE"].isin(mets.IMAGE_GROUP_USES) & group["_ID"].isin(mets.IMAGE_GROUP_IDS),
            F.lit(False),
        )
        return F.transform(
            F.coalesce(group["file"], F.array().cast(_file_array())),
            lambda f: F.struct(
                group["_ID"].alias("group_id"),
                group["_USE"].alias("group_use"),
                is_image.alias("is_image"),
                F.coalesce(f["_SEQ"], f["_GROUPID"]).try_cast("int").alias("page_number"),
                _n_children(f).alias("n_children"),
                F.try_element_at(f["FLocat"], F.lit(1))["_href"].alias("location"),
            ),
        )

    return F.coalesce(
        F.flatten(F.transform(groups, of_group)),
        F.array().cast(mets.ELEMENTS),
    )


def _located(xml: Column) -> Column:
    """Elements with the href of a single child of another name as their location."""
    elements = F.col("_e.elements")
    open_ = F.exists(elements, lambda e: (e["n_children"] == 1) & e["location"].isNull())
    # Where an href is missing or too many, places do not match, and the document fails.
    hrefs = F.when(open_, F.xpath(xml, F.lit(_HREFS)))
    filled = F.zip_with(
        elements, hrefs, lambda e, h: e.withField("location", F.coalesce(e["location"], h))
    )
    return F.when(open_ & (F.array_size(hrefs) == F.array_size(elements)), filled).otherwise(
        elements
    )


def _file_array() -> str:
    start = schemas.MANIFEST.index("file: ARRAY<") + len("file: ")
    end = schemas.MANIFEST.index(">>>, _corrupt_record")
    return schemas.MANIFEST[start:end]


def _n_children(file: Column) -> Column:
    none = F.lit(0)
    total = none
    for child in _CHILDREN:
        total = total + F.coalesce(F.array_size(file[child]), none)
    return total


def _fault(elements: Column) -> Column:
    """Name of the most serious fault of any element, in one pass over them."""
    ranks = F.transform(
        elements,
        lambda e: F.when(e["n_children"] != 1, 1)
        .when(e["location"].isNull(), 2)
        .when(e["group_id"].isNull() | e["group_use"].isNull(), 3)
        .when(e["is_image"] & e["page_number"].isNull(), 4),
    )
    names = F.array(*[F.lit(name) for name in FAULTS])
    return F.try_element_at(names, F.array_min(ranks))


def faulty_manifests(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("manifest_error").isNotNull()).drop("elements")


def manifest_elements(parsed: DataFrame) -> DataFrame:
    """One row per file element of any group, in document order."""
    keep = [c for c in parsed.columns if c not in ("elements", "manifest_error")]
    return parsed.select(*keep, F.posexplode("elements").alias("position", "e")).select(
        *keep, "position", "e.*"
    )


def manifest_files(parsed: DataFrame, on_error: str = "raise") -> DataFrame:
    """Page files of manifests: the access images, then one ALTO file for each.

    Needs ``dc_identifier``. ``position`` is the order of the files in the
    document's result. A faulty document fails the job, or is left out with
    ``on_error="reject"``.
    """
    if on_error not in ("raise", "reject"):
        raise ValueError(f"unknown on_error: {on_error}")
    keep = [c for c in parsed.columns if c not in ("elements", "manifest_error")]
    if on_error == "reject":
        parsed = parsed.where(F.col("manifest_error").isNull())
    else:
        message = F.concat_ws(" ", F.lit("manifest of"), "dc_identifier", F.lit("failed:"), "manifest_error")
        parsed = parsed.withColumn(
            "elements",
            F.when(F.col("manifest_error").isNull(), F.col("elements")).otherwise(
                F.raise_error(message)
            ),
        )
    images = F.transform(
        F.filter("elements", lambda e: e["is_image"]),
        lambda e: F.struct(
            F.lit(files.ACCESS_IMAGE).alias("kind"),
            e["page_number"].alias("page_number"),
            e["location"].alias("location_xlink"),
        ),
    )
    altos = F.transform(
        images,
        lambda i: F.struct(
            F.lit(files.ALTO).alias("kind"),
            i["page_number"].alias("page_number"),
            F.lit(None).cast("string").alias("location_xlink"),
        ),
    )
    # The array first: with the functions above inside, the generator is interpreted.
    rows = (
        parsed.select(*keep, F.concat(images, altos).alias("_files"))
        .select(*keep, F.posexplode("_files").alias("position", "f"))
        .select(*keep, "position", "f.*")
    )
    return with_names(rows)


def with_names(page_files: DataFrame) -> DataFrame:
    """Add ``filename`` and ``download_url`` to page-file rows."""
    is_alto = F.col("kind") == files.ALTO
    extension = F.when(is_alto, F.lit(".xml")).otherwise(
        files.image_extension("location_xlink")
    )
    named = page_files.withColumn(
        "filename", files.page_filename("page_number", extension)
    )
    # From page 1 on, the first number in the file name is the page number.
    page = F.col("page_number")
    plain = F.concat("dc_identifier", F.lit("/image/"), page.cast("string"))
    return named.withColumn(
        "download_url",
        F.when(is_alto, files.alto_url("dc_identifier", "page_number"))
        .when(page >= 1, plain)
        .otherwise(files.image_url("dc_identifier", "filename")),
    )


def altos_for_images(images: DataFrame) -> DataFrame:
    """Images and one ALTO row per image, for page rows that are not in a document.

    Rows are doubled where they are: a union would compute the images twice.
    """
    both = images.withColumn("_alto", F.explode(F.array(F.lit(False), F.lit(True))))
    return both.select(
        *[
            F.when(F.col("_alto"), F.lit(files.ALTO)).otherwise(F.col(c)).alias(c)
            if c == "kind"
            else F.when(~F.col("_alto"), F.col(c)).alias(c)
            if c == "location_xlink"
            else F.col(c)
            for c in images.columns
        ]
    )


def files_of_kind(page_files: DataFrame, kind: str) -> DataFrame:
    return page_files.where(F.col("kind") == kind)


def in_manifest_order(page_files: DataFrame) -> DataFrame:
    """Images before ALTO files, in document order.

    A document's files come from one row, so they are sorted where they are;
    there is no order between documents.
    """
    return page_files.sortWithinPartitions("binding_id", "position")


def download_urls(page_files: DataFrame) -> DataFrame:
    return page_files.select("binding_id", "position", "kind", "page_number", "download_url")


def date_issued(docs: DataFrame, column: str = "xml") -> DataFrame:
    """Replace manifest text by its first issue date, as text and as a date."""
    keep = [c for c in docs.columns if c != column]
    text = F.nullif(
        F.regexp_replace(
            F.xpath_string(F.col(column), F.lit("(//*[local-name()='dateIssued'])[1]")),
            r"^\s+|\s+$",
            "",
        ),
        F.lit(""),
    )
    found = computed_once(docs, "date_text", text).select(*keep, "date_text")
    return found.withColumn("date_issued", dates.partial_date("date_text"))


def issued_between(
    dated: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Issues in an inclusive, open-ended date range; undated ones are dropped."""
    return dated.where(dates.within("date_issued", start, end))
