"""Names, URLs and locations of page files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bindery.functions.ids import binding_id, col

# The kinds of page file and the manifest, which are also the
# names of their directories below a binding.
ALTO = "alto"
ACCESS_IMAGE = "access_img"
METS = "mets"

DEFAULT_BASE_PATH = "downloads"


def page_filename(page_number: Column | str, extension: Column | str) -> Column:
    """Page number padded to five digits, longer numbers kept whole, + extension."""
    page = col(page_number)
    # lpad would cut longer numbers; for the others it is the faster way.
    padded = F.when(
        page.between(0, 99999), F.lpad(page.cast("string"), 5, "0")
    ).otherwise(F.format_string("%05d", page))
    return F.concat(padded, col(extension))


def image_extension(location_xlink: Column | str) -> Column:
    """All suffixes of the location's base name (``.tar.gz``, ``.jp2``, or '').

    Dots at the start of the name do not begin a suffix, and a name that ends in
    a dot has none.
    """
    base = F.substring_index(F.rtrim(col(location_xlink), F.lit("/")), "/", -1)
    name = F.ltrim(base, F.lit("."))
    dot = F.instr(name, ".")
    return F.when(base.endswith(".") | (dot == 0), F.lit("")).otherwise(
        name.substr(dot, F.length(name))
    )


def alto_url(dc: Column | str, page_number: Column | str) -> Column:
    return F.concat(col(dc), F.lit("/page-"), col(page_number).cast("string"), F.lit(".xml"))


def image_url(dc: Column | str, filename: Column | str) -> Column:
    """Image URL: the first number without leading zeroes in the name's stem.

    Null when there is none (page 0), where no address can be formed.
    """
    stem = F.regexp_extract(col(filename), r"(?s)^(.+?)(?:\.[^.]+)?$", 1)
    page = F.nullif(F.regexp_extract(stem, r"[1-9]\d*", 0), F.lit(""))
    return F.concat(col(dc), F.lit("/image/"), page)


def default_file_dir(dc: Column | str, kind: Column | str) -> Column:
    """Default directory for direct downloads; only ALTO files have one."""
    return F.when(col(kind) == ALTO, F.concat(binding_id(dc), F.lit("/" + ALTO)))


def output_location(
    base_path: Column, file_dir: Column, filename: Column
) -> Column:
    """Join the three parts of an output path; an absolute part starts anew."""

    def joined(head: Column, tail: Column) -> Column:
        return F.when(tail.startswith("/"), tail).otherwise(
            F.concat(F.regexp_replace(head, "(?<=.)/+$", ""), F.lit("/"), tail)
        )

    return joined(joined(base_path, file_dir), filename)


def file_download_location(
    dc: Column | str,
    kind: Column | str,
    filename: Column | str,
    base_path: str | None = None,
    file_dir: str | None = None,
    name: str | None = None,
) -> Column:
    """Where a directly downloaded file goes; any part can be overridden.

    Null for a kind without a default directory when ``file_dir`` is not given.
    """
    return output_location(
        F.lit(base_path or DEFAULT_BASE_PATH),
        F.lit(file_dir) if file_dir else default_file_dir(dc, kind),
        F.lit(name) if name else col(filename),
    )


def tmp_path(path: Column | str) -> Column:
    return F.concat(col(path), F.lit(".tmp"))


def is_tmp(path: Column | str) -> Column:
    return col(path).endswith(".tmp")


def path_in_target(path: Column | str) -> Column:
    """Path inside the batch directory, whatever the number of digits of the batch."""
    return F.regexp_replace(col(path), r"^.+batch_[^/]+", "")


def is_present(size: Column | str) -> Column:
    """An existing file counts as present only when it is not empty."""
    return F.coalesce(col(size) > 0, F.lit(False))
