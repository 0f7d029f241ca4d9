"""Binding identifiers and the paths and URLs that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Length up to which an ID's directory is written out without functions over arrays.
INLINE_DEPTH = 10


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def computed_once(rows: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a costly column so that it is evaluated once per row.

    A filter on a plain column is pushed below it with a copy of its expression,
    which would parse a document again for every use. Filters stop at a generator.
    """
    return rows.select("*", F.explode(F.array(expression)).alias(name))


def binding_id(dc_identifier: Column | str) -> Column:
    """Text after the last slash of a DC identifier URL ('' if it ends in one)."""
    return F.substring_index(col(dc_identifier), "/", -1)


def dc_identifier(oai_identifier: Column | str, base_url: str) -> Column:
    """DC identifier URL of an OAI identifier: its last ``:`` part below base_url."""
    base = F.lit(base_url.rstrip("/") + "/")
    return F.concat(base, F.substring_index(col(oai_identifier), ":", -1))


def mets_file_name(dc: Column | str) -> Column:
    return F.concat(binding_id(dc), F.lit("_METS.xml"))


def mets_url(dc: Column | str) -> Column:
    return F.concat(col(dc), F.lit("/mets.xml?full=true"))


def binding_dir(id_: Column | str, depth: Column | int | None = None) -> Column:
    """Prefix-tree directory of a binding: ``1/12/123/123`` for ``123``.

    ``depth`` limits the number of prefix levels; None or 0 means one per
    character. A depth beyond the length repeats the whole ID.
    """
    id_ = col(id_)
    if depth is None or (isinstance(depth, int) and depth == 0):
        depth = F.length(id_)
        short = F.concat_ws(
            "/", *[F.when(depth >= n, F.substring(id_, 1, n)) for n in range(1, INLINE_DEPTH + 1)], id_
        )
        return F.when(depth <= INLINE_DEPTH, short).otherwise(_tree_dir(id_, depth))
    if isinstance(depth, int):
        depth = F.lit(depth)
    else:
        depth = F.when(depth == 0, F.length(id_)).otherwise(depth)
    return _tree_dir(id_, depth)


def _tree_dir(id_: Column, depth: Column) -> Column:
    """Directory of any depth; functions over arrays cost some three times ``short`` above."""
    # sequence(1, 0) counts downwards, hence the guard.
    heads = F.transform(
        F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
        lambda i: id_.substr(F.lit(1), i),
    )
    return F.when(depth < 1, id_).otherwise(
        F.concat_ws("/", heads, id_)
    )


def binding_of_entry(path: Column | str) -> Column:
    """Binding ID of an archive entry: third path segment from the end.

    Null marks a malformed path with fewer than three segments.
    """
    path = col(path)
    tail = F.substring_index(path, "/", -3)
    # A path that its first two segments are not the whole of has three; a pattern costs more.
    return F.when(F.substring_index(path, "/", 2) != path, F.substring_index(tail, "/", 1))


def binding_of_path(path: Column | str) -> Column:
    """Binding whose directory holds this entry, files and directories alike.

    The binding directory is the only place in the prefix tree where a segment
    is followed by itself. Null when the path is above all binding directories.
    """
    found = F.regexp_extract(col(path), r"(?:^|/)([^/]+)/\1/", 1)
    return F.nullif(found, F.lit(""))


def mets_base_path(path: Column | str) -> Column:
    """Binding directory of a METS entry: the path without its last two segments."""
    path = col(path)
    length = F.length(path) - F.length(F.substring_index(path, "/", -2)) - 1
    return path.substr(F.lit(1), F.greatest(length, F.lit(0)))


def ancestors(directory: Column | str) -> Column:
    """A directory path ending in a slash and all those above it, as an array."""
    directory = col(directory)
    depth = F.length(directory) - F.length(F.translate(directory, "/", ""))
    return F.transform(
        F.sequence(F.lit(1), depth),
        lambda n: F.concat(
            F.call_function("substring_index", directory, F.lit("/"), n), F.lit("/")
        ),
    )
