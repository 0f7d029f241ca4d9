"""Integrity audit: what archives should hold against what they hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions import files, ids, names
from bindery.operators import manifests, routing
from bindery.partitioning import broadcast_if_small
from bindery.scratch import stored

ERROR_CLASSES = [
    "malformed_path",
    "missing_alto",
    "missing_image",
    "unlisted_file",
    "missing_mets",
    "extra_mets",
]


def classified_entries(entries: DataFrame) -> DataFrame:
    """File entries with their binding; directories are left out."""
    return (
        entries.where(~F.col("is_dir"))
        .select("archive", "path")
        .withColumn("binding_id", ids.binding_of_entry("path"))
        .withColumn("is_mets", F.col("path").endswith("_METS.xml"))
    )


def expected_bindings(
    expected: DataFrame, archives: DataFrame, guess_prefix: bool = True
) -> DataFrame:
    """Expected (archive, binding) pairs: each archive expects its prefix's IDs.

    The prefix comes from the archive's name and may be empty; without
    ``guess_prefix`` no archive has one. If both tables have a ``set_id``, an archive
    expects IDs of its own set only. The archives' prefixes are stored and, as far as
    they are few enough, broadcast; an ID is cut to the lengths that occur among them.
    So IDs are neither compared with all prefixes nor moved by a head that many share.
    """
    both = "set_id" in expected.columns and "set_id" in archives.columns
    of_set = ["set_id"] if both else []
    prefix = names.archive_prefix("archive") if guess_prefix else F.lit("")
    prefixes = stored(
        archives.select("archive", *of_set).distinct().withColumn("_prefix", prefix), "prefixes"
    )
    id_ = F.col("binding_id")
    heads = [
        F.when(F.length(id_) >= n, id_.substr(F.lit(1), F.lit(n)))
        for n in routing.prefix_lengths(prefixes, "_prefix")
    ]
    cut = F.explode(F.array_compact(F.array(*heads).cast("array<string>"))).alias("_prefix")
    ids_of_sets = expected.select("binding_id", *of_set).distinct()
    return (
        ids_of_sets.select("*", cut)
        .join(broadcast_if_small(prefixes), [*of_set, "_prefix"])
        .select("archive", "binding_id")
    )


def expected_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("archive").agg(
        F.count_distinct("binding_id").alias("n_expected")
    )


def seen_bindings(classified: DataFrame) -> DataFrame:
    """Bindings whose manifest is in the archive."""
    return (
        classified.where(F.col("is_mets") & F.col("binding_id").isNotNull())
        .select("archive", "binding_id")
        .distinct()
    )


def malformed_paths(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("binding_id").isNull()).select("archive", "path")


def expected_files(docs: DataFrame, base_url: str, on_error: str = "raise") -> DataFrame:
    """Page files that the manifests in the archives ask for.

    ``docs`` has ``archive, path, xml``. Names ending in ``.xml`` are looked for
    as ALTO files, all others as images.
    """
    base = base_url.rstrip("/") + "/"
    docs = docs.withColumn("binding_id", ids.binding_of_entry("path")).withColumn(
        "dc_identifier", F.concat(F.lit(base), F.col("binding_id"))
    )
    page_files = manifests.manifest_files(manifests.parse_manifests(docs), on_error)
    return page_files.select(
        "archive",
        "binding_id",
        ids.mets_base_path("path").alias("base_path"),
        "filename",
    )


def expected_paths(expected: DataFrame) -> DataFrame:
    """Expected page files with the path of their plain name, and what their lack is."""
    is_alto = F.col("filename").endswith(".xml")
    return expected.withColumn(
        "error_class",
        F.when(is_alto, F.lit("missing_alto")).otherwise(F.lit("missing_image")),
    ).withColumn(
        "path",
        F.concat_ws(
            "/",
            "base_path",
            F.when(is_alto, F.lit(files.ALTO)).otherwise(F.lit(files.ACCESS_IMAGE)),
            "filename",
        ),
    )


def path_hashes(path: Column) -> list[Column]:
    """128 bits that stand for a path in its archive; paths themselves are long, share
    their beginnings, and would be moved and sorted."""
    return [
        F.xxhash64("archive", path).alias("_first"),
        F.xxhash64(path, "archive").alias("_second"),
    ]


def missing_files(
    expected: DataFrame, entries: DataFrame, differing: DataFrame | None = None
) -> DataFrame:
    """Expected page files that are in the archive under neither of two names.

    ALTO files may be called ``al-N`` and images ``pr-N``. Both names are brought
    to the plain form, which leaves one equality to join on. ``differing`` names the
    bindings (``archive, binding_id``) to look at, see ``binding_states``; the paths of
    others are not compared.
    """
    held = entries.where(~F.col("is_dir")).select("archive", "path")
    key = ["archive", "binding_id"]
    if differing is not None:
        own = differing.select(key)
        expected = expected.join(own, key, "left_semi")
        held = held.withColumn("binding_id", ids.binding_of_entry("path")).join(
            own, key, "left_semi"
        )
    wanted = expected_paths(expected).select(
        "archive", "binding_id", "error_class", "filename", *path_hashes(F.col("path"))
    )
    return wanted.join(
        held.select(*path_hashes(plain_name("path"))), ["_first", "_second"], "left_anti"
    ).select("archive", "binding_id", "error_class", F.col("filename").alias("detail"))


def plain_name(path):
    """Path with the optional name prefix of page files taken off."""
    path = ids.col(path)
    tail = F.substring_index(path, "/", -2)
    plain = path
    # Images below something that is called like a prefixed text stay as they are.
    may_be = {files.ALTO: F.lit(True), files.ACCESS_IMAGE: ~path.contains("alto/al-")}
    for kind, prefix in ((files.ALTO, "al-"), (files.ACCESS_IMAGE, "pr-")):
        # The prefix is what the path's end has before the rest of the name.
        rest = tail.substr(F.lit(len(kind) + len(prefix) + 2), F.length(tail))
        head = F.left(path, F.length(path) - F.length(rest) - len(prefix))
        found = tail.startswith(f"{kind}/{prefix}") & may_be[kind]
        plain = F.when(found, F.concat(head, rest)).otherwise(plain)
    return plain


def is_page_file(path):
    """Whether a path is that of a file in a directory for page files below another one."""
    path = ids.col(path)
    tail = F.substring_index(path, "/", -2)
    of_kind = tail.startswith(f"{files.ALTO}/") | tail.startswith(f"{files.ACCESS_IMAGE}/")
    return of_kind & (tail != path) & ~path.endswith("/")


def missing_mets(pairs: DataFrame, seen: DataFrame) -> DataFrame:
    """Expected bindings without a manifest."""
    return pairs.join(seen, ["archive", "binding_id"], "left_anti")


def extra_mets(seen: DataFrame, pairs: DataFrame) -> DataFrame:
    """Manifests of bindings that are not expected."""
    return seen.join(pairs, ["archive", "binding_id"], "left_anti")


def unlisted_files(classified: DataFrame, pairs: DataFrame) -> DataFrame:
    """Files other than manifests whose binding is not expected, one row each."""
    others = classified.where(~F.col("is_mets") & F.col("binding_id").isNotNull())
    return joined_by_pair(others.select("archive", "binding_id", "path"), pairs, "left_anti")


def joined_by_pair(rows: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    """Rows with or without a partner of their archive and binding.

    A hash of the two is the first key: rows are sorted by it, and names of archives share
    their beginnings.
    """
    key = ["archive", "binding_id"]
    hashed = F.xxhash64(*key).alias("_pair")
    return rows.select(hashed, "*").join(
        pairs.select(hashed, *key), ["_pair", *key], how
    ).drop("_pair")


#: Names of the sums over 32 bits each of the hashes of a binding's paths.
SUMS = ["_sum0", "_sum1", "_sum2", "_sum3"]


def path_sums(path: Column, sign: int) -> list[Column]:
    """A path's hashes as four summands, which add up in any order without overflow."""
    found = []
    for i, hashed in enumerate(path_hashes(path)):
        low = hashed.bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(hashed, 32)
        found += [(sign * low).alias(SUMS[2 * i]), (sign * high).alias(SUMS[2 * i + 1])]
    return found


def binding_states(
    classified: DataFrame, pairs: DataFrame, expected_page_files: DataFrame | None = None
) -> DataFrame:
    """Per archive and binding: is it listed, seen, and does it have other files.

    One aggregation over flags answers all questions about whole bindings, and
    combines the many files of a binding before the shuffle.

    With the expected page files there is ``differs``: the page files held are not those
    expected, compared by sums of their hashes, held ones added and expected ones
    subtracted. Where all are zero, no path has to be compared.
    """
    no, yes = F.lit(False), F.lit(True)
    zero = F.lit(0).cast("bigint")
    nothing = [zero.alias(name) for name in SUMS]
    path = F.col("path")
    of_page = is_page_file(path)
    sums = [
        F.when(of_page, c).otherwise(zero).alias(name)
        for name, c in zip(SUMS, path_sums(plain_name("path"), 1), strict=True)
    ]
    held = classified.where(F.col("binding_id").isNotNull()).select(
        "archive",
        "binding_id",
        no.alias("listed"),
        F.col("is_mets").alias("seen"),
        (~F.col("is_mets")).alias("other"),
        no.alias("asked"),
        *(nothing if expected_page_files is None else sums),
    )
    key = ["archive", "binding_id"]
    flags = ["listed", "seen", "other", "asked"]
    both = held.unionByName(
        pairs.select(
            *key, yes.alias("listed"), *[no.alias(f) for f in flags[1:]], *nothing
        )
    )
    if expected_page_files is not None:
        both = both.unionByName(
            expected_paths(expected_page_files).select(
                *key, *[no.alias(f) for f in flags[:3]], yes.alias("asked"), *path_sums(path, -1)
            )
        )
    states = both.groupBy(*key).agg(
        *[F.bool_or(flag).alias(flag) for flag in flags], *[F.sum(c).alias(c) for c in SUMS]
    )
    apart = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in SUMS])
    if expected_page_files is None:
        return states.select(*key, *flags[:3])
    return states.select(*key, *flags[:3], (F.col("asked") & apart).alias("differs"))


def binding_faults(
    entries: DataFrame,
    expected_ids: DataFrame,
    archives: DataFrame | None = None,
    guess_prefix: bool = True,
    expected_page_files: DataFrame | None = None,
) -> DataFrame:
    """Bindings that are listed but not seen, or held but not listed, or, with the
    expected page files, whose page files differ from those.

    ``archives`` names those to audit; without it, those that have entries.
    """
    named = entries if archives is None else archives
    pairs = expected_bindings(expected_ids, named, guess_prefix)
    states = binding_states(classified_entries(entries), pairs, expected_page_files)
    fault = (F.col("listed") != F.col("seen")) | (F.col("other") & ~F.col("listed"))
    return states.where(fault if expected_page_files is None else fault | F.col("differs"))


def integrity_errors(
    entries: DataFrame,
    expected_page_files: DataFrame,
    faults: DataFrame,
    differing: DataFrame | None = None,
) -> DataFrame:
    """All errors of all archives: archive, binding_id, error_class, detail.

    ``faults`` are those of whole bindings; the few unlisted ones among them pick
    their files from the entries. ``differing`` are the bindings whose page files are
    compared, all by default.
    """
    classified = classified_entries(entries)
    none = F.lit(None).cast("string")
    listed, seen = F.col("listed"), F.col("seen")

    def errors(rows: DataFrame, error_class, binding, detail) -> DataFrame:
        return rows.select(
            "archive",
            binding.alias("binding_id"),
            error_class.alias("error_class"),
            detail.alias("detail"),
        )

    of_mets = F.when(listed, F.lit("missing_mets")).otherwise(F.lit("extra_mets"))
    unlisted = faults.where(~listed & F.col("other")).select("archive", "binding_id")
    others = joined_by_pair(classified.where(~F.col("is_mets")), unlisted, "left_semi")
    parts = [
        errors(
            malformed_paths(classified), F.lit("malformed_path"), none, F.col("path")
        ),
        missing_files(expected_page_files, entries, differing),
        errors(others, F.lit("unlisted_file"), F.col("binding_id"), F.col("path")),
        errors(faults.where(listed != seen), of_mets, F.col("binding_id"), none),
    ]
    return reduce(DataFrame.unionByName, parts)


def error_counts(errors: DataFrame) -> DataFrame:
    """Errors per archive and class; null classes hold the totals of the rollup."""
    return errors.rollup("archive", "error_class").agg(F.count("*").alias("n_errors"))
