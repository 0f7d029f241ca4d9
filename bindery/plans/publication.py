"""The published archive and its versions.

The store only grows. An update writes its new content once, below
``data/run_id=<attempt>/target=.../kind=...``, and below ``removed/`` the places of the
rows that it replaces or deletes: a bit for each row of a data file. Content that stays
is neither read nor written. One entry in the log ``published`` then makes both count.
What is published are the rows of all attempts in the log without the removed ones. A
version is the number of the last log entry of each set, so old versions stay readable.

Readers look up the bits of a file where they read it. They come by broadcasts of bounded
size, each with the files that it is about, so content moves for no reader either.

A number of the log belongs to one writer. An update is prepared against the entries that
it has seen; if another one was published since, what it takes away is found anew before
it tries the next number. Nothing of it counts before that.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery import commits, schemas
from bindery.functions import names
from bindery.partitioning import MAX_BROADCAST_BYTES, small_broadcast, unsorted_partition_writes
from bindery.sources import archives

COLUMNS = ["binding_id", "kind", "page_number", "path", "size", "content"]
#: What names a data file of the store, and a row in it.
FILE = ["run_id", "target", "kind", "file"]
PLACE = [*FILE, "row"]
#: Rows that one bitmap of Spark is about, and its bytes.
BITMAP_ROWS = 32_768
BITMAP_BYTES = 4_096
#: Bytes of bitmaps that one broadcast holds, with some for the names of their files.
BROADCAST_BYTES = 64 * 1024 * 1024
WASTE = "subset_id STRING, n_folders BIGINT, n_rows BIGINT, n_removed BIGINT"
#: Times that a writer tries again after others were faster.
TRIES = 100


def create_store(spark: SparkSession, root: str) -> None:
    """Create the empty logs of a new store; one that is there stays as it is."""
    for name in ("published", "versions"):
        commits.commit(spark, f"{root}/{name}", 0, [])


def read_pointers(spark: SparkSession, root: str) -> DataFrame:
    return commits.read(spark, f"{root}/published", schemas.PUBLISHED)


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    return commits.read(spark, f"{root}/versions", schemas.VERSIONS)


def current_locations(pointers: DataFrame) -> DataFrame:
    """Location of each subset's newest entry; null if that one added no files."""
    newest = F.max_by(F.struct("location"), "seq")
    return pointers.groupBy("set_id", "subset_id").agg(
        newest["location"].alias("location"),
        F.max("published_at").alias("published_at"),
    )


def counting_entries(log: DataFrame) -> DataFrame:
    """Log entries from the last one on that holds its whole subset."""
    key = ["set_id", "subset_id"]
    whole = log.where("whole").groupBy(*key).agg(F.max("seq").alias("_first"))
    return (
        log.join(whole, key, "left")
        .where(F.col("_first").isNull() | (F.col("seq") >= F.col("_first")))
        .drop("_first")
    )


def placed_rows(spark: SparkSession, root: str, locations: list[str]) -> DataFrame:
    """All archive rows of some folders, each with its file and its number in it."""
    found = (
        spark.read.schema(schemas.ARCHIVE)
        .option("basePath", f"{root}/data")
        .parquet(*[f"{root}/data/{location}" for location in locations])
    )
    return found.select(
        "*",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def bitmaps(places: DataFrame) -> DataFrame:
    """Rows of ``PLACE`` as one bitmap for each file and bucket of rows."""
    return places.groupBy(*FILE, F.expr(f"row div {BITMAP_ROWS}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("row") % BITMAP_ROWS).alias("rows")
    )


def read_removed(spark: SparkSession, root: str, folders: list[str], targets: list[str]) -> DataFrame:
    """Bitmaps that updates wrote for some targets, one for each file and bucket."""
    found = spark.read.schema(schemas.REMOVED).parquet(*[f"{root}/removed/{f}" for f in folders])
    return (
        found.where(F.col("target").isin(targets))
        .groupBy(*FILE, "bucket")
        .agg(F.bitmap_or_agg("rows").alias("rows"))
    )


def is_set(bitmap: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set; false for a null bitmap."""
    byte = F.substring(bitmap, F.expr("1") + F.floor(place / 8).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(F.getbit(value, (place % 8).cast("int")) == 1, F.lit(False))


def without_removed(
    rows: DataFrame, removed: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Placed rows whose bit is not set in the bitmaps of their file.

    Bitmaps are counted. Files are dealt into as many groups as keep each broadcast below
    the bound, and every group is scanned with its own bitmaps.
    """
    n = removed.count()
    if not n:
        return rows
    groups = min(n, -(-n * (BITMAP_BYTES + 256) // broadcast_bytes))

    def in_group(g: int) -> Column:
        # On the file's name alone, so files of other groups are not opened.
        return F.pmod(F.xxhash64("file"), F.lit(groups)) == g

    def left(g: int) -> DataFrame:
        own = F.broadcast(removed.where(in_group(g)).withColumnRenamed("rows", "_rows"))
        bucket = F.expr(f"row div {BITMAP_ROWS}")
        return (
            rows.where(in_group(g))
            .withColumn("bucket", bucket)
            .join(own, [*FILE, "bucket"], "left")
            .where(~is_set(F.col("_rows"), F.col("row") % BITMAP_ROWS))
            .select(rows.columns)
        )

    return reduce(DataFrame.unionByName, [left(g) for g in range(groups)])


def read_placed(
    spark: SparkSession, root: str, log: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """Archive rows that the log entries publish, with their places; None without files.

    The entries are collected: one per subset and update since the last ``compact``.
    """
    entries = counting_entries(log).select("location", "removed").collect()
    locations = sorted({e["location"] for e in entries} - {None})
    if not locations:
        return None
    found = placed_rows(spark, root, locations)
    folders = sorted({e["removed"] for e in entries} - {None})
    if not folders:
        return found
    targets = sorted({location.split("/target=")[1] for location in locations})
    removed = read_removed(spark, root, folders, targets)
    return without_removed(found, removed, broadcast_bytes)


def read_entries(spark: SparkSession, root: str, log: DataFrame) -> DataFrame:
    """Archive rows that the log entries publish."""
    found = read_placed(spark, root, log)
    if found is None:
        return spark.createDataFrame([], schemas.ARCHIVE)
    return found.drop("file", "row")


def read_published(
    spark: SparkSession,
    root: str,
    set_id: str | None = None,
    subset_ids: list[str] | None = None,
) -> DataFrame:
    """Published archive, read from the wanted subsets' folders only."""
    log = read_pointers(spark, root)
    if set_id is not None:
        log = log.where(F.col("set_id") == set_id)
    if subset_ids is not None:
        log = log.where(F.col("subset_id").isin(subset_ids))
    return read_entries(spark, root, log)


def select_binding(
    spark: SparkSession, root: str, set_id: str, binding_id: str
) -> DataFrame:
    """One binding's files, read from the folders of the subsets it may be in."""
    log = read_pointers(spark, root).where(
        (F.col("set_id") == set_id)
        & F.lit(binding_id).startswith(F.col("subset_id"))
    )
    return archives.select_files(read_entries(spark, root, log), binding_id=binding_id)


def removed_places(
    held: DataFrame | None,
    new: DataFrame,
    deleted: DataFrame,
    broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Places of the rows that an update takes away.

    Held rows go if a new one has their path, and all rows of a deleted binding go,
    the new ones too: additions come first. Reads no content. The new paths are broadcast
    if they measure little: Spark guesses from the files' sizes, which for many short paths
    is far too low, and would send them all through the driver.
    """
    columns = [*PLACE, "path", "binding_id"]
    both = new.select(*columns, F.lit(False).alias("_held"))
    if held is not None:
        both = both.unionByName(held.select(*columns, F.lit(True).alias("_held")))
    yes = F.lit(True)
    few = small_broadcast(new.select("path"), broadcast_bytes) is not None
    again = (
        new.select("path").distinct().withColumn("_again", yes)
        .hint("broadcast" if few else "merge")
    )
    gone = deleted.select("binding_id").distinct().withColumn("_gone", yes)
    return (
        both.join(again, "path", "left")
        .join(gone, "binding_id", "left")
        .where(F.col("_gone") | (F.col("_held") & F.col("_again")))
        .select(PLACE)
    )


def new_attempt(set_id: str, run_id: str) -> str:
    """Folder name that nothing has used, whatever characters the names have."""
    return re.sub(r"[^A-Za-z0-9._-]", "_", f"{set_id}.{run_id}") + f".{uuid.uuid4().hex}"


def write_rows(root: str, attempt: str, set_id: str, rows: DataFrame) -> DataFrame:
    """Write archive rows to an attempt's folder; returns them with their places there."""
    spark = rows.sparkSession
    path = f"{root}/data/run_id={attempt}"
    target = names.folder_name(names.subset_name(F.lit(set_id), "subset_id"))
    placed = (
        rows.select("subset_id", *COLUMNS)
        .withColumn("set_id", F.lit(set_id))
        .withColumn("target", target)
    )
    with unsorted_partition_writes(spark):
        placed.write.partitionBy("target", "kind").parquet(path)
    return placed_rows(spark, root, [f"run_id={attempt}"])


@dataclass(frozen=True)
class Update:
    """An update whose files are written, and which nothing counts of yet."""

    root: str
    set_id: str
    run_id: str
    attempt: str
    published_at: str
    new: DataFrame
    deleted: DataFrame
    locations: dict[str, str | None]
    #: Number of the set's last entry that ``removed`` takes into account.
    seen: int = -1
    removed: str | None = None
    tries: int = field(default=0)


def locations_of(attempt: str, subset_ids: list[str], written: DataFrame) -> dict[str, str | None]:
    """Folder of each subset's new files; None if it has none."""
    targets = dict(written.select("subset_id", "target").distinct().collect())
    return {
        s: f"run_id={attempt}/target={targets[s]}" if s in targets else None for s in subset_ids
    }


def entries_of(
    set_id: str,
    run_id: str,
    attempt: str,
    locations: dict[str, str | None],
    removed: str | None,
    whole: bool,
    published_at: str | None,
    seq: int,
) -> list[dict]:
    """Log rows of a number, one per subset."""
    return [
        {
            "set_id": set_id,
            "subset_id": subset_id,
            "run_id": run_id,
            "attempt": attempt,
            "seq": seq,
            "location": location,
            "removed": removed,
            "whole": whole,
            "published_at": published_at,
        }
        for subset_id, location in locations.items()
    ]


def of_set(log: DataFrame, set_id: str) -> DataFrame:
    return log.where(F.col("set_id") == set_id)


def prepare_update(
    spark: SparkSession,
    root: str,
    set_id: str,
    run_id: str,
    published_at: str,
    added: DataFrame,
    deleted: DataFrame,
) -> Update:
    """Write what an update adds to and takes from a set, without publishing it.

    ``added`` are archive rows with ``subset_id``, ``deleted`` has ``subset_id,
    binding_id``. Only subsets named by either are touched.
    """
    refuse_published(read_pointers(spark, root), set_id, run_id)
    attempt = new_attempt(set_id, run_id)
    new = write_rows(root, attempt, set_id, added)
    touched = new.select("subset_id").union(deleted.select("subset_id")).distinct()
    # One row per subset of the set's split.
    subset_ids = [r["subset_id"] for r in touched.collect()]
    locations = locations_of(attempt, subset_ids, new)
    update = Update(root, set_id, run_id, attempt, published_at, new, deleted, locations)
    return against(update, read_pointers(spark, root)) if subset_ids else update


def refuse_published(log: DataFrame, set_id: str, run_id: str) -> None:
    if not of_set(log, set_id).where(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} of {set_id} is already published")


def against(update: Update, log: DataFrame) -> Update:
    """The update with what it takes away from the state of a log. Writes bitmaps only."""
    spark = update.new.sparkSession
    log = of_set(log, update.set_id)
    last = commits.last_number(log, "seq")
    if last == update.seen:
        return update
    touched = log.where(F.col("subset_id").isin(list(update.locations)))
    held = read_placed(spark, update.root, touched)
    removed = f"{update.attempt}.{update.tries}"
    places = removed_places(held, update.new, update.deleted)
    bitmaps(places).write.parquet(f"{update.root}/removed/{removed}")
    return replace(update, seen=last, removed=removed, tries=update.tries + 1)


def publish(update: Update) -> int | None:
    """Publish a prepared update; returns its number, None if it changes nothing.

    Where another writer was faster, the update takes the next number, after a look at
    what the other one has changed. A run of that name in the log is refused.
    """
    spark, root = update.new.sparkSession, update.root
    time = commits.utc_text(spark, update.published_at)
    for _ in range(TRIES):
        if not update.locations:
            return None
        log = read_pointers(spark, root)
        refuse_published(log, update.set_id, update.run_id)
        number = commits.last_number(log, "seq") + 1
        update = against(update, log)
        rows = entries_of(
            update.set_id,
            update.run_id,
            update.attempt,
            update.locations,
            update.removed,
            False,
            time,
            number,
        )
        if commits.commit(spark, f"{root}/published", number, rows):
            return number
    raise RuntimeError(f"run {update.run_id} of {update.set_id} is not published: others were faster")


def apply_update(
    spark: SparkSession,
    root: str,
    set_id: str,
    run_id: str,
    published_at: str,
    added: DataFrame,
    deleted: DataFrame,
) -> None:
    """Write and publish what an update adds to and takes from a set.

    A run that was broken off can be repeated: it writes to a new folder, and nothing
    was published. A run that is in the log is refused.
    """
    publish(prepare_update(spark, root, set_id, run_id, published_at, added, deleted))


def waste(spark: SparkSession, root: str, set_id: str) -> DataFrame:
    """What each of a set's subsets has in the store: ``subset_id, n_folders, n_rows,
    n_removed``; removed rows are counted in ``n_rows``.

    Counts file rows and bits of bitmaps, and reads no content. Subsets without files are
    left out.
    """
    entries = counting_entries(of_set(read_pointers(spark, root), set_id))
    places = entries.where("location IS NOT NULL").select(
        "subset_id",
        F.regexp_extract("location", "^run_id=(.*)/target=(.*)$", 1).alias("run_id"),
        F.regexp_extract("location", "^run_id=(.*)/target=(.*)$", 2).alias("target"),
        "location",
    )
    # One entry per subset and update since the subset was last written anew.
    found = [r.asDict() for r in places.distinct().collect()]
    locations = sorted(r["location"] for r in found)
    if not found:
        return spark.createDataFrame([], WASTE)
    folder = ["run_id", "target"]
    counted = placed_rows(spark, root, locations).groupBy(*folder).agg(F.count("*").alias("n_rows"))
    removed = [r[0] for r in entries.where("removed IS NOT NULL").select("removed").distinct().collect()]
    gone = spark.createDataFrame([], "run_id string, target string, n_removed bigint")
    if removed:
        targets = sorted({r["target"] for r in found})
        bits = read_removed(spark, root, removed, targets)
        gone = bits.groupBy(*folder).agg(F.sum(F.bitmap_count("rows")).alias("n_removed"))
    return (
        places.distinct()
        .join(counted, folder)
        .join(gone, folder, "left")
        .groupBy("subset_id")
        .agg(
            F.count("*").alias("n_folders"),
            F.sum("n_rows").alias("n_rows"),
            F.coalesce(F.sum("n_removed"), F.lit(0)).alias("n_removed"),
        )
    )


def compact(
    spark: SparkSession,
    root: str,
    set_id: str,
    least_removed: float = 0.0,
    most_folders: int | None = None,
) -> list[str]:
    """Write subsets of a set anew, each without removed rows and in one folder.

    Those are taken of whose rows at least the share ``least_removed`` is removed, or
    which have more than ``most_folders`` folders; by default all. Files of the others stay
    untouched. Returns the subsets taken. Published rows stay the same, and so do
    versions: no older folder is deleted. If the set is updated meanwhile, it starts again.
    """
    seen, attempt, locations = -1, "", {}
    for _ in range(TRIES):
        log = read_pointers(spark, root)
        own = of_set(log, set_id)
        last = commits.last_number(own, "seq")
        if last != seen:
            subset_ids = wasteful(spark, root, own, set_id, least_removed, most_folders)
            if not subset_ids:
                return []
            attempt = new_attempt(set_id, "whole")
            taken = own.where(F.col("subset_id").isin(subset_ids))
            rows = write_rows(root, attempt, set_id, read_entries(spark, root, taken))
            locations, seen = locations_of(attempt, subset_ids, rows), last
            continue
        number = commits.last_number(log, "seq") + 1
        entries = entries_of(set_id, attempt, attempt, locations, None, True, None, number)
        if commits.commit(spark, f"{root}/published", number, entries):
            return sorted(locations)
    raise RuntimeError(f"set {set_id} is not compacted: it was updated all the time")


def wasteful(
    spark: SparkSession,
    root: str,
    own: DataFrame,
    set_id: str,
    least_removed: float,
    most_folders: int | None,
) -> list[str]:
    """Subsets that a compaction takes; one row per subset of a set's split comes here."""
    if least_removed <= 0:
        return [r["subset_id"] for r in own.select("subset_id").distinct().collect()]
    bad = F.col("n_removed") >= least_removed * F.col("n_rows")
    if most_folders is not None:
        bad |= F.col("n_folders") > most_folders
    return [r["subset_id"] for r in waste(spark, root, set_id).where(bad).select("subset_id").collect()]


def create_version(
    spark: SparkSession, root: str, version_id: str, created_at: str
) -> None:
    """Record the published state as a version; a known version is refused."""
    time = commits.utc_text(spark, created_at)
    for _ in range(TRIES):
        versions = read_versions(spark, root)
        if not versions.where(F.col("version_id") == version_id).isEmpty():
            raise ValueError(f"version {version_id} is already there")
        number = commits.last_number(versions, "number") + 1
        # One row per set; a version of the empty store has none of them.
        state = read_pointers(spark, root).groupBy("set_id").agg(F.max("seq")).collect()
        rows = [
            {
                "version_id": version_id,
                "created_at": time,
                "set_id": set_id,
                "seq": seq,
                "number": number,
            }
            for set_id, seq in state or [(None, 0)]
        ]
        if commits.commit(spark, f"{root}/versions", number, rows):
            return
    raise RuntimeError(f"version {version_id} is not recorded: others were faster")


def list_versions(versions: DataFrame) -> DataFrame:
    return versions.select("version_id", "created_at").distinct()


def latest_version(versions: DataFrame) -> DataFrame:
    """One row: the version of the highest number, null when there is none."""
    return versions.agg(
        F.max_by("version_id", "number").alias("version_id"),
        F.max_by("created_at", "number").alias("created_at"),
    )


def current_version(pointers: DataFrame, versions: DataFrame) -> DataFrame:
    """One row: the version of the published state, null while it has none.

    The marker is cleared by every publication and set by the next version, whatever
    dates they were given. A compaction publishes nothing.
    """
    published = pointers.where(~F.col("whole")).select("set_id", F.col("seq").alias("_published"))
    both = versions.select(
        "set_id", "version_id", "number", F.col("seq").alias("_recorded")
    ).unionByName(published, allowMissingColumns=True)
    by_set = both.groupBy("set_id").agg(
        F.max_by("version_id", "number").alias("version_id"),
        F.max("number").alias("number"),
        (F.coalesce(F.max("_published"), F.lit(0)) > F.coalesce(F.max("_recorded"), F.lit(0))).alias(
            "_open"
        ),
    )
    newest = by_set.agg(
        F.max_by("version_id", "number").alias("version_id"),
        F.coalesce(F.bool_or("_open"), F.lit(False)).alias("_open"),
    )
    return newest.select(F.when(~F.col("_open"), F.col("version_id")).alias("version_id"))


def read_version(
    spark: SparkSession,
    root: str,
    version_id: str = "latest",
    include: str | None = None,
    exclude: str | None = None,
) -> DataFrame:
    """Archive rows of a version, whole or by path patterns."""
    versions = read_versions(spark, root)
    if version_id == "latest":
        version_id = latest_version(versions).first()["version_id"]
    wanted = versions.where(F.col("version_id") == version_id)
    if wanted.isEmpty():
        raise LookupError(f"no version {version_id}")
    last = wanted.select("set_id", F.col("seq").alias("_last"))
    log = read_pointers(spark, root).join(last, "set_id").where("seq <= _last").drop("_last")
    return archives.matching(read_entries(spark, root, log), include, exclude)


def version_ids(log: DataFrame, column: str = "line") -> DataFrame:
    """Version ids out of backup log lines."""
    return log.select(names.snapshot_id(column).alias("version_id")).where(
        F.col("version_id").isNotNull()
    )
