"""Near-duplicate groups: b-bit MinHash signatures in a multi-index Hamming join.

A document is the set of its five-word shingles. Its signature has ``LANES`` MinHash
values of ``BITS`` bits, and the distance of two signatures is the number of lanes
that differ. The lanes are split into chunks. If at most ``DISTANCE`` lanes differ,
some chunk has at most ``DISTANCE // CHUNKS`` errors, so a document gets a key for
every chunk and every choice of that many lanes to leave out of it: all pairs within
the distance share a key. With 32 lanes, a pair of similarity 0.85 exceeds a distance
of 15 once in 286,000 times, by the binomial tail. Candidates are confirmed on their full
sets.

Rows of one word sequence are one class first. Keys, links and components are those of
classes, so rows of one ID with different texts are told apart; IDs come back at the end.
The pairs of a group are not listed: each member is compared with the group's pivot, the
member whose keys are the most common, and links join into components. Only pairs
across components are left. Those take part whose finer signatures of ``FINE`` single
bits are near, each at the smallest key that its two documents share, and are confirmed
in turn. A pair of similarity 0.85 is not near once in 3,570,000 times, and less often
above; other links between components are not lost, and a large group of copies costs
one comparison for each member.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stored

SHINGLE = 5
PERCENT = 85
LANES, BITS = 32, 16
DISTANCE, CHUNKS = 15, 8
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Lanes of the finer signature, and its greatest distance. At a similarity of 0.85 it is
#: exceeded once in 3,570,000 times, a twelfth of what the keys lose.
FINE = 2048
FINE_DISTANCE = 216
#: Hashes of sets that a task remembers.
REMEMBERED = 4_000_000
SEEDS = np.random.default_rng(5).integers(1, 2**63, (2, LANES + FINE, 1), dtype=np.uint64)
#: Shingles that are hashed by all lanes at a time.
AT_ONCE = 2048


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased: bytes.lower and bytes.split know ASCII only."""
    return (text or "").encode().lower().split()


def spread(h: np.ndarray) -> np.ndarray:
    """64-bit values with all bits mixed."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of a document's distinct shingles.

    Fewer words than a shingle has are one shingle as a whole; no words, none.
    ``known`` remembers hashes of words. Two different shingles of a pair of documents
    with 10,000 words have equal hashes once in 10**11 times.
    """
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(known) > 1_000_000:
        known.clear()
    hashes = np.empty(len(words), dtype=np.uint64)
    for i, word in enumerate(words):
        h = known.get(word)
        if h is None:
            h = known[word] = xxhash.xxh64_intdigest(word)
        hashes[i] = h
    length = min(SHINGLE, len(words))
    n = len(words) - length + 1
    rolled = np.full(n, length, dtype=np.uint64)
    for i in range(length):
        rolled = rolled * BASE + hashes[i : i + n]
    return np.unique(spread(rolled))


def minima(found: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Smallest hash of a set under each of the lanes' functions."""
    flips, factors = seeds[0], seeds[1] | np.uint64(1)
    least = np.full(len(flips), 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(found), AT_ONCE):
        some = (found[None, at : at + AT_ONCE] ^ flips) * factors
        np.minimum(least, some.min(axis=1), out=least)
    return least


def signature(found: np.ndarray) -> np.ndarray:
    """Lowest ``BITS`` bits of the smallest hash in each lane."""
    return (minima(found, SEEDS[:, :LANES]) & np.uint64(2**BITS - 1)).astype(np.int32)


def fine_signature(found: np.ndarray) -> np.ndarray:
    """One bit of the smallest hash in each further lane, in words of 64."""
    bits = (spread(minima(found, SEEDS[:, LANES:])) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, on full sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def keys() -> list[Column]:
    """A hash for each chunk and each choice of lanes that may be wrong in it."""
    errors = DISTANCE // CHUNKS
    found = []
    for i, chunk in enumerate(np.array_split(np.arange(LANES), CHUNKS)):
        for kept in combinations(chunk.tolist(), max(1, len(chunk) - errors)):
            lanes = [F.get(F.col("lanes"), F.lit(lane)) for lane in kept]
            found.append(F.xxhash64(F.lit(f"{i}:{kept}"), *lanes))
    return found


def text_key() -> Column:
    """What tells the texts of one ID apart."""
    return F.xxhash64("text")


def read_documents(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, hash of the word sequence, and the signature's lanes."""
    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("text_key", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("sequence", T.StringType()),
            T.StructField("lanes", T.ArrayType(T.IntegerType())),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            sizes, sequences, lanes = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                found = shingles(words, known)
                sizes.append(len(found))
                sequences.append(xxhash.xxh3_128_hexdigest(b" ".join(words)) if words else None)
                lanes.append(signature(found) if words else None)
            columns = [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(sizes, pa.int64()),
                pa.array(sequences, pa.string()),
                pa.array(lanes, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return documents.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(rows, schema)


def fine_signatures(texts: DataFrame) -> DataFrame:
    """``id`` and the finer signature ``fine`` of texts ``id, text``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            found = [
                fine_signature(shingles(words_of(t), known))
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.list_(pa.int64()))], ["id", "fine"]
            )

    schema = T.StructType([texts.schema["id"], T.StructField("fine", T.ArrayType(T.LongType()))])
    return texts.select("id", "text").mapInArrow(rows, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``a, b`` that are similar on their full sets.

    A task remembers the sets of documents that it meets again.
    """
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        sets: dict = {}
        size = 0
        for batch in batches:
            good = []
            ids = [batch.column(c).to_pylist() for c in ("a", "b")]
            text_a, text_b = batch.column("text_a"), batch.column("text_b")
            for i, (a, b) in enumerate(zip(*ids, strict=True)):
                if size > REMEMBERED:
                    sets.clear()
                    size = 0
                for one_id, text in ((a, text_a), (b, text_b)):
                    if one_id not in sets:
                        sets[one_id] = shingles(words_of(text[i].as_py()), known)
                        size += len(sets[one_id])
                good.append(similar(sets[a], sets[b], percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    schema = T.StructType([pairs.schema["a"], pairs.schema["b"]])
    return pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        check, schema
    )


def components(edges: DataFrame) -> DataFrame:
    """``id`` and the smallest ID that it reaches, for IDs that have an edge ``a, b``.

    Each round takes the smallest label among a vertex and its neighbours, then the
    label of that label, so chains shrink by half at least. Labels are stored after
    every round, which cuts the lineage.
    """
    both = stored(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "edges",
    )
    labels = stored(
        both.groupBy("a")
        .agg(F.min("b").alias("least"))
        .select(F.col("a").alias("id"), F.least("a", "least").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        closer = labels.join(near, "id").select(
            "id", "component", F.least("component", "near").alias("next")
        )
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("far"))
        moved = stored(
            closer.join(jump, "next").select(
                "id", F.least("next", "far").alias("component"), F.col("component").alias("old")
            ),
            "labels",
        )
        labels = moved.select("id", "component")
        if moved.where("component <> old").isEmpty():
            return labels


def link(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Groups of near-duplicates: one row per document.

    Columns: ``doc_id``, ``n_shingles``, ``component_id`` (smallest ID that a chain of
    links reaches, its own included), ``kept`` (that is its own), ``text_key`` (hash of
    the text), ``chosen`` (true for one ID and text of each component). Null and empty texts, and texts without words, are linked
    with nothing; texts of any length are read whole. Equal rows of one ID have one
    result each. Different texts of one ID are linked each by itself, and not with each
    other. Rows with a null ID take no part in linking and are kept. Other columns are
    ignored; an empty table gives an empty result.
    """
    read = stored(read_documents(documents), "signatures")
    usable = read.where("doc_id IS NOT NULL AND sequence IS NOT NULL")
    classes = stored(
        usable.groupBy("sequence")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("own"), F.first("lanes").alias("lanes"))
        .select(
            F.monotonically_increasing_id().alias("id"),
            "sequence",
            "lanes",
            F.col("own.doc_id").alias("first_id"),
            F.col("own.text_key").alias("text_key"),
        ),
        "classes",
    )
    keyed = classes.select("id", F.explode(F.array(*keys())).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sharing = stored(keyed.join(shared, "key"), "keys")
    degrees = sharing.groupBy("id").agg(F.sum("n").alias("degree"))
    pivots = (
        sharing.join(degrees, "id")
        .groupBy("key")
        .agg(F.max(F.struct("degree", (-F.col("id")).alias("least"), "id")).alias("pivot"))
        .select("key", F.col("pivot.id").alias("pivot"))
    )
    members = stored(sharing.select("id", "key").join(pivots, "key"), "members")
    stars = stored(
        members.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(),
        "pairs",
    )
    # One text of each class; equal rows of an ID have equal texts.
    ids = members.select("id").distinct()
    sharers = classes.join(ids, "id", "left_semi").select("id", "first_id", "text_key")
    texts = stored(
        documents.where("doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("first_id"), text_key().alias("text_key"), "text")
        .join(sharers, ["first_id", "text_key"])
        .select("id", "text")
        .dropDuplicates(["id"]),
        "texts",
    )
    near = stored(confirmed(stars, texts, percent), "links")
    first = components(near)
    # What is not with its group's pivot is compared with the others.
    place = first.select("id", "component")
    located = (
        members.join(place, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .join(
            place.select(F.col("id").alias("pivot"), F.col("component").alias("main")),
            "pivot",
            "left",
        )
        .withColumn("main", F.coalesce("main", "pivot"))
    )
    away = stored(located.where("component <> main"), "away")
    # Groups in one component are done, and so are a group's pairs with its pivot.
    rest = stored(
        located.join(away.select("key").distinct(), "key", "left_semi").where("id <> pivot"),
        "others",
    )
    several = rest.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    open_ = rest.join(several, "key", "left_semi")
    fine = fine_signatures(texts.join(open_.select("id").distinct(), "id", "left_semi"))
    all_keys = classes.select("id", F.array_sort(F.array(*keys())).alias("keys"))
    described = stored(open_.join(fine.join(all_keys, "id"), "id"), "described")
    mine, others = described.where("component <> main").alias("x"), described.alias("y")
    distance = " + ".join(f"bit_count(x.fine[{i}] ^ y.fine[{i}])" for i in range(FINE // 64))
    pairs = stored(
        mine.join(
            others,
            F.expr(
                # Each pair once: two that are both away come from either side.
                "x.key = y.key AND x.component <> y.component "
                "AND (y.component = y.main OR x.id < y.id) "
                f"AND {distance} <= {FINE_DISTANCE} "
                "AND array_min(array_intersect(x.keys, y.keys)) = x.key"
            ),
        )
        .select(F.least("x.id", "y.id").alias("b"), F.greatest("x.id", "y.id").alias("a"))
        .distinct()
        .join(
            stars.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")),
            ["a", "b"],
            "left_anti",
        ),
        "pairs",
    )
    more = confirmed(pairs, texts, percent)
    groups = components(near.unionByName(more))
    placed = (
        classes.join(groups, "id", "left")
        .select(
            "sequence",
            F.struct(F.col("first_id").alias("doc_id"), "text_key").alias("own"),
            F.coalesce("component", "id").alias("place"),
        )
    )
    least = placed.groupBy("place").agg(F.min("own").alias("first"))
    result = placed.join(least, "place").select("sequence", "first")
    with_words = read.where("sequence IS NOT NULL").join(result, "sequence", "left")
    without = read.where("sequence IS NULL").withColumn(
        "first", F.struct("doc_id", "text_key")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.col("first.doc_id"))
    alone = F.col("doc_id").isNull()
    return with_words.unionByName(without).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (alone | (F.col("doc_id") == F.col("first.doc_id"))).alias("kept"),
        "text_key",
        (alone | (F.struct("doc_id", "text_key") == F.col("first"))).alias("chosen"),
    )
