"""Exact substring dedup: remove word windows that occur more than once.

Every fixed-length window of words has a Rabin-Karp hash. Moving all of them would
cost several times the corpus, so two rounds find the repeated ones, without loss:

1. A window is represented by its minimizer: the smallest hash among the shorter
   grams inside it, the first one if there are several. Equal windows have equal
   minimizers at equal offsets, so a repeated window has a minimizer that occurs at
   two places at least. Minimizers are far fewer than windows, and Spark counts them.
2. Only windows with a repeated minimizer are hashed as a whole and counted.

Repeated windows merge into maximal intervals of words, which are removed. Both counts
are partial before their shuffle, and hashes find their documents by joins on rows of
a hash and a document, which Spark splits where a passage is very common. Text moves
once, and only that of documents with a repeated minimizer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stored

TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string())
#: Words of a window, and of the grams that stand for it.
WINDOW = 35
GRAM = 16
#: Multiplier of the rolling hash, odd.
BASE = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of words. ``known`` serves as a memory and may be emptied."""
    if len(known) > 1_000_000:
        known.clear()
    out = np.empty(len(words), dtype=np.uint64)
    for i, word in enumerate(words):
        h = known.get(word)
        if h is None:
            h = known[word] = xxhash.xxh64_intdigest(word)
        out[i] = h
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes with all bits spread, so that their order is random."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of every window of that many words.

    Windows are built by doubling: that of 2k words from two of k words.
    """
    if len(hashes) < length:
        return np.empty(0, dtype=np.uint64)
    n = len(hashes) - length + 1
    out, done = np.zeros(n, dtype=np.uint64), 0
    power, size, factor = hashes, 1, BASE  # windows of ``size`` words, BASE ** size
    while True:
        if length & size:
            out = out * factor + power[done : done + n]
            done += size
        if done == length:
            return mixed(out)
        power = power[: len(power) - size] * factor + power[size:]
        with np.errstate(over="ignore"):
            factor = np.uint64(factor * factor)
        size *= 2


def minimizers(grams: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest gram in each run of ``span``, the first of equal ones."""
    views = np.lib.stride_tricks.sliding_window_view(grams, span)
    return np.arange(len(views)) + views.argmin(axis=1)


def minimizer_rows(words: list[bytes], known: dict, window: int, gram: int) -> np.ndarray:
    """Minimizer hashes of a text, one for each place that is a minimizer."""
    hashes = word_hashes(words, known)
    if len(words) < window:
        return np.empty(0, dtype=np.uint64)
    grams = rolling(hashes, gram)
    return grams[np.unique(minimizers(grams, window - gram + 1))]


def split(text: str | None) -> list[bytes]:
    """Words of a text: bytes.split cuts at the six ASCII spaces and nothing else."""
    return (text or "").encode().split()


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def covered(places: list[int], n_words: int, window: int) -> np.ndarray:
    """Which words lie in a window that starts at one of the places."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    starts = np.unique(np.array(places, dtype=np.int64))
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Remove every word that a repeated window covers; one row per document.

    A window repeats if its words also start at any other place of the table, in the
    same document too. Columns: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (text
    of the other words, joined by a space; null unless something was removed, as the
    words are then those of the document), ``kept_sha256``.

    Null and empty texts have no words, shorter texts no windows. Repeated rows are
    documents of their own, as long as they differ in ``doc_id``; rows of one ID are
    separate texts whose results share the ID. Other columns are ignored.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram has between one word and the words of a window")
    numbered = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_id"))
    long, hashes = T.LongType(), T.ArrayType(T.LongType())

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            counts, digests, found = [], [], []
            for text in batch.column("text").to_pylist():
                words = split(text)
                counts.append(len(words))
                digests.append(digest(words))
                found.append(minimizer_rows(words, known, window, gram).view(np.int64))
            columns = [
                batch.column("doc_id"),
                batch.column("row_id"),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(found, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, texts_read.names)

    texts_read = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("row_id", long),
            T.StructField("n_words", long),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("hashes", hashes),
        ]
    )
    read = stored(numbered.mapInArrow(first, texts_read), "minimizers")
    minimal = read.select("row_id", F.explode("hashes").alias("hash"))
    repeated = minimal.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    wanted = stored(
        minimal.join(repeated, "hash", "left_semi")
        .groupBy("row_id")
        .agg(F.collect_set("hash").alias("hashes")),
        "repeated",
    )
    suspects = stored(numbered.join(wanted, "row_id"), "suspects")

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            ids, places, windows = [], [], []
            rows = zip(
                batch.column("row_id").to_pylist(),
                batch.column("text").to_pylist(),
                batch.column("hashes"),
                strict=True,
            )
            for row_id, text, wanted_hashes in rows:
                hashes = word_hashes(split(text), known)
                grams = rolling(hashes, gram)
                best = grams[minimizers(grams, window - gram + 1)]
                mine = np.unique(wanted_hashes.values.to_numpy()).view(np.uint64)
                start = np.flatnonzero(np.isin(best, mine))
                ids.append(np.full(len(start), row_id, dtype=np.int64))
                places.append(start.astype(np.int32))
                windows.append(rolling(hashes, window)[start].view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (ids, places, windows)],
                    ["row_id", "place", "hash"],
                )

    starts = stored(
        suspects.mapInArrow(
            second,
            T.StructType(
                [
                    T.StructField("row_id", long),
                    T.StructField("place", T.IntegerType()),
                    T.StructField("hash", long),
                ]
            ),
        ),
        "windows",
    )
    twice = starts.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    cut = (
        starts.join(twice, "hash", "left_semi")
        .groupBy("row_id")
        .agg(F.collect_set("place").alias("places"))
    )
    result = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("n_words", long),
            T.StructField("n_removed", long),
            T.StructField("kept", T.StringType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = (batch.column(c).to_pylist() for c in ("text", "places"))
            out = []
            for text, places_of in zip(texts, places, strict=True):
                words = split(text)
                n = len(words)
                kept = None
                if places_of:
                    gone = covered(places_of, n, window)
                    words = [w for w, g in zip(words, gone, strict=True) if not g]
                    kept = b" ".join(words).decode()
                out.append((n, n - len(words), kept, digest(words)))
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)],
                result.names,
            )

    clean = read.join(wanted, "row_id", "left_anti").select(
        "doc_id",
        "n_words",
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(None).cast("string").alias("kept"),
        "kept_sha256",
    )
    return clean.unionByName(suspects.join(cut, "row_id", "left").mapInArrow(last, result))
