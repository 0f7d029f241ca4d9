"""Phrase collocations: word sequences that occur often and hold together.

1. Words are counted exactly; that gives the mass, the number of all n-gram occurrences.
2. Every n-gram gets a fingerprint, whose high bits name a hash partition. Each task sums
   its own n-grams first. A partition merges these sums into one Misra-Gries summary with
   more counters than its mass divided by the threshold: beyond that number, the largest
   counter that has no place is subtracted from all. What is subtracted in all then stays
   below the threshold, so every n-gram that occurs that often survives. Fingerprints that
   coincide share a counter, which only keeps more.
3. Survivors mark bits of a filter of bounded size. A second pass counts all n-grams that
   it lets through exactly, by their words, and drops those below the threshold. The
   filter lets more through as a corpus grows, and the result is the same.

Scores, cuts and the removal of phrases inside longer ones are joins on the counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stored
from .substrings import BASE, mixed

#: Occurrences that a partition's summary covers, about.
PART_MASS = 1 << 23
#: Partitions of a shuffle that a driver can still track.
MAX_PARTS = 1 << 14
#: Bits of the filter, all partitions together: 64 MiB at most.
FILTER_BITS = 1 << 29
#: Bits of one partition's share at most, and at least.
PART_BITS = (10, 21)
#: N-grams, and characters of phrases, that a task sums up before it passes them on.
BUFFER = 1 << 22
BUFFER_BYTES = 64 << 20
#: Phrases of one part in so many of all words are joined by a broadcast.
FREQUENT = 4096
#: Parts into which phrases of one language are dealt.
SALTS = 32

#: A-Z in lower case, a space for a tab, a line feed for what ends a piece.
FOLDED = bytes(
    0x0A if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else ord(chr(b).lower()) if b < 0x80 else b
    for b in range(256)
)
#: Hash of the end of a piece; words have others, but for one in 2**64.
BREAK = np.uint64(0)

PHRASES = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("phrase", T.StringType()),
        T.StructField("c", T.LongType()),
    ]
)


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text, with a line feed at the end of each piece."""
    folded = (text or "").encode().translate(FOLDED).replace(b"\n", b" \n ")
    tokens = [t for t in folded.split(b" ") if t]
    tokens.append(b"\n")
    return tokens


def hashes_of(tokens: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Hashes of words, 0 for the end of a piece. ``known`` is a memory; it may be emptied."""
    if len(known) > 1_000_000:
        known.clear()
    known[b"\n"] = 0
    missing = set(tokens).difference(known)
    known.update((t, xxhash.xxh64_intdigest(t)) for t in missing)
    return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def language_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed=1))


def fingerprints(hashes: np.ndarray, length: int, seed: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """64-bit fingerprint of the n-gram at each place, and where there is one."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=bool)
    out = np.full(n, seed + np.uint64(length), dtype=np.uint64)
    inside = np.ones(n, dtype=bool)
    for i in range(length):
        word = hashes[i : i + n]
        out = out * BASE + word
        inside &= word != BREAK
    return mixed(out), inside


def parts_of(prints: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash partition of fingerprints, by their upper half, and 32 bits inside it."""
    part = ((prints >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return part.astype(np.int64), prints.astype(np.uint32)


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Tokens of each row, with its language."""
    for lang, text in zip(
        batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True
    ):
        yield lang, tokens_of(text)


def phrase_rows(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.binary()).cast(pa.string()),
            pa.array(list(counts.values()), pa.int64()),
        ],
        PHRASES.names,
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, phrase, c``: exact counts of words, summed by task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0
        for batch in batches:
            for lang, tokens in by_language(batch):
                counts = held.setdefault(lang, Counter())
                before = len(counts)
                counts.update(tokens)
                size += len(counts) - before
                if size > BUFFER // 4:
                    yield from flushed(held)
                    size = 0
        yield from flushed(held)

    def flushed(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            del counts[b"\n"]
            yield phrase_rows(Counter({(lang, w): c for w, c in counts.items()}))
        held.clear()

    rows = texts.mapInArrow(count, PHRASES)
    return rows.groupBy("lang", "phrase").agg(F.sum("c").alias("c"))


class Summary:
    """Misra-Gries summary of 32-bit keys: no counter is above the true count, and none
    is more than ``off`` below it. Summaries are merged by adding them."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.off = capacity, 0
        self.keys = np.empty(0, dtype=np.uint32)
        self.counts = np.empty(0, dtype=np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge another summary; done for several at once when they are large enough."""
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.size = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
        self.keys = keys[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts
        if len(self.keys) > self.capacity:
            at = len(self.counts) - self.capacity - 1
            cut = np.partition(self.counts, at)[at]
            left = self.counts > cut
            self.keys, self.counts = self.keys[left], self.counts[left] - cut
            self.off += int(cut)

    def survivors(self, threshold: int) -> np.ndarray:
        """Keys that may occur ``threshold`` times, all that do among them."""
        self.merge()
        return self.keys[self.counts + self.off >= threshold]


def packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Keys that occur once, then the others, and the counts of these."""
    many = counts > 1
    body = np.concatenate([keys[~many], keys[many]])
    return body.tobytes(), counts[many].astype(np.int64).tobytes()


def unpacked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    body, many = np.frombuffer(keys, dtype=np.uint32), np.frombuffer(counts, dtype=np.int64)
    return body, np.concatenate([np.ones(len(body) - len(many), dtype=np.int64), many])


def local_sums(texts: DataFrame, longest: int, parts: int) -> DataFrame:
    """``part, mass, keys, counts``: each task's n-grams, summed. A row without keys,
    which sorts first, tells how many occurrences the task sends to a partition."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        seeds: dict[str, np.uint64] = {}
        waiting: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for lang, tokens in by_language(batch):
                if lang not in seeds:
                    seeds[lang] = language_seed(lang)
                hashes = hashes_of(tokens, known)
                for length in range(2, longest + 1):
                    prints, inside = fingerprints(hashes, length, seeds[lang])
                    waiting.append(prints[inside])
                    size += len(waiting[-1])
                if size > BUFFER:
                    yield flushed(waiting)
                    waiting, size = [], 0
        if size:
            yield flushed(waiting)

    def flushed(waiting: list[np.ndarray]) -> pa.RecordBatch:
        prints, counts = np.unique(np.concatenate(waiting), return_counts=True)
        part, keys = parts_of(prints, parts)
        found, first = np.unique(part, return_index=True)
        ends = np.append(first[1:], len(part))
        rows = []
        for p, start, end in zip(found, first, ends, strict=True):
            own = counts[start:end]
            rows.append((int(p), int(own.sum()), None, None))
            rows.append((int(p), 0, *packed(keys[start:end], own)))
        columns = list(zip(*rows, strict=True))
        types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            ["part", "mass", "keys", "counts"],
        )

    return texts.mapInArrow(sums, "part int, mass long, keys binary, counts binary")


def summaries(sums: DataFrame, threshold: int, parts: int, bits: int) -> DataFrame:
    """``part, marks``: 2**bits marks for each partition, set where a survivor falls."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def closed() -> pa.RecordBatch:
            marks = np.zeros(1 << bits, dtype=np.uint8)
            if summary is not None:
                marks[summary.survivors(threshold) >> np.uint32(32 - bits)] = 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([np.packbits(marks).tobytes()], pa.binary())],
                ["part", "marks"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "mass", "keys", "counts"))
            for own, some, keys, counts in zip(*columns, strict=True):
                if own != part:
                    if part is not None:
                        yield closed()
                    part, mass, summary = own, 0, None
                if keys is None:
                    mass += some
                    continue
                if summary is None:
                    summary = Summary(mass // threshold + 1)
                summary.add(*unpacked(keys, counts))
        if part is not None:
            yield closed()

    dealt = sums.repartition(parts, "part").sortWithinPartitions(
        "part", F.col("keys").isNotNull()
    )
    return dealt.mapInArrow(summarise, "part int, marks binary")


def collected(marks: DataFrame, parts: int, bits: int) -> np.ndarray:
    """The filter, a byte for eight marks: at most ``FILTER_BITS`` bits."""
    out = np.zeros((parts, 1 << bits >> 3), dtype=np.uint8)
    for row in marks.toLocalIterator():
        out[row["part"]] = np.frombuffer(row["marks"], dtype=np.uint8)
    return out.ravel()


def passing(prints: np.ndarray, filter_: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Which fingerprints the filter lets through."""
    part, key = parts_of(prints, parts)
    at = (part << bits) + (key >> np.uint32(32 - bits)).astype(np.int64)
    return (filter_[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def exact_counts(
    texts: DataFrame, marks: DataFrame, longest: int, threshold: int, parts: int, bits: int
) -> DataFrame:
    """``lang, phrase, c``: exact counts of the n-grams of at least the threshold."""
    filter_ = texts.sparkSession.sparkContext.broadcast(collected(marks, parts, bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        seeds: dict[str, np.uint64] = {}
        held: Counter = Counter()
        size = 0
        for batch in batches:
            for lang, tokens in by_language(batch):
                if lang not in seeds:
                    seeds[lang] = language_seed(lang)
                hashes = hashes_of(tokens, known)
                before: np.ndarray | None = None
                for length in range(2, longest + 1):
                    prints, inside = fingerprints(hashes, length, seeds[lang])
                    if before is not None and len(prints):
                        # A frequent n-gram consists of frequent shorter ones.
                        inside &= before[:-1] & before[1:]
                    at = np.flatnonzero(inside)
                    at = at[passing(prints[at], filter_.value, parts, bits)]
                    before = np.zeros(len(prints), dtype=bool)
                    before[at] = True
                    for i in at.tolist():
                        key = (lang, b" ".join(tokens[i : i + length]))
                        if key not in held:
                            size += len(key[1]) + 200
                        held[key] += 1
                if size > 4 * BUFFER_BYTES:
                    yield phrase_rows(held)
                    held, size = Counter(), 0
        yield phrase_rows(held)

    rows = texts.mapInArrow(count, PHRASES)
    return rows.groupBy("lang", "phrase").agg(F.sum("c").alias("c")).where(F.col("c") >= threshold)


def with_count(rows: DataFrame, key: str, counts: DataFrame, frequent: DataFrame, name: str) -> DataFrame:
    """Rows with the count of the phrase in ``key``. Frequent phrases, which many rows may
    hold, get theirs from a broadcast, and their rows go by their own phrase after it."""
    near = F.broadcast(
        frequent.select(F.col("lang"), F.col("phrase").alias(key), F.col("c").alias("_near"))
    )
    far = counts.select(
        F.col("lang"), F.col("phrase").alias("_key"), F.col("c").alias("_far")
    )
    # No phrase has a line feed.
    own = F.when(F.col("_near").isNull(), F.col(key)).otherwise(F.concat(F.lit("\n"), "phrase"))
    return (
        rows.join(near, ["lang", key], "left")
        .withColumn("_key", own)
        .join(far, ["lang", "_key"], "left")
        .withColumn(name, F.coalesce("_near", "_far"))
        .drop("_near", "_far", "_key")
    )


def cuts(candidates: DataFrame, counts: DataFrame, frequent: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score``: the lowest-scoring cut of each candidate."""
    words = F.split("phrase", " ")
    parted = (
        candidates.select("lang", "phrase", F.col("c").alias("a"), words.alias("words"))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
        .select(
            "lang",
            "phrase",
            "a",
            "k",
            F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
            F.array_join(
                F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " "
            ).alias("rest"),
        )
    )
    counted = with_count(parted, "first", counts, frequent, "l")
    counted = with_count(counted, "rest", counts, frequent, "r")
    # Exact up to 1e16 occurrences; more digits than a decimal holds would be an error.
    wide = {c: f"cast({c} as decimal(16, 0))" for c in "alr"}
    ratio = F.expr(f"({wide['a']} * {wide['a']} * 1000000) div ({wide['l']} * {wide['r']})")
    best = F.min(F.struct(ratio.alias("score"), "k", "l", "r"))
    return (
        counted.groupBy("lang", "phrase", "a")
        .agg(best.alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )


def inner_phrases(candidates: DataFrame) -> DataFrame:
    """``lang, phrase, most``: phrases inside longer candidates, with the highest count
    of those."""
    words = F.split("phrase", " ")
    longer = candidates.select("lang", "c", words.alias("words")).where(F.size("words") > 2)
    length = longer.withColumn("length", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    at = length.withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1))
    )
    inner = F.array_join(F.slice("words", F.col("at"), F.col("length")), " ")
    return at.groupBy("lang", inner.alias("phrase")).agg(F.max("c").alias("most"))


def best_of(scored: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` phrases of each language. A language is dealt into parts,
    whose first ones are put together, so that no task sorts all of it."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("part")
    within = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    first = scored.withColumn("part", part).withColumn("place", within).where(F.col("place") <= limit)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return first.withColumn("rank", rank).where(F.col("rank") <= limit).drop("part", "place")


def collocations(
    documents: DataFrame,
    longest: int = 3,
    threshold: int = 10,
    limit: int | None = 2000,
    inside_percent: int = 50,
    part_mass: int = PART_MASS,
) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Candidates are sequences of 2 to ``longest`` words within a piece that occur ``a`` >=
    ``threshold`` times in their language. Of the cuts into two parts, with ``l`` and ``r``
    occurrences, the one of the lowest score ``floor(1000000 * a * a / (l * r))`` counts,
    the earliest of equal ones. A candidate inside a longer one that has at least
    ``inside_percent`` of its occurrences is left out, also where the longer one is left
    out itself. ``n`` counts the language's words. ``limit`` rows for each language, all
    for None; equal scores by ``a``, then by the phrase's bytes.

    A null language is ``und``, which joins rows that say so; a null or an empty text has
    no words; repeated rows count again; an empty table gives no row. Texts of any length
    are read whole. Other columns are ignored.
    """
    if longest < 2 or threshold < 1:
        raise ValueError("phrases have two words at least and a threshold of one at least")
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text"
    )
    words = stored(word_counts(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("c").alias("n"))
    # Each word starts at most one n-gram of each length.
    n_words = words.agg(F.sum("c")).first()[0] or 0
    mass = n_words * (longest - 1)
    parts = max(1, min(MAX_PARTS, -(-mass // part_mass)))
    bits = min(PART_BITS[1], max(PART_BITS[0], (FILTER_BITS // parts).bit_length() - 1))
    marks = stored(
        summaries(local_sums(texts, longest, parts), threshold, parts, bits), "survivors"
    )
    candidates = stored(exact_counts(texts, marks, longest, threshold, parts, bits), "phrases")
    counts = words.where(F.col("c") >= threshold).unionByName(candidates)
    # At most FREQUENT of each length, by definition.
    frequent = counts.where(F.col("c") * FREQUENT >= n_words)
    scored = cuts(candidates, counts, frequent)
    inner = inner_phrases(candidates)
    apart = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (100 * F.col("most") < inside_percent * F.col("a"))
    )
    apart = stored(apart.drop("most"), "apart")
    if limit is None:
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        best = apart.withColumn("rank", F.row_number().over(order))
    else:
        best = best_of(apart, limit)
    # Languages are as many as rows of ``totals``; the join's side is left to Spark.
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


SQL = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i
        FROM worded, (SELECT unnest([1, 2, 3]) AS k))),
f AS (SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (
  SELECT lang, phrase, k AS words, c AS a, string_split(phrase, ' ') AS w
  FROM f WHERE k > 1 AND c >= 10),
cut AS (
  SELECT lang, phrase, words, a, unnest(range(1, words)) AS k, w FROM candidates),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, cut.k, x.c AS l, y.c AS r,
         ((1000000::HUGEINT * cut.a * cut.a) // (x.c::HUGEINT * y.c))::BIGINT AS score
  FROM cut
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:cut.k], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[cut.k + 1:], ' ')),
best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_pairs AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
  FROM candidates WHERE words = 3),
most AS (SELECT lang, phrase, max(a) AS most FROM inner_pairs GROUP BY lang, phrase),
ranked AS (
  SELECT best.lang, best.phrase, best.a, l, r, score, row_number() OVER (
    PARTITION BY best.lang ORDER BY score DESC, best.a DESC, best.phrase)::INTEGER AS rank
  FROM best LEFT JOIN most ON most.lang = best.lang AND most.phrase = best.phrase
  WHERE most IS NULL OR 100 * most < 50 * best.a)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
