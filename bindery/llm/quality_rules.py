"""Rule-based quality: base rules, and importance of hashed n-grams.

The method compares two multinomials over hashed word unigrams and bigrams: that of
trusted documents and that of the whole corpus. A document's score is the mean log
likelihood ratio of its n-grams, and it is kept if that is at or above a fixed
threshold. Ratios are rounded to whole millionths, so sums do not depend on the
order of addition.

Corpus counts are aggregated per bucket before the shuffle, so a frequent n-gram
costs one row per task. The table of ratios has a fixed number of entries and goes
into the plan as a literal; scoring shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..partitioning import broadcast_if_small
from .texts import CRC_TABLE_SQL, SPACES, WORD_SQL, crc32_sql, whole, words

SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50
#: Most words in repeated three-word windows, in percent.
MOST_REPEATED = 50
BUCKETS = 16384
#: Added to the count of every bucket.
SMOOTHING = 1.0
#: Lowest mean log likelihood ratio of a kept document, in millionths of a nat.
THRESHOLD = -50_000


def repeat_words(hashes: str, w: str, bits: str) -> Column:
    """Places of three-word windows that occur twice or more in the text, in order.

    ``hashes`` names the sorted array of windows: a hash in the upper bits, the place
    in the lowest ``bits``. Equal neighbours are compared word by word, so equal hashes
    of different windows do not count.
    """
    place = f"(shiftleft(1L, {bits}) - 1L)"

    def same(other: str) -> str:
        p, q = f"cast(x & {place} AS INT)", f"cast({other} & {place} AS INT)"
        equal = " AND ".join(f"get({w}, {p} + {k}) = get({w}, {q} + {k})" for k in range(3))
        return f"(shiftrightunsigned(x ^ {other}, {bits}) = 0 AND {equal})"

    repeated = (
        f"filter({hashes}, (x, j) -> {same(f'get({hashes}, j - 1)')} "
        f"OR {same(f'get({hashes}, j + 1)')})"
    )
    return F.expr(f"sort_array(transform({repeated}, x -> x & {place}))")


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that is computed once a row.

    Filters are pushed below projections, with a copy of an array's expression for
    each of its uses, also inside lambdas. They stop at a generator's output.
    """
    return rows.drop(name).select("*", F.explode(F.array(value)).alias(name))


def base_metrics(documents: DataFrame) -> DataFrame:
    """The documents with their words as ``w`` and the base metrics."""
    text = whole(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"\S"))
    rows = once(documents, "w", words(F.col("text"))).withColumn("n", F.size("w"))
    rows = once(rows, "bits", F.expr("length(bin(n))"))
    hashes = F.expr(
        "sort_array(transform(slice(w, 1, greatest(n - 2, 0)), (x, i) -> "
        "shiftleft(xxhash64(x, get(w, i + 1), get(w, i + 2)), bits) | cast(i AS BIGINT)))"
    )
    rows = once(rows, "hashes", hashes)
    rows = once(rows, "places", repeat_words("hashes", "w", "bits"))
    return (
        rows.withColumn("lines", lines)
        .withColumn("n_words", F.col("n").cast("long"))
        .withColumn(
            "word_chars", F.length(F.translate(text, SPACES, "")).cast("long")
        )
        .withColumn(
            "n_symbols",
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        )
        .withColumn(
            "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
        )
        .withColumn(
            "n_repeat_words",
            F.coalesce(
                F.expr(
                    "aggregate(transform(places, (p, k) -> "
                    "least(3L, coalesce(get(places, k + 1) - p, 3L))), 0L, (a, x) -> a + x)"
                ),
                F.lit(0).cast("long"),
            ),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < FEWEST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        )
        .drop("n", "bits", "lines", "hashes", "places")
    )


def bucket(text: str, buckets: int) -> str:
    return f"crc32(cast({text} AS BINARY)) % {buckets}"


def bucket_counts(documents: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """Counts of hashed unigrams and bigrams, of all documents and of trusted ones.

    ``trusted`` holds the IDs of trusted documents, each once.
    """
    ids = broadcast_if_small(trusted.select(F.col("doc_id").alias("id"), F.lit(1).alias("good")))
    placed = documents.select("doc_id", words(F.col("text")).alias("w")).join(
        ids, F.col("doc_id") == F.col("id"), "left"
    )
    return (
        placed.select("good", "w", F.posexplode("w").alias("i", "word"))
        .select(
            "good",
            F.explode(
                F.expr(
                    f"array({bucket('word', buckets)}, "
                    f"{bucket("concat(word, ' ', get(w, i + 1))", buckets)})"
                )
            ).alias("bucket"),
        )
        .where("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), F.count("good").alias("n_good"))
    )


def ratios(counts: list[tuple[int, int, int]], buckets: int, smoothing: float) -> Column | None:
    """Literal array of the buckets' log ratios in millionths; None if nothing is trusted."""
    import math

    total, good = sum(c[1] for c in counts), sum(c[2] for c in counts)
    if not good:
        return None
    found = {b: (n, g) for b, n, g in counts}
    scale = math.log((total + smoothing * buckets) / (good + smoothing * buckets))
    values = []
    for b in range(buckets):
        n, g = found.get(b, (0, 0))
        values.append(round(1e6 * (math.log((g + smoothing) / (n + smoothing)) + scale)))
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def judge(
    documents: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """The documents with base metrics, ``base_failed``, ``score`` and ``kept``.

    ``trusted`` has the IDs of trusted documents in ``doc_id``; repeated and null
    ones are passed over. Rows keep their columns and are judged one by one, so
    repeated rows get equal verdicts. A null or empty text has no words and fails
    the base rules; its score is null. If no trusted document has a word, the method
    rejects nothing. Columns that clash with results are replaced.

    The driver gets one row per bucket, whatever the size of the corpus.
    """
    known = trusted.where("doc_id IS NOT NULL").select("doc_id").distinct()
    counts = [tuple(r) for r in bucket_counts(documents, known, buckets).collect()]
    table = ratios(counts, buckets, smoothing)
    measured = base_metrics(documents)
    if table is None:
        return measured.withColumn("score", F.lit(None).cast("double")).drop("w").withColumn(
            "kept", ~F.col("base_failed")
        )
    total = F.expr(
        "aggregate(zip_with(w, slice(w, 2, greatest(size(w), 1)), (x, y) -> "
        f"get(ratios, cast({bucket('x', buckets)} AS INT)) "
        f"+ coalesce(get(ratios, cast({bucket("concat(x, ' ', y)", buckets)} AS INT)), 0L)), "
        "0L, (a, ratio) -> a + ratio)"
    )
    return (
        once(measured.withColumn("ratios", table), "total", total)
        .withColumn("grams", F.greatest(2 * F.col("n_words") - 1, F.lit(1)))
        .withColumn(
            "score", F.when(F.col("n_words") > 0, F.col("total") / F.col("grams") / 1e6)
        )
        .withColumn(
            "kept", ~F.col("base_failed") & (F.col("total") >= threshold * F.col("grams"))
        )
        .drop("w", "ratios", "total", "grams")
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """IDs that are labelled good and nothing else."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")


SQL = f"""WITH {CRC_TABLE_SQL},
split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') AS w
  FROM documents),
trusted AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
grams AS (
  SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)),
           lambda i: w[i] || ' ' || w[i + 1]))) AS g
  FROM split),
hashed AS (
  SELECT g, {crc32_sql('g')} % {BUCKETS} AS b
  FROM (SELECT DISTINCT g FROM grams), crc_table),
gram_buckets AS (SELECT r, b FROM grams JOIN hashed USING (g)),
counts AS (
  SELECT b, count(*) AS n, count(trusted.doc_id) AS n_good
  FROM gram_buckets JOIN split USING (r) LEFT JOIN trusted ON split.doc_id = trusted.doc_id
  GROUP BY b),
ratios AS (
  SELECT b, round(1e6 * (ln((n_good + {SMOOTHING}) / (n + {SMOOTHING}))
           + ln(((SELECT sum(n) FROM counts) + {SMOOTHING * BUCKETS})
                / ((SELECT sum(n_good) FROM counts) + {SMOOTHING * BUCKETS}))))::BIGINT AS ratio
  FROM counts),
scores AS (
  SELECT r, sum(ratio)::BIGINT AS total, count(*) AS n_grams
  FROM gram_buckets JOIN ratios USING (b) GROUP BY r),
windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
repeated AS (
  SELECT r, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows)
        WHERE n > 1)
  GROUP BY r),
lines AS (
  SELECT r, list_filter(string_split(text, chr(10)),
              lambda x: regexp_matches(x, '{WORD_SQL}')) AS l
  FROM split),
metrics AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, total, n_grams
  FROM split JOIN lines USING (r) LEFT JOIN repeated USING (r) LEFT JOIN scores USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
       AND ((SELECT sum(n_good) FROM counts) = 0 OR total >= {THRESHOLD} * n_grams) AS kept
FROM metrics"""
