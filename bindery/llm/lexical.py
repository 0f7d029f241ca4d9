"""Ranked lexical search over an index that is stratified by document length.

Documents are dealt into shards of bounded size. Inside a shard those of one length
normaliser m form a stratum, one row of the index: its terms, and for each term its
documents in runs of one frequency tf, the highest first. Within a stratum m is fixed,
so what a term adds to a score, apart from its weight, depends on tf only and is
computed once for each tf. The first run of each term gives an upper bound of any
score in the stratum. A query visits strata in order of their bounds and stops when the
next bound lies below its k-th score. The best k of all shards hold the best k of all
documents.

Work on postings grows with documents and queries; what a task holds is one shard and
one chunk of queries, both of bounded numbers of rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stored

#: Documents of a shard and items of a chunk, about.
SHARD_DOCS = 16_384
CHUNK_ITEMS = 256
#: Slots of the filter that tells which terms are asked for: 512 KiB at any size.
SLOTS = 1 << 22
#: Scales of weights and impacts, and the share of length in the normaliser (percent).
WEIGHT_SCALE = 1000
IMPACT_SCALE = 1_000_000_000
LENGTH_PERCENT = 50

ASCII_TERM = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B))
#: A-Z in lower case, and a space for what belongs to no term.
FOLDED = bytes(
    ord(chr(b).lower()) if b in ASCII_TERM else (b if b >= 0x80 else 0x20) for b in range(256)
)

INDEX = (
    "shard int, m long, doc_ids array<{doc}>, terms array<string>, term_runs array<int>, "
    "tfs array<int>, run_places array<int>, places array<int>"
)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text: runs of ASCII letters, digits and any other characters."""
    return (text or "").encode().translate(FOLDED).split()


def slot_of(term: Column) -> Column:
    return F.crc32(term.cast("binary")) % SLOTS


def asked_slots(terms: DataFrame) -> bytes:
    """Bit per slot that a ``term`` falls into; at most ``SLOTS`` numbers are fetched."""
    bits = np.zeros(SLOTS, dtype=np.uint8)
    slots = terms.select(slot_of(F.col("term")).alias("s")).distinct().toArrow()["s"]
    bits[slots.to_numpy()] = 1
    return bits.tobytes()


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``: the distinct terms of each item, of all its rows together."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column("text").to_pylist()]
            places = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").take(pa.array(places)),
                    pa.array([t.decode() for f in found for t in f], pa.string()),
                ],
                ["item_id", "term"],
            )

    schema = T.StructType([items.schema["item_id"], T.StructField("term", T.StringType())])
    return items.select("item_id", "text").mapInArrow(split, schema).distinct()


def term_counts(documents: DataFrame, slots: bytes | None = None) -> DataFrame:
    """``doc_id, n, terms, tfs``: each document's length and the counts of its terms.

    With ``slots``, terms outside them are left out of the arrays, though not of ``n``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, tfs, offsets = [], [], [], [0]
            for text in batch.column("text").to_pylist():
                found = terms_of(text)
                lengths.append(len(found))
                for term, tf in Counter(found).items():
                    if slots is None or slots[zlib.crc32(term) % SLOTS]:
                        terms.append(term)
                        tfs.append(tf)
                offsets.append(len(terms))
            ends = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.StringType())),
            T.StructField("tfs", T.ArrayType(T.IntegerType())),
        ]
    )
    return documents.select("doc_id", "text").mapInArrow(count, schema)


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Lengths of a list column's rows, and its values."""
    lists = column.combine_chunks()
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten()


def listed(arrays: list[pa.Array]) -> pa.ListArray:
    """A list column with an array for each row."""
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(arrays))


def starts_of(sorted_keys: list[np.ndarray]) -> np.ndarray:
    """Places where any of the keys, sorted together, takes a new value."""
    new = np.zeros(len(sorted_keys[0]), dtype=bool)
    new[:1] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def strata(shard: pa.Table) -> Iterator[dict]:
    """Index rows of a shard's documents, which have ``doc_id, m, terms, tfs``."""
    shard = shard.take(
        pc.sort_indices(
            shard, sort_keys=[("m", "ascending"), ("doc_id", "ascending")], null_placement="at_end"
        )
    )
    m = shard["m"].to_numpy()
    lengths, terms = flat(shard["terms"])
    tfs = flat(shard["tfs"])[1].to_numpy()
    coded = terms.dictionary_encode()
    codes = coded.indices.to_numpy()
    first = starts_of([m])
    ends = np.append(first[1:], len(m))
    posting_ends = np.concatenate([[0], np.cumsum(lengths)])
    for start, end in zip(first, ends, strict=True):
        here = slice(posting_ends[start], posting_ends[end])
        code, tf = codes[here], tfs[here]
        place = np.repeat(np.arange(end - start), lengths[start:end])
        order = np.lexsort([place, -tf, code])
        code, tf, place = code[order], tf[order], place[order]
        runs = starts_of([code, tf]) if len(code) else np.empty(0, dtype=np.int64)
        by_term = starts_of([code[runs]]) if len(code) else runs
        yield {
            "shard": shard["shard"][0].as_py(),
            "m": int(m[start]),
            "doc_ids": shard["doc_id"].slice(start, end - start).combine_chunks(),
            "terms": coded.dictionary.take(pa.array(code[runs[by_term]])),
            "term_runs": pa.array(by_term, pa.int32()),
            "tfs": pa.array(tf[runs], pa.int32()),
            "run_places": pa.array(runs, pa.int32()),
            "places": pa.array(place, pa.int32()),
        }


def build_index(counts: DataFrame, shard_docs: int = SHARD_DOCS) -> tuple[DataFrame, int, int]:
    """The stratified index of stored ``term_counts``, with the number of documents that
    have a term and the number of all their terms.

    Each row is a stratum of a shard. ``term_runs`` gives each term's first run,
    ``run_places`` each run's first entry in ``places``, which point into ``doc_ids``.
    """
    row = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, n_terms = row
    shards = max(1, -(-n_docs // shard_docs))
    # n * N stays within 64 bits for 3 billion documents of 60 million terms.
    m = F.expr(f"{100 - LENGTH_PERCENT}L + ({LENGTH_PERCENT}L * n * {n_docs}L) div {max(1, n_terms)}L")
    dealt = counts.where("n > 0").select(
        # By row, not by ID: no ID or text, however often it is there, fills a shard.
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
        m.alias("m"),
        "doc_id",
        "terms",
        "tfs",
    )

    def build(shard: pa.Table) -> pa.Table:
        rows = list(strata(shard))
        lists = {
            name: listed([r[name] for r in rows])
            for name in rows[0]
            if name not in ("shard", "m")
        }
        return pa.table(
            {
                "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                "m": pa.array([r["m"] for r in rows], pa.int64()),
                **lists,
            }
        )

    schema = INDEX.format(doc=counts.schema["doc_id"].dataType.simpleString())
    return dealt.groupBy("shard").applyInArrow(build, schema), n_docs, n_terms


class Stratum:
    """A stratum's postings of the terms that a chunk of queries asks for."""

    def __init__(self, row: dict, vocabulary: pa.Array) -> None:
        m = row["m"].as_py()
        self.doc_ids = row["doc_ids"].values
        terms = row["terms"].values
        runs = row["tfs"].values.to_numpy()
        places = row["places"].values.to_numpy()
        run_ends = np.append(row["run_places"].values.to_numpy(), len(places))
        term_runs = row["term_runs"].values.to_numpy()
        term_ends = np.append(term_runs, len(runs))
        found = pc.index_in(terms, vocabulary)
        mine = np.flatnonzero(pc.is_valid(found).to_numpy(zero_copy_only=False))
        codes = found.take(pa.array(mine)).to_numpy()
        order = np.argsort(codes)
        mine, self.codes = mine[order], codes[order]
        # What a term adds to a score at weight 1: once for each tf of the stratum.
        levels, level = np.unique(runs.astype(np.int64), return_inverse=True)
        impact = (IMPACT_SCALE * levels // (1000 * levels + 20 * m))[level]
        self.best = impact[term_runs[mine]] if len(mine) else np.empty(0, dtype=np.int64)
        self.start = run_ends[term_runs[mine]]
        self.end = run_ends[term_ends[mine + 1]]
        self.places = places
        self.impacts = np.repeat(impact, np.diff(run_ends))

    def scores(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of all documents of the stratum for one query."""
        out = np.zeros(len(self.doc_ids), dtype=np.int64)
        if not len(self.codes):
            return out
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        for i in np.flatnonzero(self.codes[at] == codes):
            here = slice(self.start[at[i]], self.end[at[i]])
            out[self.places[here]] += weights[i] * self.impacts[here]
        return out


class Chunk:
    """Queries: ``item_id, term, w`` by item, with terms as numbers."""

    def __init__(self, asked: pa.Table) -> None:
        asked = asked.sort_by([("item", "ascending"), ("term", "ascending")])
        self.vocabulary = pc.unique(asked["term"])
        self.codes = pc.index_in(asked["term"], self.vocabulary).to_numpy()
        self.weights = asked["w"].to_numpy()
        items = asked["item"].to_numpy()
        self.first = starts_of([items])
        self.ends = np.append(self.first[1:], len(items))
        self.item_ids = asked["item_id"].take(pa.array(self.first))

    def bounds(self, stratum: Stratum) -> np.ndarray:
        """Upper bound of the stratum's scores for each query."""
        best = np.zeros(len(self.vocabulary), dtype=np.int64)
        best[stratum.codes] = stratum.best
        return np.add.reduceat(self.weights * best[self.codes], self.first)

    def search(self, q: int, found: list[Stratum], bounds: np.ndarray, k: int) -> list[tuple]:
        """Best k of the shard for a query: (score, stratum, place), and no document of
        score 0. Visits no stratum whose bound lies below the k-th score."""
        here = slice(self.first[q], self.ends[q])
        codes, weights = self.codes[here], self.weights[here]
        best: list[tuple[int, object, int, int]] = []
        least = 1
        for s in np.argsort(-bounds, kind="stable"):
            if bounds[s] < least:
                break
            scores = found[s].scores(codes, weights)
            for place in np.flatnonzero(scores >= least):
                doc_id = found[s].doc_ids[int(place)].as_py()
                best.append((-int(scores[place]), doc_id is None, doc_id, int(s), int(place)))
            if len(best) > k:
                best.sort(key=lambda b: (b[0], b[1], 0 if b[1] else b[2]))
                del best[k:]
            if len(best) == k:
                least = max(1, -max(b[0] for b in best))
        return best


def search(
    index: DataFrame,
    weighted: DataFrame,
    k: int,
    chunk_items: int = CHUNK_ITEMS,
) -> DataFrame:
    """The k best documents of each item: ``item_id, rank, doc_id, score``.

    ``weighted`` has ``item_id, term, w``: the terms of each query with their weights.
    """
    n_items, shards = (
        weighted.select("item_id").distinct().count(),
        (index.agg(F.max("shard")).first()[0] or 0) + 1,
    )
    chunks = max(1, -(-n_items // chunk_items))
    item = F.xxhash64("item_id")
    asked = weighted.select(
        F.pmod(item, F.lit(chunks)).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        item.alias("item"),
        "item_id",
        "term",
        "w",
    )
    visited = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    types = (weighted.schema["item_id"].dataType, index.schema["doc_ids"].dataType.elementType)
    schema = T.StructType(
        [
            T.StructField("item_id", types[0]),
            T.StructField("doc_id", types[1]),
            T.StructField("score", T.LongType()),
        ]
    )

    def meet(shard: pa.Table, queries: pa.Table) -> pa.Table:
        doc_type = shard.schema.field("doc_ids").type.value_type
        item_type = queries.schema.field("item_id").type
        items, docs, scores = [], [], []
        if shard.num_rows and queries.num_rows:
            chunk = Chunk(queries)
            rows = [
                {name: shard[name][i] for name in shard.column_names}
                for i in range(shard.num_rows)
            ]
            found = [Stratum(row, chunk.vocabulary) for row in rows]
            bounds = np.stack([chunk.bounds(s) for s in found])
            ids = chunk.item_ids.to_pylist()
            for q, item_id in enumerate(ids):
                for negative, _, doc_id, _, _ in chunk.search(q, found, bounds[:, q], k):
                    items.append(item_id)
                    docs.append(doc_id)
                    scores.append(-negative)
        return pa.table(
            {
                "item_id": pa.array(items, item_type),
                "doc_id": pa.array(docs, doc_type),
                "score": pa.array(scores, pa.int64()),
            }
        )

    keys = ("shard", "chunk")
    partial = visited.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def rank(
    documents: DataFrame,
    items: DataFrame,
    k: int = 50,
    shard_docs: int = SHARD_DOCS,
    chunk_items: int = CHUNK_ITEMS,
) -> DataFrame:
    """The k best of all documents for each item: ``item_id, rank, doc_id, score``.

    ``documents`` have ``doc_id, text``, ``items`` have ``item_id, text``; other columns
    are ignored. A document without a term, so a null or an empty one, takes no part.
    Equal scores go to the smaller ``doc_id``, null last; repeated rows are documents of
    their own and may both be found. Rows of one item are one query; an item without a
    term, or none that a document has, gives no row, and neither does an empty table.
    """
    asked = stored(item_terms(items), "asked")
    counts = stored(term_counts(documents, asked_slots(asked)), "terms")
    index, n_docs, _ = build_index(counts, shard_docs)
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df")
    )
    weight = F.floor(
        WEIGHT_SCALE * F.log(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1))
    )
    weighted = stored(
        asked.join(held, "term").select("item_id", "term", weight.cast("long").alias("w")),
        "weights",
    )
    return search(stored(index, "strata"), weighted, k, chunk_items)


SQL = r"""WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
lengths AS (SELECT row_id, doc_id, count(*) AS n FROM d GROUP BY row_id, doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
normed AS (
  SELECT row_id, doc_id, 100 - 50 + (50 * n * docs) // terms AS m FROM lengths, corpus),
postings AS (SELECT row_id, term, count(*) AS tf FROM d GROUP BY row_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, corpus GROUP BY term, docs),
scored AS (
  SELECT item_id, row_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN weights USING (term) JOIN postings USING (term) JOIN normed USING (row_id)
  GROUP BY item_id, row_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""
