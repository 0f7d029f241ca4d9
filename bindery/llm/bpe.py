"""Byte-level BPE: texts to token IDs and back, by recursive queries in each task.

A text is cut by the tokenizer's pattern. Every Python worker holds an in-process DuckDB with
the vocabulary and the merge table, and contracts all new words of a slice of its
documents in one recursive query over rows (place, token): each round joins
neighbouring tokens with the merge table and contracts the pairs of a word's lowest
rank, leftmost first, until no word has a pair left. Finished words leave the
recursion, and a Python worker remembers them for its next tasks. Decoding joins IDs with the vocabulary and aggregates bytes in order.

The vocabulary is a fixed file that the driver reads; its size bounds what is sent
to the tasks. Nothing is shuffled, and a lost executor costs its tasks only.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Code points that a task works on at a time; a longer text is a slice of its own.
SLICE_CHARS = 4_000_000
#: Encoded words that a Python worker remembers, from task to task.
REMEMBERED = 1_000_000
#: Words that one recursive query contracts, and tokens that one query decodes.
WORDS_PER_QUERY = 50_000
TOKENS_PER_QUERY = 2_000_000

# ``place`` holds the word's number in its upper half. A word's pairs of equal lowest
# rank are contracted together, every other one of a run (aaaa: 1st and 3rd): a merge
# of a trained vocabulary never makes a pair of a lower rank than its own possible, so
# this is what one at a time gives. ``before`` counts the hits of a run before a row; a
# word's last token is no hit, so runs end with their word.
CONTRACT = """
WITH RECURSIVE state(place, token, done) AS (
  SELECT place, token, false FROM start
  UNION ALL
  (WITH paired AS (
     SELECT place, place >> 32 AS word, token, row_number() OVER w AS i,
            CASE WHEN lead(place) OVER w >> 32 = place >> 32 THEN lead(token) OVER w END AS following
     FROM state WHERE NOT done WINDOW w AS (ORDER BY place)),
   ranked AS (
     SELECT place, word, token, i, merged
     FROM paired LEFT JOIN merges ON token = lhs AND following = rhs),
   lowest AS (SELECT word, min(merged) AS rank FROM ranked GROUP BY word),
   hits AS (
     SELECT place, token, i, merged, rank, coalesce(merged = rank, false) AS hit
     FROM ranked JOIN lowest USING (word)),
   runs AS (
     SELECT *, i - 1 - coalesce(last_value(CASE WHEN NOT hit THEN i END IGNORE NULLS) OVER (
       ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
     FROM hits)
   SELECT place, CASE WHEN hit THEN merged ELSE token END, rank IS NULL
   FROM runs WHERE before % 2 = 0))
SELECT place >> 32 AS word, token FROM state WHERE done ORDER BY place"""

DECODE = """
SELECT doc, sha256(unhex(string_agg(hex, '' ORDER BY place))) AS digest
FROM encoded JOIN vocabulary USING (token) GROUP BY doc"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, which are their IDs, of a rank file."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """All pairs of tokens that join to a token: ``lhs, rhs, merged``."""
    rows = [
        (ranks[token[:cut]], ranks[token[cut:]], rank)
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    columns = np.array(rows, dtype=np.int32).reshape(-1, 3).T
    return pa.table({n: pa.array(c) for n, c in zip(("lhs", "rhs", "merged"), columns, strict=True)})


def unicode_pattern(pattern: str) -> str:
    """The pattern with white space as Unicode defines it, without four control codes."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class Coder:
    """Encoder and decoder, with the tokens of the words that it has met."""

    def __init__(self, ranks: dict[bytes, int], merges: pa.Table, pattern: str) -> None:
        import duckdb
        import regex

        self.words = regex.compile(unicode_pattern(pattern)).findall
        self.ranks = ranks
        self.letters = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.forget()
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB"})
        vocabulary = pa.table(
            {
                "token": pa.array(list(ranks.values()), pa.int32()),
                "hex": pa.array([t.hex() for t in ranks], pa.string()),
            }
        )
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS FROM given")
            self.db.unregister("given")

    def forget(self) -> None:
        # A word's number, and by it the place and number of its tokens.
        self.known: dict[str, int] = defaultdict(count().__next__)
        self.tokens = np.empty(0, np.int32)
        self.sizes = np.empty(0, np.int64)

    def contracted(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words, one after the other, and how many each word has."""
        lengths = np.array([len(w) for w in words])
        start = pa.table(
            {
                "place": (np.repeat(np.arange(len(words)), lengths) << 32)
                + np.arange(lengths.sum()),
                "token": self.letters[np.frombuffer(b"".join(words), np.uint8)],
            }
        )
        self.db.register("start", start)
        found = self.db.execute(CONTRACT).fetchnumpy()
        self.db.unregister("start")
        return found["token"], np.bincount(found["word"], minlength=len(words))

    def learn(self, words: list[str]) -> None:
        """Encode words, numbered in this order after those that are encoded."""
        raw = [w.encode() for w in words]
        ranks = [self.ranks.get(r) for r in raw]
        rest = [i for i, rank in enumerate(ranks) if rank is None]
        sizes = np.ones(len(words), np.int64)
        found = [self.contracted([raw[i] for i in rest[at : at + WORDS_PER_QUERY]])
                 for at in range(0, len(rest), WORDS_PER_QUERY)]
        if rest:
            sizes[rest] = np.concatenate([n for _, n in found])
        alone = np.ones(len(words), bool)
        alone[rest] = False
        tokens = np.empty(sizes.sum(), np.int32)
        of_alone = np.repeat(alone, sizes)
        tokens[of_alone] = [rank for rank in ranks if rank is not None]
        if rest:
            tokens[~of_alone] = np.concatenate([t for t, _ in found])
        self.tokens = np.concatenate([self.tokens, tokens])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token IDs of each text."""
        ids, lengths = self.encode_all(texts)
        return np.split(ids, np.cumsum(lengths)[:-1])

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token IDs of the texts, one after the other, and how many each text has."""
        cut = [self.words(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        n_words = np.array([len(words) for words in cut])
        numbers = np.fromiter(  # a word that is not known gets the next number
            map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, n_words.sum()
        )
        if len(self.known) > len(self.sizes):
            self.learn(list(islice(self.known, len(self.sizes), None)))
        sizes = self.sizes[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(self.starts[numbers] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.tokens[places], np.diff(ends[np.concatenate([[0], np.cumsum(n_words)])])

    def decoded_digests(self, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """SHA-256 of the bytes that the IDs of each text stand for.

        ``ids`` holds those of all texts, ``lengths`` how many each has.
        """
        digests = [hashlib.sha256(b"").hexdigest()] * len(lengths)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        first = 0
        while first < len(lengths):
            last = int(np.searchsorted(ends, ends[first] + TOKENS_PER_QUERY, "right")) - 1
            last = min(max(last, first + 1), len(lengths))
            some = ids[ends[first] : ends[last]]
            encoded = pa.table(
                {
                    "doc": np.repeat(np.arange(first, last, dtype=np.int32), lengths[first:last]),
                    "place": np.arange(len(some), dtype=np.int32),
                    "token": some,
                }
            )
            self.db.register("encoded", encoded)
            for doc, digest in self.db.execute(DECODE).fetchall():
                digests[doc] = digest
            self.db.unregister("encoded")
            first = last
        return digests


#: The coder of this Python worker, by the key of its vocabulary and pattern.
CODERS: dict[str, Coder] = {}


def coder_of(key: str, ranks: dict[bytes, int], merges: pa.Table, pattern: str) -> Coder:
    """The worker's coder; one of another vocabulary or pattern gives way to it."""
    if key not in CODERS:
        CODERS.clear()
        CODERS[key] = Coder(ranks, merges, pattern)
    return CODERS[key]


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts with a bounded number of code points."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > SLICE_CHARS:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def tokenize(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token IDs of whole texts, and the digest of what they decode to.

    ``path`` names a file of ranks that the driver can read, ``pattern`` the regular
    expression that cuts texts into words. Columns: those of the documents except
    ``text`` and any that clash with the new ones, then ``token_ids`` (array),
    ``n_tokens``, ``ids_sha256`` (of the IDs as little-endian 32-bit integers),
    ``decoded_sha256``. Special tokens do not exist. A null or empty text has no
    tokens. Rows are encoded one by one, so repeated rows give repeated results. An
    empty table gives an empty result. Texts are encoded whole, however long; the time of
    a single word without a break grows faster than its length.
    """
    ranks = read_ranks(path)
    merges = merge_table(ranks)
    key = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
    added = T.StructType(
        [
            T.StructField("token_ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    rest = [c for c in documents.columns if c != "text" and c not in added.names]
    schema = T.StructType([documents.schema[c] for c in rest] + added.fields)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coder = coder_of(key, ranks, merges, pattern)
            at = 0
            for texts in slices([t or "" for t in batch.column("text").to_pylist()]):
                ids, lengths = coder.encode_all(texts)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                raw = ids.astype("<u4")
                columns = [batch.column(c).slice(at, len(texts)) for c in rest] + [
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                    pa.array(lengths, pa.int64()),
                    pa.array(
                        [
                            hashlib.sha256(raw[i:j]).hexdigest()
                            for i, j in zip(ends, ends[1:], strict=False)
                        ],
                        pa.string(),
                    ),
                    pa.array(coder.decoded_digests(ids, lengths), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                at += len(texts)

    return documents.select(*rest, "text").mapInArrow(code, schema)
