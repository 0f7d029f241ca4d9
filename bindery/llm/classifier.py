"""Quality classifier: a factorisation machine over whole texts.

A document's features are its hashed words, statistics of its structure, and the
table's own count of its characters. Besides a weight, each feature has a short
vector; the inner product of two vectors is the weight of their pair. The sum over
all pairs is half of (square of the sum - sum of the squares), per place of the
vectors, so a score takes time in proportion to the features.

The model is fitted on a bounded sample of labelled documents and has a fixed size,
so it travels with the tasks. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .texts import remainder

#: Hash buckets of words, statistics behind them, and places of a feature's vector.
WORD_BUCKETS = 16384
RANK = 8
#: Most labelled documents of a class that the model is fitted on.
SAMPLE_PER_CLASS = 3000
EPOCHS = 6
BATCH = 64
RATE = 0.05
DECAY = 1e-5

#: Classes of bytes: 0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 new line,
#: 6 sentence marks, 7 exclamation marks, 8 symbols, 9 bars, 10 beyond ASCII.
CLASSES = np.zeros(256, dtype=np.uint8)
for _number, _bytes in (
    (1, range(65, 91)),
    (2, range(97, 123)),
    (3, range(48, 58)),
    (4, b" \t\r\x0b\x0c"),
    (5, b"\n"),
    (6, b".,;:?"),
    (7, b"!"),
    (8, b"#*$%&<>@^~=+_{}[]\\"),
    (9, b"|"),
    (10, range(128, 256)),
):
    CLASSES[list(_bytes)] = _number

N_STATISTICS = 18


def statistics(raw: bytes, words: list[bytes], counts: Counter, n_chars: int | None) -> np.ndarray:
    """Statistics of structure, between 0 and 2."""
    of = np.bincount(CLASSES[np.frombuffer(raw, np.uint8)], minlength=11).astype(float)
    chars = max(1, len(raw) - 0.5 * of[10])  # about: a letter beyond ASCII has two bytes
    n = max(1, len(words))
    letters = max(1.0, of[1] + of[2] + of[10] / 2)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    windows = max(1, len(words) - 2)
    distinct = len(set(zip(words, words[1:], words[2:], strict=False)))
    length = np.log1p(chars)
    told = np.log1p(max(0, n_chars)) if n_chars is not None else 0.0
    values = [
        length / 10,
        of[1] / letters,
        10 * of[3] / chars,
        of[8] / n,
        of[6] / n,
        of[7] / n,
        of[9] / n,
        of[10] / chars,
        len(counts) / n,
        (max(counts.values()) if counts else 0) / n,
        1 - distinct / windows if len(words) > 2 else 0.0,
        1 - len(set(lines)) / n_lines,
        np.log1p(n / n_lines) / 5,
        np.log1p(n_lines) / 5,
        sum(map(len, words)) / n / 10,
        float(len(words) < 20),
        told / 10,
        float(n_chars is None),
    ]
    return np.clip(np.array(values, dtype=np.float32), 0.0, 2.0)


def features(text: str | None, n_chars: int | None, known: dict[bytes, int]) -> tuple:
    """Places and values of a document's features. ``known`` remembers hashes."""
    raw = (text or "").encode()
    words = raw.split()
    counts = Counter(words)
    if len(known) > 500_000:
        known.clear()
    places = []
    for word in counts:
        h = known.get(word)
        if h is None:
            h = known[word] = zlib.crc32(word) % WORD_BUCKETS
        places.append(h)
    values = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    if len(values):
        values /= np.sqrt((values**2).sum())
    known_chars = None if n_chars is None or n_chars != n_chars else int(n_chars)
    more = statistics(raw, words, counts, known_chars)
    return (
        np.concatenate([np.array(places, np.int32), np.arange(N_STATISTICS, dtype=np.int32) + WORD_BUCKETS]),
        np.concatenate([values, more]),
    )


@dataclass
class Model:
    """A fitted factorisation machine."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margin(self, places: np.ndarray, values: np.ndarray) -> float:
        v = self.vectors[places] * values[:, None]
        pairs = 0.5 * (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum()
        return float(self.bias + self.weights[places] @ values + pairs)

    def score(self, places: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(places, values), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 0) -> Model:
    """Fit by AdaGrad on the logistic loss, in batches of a fixed order."""
    random = np.random.default_rng(seed)
    n = WORD_BUCKETS + N_STATISTICS
    w, v = np.zeros(n), random.normal(0, 0.05, (n, RANK))
    gw, gv = np.full(n, 1e-6), np.full((n, RANK), 1e-6)
    bias, gb = 0.0, 1e-6
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            sizes = np.array([len(rows[i][0]) for i in some])
            place = np.concatenate([rows[i][0] for i in some])
            x = np.concatenate([rows[i][1] for i in some]).astype(float)
            doc = np.repeat(np.arange(len(some)), sizes)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            vx = v[place] * x[:, None]
            total = np.add.reduceat(vx, starts, axis=0)
            squares = np.add.reduceat(vx**2, starts, axis=0)
            margin = bias + np.add.reduceat(w[place] * x, starts)
            margin += 0.5 * (total**2 - squares).sum(axis=1)
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]
            unique, back = np.unique(place, return_inverse=True)
            e = error[doc] * x
            dw = np.bincount(back, e) / len(some) + DECAY * w[unique]
            per_feature = e[:, None] * (total[doc] - vx)
            dv = np.stack(
                [np.bincount(back, per_feature[:, f]) for f in range(RANK)], axis=1
            ) / len(some) + DECAY * v[unique]
            db = error.mean()
            gw[unique] += dw**2
            gv[unique] += dv**2
            gb += db**2
            w[unique] -= RATE * dw / np.sqrt(gw[unique])
            v[unique] -= RATE * dv / np.sqrt(gv[unique])
            bias -= RATE * db / np.sqrt(gb)
    return Model(bias, w.astype(np.float32), v.astype(np.float32))


def n_chars_of(documents: DataFrame):
    """The table's own count of characters, if it has one."""
    if "n_chars" in documents.columns:
        return F.col("n_chars").cast("double").alias("n_chars")
    return F.lit(None).cast("double").alias("n_chars")


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_CLASS) -> Model | None:
    """Fit on at most ``sample`` labelled documents of a class, chosen by a hash of the ID.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1); null ones and conflicting ones
    are left out. None if no labelled document is found.
    """
    clear = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
        .select(F.col("doc_id").alias("labelled"), "quality")
    )
    by_hash = (F.xxhash64("labelled"), F.col("labelled"))
    chosen = (
        clear.where("quality = 0").orderBy(*by_hash).limit(sample)
    ).unionByName(clear.where("quality = 1").orderBy(*by_hash).limit(sample))
    rows = (
        documents.select("doc_id", "text", n_chars_of(documents))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .select("doc_id", "text", "n_chars", "quality")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            texts, told = (batch.column(c).to_pylist() for c in ("text", "n_chars"))
            found = [features(t, c, known) for t, c in zip(texts, told, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.string()),
                    pa.array([p.tobytes() for p, _ in found], pa.binary()),
                    pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary()),
                    batch.column("quality").cast(pa.float64()),
                ],
                ["id", "places", "values", "quality"],
            )

    found = rows.mapInArrow(read, "id string, places binary, values binary, quality double")
    examples = sorted(tuple(r) for r in found.collect())
    if not examples:
        return None
    return fit(
        [(np.frombuffer(p, np.int32), np.frombuffer(v, np.float32)) for _, p, v, _ in examples],
        np.array([q for *_, q in examples]),
    )


def classify(documents: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every document.

    Only the text and ``n_chars`` enter a score. A null text counts as empty and has a
    score of its own. Without a model all scores are 0.5. Rows are scored one by one:
    repeated rows give repeated results, other columns are ignored.
    """
    schema = T.StructType([documents.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            texts, told = (batch.column(c).to_pylist() for c in ("text", "n_chars"))
            scores = [
                model.score(*features(t, c, known)) if model else 0.5
                for t, c in zip(texts, told, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], schema.names
            )

    scored = documents.select("doc_id", "text", n_chars_of(documents)).mapInArrow(rows, schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id_):
    """Whether a document's label must not be learnt from."""
    return remainder(id_, 3) == 1
