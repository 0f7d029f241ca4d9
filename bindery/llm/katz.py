"""Language-model scores: Katz backoff with Good-Turing discounts.

The model has unigrams, and bigrams after every word and after the start of a text.

Counts up to ``RELIABLE`` are discounted by Good-Turing, larger ones give up a share
of ``LEAST_MASS``, so that every history leaves mass for words not seen after it. A
history's backoff weight is that mass over the unigram mass of the words not seen
after it, so its probabilities add up to exactly 1. Unigram mass that the discounts
leave belongs to one unknown word.

Evaluation is recursive: the bigram if it was seen, else the weight of the history
times the unigram, else the unknown word.

Texts are coded once, some megabytes of them as one batch: a batch's distinct words and
its tokens as numbers of them. Twice a batch asks the buckets of a shuffle about what it
holds, each thing once, and adds what training has of it: first words, whose buckets
count and number them, then pairs, whose buckets count them and weigh their histories.
An answer is in the order of its question, so it repeats no keys. A batch then adds up
its texts' scores by itself.

``FREQUENT_SHARE`` says only how pairs are dealt, not what is counted: by history, or
after frequent ones and the start by word, so that no bucket gets all pairs of one
history. The sums of those histories are put together over the buckets.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stored

#: Words with this share of the training tokens are dealt as frequent ones.
FREQUENT_SHARE = 1e-3
RELIABLE = 5
LEAST_MASS = 1e-6
#: Tokens for which there is one bucket, and the fewest buckets.
TOKENS_PER_BUCKET = 2_000_000
FEWEST_BUCKETS = 64
#: Bytes of text of a batch, at most, but for a longer text.
BATCH_BYTES = 10 << 20
#: No word holds a space, so this is the hash of none.
END = xxhash.xxh64_intdigest(b" end")
#: Numbers of the start as a history, and of a bucket's sums over all its pairs.
START, ALL = -1, -2
#: Rows to no batch: what a bucket tells of itself.
NOWHERE = -1
#: Sources of a batch's own rows, which come before those of buckets.
WORDS, TEXTS = -2, -1
MAIL = "to long, source long, payload binary"


def thin(values: np.ndarray) -> np.ndarray:
    """Numbers of at least 0 by the bytes of their places, which compress better."""
    most = int(values.max()) if len(values) else 0
    kind = next(k for k in ("u1", "<u2", "<u4", "<u8") if most <= np.iinfo(k).max)
    narrow = np.ascontiguousarray(values, kind)
    return np.ascontiguousarray(narrow.view(np.uint8).reshape(len(values), narrow.itemsize).T)


def thick(planes: np.ndarray) -> np.ndarray:
    """The numbers that ``thin`` got."""
    return np.ascontiguousarray(planes.T).view(f"<u{len(planes)}")[:, 0].astype(np.int64)


def steps(ascending: np.ndarray) -> np.ndarray:
    return thin(np.diff(ascending, prepend=ascending.dtype.type(0)))


def climbed(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(thick(planes))


def packed(*parts) -> bytes:
    raw = pickle.dumps(parts, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(payload: bytes) -> tuple:
    size = int.from_bytes(payload[:8], "little")
    return pickle.loads(pa.decompress(payload[8:], size, "zstd", asbytes=True))


def mail(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    to, source, payload = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(to, pa.int64()), pa.array(source, pa.int64()), pa.array(payload, pa.binary())],
        ["to", "source", "payload"],
    )


def letters(table: pa.Table) -> list[tuple[int, tuple]]:
    """Sources and parts of the mail of one receiver, by source."""
    order = np.argsort(table.column("source").to_numpy(), kind="stable")
    return [
        (table.column("source")[i].as_py(), unpacked(table.column("payload")[i].as_py()))
        for i in order.tolist()
    ]


def discounts(of: list[int]) -> np.ndarray:
    """Good-Turing factors of the counts 1 to ``RELIABLE``, from the counts of counts 1 to one more.

    Where those do not give factors between 0 and 1, half a count is taken off.
    """
    k = RELIABLE
    plain = (np.arange(1, k + 1) - 0.5) / np.arange(1, k + 1)
    if min(of) <= 0:
        return plain
    tail = (k + 1) * of[k] / of[0]
    stars = [(r + 1) * of[r] / of[r - 1] / r for r in range(1, k + 1)]
    found = (np.array(stars) - tail) / (1 - tail) if tail != 1 else np.zeros(k)
    return found if ((found > 0) & (found < 1)).all() else plain


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    all_factors = np.append(factors, 1 - LEAST_MASS)
    return counts * all_factors[np.clip(counts, 1, RELIABLE + 1) - 1]


def left(sums: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """What the discounts take off; ``sums`` has how many things have the counts 1 to
    ``RELIABLE``, and the sum of the larger counts."""
    return sums @ np.append(np.arange(1, RELIABLE + 1) * (1 - factors), LEAST_MASS)


def tally(counts: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Those sums by group."""
    columns = [np.bincount(groups[counts == r], minlength=n) for r in range(1, RELIABLE + 1)]
    large = counts > RELIABLE
    rest = np.bincount(groups[large], counts[large], n).astype(np.int64)
    return np.stack([*columns, rest], axis=1)


def counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == r).sum()) for r in range(1, RELIABLE + 2)]


@dataclass
class Model:
    """What every task needs to know; bounded by the number of frequent words."""

    tokens: int
    words: int
    starts: int  # training texts
    buckets: int
    unigram_factors: np.ndarray
    unknown: float  # probability of the unknown word
    hot: np.ndarray  # sorted numbers of the start and frequent words
    pair_factors: np.ndarray | None = None
    hot_weights: np.ndarray | None = None  # log10

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities of words with those counts."""
        if not self.tokens:
            return np.ones(len(counts))
        known = discounted(np.maximum(counts, 1), self.unigram_factors) / self.tokens
        return np.where(counts > 0, known, self.unknown)

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.words + 1)))

    def hot_places(self, histories: np.ndarray) -> np.ndarray:
        """Places of histories among the frequent ones, -1 for others."""
        at = np.minimum(np.searchsorted(self.hot, histories), len(self.hot) - 1)
        return np.where(self.hot[at] == histories, at, -1)

    def log_weights(self, sums: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """Log10 backoff weights of histories; that of one not in training is 0."""
        total = sums @ np.append(np.arange(1, RELIABLE + 1), 1)
        known = total > 0
        share = left(sums[known], self.pair_factors) / total[known]
        out = np.zeros(len(total))
        out[known] = np.log10(share / (1 - mass[known]))
        return out


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows with about ``BATCH_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    n = max(1, -(-int(ends[-1]) // BATCH_BYTES)) if len(ends) else 0
    cuts = np.searchsorted(ends, [ends[-1] * i / n for i in range(1, n)]) if n else []
    edges = np.unique([0, *cuts, batch.num_rows])
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)


def code(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct lower-cased words and the end, the commonest first; the
    tokens as numbers of them, each text with its end; and their number by text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    of = np.repeat(np.arange(len(text)), lengths)[real.to_numpy(zero_copy_only=False)]
    lengths = np.bincount(of, minlength=len(text)) + 1
    coded = words.filter(real).dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.array([*map(xxhash.xxh64_intdigest, names), END], dtype=np.uint64)
    tokens = np.full(lengths.sum(), len(names))
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(lengths) - 1] = False
    tokens[inside] = coded.indices.to_numpy(zero_copy_only=False)
    hashes, same = np.unique(hashes, return_inverse=True)  # words of one hash are one
    counts = np.bincount(same[tokens], minlength=len(hashes))
    order = np.argsort(-counts, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return hashes[order], rank[same][tokens], lengths


def code_texts(rows: DataFrame) -> DataFrame:
    """Batches of texts: distinct words with their counts in training, and tokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in pieces(batch):
                hashes, tokens, lengths = code(part.column("text"))
                trains, scored = (
                    part.column(c).to_numpy(zero_copy_only=False) for c in ("trains", "scored")
                )
                own = np.repeat(trains, lengths)
                learnt = np.bincount(tokens[own], minlength=len(hashes))
                ids = part.column("doc_id").filter(pa.array(scored))
                columns = {
                    "batch": number,
                    "tokens": len(tokens),
                    "train_tokens": int(own.sum()),
                    "train_texts": int(trains.sum()),
                    "words": packed(hashes, thin(learnt)),
                    "texts": packed(thin(tokens), thin(lengths), trains, scored, ids),
                }
                yield pa.RecordBatch.from_pylist([columns])
                number += 1

    return rows.mapInArrow(
        encode,
        "batch long, tokens long, train_tokens long, train_texts long, words binary, texts binary",
    )


def deal_words(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of words by bucket and hash, and where the buckets begin in it."""
    bucket = (hashes >> np.uint64(8)) % np.uint64(buckets)
    order = np.lexsort([hashes, bucket])
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def ask_words(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, payload in zip(batch.column("batch"), batch.column("words"), strict=True):
                hashes, learnt = unpacked(payload.as_py())
                learnt = thick(learnt)
                order, edges = deal_words(hashes, buckets)
                rows = []
                for i in range(buckets):
                    part = order[edges[i] : edges[i + 1]]
                    if len(part):
                        rows.append((i, source.as_py(), packed(hashes[part], thin(learnt[part]))))
                yield mail(rows)

    return ask


def count_words(buckets: int, frequent: float):
    """A bucket's answers: words' counts in training and numbers; and what it has in all."""

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("to")[0].as_py()
        asked = letters(table)
        words, place = np.unique(np.concatenate([h for _, (h, _) in asked]), return_inverse=True)
        learnt = np.concatenate([thick(n) for _, (_, n) in asked])
        counts = np.bincount(place, learnt, len(words)).astype(np.int64)
        numbers = np.arange(len(words)) * buckets + bucket
        ends = np.cumsum([len(h) for _, (h, _) in asked])
        rows = [
            (source, bucket, packed(thin(counts[at]), steps(numbers[at])))
            for (source, _), at in zip(asked, np.split(place, ends[:-1]), strict=True)
        ]
        sums = tally(counts, np.zeros(len(counts), np.int64), 1)[0]
        own = (int((counts > 0).sum()), counts_of_counts(counts), sums, numbers[counts >= frequent])
        rows.append((NOWHERE, bucket, packed(*own)))
        return pa.Table.from_batches([mail(rows)])

    return count


def pairs_of(tokens: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a batch by history and word, and each token's among them. The
    start is the history ``n``, the number of words."""
    before = np.concatenate([[n], tokens[:-1]]) if len(tokens) else tokens
    before[np.cumsum(lengths) - lengths] = n
    pairs, place = np.unique(before * n + tokens, return_inverse=True)
    return pairs // n, pairs % n, place


def deal_pairs(model: Model, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of pairs by bucket, history and word, and where the buckets begin in it."""
    bucket = np.where(model.hot_places(h) < 0, h, w) % model.buckets
    order = np.lexsort([w, h, bucket])
    return order, np.searchsorted(bucket[order], np.arange(model.buckets + 1))


def known_words(model: Model, hashes: np.ndarray, answers: list) -> tuple[np.ndarray, np.ndarray]:
    """Counts of a batch's words and numbers of them and the start."""
    order, _ = deal_words(hashes, model.buckets)
    counts, numbers = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
    counts[order] = np.concatenate([thick(c) for c, _ in answers])
    numbers[order] = np.concatenate([climbed(n) for _, n in answers])
    return counts, np.append(numbers, START)


def list_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's words and distinct pairs, with their counts in training."""
    for batch in batches:
        for i in range(batch.num_rows):
            hashes, _ = unpacked(batch.column("words")[i].as_py())
            tokens, lengths, trains, *_ = unpacked(batch.column("texts")[i].as_py())
            tokens, lengths = thick(tokens), thick(lengths)
            h, w, place = pairs_of(tokens, lengths, len(hashes))
            learnt = np.bincount(place[np.repeat(trains, lengths)], minlength=len(h))
            runs = np.bincount(h, minlength=len(hashes) + 1)
            own = packed(hashes, thin(runs), thin(w), thin(learnt))
            yield mail([(batch.column("batch")[i].as_py(), WORDS, own)])


def ask_pairs(model: Model):
    def ask(table: pa.Table) -> pa.Table:
        source = table.column("to")[0].as_py()
        (_, (hashes, runs, w, learnt)), *answers = letters(table)
        counts, numbers = known_words(model, hashes, [a for _, a in answers])
        w, learnt = thick(w), thick(learnt)
        history = np.repeat(numbers, thick(runs))
        order, edges = deal_pairs(model, history, numbers[w])
        rows = []
        for i in range(model.buckets):
            part = order[edges[i] : edges[i + 1]]
            if not len(part):
                continue
            histories, run = np.unique(history[part], return_counts=True)
            words, first, at = np.unique(numbers[w[part]], return_index=True, return_inverse=True)
            rows.append(
                (
                    i,
                    source,
                    packed(
                        steps(histories - START),
                        thin(run),
                        steps(words),
                        thin(counts[w[part][first]]),
                        thin(at),
                        thin(learnt[part]),
                    ),
                )
            )
        return pa.Table.from_batches([mail(rows)])

    return ask


def count_pairs(model: Model):
    """A bucket's answers: pairs' counts in training and, of histories with pairs that it
    has not, but for the frequent ones, the sums that weigh them; and what it has in all."""

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("to")[0].as_py()
        asked = [(source, [thick(x) for x in parts]) for source, parts in letters(table)]
        for _, parts in asked:
            parts[0] = np.cumsum(parts[0]) + START
            parts[2] = np.cumsum(parts[2])
        histories, h = np.unique(np.concatenate([p[0] for _, p in asked]), return_inverse=True)
        words, first, w = np.unique(
            np.concatenate([p[2] for _, p in asked]), return_index=True, return_inverse=True
        )
        unigrams = model.unigram(np.concatenate([p[3] for _, p in asked])[first])
        keys, h_at, w_at = [], 0, 0
        for _, (own_h, run, own_w, _, at, _) in asked:
            of = np.repeat(h[h_at : h_at + len(own_h)], run)
            keys.append(of * len(words) + w[w_at : w_at + len(own_w)][at])
            h_at, w_at = h_at + len(own_h), w_at + len(own_w)
        pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
        learnt = np.concatenate([p[5] for _, p in asked])
        counts = np.bincount(place, learnt, len(pairs)).astype(np.int64)
        of, seen = pairs // len(words), counts > 0
        sums = tally(counts, of, len(histories))
        mass = np.bincount(of[seen], unigrams[pairs[seen] % len(words)], len(histories))
        hot = model.hot_places(histories) >= 0
        rows, start = [], 0
        for (source, _), key in zip(asked, keys, strict=True):
            found = counts[place[start : start + len(key)]]
            start += len(key)
            open_ = np.unique((key // len(words))[found == 0])
            open_ = open_[~hot[open_]]
            own = (thin(found), [thin(c) for c in sums[open_].T], mass[open_])
            rows.append((source, bucket, packed(*own)))
        own = (np.append(histories[hot], ALL), sums[hot], mass[hot], counts_of_counts(counts))
        rows.append((NOWHERE, bucket, packed(*own)))
        return pa.Table.from_batches([mail(rows)])

    return count


SUMS = [f"s{r}" for r in range(1, RELIABLE + 2)]


def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What buckets have in all, as rows: sums of frequent histories and counts of counts."""
    for batch in batches:
        for payload in batch.column("payload"):
            histories, sums, mass, of = unpacked(payload.as_py())
            columns = [pa.array(histories, pa.int64())]
            columns += [pa.array(c, pa.int64()) for c in np.concatenate([sums, [of]]).T]
            columns.append(pa.array(np.append(mass, 0.0), pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, ["h", *SUMS, "mass"])


def add_up(model: Model):
    """A batch's scores of its texts, from the answers about its words and pairs."""

    def add(table: pa.Table) -> pa.Table:
        post = letters(table)
        own = dict(post[:2])
        hashes, (tokens, lengths, _, scored, ids) = own[WORDS][0], own[TEXTS]
        about_words = [a for source, a in post if 0 <= source < model.buckets]
        about_pairs = [a for source, a in post if source >= model.buckets]
        tokens, lengths = thick(tokens), thick(lengths)
        counts, numbers = known_words(model, hashes, about_words)
        h, w, place = pairs_of(tokens, lengths, len(hashes))
        order, _ = deal_pairs(model, numbers[h], numbers[w])
        found = np.empty(len(order), np.int64)
        found[order] = np.concatenate([thick(c) for c, _, _ in about_pairs])
        hot = model.hot_places(numbers[h])
        weights = np.where(hot < 0, 0.0, model.hot_weights[hot])
        # Other histories of pairs not seen, as the buckets have them.
        open_ = order[(found[order] == 0) & (hot[order] < 0)]
        sums = np.concatenate([np.stack([thick(c) for c in s], axis=1) for _, s, _ in about_pairs])
        mass = np.concatenate([m for *_, m in about_pairs])
        new = np.diff(h[open_], prepend=-1) != 0
        weights[open_] = model.log_weights(sums, mass)[np.cumsum(new) - 1]
        history_counts = np.maximum(1, np.append(counts, model.starts))
        seen = discounted(np.maximum(found, 1), model.pair_factors) / history_counts[h]
        logs = np.where(found > 0, np.log10(seen), np.log10(model.unigram(counts))[w] + weights)
        of, n = np.repeat(np.arange(len(lengths)), lengths), len(lengths)
        columns = [
            lengths,
            np.bincount(of, (counts > 0)[tokens], n).astype(np.int64),
            np.full(n, model.tokens),
            np.bincount(of, model.log_base(counts)[tokens], n),
            np.bincount(of, logs[place], n),
        ]
        return pa.Table.from_arrays(
            [ids, *[pa.array(c[scored]) for c in columns]],
            ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return add


def own_mail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, words, texts in zip(*batch.columns, strict=True):
            to = number.as_py()
            yield mail([(to, WORDS, words.as_py()), (to, TEXTS, texts.as_py())])


def learn_words(coded: DataFrame) -> tuple[Model, DataFrame]:
    """The model without its pairs, and what batches are told of their words."""
    total = coded.agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "train_tokens", "train_texts")]
    ).first()
    buckets = max(FEWEST_BUCKETS, -(-total[0] // TOKENS_PER_BUCKET))
    answers = stored(
        coded.select("batch", "words")
        .mapInArrow(ask_words(buckets), MAIL)
        .groupBy("to")
        .applyInArrow(count_words(buckets, max(1.0, FREQUENT_SHARE * total[1])), MAIL),
        "words",
    )
    # One row for each bucket, with at most 1 / FREQUENT_SHARE words in all.
    own = [unpacked(r["payload"]) for r in answers.where(F.col("to") == NOWHERE).collect()]
    of = np.sum([o[1] for o in own], axis=0) if own else np.zeros(RELIABLE + 1)
    factors = discounts(list(of))
    mass = sum(left(o[2], factors) for o in own)
    return Model(
        tokens=total[1],
        words=sum(o[0] for o in own),
        starts=total[2],
        buckets=buckets,
        unigram_factors=factors,
        unknown=mass / max(1, total[1]),
        hot=np.sort(np.concatenate([[START], *[o[3] for o in own]])).astype(np.int64),
    ), answers.where(F.col("to") != NOWHERE)


def learn_pairs(coded: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """What batches are told of their pairs; adds factors and weights to the model."""
    answers = stored(
        coded.select("batch", "words", "texts")
        .mapInArrow(list_pairs, MAIL)
        .unionByName(words)
        .groupBy("to")
        .applyInArrow(ask_pairs(model), MAIL)
        .groupBy("to")
        .applyInArrow(count_pairs(model), MAIL),
        "bigrams",
    )
    in_all = (
        answers.where(F.col("to") == NOWHERE)
        .select("payload")
        .mapInArrow(told, f"h long, {', '.join(f'{c} long' for c in SUMS)}, mass double")
        .groupBy("h")
        .agg(*[F.sum(c).alias(c) for c in (*SUMS, "mass")])
    )
    rows = {r["h"]: r for r in in_all.collect()}  # at most 1 / FREQUENT_SHARE, and two
    of = list(rows.pop(ALL)[1:-1]) if rows else [0] * (RELIABLE + 1)
    model.pair_factors = discounts(of)
    model.hot_weights = np.zeros(len(model.hot))
    for at, h in enumerate(model.hot.tolist()):
        if h in rows:
            *sums, mass = rows[h][1:]
            model.hot_weights[at] = model.log_weights(np.array([sums]), np.array([mass]))[0]
    return answers.where(F.col("to") != NOWHERE)


def score(documents: DataFrame, training: DataFrame | Column) -> DataFrame:
    """Scores of documents under the model of the ``training`` texts: those of a table,
    or those documents for which a condition holds, which are then read once.

    Columns: ``doc_id``, ``n_tokens``, ``n_known`` (tokens that occur in training),
    ``train_tokens``, ``base_score`` (add-half unigrams), ``score`` (log10 probability of
    the text under the model). A null or empty text is its end alone. Without training
    texts, ``score`` is 0. Other columns are ignored; an empty table gives an empty
    result. Words are compared by 64-bit hashes.
    """
    yes, no = F.lit(True).alias("scored"), F.lit(False)
    if isinstance(training, Column):
        trains = F.coalesce(training, no).alias("trains")
        rows = documents.select("doc_id", "text", yes, trains)
    else:
        no_id = F.lit(None).cast(documents.schema["doc_id"].dataType).alias("doc_id")
        rows = documents.select("doc_id", "text", yes, no.alias("trains")).unionByName(
            training.select(no_id, "text", no.alias("scored"), F.lit(True).alias("trains"))
        )
    coded = stored(code_texts(rows), "texts")
    model, words = learn_words(coded)
    pairs = learn_pairs(coded, model, words)
    schema = documents.select("doc_id").schema
    for name in ("n_tokens", "n_known", "train_tokens"):
        schema = schema.add(name, "long")
    for name in ("base_score", "score"):
        schema = schema.add(name, "double")
    # Sources tell the answers apart: those about pairs follow those about words.
    return (
        coded.select("batch", "words", "texts")
        .mapInArrow(own_mail, MAIL)
        .unionByName(words)
        .unionByName(pairs.withColumn("source", F.col("source") + model.buckets))
        .groupBy("to")
        .applyInArrow(add_up(model), schema)
    )
