"""Phrases, archives and lexical search against plain versions of what they compute."""

import base64
import collections
import hashlib
import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from bindery.llm import collocations, lexical, warc

TEXT = "doc_id long, text string, lang string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sentences(n, seed, vocabulary):
    r = random.Random(seed)
    return "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(n))


# --- phrases ---------------------------------------------------------------------------


def plain_phrases(rows, longest, threshold, limit, percent):
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        f = counts["und" if lang is None else lang]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= threshold}
        gone = set()
        for p, c in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * c >= percent * candidates[p[i : i + k]]:
                        gone.add(p[i : i + k])
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min(
                    (1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))
                )
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out, key=str)


WORDS = ["New", "new", "york", "Ärger", "ärger", "a", "b", "É", "x\x00y", "\x1c", "中文", "o'k", "long-word"]
PHRASE_ROWS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n.,;", None),
    (4, sentences(3000, 1, WORDS), "en"),
    (5, sentences(2000, 2, WORDS), "de"),
    (6, sentences(500, 3, WORDS), None),
    (7, sentences(500, 4, WORDS), "und"),
    (8, "tie one. tie two. " * 12, "fr"),
    (8, "tie one. tie two. " * 12, "fr"),
    (None, "a a a a a a a a a a a a", "es"),
    (9, "new york " * 30_000, "en"),
]


@pytest.fixture(scope="module")
def phrase_rows(spark):
    rows = spark.createDataFrame(PHRASE_ROWS, TEXT).repartition(4)
    return rows.withColumns({c: F.lit("x") for c in ("phrase", "c", "part", "rank", "k", "first", "n")})


@pytest.mark.parametrize("longest, threshold, percent", [(3, 10, 50), (2, 2, 50), (4, 3, 90)])
def test_phrases_are_those_of_a_plain_count(phrase_rows, longest, threshold, percent):
    # Parts of few occurrences, so that there are many of them.
    found = collocations.collocations(phrase_rows, longest, threshold, 40, percent, part_mass=5000)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    wanted = plain_phrases(PHRASE_ROWS, longest, threshold, 40, percent)
    assert wanted and sorted_rows(found) == wanted


def test_phrases_without_a_limit_and_of_no_rows(spark, phrase_rows):
    found = collocations.collocations(phrase_rows, limit=None)
    assert sorted_rows(found) == plain_phrases(PHRASE_ROWS, 3, 10, None, 50)
    assert collocations.collocations(phrase_rows.limit(0)).collect() == []
    with pytest.raises(ValueError):
        collocations.collocations(phrase_rows, longest=1)


def test_summary_keeps_all_frequent_keys_within_its_capacity():
    r = np.random.default_rng(5)
    for _ in range(20):
        keys = np.concatenate([r.integers(0, 3000, 20_000), r.zipf(1.3, 20_000) % 5000])
        threshold = int(r.integers(5, 60))
        capacity = len(keys) // threshold + 1
        whole = collocations.Summary(capacity)
        for some in np.array_split(r.permutation(keys), 7):  # summaries of parts, merged
            whole.add(*(a.astype(t) for a, t in zip(np.unique(some, return_counts=True), (np.uint32, np.int64))))
            whole.merge()
        true = dict(zip(*np.unique(keys, return_counts=True)))
        assert len(whole.keys) <= capacity and whole.off < threshold
        assert all(true[k] - whole.off <= c <= true[k] for k, c in zip(whole.keys, whole.counts))
        assert {k for k, c in true.items() if c >= threshold} <= set(whole.survivors(threshold))


def test_sums_are_packed_and_unpacked():
    keys, counts = np.array([5, 1, 9], dtype=np.uint32), np.array([1, 7, 1])
    got = collocations.unpacked(*collocations.packed(keys, counts))
    assert dict(zip(*got)) == {5: 1, 1: 7, 9: 1}


# --- archives --------------------------------------------------------------------------

PAGES = [
    (3, "http://a.example/3", "<p>same</p>"),
    (1, "http://a.example/1", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (4, "http://a.example/ü\r\nX-Injected: yes", "<p>größe \U0001f600\r\n\r\nWARC/1.1\r\n</p>"),
    (5, "", None),
    (6, "http://a.example/6", ""),
    (7, "http://a.example/7", "x" * 3_000_000),
    (8, "http://a.example/8", "twice"),
    (8, "http://a.example/8", "twice"),
    (8, "http://a.example/8", "other"),
    (None, "http://a.example/n", "<p>same</p>"),
    (None, "http://a.example/m", "alone"),
    (None, "http://a.example/m", "alone"),
] + [(100 + i, f"http://b.example/{i}", f"<html><body>{'word ' * (i % 50)}{i}</body></html>") for i in range(300)]


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    return rows.withColumns({c: F.lit("x") for c in ("key", "_id", "payload", "start", "_sha1")})


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain_records(min_bytes):
    groups = collections.defaultdict(list)
    for page_id, _, html in PAGES:
        groups[(html or "").encode()].append(page_id)
    out = []
    for payload, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        seen = False
        for i in ids:
            response = len(payload) < min_bytes or first is None or (i == first and not seen)
            seen |= i == first
            row = (None if i is None else str(i), len(payload), digest(payload))
            out.append((*row, "response" if response else "revisit", None if response else str(first)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 6, 10**9])
def test_archives_read_back_as_written(spark, pages, tmp_path, min_bytes):
    folder = f"file://{tmp_path}"
    places = warc.write(pages, folder, min_bytes=min_bytes, archive_bytes=20_000)
    again = places.collect()
    places.collect()  # a job that runs twice leaves the same files
    found = warc.read(spark, folder)
    got = found.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted_rows(got) == plain_records(min_bytes)
    payloads = collections.Counter(bytes(r.payload) for r in found.where("record_type = 'response'").collect())
    wanted = collections.Counter((h or "").encode() for _, _, h in PAGES)
    assert set(payloads) == set(wanted)
    files = {p.name for p in Path(tmp_path).glob("*.zst")}
    assert files == {r.archive for r in again} and len(files) > 4
    # Each record can be read by its place alone.
    for row in random.Random(1).sample(again, 20):
        content = (Path(tmp_path) / row.archive).read_bytes()
        record = warc.record_at(content, row.start, row.length)
        key = b"" if row.key is None else f"X-Record-Key: {row.key}\r\n".encode()
        assert record.startswith(b"WARC/1.1\r\n") and key in record


def test_archive_begins_with_its_dictionary():
    records = [b"record number %d of many that are alike" % i * 20 for i in range(200)]
    made = warc.archive_of(records)
    dictionary, start = warc.dictionary_of(made.content)
    assert made.content[:4] == b"\x5d\x2a\x4d\x18" and start == made.starts[0]
    assert dictionary.startswith(warc.DICTIONARY_MAGIC)
    # Readers that know nothing of it skip the frame, and need the dictionary after it.
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    for record, at, length in zip(records, made.starts, made.lengths):
        assert reader.decompress(made.content[at : at + length]) == record
    for few in ([b"x"], [b"", b""], [b"short"] * 3):
        made = warc.archive_of(few)
        assert [warc.record_at(made.content, *p) for p in zip(made.starts, made.lengths)] == few


def test_header_values_stay_on_their_line(spark, pages, tmp_path):
    warc.write(pages, f"file://{tmp_path}").collect()
    row = warc.read(spark, f"file://{tmp_path}").where("key = '4'").first()
    assert row.url == "http://a.example/ü%0D%0AX-Injected: yes"


def test_damaged_archives_are_refused():
    made = warc.archive_of([warc.record_bytes("1", "u", b"payload", digest(b"payload"), None, "d")])
    assert [r["payload"] for r in warc.records_of(made.content)] == [b"payload"]
    wrong = warc.archive_of([warc.record_bytes("1", "u", b"payload", digest(b"other"), None, "d")])
    with pytest.raises(ValueError, match="differs"):
        list(warc.records_of(wrong.content))
    for content in (b"", made.content[4:], made.content[: made.starts[0] - 1]):
        with pytest.raises(ValueError):
            list(warc.records_of(content))


def test_no_pages_give_no_archive(spark, pages, tmp_path):
    assert warc.write(pages.limit(0), f"file://{tmp_path}").collect() == []
    assert not list(Path(tmp_path).glob("*.zst"))


# --- lexical search ---------------------------------------------------------------------


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def plain_ranks(documents, items, k):
    counted = [(d, collections.Counter(plain_terms(t))) for d, t, *_ in documents]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item].update(plain_terms(text))
    out = []
    for item, terms in asked.items():
        found = []
        for doc_id, c in counted:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = 0
            for t in terms:
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, doc_id, -score))
    return sorted(out, key=str)


TERMS = ["alpha", "Beta", "gamma3", "é", "中", "x1", "the", "the", "the", "of", "I'm", "rare"]
DOCUMENTS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, "\x00 ... \x7f", "en"),
    (4, "unique-term Unique", "en"),
    (5, sentences(20_000, 9, TERMS), "en"),
    (None, "alpha beta the", "en"),
    (None, "alpha beta the", "en"),
    (7, "alpha beta the", "en"),
    (7, "alpha beta the", "en"),
] + [(10 + i, sentences(1 + i % 90, i, TERMS + [f"w{i % 17}"]), "en") for i in range(150)]
ITEMS = [
    (1, "Alpha the"),
    (1, "alpha gamma3 the"),
    (2, None),
    (3, ""),
    (4, "nothing has these"),
    (5, "unique 中 é rare of the x1 i m w3 w5"),
    (6, "the of"),
    (6, "the of"),
    (None, "beta w1"),
] + [(20 + i, f"w{i} rare the") for i in range(12)]


@pytest.fixture(scope="module")
def searched(spark):
    documents = spark.createDataFrame(DOCUMENTS, TEXT).repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clash = {c: F.lit("x") for c in ("n", "m", "terms", "shard", "w", "score", "df", "chunk")}
    return documents.withColumns(clash), items.withColumns(clash)


@pytest.mark.parametrize("k, shard_docs, chunk_items", [(50, 16_384, 256), (5, 10, 4), (3, 40, 1)])
def test_search_finds_what_scoring_every_document_finds(searched, k, shard_docs, chunk_items):
    found = lexical.rank(*searched, k, shard_docs, chunk_items)
    wanted = plain_ranks(DOCUMENTS, ITEMS, k)
    assert wanted and sorted_rows(found) == wanted


def test_search_of_empty_tables(searched):
    documents, items = searched
    for pair in ((documents.limit(0), items), (documents, items.limit(0)), (documents.where("doc_id < 4"), items)):
        assert lexical.rank(*pair).collect() == []


def test_index_holds_every_document_by_its_length(spark, searched):
    documents, _ = searched
    counts = lexical.term_counts(documents)
    index, n_docs, n_terms = lexical.build_index(counts, 25)
    rows = index.collect()
    assert n_docs == sum(len(r.doc_ids) for r in rows) == sum(bool(plain_terms(t)) for _, t, _ in DOCUMENTS)
    assert n_terms == sum(len(plain_terms(t)) for _, t, _ in DOCUMENTS)
    assert len({(r.shard, r.m) for r in rows}) == len(rows)
    got = collections.Counter()
    for r in rows:
        starts, ends = r.run_places, [*r.run_places[1:], len(r.places)]
        for i, first in enumerate(r.term_runs):
            last = r.term_runs[i + 1] if i + 1 < len(r.term_runs) else len(r.tfs)
            assert list(r.tfs[first:last]) == sorted(set(r.tfs[first:last]), reverse=True)
            for run in range(first, last):
                for place in r.places[starts[run] : ends[run]]:
                    got[r.doc_ids[place], r.terms[i], r.tfs[run]] += 1
    wanted = collections.Counter(
        (d, t, tf) for d, text, _ in DOCUMENTS for t, tf in collections.Counter(plain_terms(text)).items()
    )
    assert got == wanted


def test_search_stops_at_the_bound():
    import pyarrow as pa

    class Counted(lexical.Stratum):
        visits = 0

        def scores(self, codes, weights):
            Counted.visits += 1
            return super().scores(codes, weights)

    # One short document with the term, and many long strata that cannot beat it.
    m = [50, *range(1000, 1100)]
    shard = pa.table(
        {
            "shard": pa.array([0] * len(m), pa.int32()),
            "m": m,
            "doc_id": list(range(len(m))),
            "terms": [["t"]] * len(m),
            "tfs": pa.array([[3]] + [[1]] * 100, pa.list_(pa.int32())),
        }
    )
    rows = [{k: pa.scalar(v) if isinstance(v, int) else lexical.listed([v])[0] for k, v in r.items()} for r in lexical.strata(shard)]
    asked = pa.table({"item": [1], "item_id": [1], "term": ["t"], "w": [1000]})
    chunk = lexical.Chunk(asked)
    found = [Counted(r, chunk.vocabulary) for r in rows]
    bounds = np.array([chunk.bounds(s)[0] for s in found])
    best = chunk.search(0, found, bounds, 1)
    assert [b[2] for b in best] == [0] and Counted.visits == 1
