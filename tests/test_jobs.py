import pyarrow.parquet as pq
import pytest
from conftest import BASE, image_group, manifest, rows
from pyspark.sql import functions as F
from test_sources import header, page

from bindery.functions import files
from bindery.operators import changes, fetching, outcomes
from bindery.plans import auditing, download, listing, publication
from bindery.sources import archives, lists
from bindery.streaming import listing as stream

CONTENT = "<xml>test cöntent</xml>".encode()


class Mirror:
    """Folder that stands for the provider; files can be made to fail."""

    def __init__(self, root):
        self.root = root

    def put(self, url, content):
        path = self.root / url.split("://", 1)[-1].replace("?", "_")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)

    def put_binding(self, id_, pages):
        self.put(f"{BASE}{id_}/mets.xml?full=true", manifest([image_group(pages)]).encode())
        for i in range(1, pages + 1):
            self.put(f"{BASE}{id_}/image/{i}", bytes([i]) * 10)
            self.put(f"{BASE}{id_}/page-{i}.xml", CONTENT)

    def fetcher(self, failing=None):
        read = fetching.folder_fetcher(str(self.root))
        failing = failing or {}

        def fetch(url):
            status = failing.get(url)
            if status is None:
                return read(url)
            if status == 0:
                raise TimeoutError("no answer")
            return status, b""

        return fetch


@pytest.fixture
def mirror(tmp_path):
    return Mirror(tmp_path / "mirror")


def batched(spark, ids):
    changes = spark.createDataFrame(
        [(i, BASE + i, "added") for i in ids],
        "binding_id string, dc_identifier string, kind string",
    )
    return download.batched_bindings(download.plan_subsets(changes, ["1", "2", ""], initial=True))


def test_stow(spark, tmp_path, mirror):
    mirror.put_binding("11", 3)
    mirror.put_binding("21", 1)
    mirror.put(f"{BASE}22/mets.xml?full=true", b"")
    mirror.put(f"{BASE}23/mets.xml?full=true", b"<mets>")
    fetcher = mirror.fetcher({f"{BASE}11/image/1": 500, f"{BASE}21/page-1.xml": 0})
    staged = download.stow(batched(spark, ["11", "21", "22", "23", "24"]), fetcher, str(tmp_path / "s"))
    found = rows(
        staged.log.select("binding_id", "kind", F.coalesce("page_number", F.lit(0)), "outcome")
    )
    assert found == sorted(
        [
            ("11", "mets", 0, "ok"),
            ("11", "access_img", 1, "error"),
            ("11", "access_img", 2, "not_attempted"),
            ("11", "access_img", 3, "not_attempted"),
            *[("11", "alto", i, "ok") for i in (1, 2, 3)],
            ("21", "mets", 0, "ok"),
            ("21", "access_img", 1, "ok"),
            ("21", "alto", 1, "no_response"),
            ("22", "mets", 0, "empty"),
            ("23", "mets", 0, "ok"),
            ("23", "mets", 0, "error"),
            ("24", "mets", 0, "not_found"),
        ]
    )
    content = {r["path"]: bytes(r["content"]) for r in staged.content.collect()}
    assert content["1/11/11/alto/00002.xml"] == CONTENT
    assert content["2/21/21/access_img/00001.jp2"] == bytes([1]) * 10
    assert "1/11/11/access_img/00002.jp2" not in content
    assert rows(staged.verdicts.select("subset_id", "batch_index", "verdict")) == [
        ("1", 0, "fail"), ("2", 0, "fail"),
    ]


def test_only_one_kind(spark, tmp_path, mirror):
    mirror.put_binding("11", 2)
    staged = download.stow(
        batched(spark, ["11"]), mirror.fetcher(), str(tmp_path / "s"), kinds=[files.ALTO]
    )
    assert rows(staged.content.select("kind").distinct()) == [("alto",), ("mets",)]


def test_retries_fetch_only_what_is_missing(spark, tmp_path, mirror):
    mirror.put_binding("11", 2)
    mirror.put_binding("21", 2)
    fetcher = mirror.fetcher({f"{BASE}11/image/2": 404})
    staged = download.stow_with_retries(batched(spark, ["11", "21"]), fetcher, str(tmp_path / "s"))
    attempts = staged.log.groupBy("attempt").count()
    assert rows(attempts) == [(1, 10), (2, 1), (3, 1)]
    assert rows(staged.verdicts.select("subset_id", "attempt", "verdict")) == [
        ("1", 3, "proceed"), ("2", 1, "proceed"),
    ]
    assert staged.content.count() == staged.content.select("path").distinct().count() == 9
    last = outcomes.latest_attempts(staged.log.where("path like '%access_img/00002.jp2'"), ["path"])
    assert rows(last) == [
        ("1/11/11/access_img/00002.jp2", 3, 3, "not_found"),
        ("2/21/21/access_img/00002.jp2", 1, 1, "ok"),
    ]


def test_pages_listed_twice_and_empty_pages(spark, tmp_path, mirror):
    """A page listed twice is fetched once; an empty one again in every attempt."""
    twice = [(f'ID="{n}" SEQ="1"', [f"{n}.jp2"]) for n in ("a", "b")]
    third = [('ID="c" SEQ="3"', ["c.jp2"])]
    text = manifest([("IMGGRP", "Images", twice + third)])
    mirror.put(f"{BASE}11/mets.xml?full=true", text.encode())
    mirror.put(f"{BASE}11/image/1", b"x")
    mirror.put(f"{BASE}11/page-1.xml", b"")
    mirror.put(f"{BASE}11/page-3.xml", CONTENT)
    staged = download.stow_with_retries(batched(spark, ["11"]), mirror.fetcher(), str(tmp_path / "s"))
    found = staged.log.where("kind <> 'mets'").groupBy("attempt", "kind", "page_number", "outcome").count()
    again = [
        (n, kind, page, outcome, count)
        for n in (2, 3)
        for kind, page, outcome, count in [("access_img", 3, "not_found", 1), ("alto", 1, "ok", 2)]
    ]
    assert rows(found) == [
        (1, "access_img", 1, "ok", 1), (1, "access_img", 1, "skipped", 1),
        (1, "access_img", 3, "not_found", 1), (1, "alto", 1, "ok", 2), (1, "alto", 3, "ok", 1),
        *again,
    ]
    sizes = rows(staged.content.where("kind <> 'mets'").select("path", "size"))
    assert sizes == [
        ("1/11/11/access_img/00001.jp2", 1),
        ("1/11/11/alto/00001.xml", 0),
        ("1/11/11/alto/00003.xml", len(CONTENT)),
    ]


def test_a_stop_keeps_what_came_before(spark, tmp_path, mirror):
    """A page that is listed again after the stop keeps its first content."""
    members = [(f'SEQ="{n}"', [f"{n}.jp2"]) for n in (1, 2, 1, 3)]
    mirror.put(f"{BASE}11/mets.xml?full=true", manifest([("IMGGRP", "Images", members)]).encode())
    for i in (1, 2, 3):
        mirror.put(f"{BASE}11/image/{i}", b"x")
        mirror.put(f"{BASE}11/page-{i}.xml", CONTENT)
    fetcher = mirror.fetcher({f"{BASE}11/image/2": 503})
    staged = download.stow(batched(spark, ["11"]), fetcher, str(tmp_path / "s"))
    images = staged.log.where("kind = 'access_img'").select("position", "outcome")
    assert rows(images) == [
        (0, "ok"), (1, "error"), (2, "not_attempted"), (3, "not_attempted"),
    ]
    assert rows(staged.content.where("kind = 'access_img'").select("page_number")) == [(1,)]


def test_large_content_is_handed_on_in_pieces(spark, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(fetching, "MAX_BATCH_ROWS", 2)
    plan = spark.createDataFrame([(str(i),) for i in range(5)], "path string").withColumn(
        "download_url", F.col("path")
    )
    found = fetching.fetch(plan, lambda url: (200, url.encode()), partitions=1)
    assert rows(found.select("path", F.decode("content", "utf-8"))) == [(str(i),) * 2 for i in range(5)]
    result = (200, None, 0, b"", False)
    part = fetching._with_results(pd.DataFrame({"a": [1, 2, 3]}), 1, [result])
    assert part.to_dict("records")[0]["a"] == 2


@pytest.mark.parametrize("set_id", ["col-1", "col-1:col-2"])
def test_update_cycle(spark, tmp_path, mirror, set_id):
    """Initial load, update with additions and deletions, listings and versions."""
    root = str(tmp_path / "store")
    publication.create_store(spark, root)
    publication.create_store(spark, root)

    def update(run, day, ids, gone):
        staged = download.stow_with_retries(batched(spark, ids), mirror.fetcher(), f"{root}/staging/{run}")
        deleted = spark.createDataFrame(gone, "subset_id string, binding_id string")
        publication.apply_update(spark, root, set_id, run, day, staged.content, deleted)
        listed = [("added", i) for i in ids] + [("deleted", g) for _, g in gone]
        wanted = spark.createDataFrame(listed, "kind string, binding_id string")
        published = publication.read_published(spark, root)
        present = archives.mets_ids(archives.as_entries(published))
        return rows(changes.change_listings(wanted, present))

    def marker():
        return publication.current_version(
            publication.read_pointers(spark, root), publication.read_versions(spark, root)
        ).first()[0]

    def held(**kwargs):
        return rows(publication.read_published(spark, root, **kwargs).select("binding_id").distinct())

    for id_ in ("11", "12", "21", "31"):
        mirror.put_binding(id_, 1)
    assert marker() is None
    first = update("r1", "2024-01-31", ["11", "12", "21", "31", "32"], [])
    assert first == [
        *[("added_bindings", i) for i in ("11", "12", "21", "31")], ("added_bindings_FAILED", "32"),
    ]
    assert held() == [("11",), ("12",), ("21",), ("31",)]
    # The empty prefix is a subset like any other.
    assert rows(publication.read_published(spark, root, set_id, [""]).select("subset_id").distinct()) == [("",)]
    publication.create_version(spark, root, "aaaaaaaa", "2024-01-31 12:00:00")
    assert marker() == "aaaaaaaa"

    # 13 is added and deleted at once, 21 is the last of its subset, 99 was never there.
    mirror.put_binding("13", 1)
    second = update("r2", "2024-02-29", ["13"], [("1", "13"), ("1", "11"), ("2", "21"), ("1", "199")])
    assert second == [
        ("added_bindings_FAILED", "13"),
        *[("deleted_bindings", i) for i in ("11", "13", "199", "21")],
    ]
    assert held() == [("12",), ("31",)]
    assert marker() is None
    publication.create_version(spark, root, "bbbbbbbb", "2024-03-01 12:00:00")
    assert marker() == "bbbbbbbb"

    # The untouched subset still points to the first run; the last one got no files.
    newest = publication.current_locations(publication.read_pointers(spark, root))
    attempt = F.regexp_replace("location", r"\.[0-9a-f]{32}/", "/")
    where = rows(newest.select("subset_id", attempt))
    folder = set_id.replace(":", "_")
    assert where == [
        ("", f"run_id={folder}.r1/target={folder}"),
        ("1", f"run_id={folder}.r2/target={folder}_1"),
        ("2", None),
    ]
    # Compaction changes nothing that is published.
    publication.compact(spark, root, set_id)
    assert held() == [("12",), ("31",)]
    assert marker() == "bbbbbbbb"
    versions = publication.read_versions(spark, root)
    assert [r[0] for r in rows(publication.list_versions(versions))] == ["aaaaaaaa", "bbbbbbbb"]

    def restored(*args, **kwargs):
        return rows(publication.read_version(spark, root, *args, **kwargs).select("binding_id").distinct())

    assert restored("aaaaaaaa") == [("11",), ("12",), ("21",), ("31",)]
    assert restored() == [("12",), ("31",)]
    assert restored("aaaaaaaa", include="/21/") == [("21",)]
    assert restored("aaaaaaaa", exclude="^1/") == [("21",), ("31",)]
    with pytest.raises(LookupError):
        publication.read_version(spark, root, "cccccccc")
    one = publication.select_binding(spark, root, set_id, "12")
    assert rows(one.select("kind")) == [("access_img",), ("alto",), ("mets",)]
    assert publication.select_binding(spark, root, set_id, "11").count() == 0

    # An update without changes publishes nothing.
    publication.apply_update(
        spark, root, set_id, "r3", "2024-03-31", one.limit(0),
        spark.createDataFrame([], "subset_id string, binding_id string"),
    )
    assert marker() == "bbbbbbbb"
    ids = spark.createDataFrame([("12",), ("31",), ("14",)], "binding_id string")
    errors = auditing.audit_archive(
        publication.read_published(spark, root), ids, BASE, f"{root}/staging/audit"
    )
    found = rows(errors.select("archive", "binding_id", "error_class"))
    # The target without a prefix expects every ID.
    assert found == [
        (f"{set_id}.zip", "12", "missing_mets"),
        (f"{set_id}.zip", "14", "missing_mets"),
        (f"{set_id}_1.zip", "14", "missing_mets"),
    ]


def archive_rows(spark, *paths):
    """Manifests of bindings of subset 1, with their path as content."""
    found = [("1", p.split("/")[0], "mets", None, p, 1, p.encode()) for p in paths]
    return spark.createDataFrame(
        found,
        "subset_id string, binding_id string, kind string, page_number int, path string, "
        "size bigint, content binary",
    )


def store_of(spark, tmp_path):
    """Empty store, a function that publishes paths, and one that reads them."""
    root = str(tmp_path / "store")
    publication.create_store(spark, root)

    def add(set_id, run, *paths, gone=()):
        deleted = spark.createDataFrame([("1", g) for g in gone], "subset_id string, binding_id string")
        publication.apply_update(spark, root, set_id, run, "2024-01-31", archive_rows(spark, *paths), deleted)

    def held(**kwargs):
        return rows(publication.read_published(spark, root, **kwargs).select("set_id", "path"))

    return root, add, held


def test_a_published_run_is_refused(spark, tmp_path):
    root, add, held = store_of(spark, tmp_path)
    add("s", "r1", "11/a", "12/a")
    publication.create_version(spark, root, "v1", "2024-01-31")
    for _ in range(2):
        with pytest.raises(ValueError, match="already published"):
            add("s", "r1", "13/a")
    with pytest.raises(ValueError, match="already there"):
        publication.create_version(spark, root, "v1", "2024-02-01")
    assert held() == [("s", "11/a"), ("s", "12/a")]
    assert publication.read_version(spark, root, "v1").count() == 2
    # Another set may have a run of that name.
    add("t", "r1", "11/a")
    assert held(set_id="t") == [("t", "11/a")]


def test_updates_of_one_day(spark, tmp_path):
    root, add, held = store_of(spark, tmp_path)
    for run, path in (("r1", "11/a"), ("r2", "12/a"), ("r3", "13/a")):
        add("s", run, path)
        publication.create_version(spark, root, run, "2024-01-31")
    assert held() == [("s", "11/a"), ("s", "12/a"), ("s", "13/a")]
    # A replaced row, a deleted binding, and one that comes back after it was deleted.
    add("s", "r4", "11/a", "11/b", gone=["12"])
    add("s", "r5", "12/a")
    publication.compact(spark, root, "s")
    add("s", "r6", gone=["13"])
    assert held() == [("s", "11/a"), ("s", "11/b"), ("s", "12/a")]
    assert publication.read_version(spark, root, "r2").count() == 2
    assert publication.read_version(spark, root, "r3").count() == 3


def test_sets_of_alike_names(spark, tmp_path):
    _, add, held = store_of(spark, tmp_path)
    add("a:b", "r1", "11/a")
    add("a_b", "r1", "12/a")
    assert held() == [("a:b", "11/a"), ("a_b", "12/a")]


def test_version_ids_of_a_log(spark):
    log = spark.createDataFrame([("start",), ("snapshot 2f8df9e7 saved",)], "line string")
    assert rows(publication.version_ids(log)) == [("2f8df9e7",)]


def test_landed_responses_are_those_of_a_fetch(spark, tmp_path):
    plan = spark.createDataFrame(
        [("p1", "u1", 0), ("p1", "u1", 1), ("p2", "u2", 0), ("p2", "u2", 1), ("p3", "u3", 0), ("p4", None, 0)],
        "path string, download_url string, position int",
    )
    answers = {"u1": (200, b"x"), "u2": (404, b""), "u9": (200, b"y")}
    responses = spark.createDataFrame(
        [(u, *a) for u, a in answers.items()], "url string, status int, content binary"
    )
    columns = ["path", "position", "status", "n_bytes", "content", "skipped"]
    found = rows(fetching.from_responses(plan, responses).select(columns))
    assert found == rows(fetching.fetch(plan, answers.__getitem__, 1).select(columns))


@pytest.mark.parametrize(("kind", "codec"), [("access_img", "UNCOMPRESSED"), ("alto", "ZSTD")])
def test_each_kind_has_its_compression(spark, tmp_path, kind, codec):
    path = str(tmp_path / kind)
    fetching.write_fetched(spark.range(9).withColumn("content", F.lit(b"abc")), path, kind)
    for file in (tmp_path / kind).glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        assert {group.column(i).compression for i in range(2)} == {codec}


def landed(folder, name, *headers):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(page("ListIdentifiers", "".join(headers)))


def test_listing_job(spark, tmp_path):
    landing = tmp_path / "landing"
    landed(landing / "set_id=a%3Ab", "1.xml", header(1, "2024-01-10T00:00:00Z", ["a:b"]),
           header(2, "2024-02-29T00:00:00Z", ["a:b"]))
    landed(landing / "set_id=c", "1.xml", header(3, "2023-01-10T00:00:00Z", ["c"]))
    landed(landing / "set_id=unconfigured", "1.xml", header(4, "2024-06-01T00:00:00Z", ["x"]))
    deleted = tmp_path / "deleted"
    landed(deleted / "set_id=deleted", "1.xml", header(5, "2024-01-10T00:00:00Z", ["a:b", "c"], True),
           header(6, "2024-03-01T00:00:00Z", ["a:b", "a"], True))
    sets = spark.createDataFrame([("a:b",), ("c",)], "set_id string")
    runs = spark.createDataFrame(
        [("a:b", "r1", "success", "2024-02-29 10:00:00")],
        "set_id string, run_id string, state string, t string",
    ).withColumn("execution_date", F.col("t").cast("timestamp"))

    def listed(root, runs):
        listing.run_listing(spark, str(landing), str(deleted), sets, BASE, "2024-05-01", root, runs)
        found = lists.latest_lists(lists.read_binding_lists(spark, root), lists.read_list_markers(spark, root))
        return rows(found.select("set_id", "kind", F.replace("dc_identifier", F.lit(BASE), F.lit(""))))

    assert listed(str(tmp_path / "all"), None) == [
        ("a:b", "added", "1"), ("a:b", "added", "2"), ("a:b", "deleted", "5"),
        ("a:b", "deleted", "6"), ("c", "added", "3"), ("c", "deleted", "5"),
    ]
    # A set without a successful run is listed from the start.
    assert listed(str(tmp_path / "new"), runs) == [
        ("a:b", "added", "2"), ("a:b", "deleted", "6"), ("c", "added", "3"), ("c", "deleted", "5"),
    ]


def test_streamed_listing_reads_each_page_once(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "out")

    def run():
        query = stream.append_new_identifiers(
            stream.stream_headers(spark, str(landing)), BASE, target, str(tmp_path / "checkpoint")
        )
        query.awaitTermination(120)
        assert query.exception() is None
        return rows(spark.read.parquet(target).select("batch_id", "set_id", "dc_identifier"))

    landed(landing / "set_id=a", "1.xml", header(1, "2024-01-10T00:00:00Z", ["a"]))
    assert run() == [(0, "a", BASE + "1")]
    landed(landing / "set_id=a", "2.xml", header(2, "2024-01-10T00:00:00Z", ["a"]))
    assert run() == [(0, "a", BASE + "1"), (1, "a", BASE + "2")]
    assert len(run()) == 2
