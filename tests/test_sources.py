import datetime

import pytest
from conftest import BASE, image_group, manifest, rows
from pyspark.sql import functions as F

from bindery.sources import archives, listings, lists, manifests

UTC = datetime.datetime


def header(n, stamp, sets, deleted=False):
    status = ' status="deleted"' if deleted else ""
    specs = "".join(f"<setSpec>{s}</setSpec>" for s in sets)
    return (
        f"<header{status}><identifier>oai:host:{n}</identifier>"
        f"<datestamp>{stamp}</datestamp>{specs}</header>"
    )


def page(verb, body, token=None):
    if token is not None:
        body += f'<resumptionToken completeListSize="{token}" cursor="0">t</resumptionToken>'
    return (
        '<?xml version="1.0" encoding="UTF-8"?>'
        '<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">'
        f"<responseDate>2024-05-01T00:00:00Z</responseDate><{verb}>{body}</{verb}></OAI-PMH>"
    )


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing" / "set_id=col-7%3Acol-8"
    folder.mkdir(parents=True)
    first = "".join(header(i, "2024-04-30T22:00:00Z", ["a", "col-7:col-8"]) for i in range(100))
    second = "".join(header(i, "2024-05-02T22:00:00Z", ["a"]) for i in range(100, 106))
    (folder / "p1.xml").write_text(page("ListIdentifiers", first, token=106))
    (folder / "p2.xml").write_text(page("ListIdentifiers", second))
    return str(tmp_path / "landing")


def test_identifiers_of_a_listing_of_two_pages(spark, landing):
    headers = listings.read_headers(spark, landing)
    found = rows(listings.list_identifiers(headers, BASE))
    assert len(found) == 106
    assert ("col-7:col-8", BASE + "105") in found
    recent = rows(listings.list_identifiers(headers, BASE, "2024-05-01"))
    assert recent == [("col-7:col-8", BASE + str(i)) for i in range(100, 106)]


def test_complete_and_incomplete_listings(spark, landing):
    headers = listings.read_headers(spark, landing)
    tokens = listings.read_page_tokens(spark, landing)
    assert listings.incomplete_listings(headers, tokens, ["set_id"]).count() == 0
    short = headers.where("identifier <> 'oai:host:5'")
    assert rows(listings.incomplete_listings(short, tokens, ["set_id"])) == [
        ("col-7:col-8", 106, 105)
    ]


def test_deleted_records(spark, tmp_path):
    records = [
        header(1, "2024-05-01T00:00:00Z", ["c", "c:d"], True),
        header(2, "2024-04-30T23:59:59Z", ["c"], True),
        header(3, "2024-06-01T00:00:00Z", ["c:d"], True),
    ]
    body = "".join(f"<record>{r}</record>" for r in records)
    (tmp_path / "p.xml").write_text(page("ListRecords", body))
    headers = listings.read_headers(spark, str(tmp_path))
    assert rows(listings.list_deleted(headers, BASE, "c", "2024-05-01")) == [("c", BASE + "1")]
    assert rows(listings.list_deleted(headers, BASE, "c")) == [("c", BASE + "1"), ("c", BASE + "2")]
    assert rows(listings.list_deleted(headers, BASE, None, "2024-05-01")) == [
        ("c", BASE + "1"),
        ("c:d", BASE + "1"),
        ("c:d", BASE + "3"),
    ]
    text = spark.createDataFrame([(page("ListRecords", body, 3),)], "xml string")
    parsed = listings.parse_headers(text)
    assert rows(parsed.select("identifier", "datestamp", "setSpec", "_status")) == rows(
        headers.select("identifier", "datestamp", "setSpec", "_status")
    )
    assert listings.parse_page_tokens(text).first()["complete_list_size"] == 3


def test_sets(spark, tmp_path):
    body = "".join(
        f"<set><setSpec>{s}</setSpec><setName>{n}</setName></set>"
        for s, n in [("news", "Newspapers"), ("col-1:col-2", "Käsi & co".replace("&", "&amp;"))]
    )
    (tmp_path / "s.xml").write_text(page("ListSets", body))
    expected = [("col-1:col-2", "Käsi & co"), ("news", "Newspapers")]
    assert rows(listings.read_sets(spark, str(tmp_path))) == expected
    text = spark.createDataFrame([(page("ListSets", body),)], "xml string")
    assert rows(listings.parse_sets(text)) == expected


def test_latest_text_list(spark, tmp_path):
    folder = tmp_path / "col_0"
    folder.mkdir()
    (folder / "added_2024-01-31").write_text(BASE + "1\n")
    (folder / "added_2024-02-29").write_text(f"{BASE}201000\n{BASE}212000")
    (folder / "deleted_2024-02-29").write_text("")
    (folder / "added_2024-03-31.swp").write_text("x")
    root = str(tmp_path)
    found = rows(lists.read_latest_list(spark, root, "col:0", "added"))
    assert found == [(BASE + "201000", "201000"), (BASE + "212000", "212000")]
    assert rows(lists.read_latest_list(spark, root, "col:0", "deleted")) == []
    with pytest.raises(FileNotFoundError):
        lists.read_latest_list(spark, root, "col:1", "added")
    # A newer list of the other kind hides the older one of the wanted kind.
    (folder / "deleted_2024-03-31").write_text(BASE + "9\n")
    with pytest.raises(FileNotFoundError):
        lists.read_latest_list(spark, root, "col:0", "added")
    # A list may be a folder that Spark wrote, an empty one too.
    spark.range(0).selectExpr("string(id)").write.text(str(folder / "added_2024-04-30"))
    assert rows(lists.read_latest_list(spark, root, "col:0", "added")) == []
    (folder / "added_lately").write_text(BASE + "9\n")
    with pytest.raises(Exception, match="no date in the name of the list added_lately"):
        lists.read_latest_list(spark, root, "col:0", "added")


def test_list_table(spark, tmp_path):
    root = str(tmp_path)
    sets = spark.createDataFrame([("a:b",), ("c",)], "set_id string")

    def write(day, *changes):
        schema = "set_id string, kind string, dc_identifier string"
        lists.write_binding_lists(spark.createDataFrame(list(changes), schema), sets, day, root)

    def latest():
        found = lists.latest_lists(
            lists.read_binding_lists(spark, root), lists.read_list_markers(spark, root)
        )
        return rows(found.select("set_id", "kind", "dc_identifier"))

    write("2024-01-31", ("a:b", "added", "u1"), ("a:b", "deleted", "u2"), ("c", "added", "u3"))
    assert latest() == [("a:b", "added", "u1"), ("a:b", "deleted", "u2"), ("c", "added", "u3")]
    # Empty lists of a newer day count.
    write("2024-02-29", ("a:b", "added", "u4"))
    assert latest() == [("a:b", "added", "u4")]
    # A list that is written again and now empty is empty.
    write("2024-02-29", ("c", "deleted", "u5"))
    assert latest() == [("c", "deleted", "u5")]
    markers = lists.read_list_markers(spark, root)
    newest = markers.where(F.col("list_date") == "2024-02-29")
    assert rows(newest.select("set_id", "kind", "n_rows")) == [
        ("a:b", "added", 0),
        ("a:b", "deleted", 0),
        ("c", "added", 0),
        ("c", "deleted", 1),
    ]


def test_id_list_is_trimmed_after_the_prefix_test(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text("13\t\n131 \n 139\n20\n20\n\n")
    assert rows(lists.read_id_list(spark, str(path), "13")) == [("13",), ("131",)]
    assert rows(lists.read_id_list(spark, str(path))) == [
        ("",), ("13",), ("131",), ("139",), ("20",),
    ]


def test_subset_split_is_written_once(spark, tmp_path):
    root = str(tmp_path)
    lists.save_subset_split(lists.split_table(spark, "a:b", ["12", "1", ""]), root, "a:b")
    lists.save_subset_split(lists.split_table(spark, "a:b", ["9"]), root, "a:b")
    assert rows(lists.read_subset_split(spark, root, "a:b")) == [
        ("a:b", 0, "12"), ("a:b", 1, "1"), ("a:b", 2, ""),
    ]


def test_manifest_files_are_decoded(spark, tmp_path):
    text = manifest([image_group(1)], issued="Pävä")
    (tmp_path / "55_METS.xml").write_bytes(text.encode("latin-1"))
    (tmp_path / "other.xml").write_text("x")
    found = manifests.read_manifest_files(spark, str(tmp_path), "ISO-8859-1").collect()
    assert [(r["binding_id"], r["xml"]) for r in found] == [("55", text)]
    assert rows(archives.local_issues(spark, str(tmp_path)))[0][0].endswith(tmp_path.parent.name)


def test_entries_with_directories(spark):
    held = [("1/12/12/mets/12_METS.xml", 24), ("1/12/12/mets/x.txt", 3), ("ä/empty.txt", 0), ("n.txt", 1)]
    entries = spark.createDataFrame(
        [("set_1.zip", p, False, n) for p, n in held],
        "archive string, path string, is_dir boolean, size long",
    )
    found = archives.with_directories(entries)
    directories = [("1/12/12/mets/", True, 0), ("ä/", True, 0)]
    assert rows(found.select("path", "is_dir", "size")) == sorted(
        [(p, False, n) for p, n in held] + directories
    )
    assert rows(archives.mets_ids(found)) == [("12",)]


def test_archive_selections(spark):
    archive = spark.createDataFrame(
        [
            ("1", "12", "mets", "1/12/12/mets/12_METS.xml", 5),
            ("1", "12", "alto", "1/12/12/alto/00001.xml", 0),
            ("2", "2", "alto", "2/2/alto/00001.xml", 7),
        ],
        "subset_id string, binding_id string, kind string, path string, size long",
    )
    assert rows(archives.present_paths(archive)) == [
        ("1/12/12/mets/12_METS.xml",), ("2/2/alto/00001.xml",),
    ]
    assert archives.select_files(archive, binding_id="12").count() == 2
    assert archives.select_files(archive, kind="alto", subset_ids=["2"]).count() == 1
    assert archives.matching(archive, include="/alto/", exclude="^2/").count() == 1
    assert rows(archives.binding_ids(archive)) == [("12",), ("2",)]
