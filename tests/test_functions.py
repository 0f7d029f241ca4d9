import datetime

import pytest
from conftest import BASE
from pyspark.sql import functions as F

from bindery.functions import dates, files, ids, names


@pytest.mark.parametrize(
    "url, expected", [(BASE + "379", "379"), (BASE + "379/", ""), ("379", "379")]
)
def test_binding_id(value, url, expected):
    assert value(ids.binding_id("u"), u=url) == expected


def test_dc_identifier(value):
    assert value(ids.dc_identifier("i", BASE), i="oai:host:77") == BASE + "77"
    assert value(ids.dc_identifier("i", BASE.rstrip("/")), i="77") == BASE + "77"


def test_mets_names(value):
    assert value(ids.mets_file_name("u"), u=BASE + "9") == "9_METS.xml"
    assert value(ids.mets_url("u"), u=BASE + "9") == BASE + "9/mets.xml?full=true"


@pytest.mark.parametrize(
    "id_, depth, expected",
    [
        ("123456", None, "1/12/123/1234/12345/123456/123456"),
        ("123456", 0, "1/12/123/1234/12345/123456/123456"),
        ("123456", 3, "1/12/123/123456"),
        ("12", 4, "1/12/12/12/12"),
        ("7", None, "7/7"),
        ("", None, ""),
        ("12", -1, "12"),
    ],
)
def test_binding_dir(value, id_, depth, expected):
    assert value(ids.binding_dir("i", depth), i=id_) == expected


@pytest.mark.parametrize(
    "path, expected",
    [
        ("1/12/12/alto/00001.xml", "12"),
        ("./1/12/12/mets/12_METS.xml", "12"),
        ("alto/00001.xml", None),
        ("00001.xml", None),
    ],
)
def test_binding_of_entry(value, path, expected):
    assert value(ids.binding_of_entry("p"), p=path) == expected


@pytest.mark.parametrize(
    "path, expected",
    [
        ("1/12/12/alto/", "12"),
        ("1/12/12/", "12"),
        ("1/1/mets/1_METS.xml", "1"),
        ("1/11/111/111/alto/", "111"),
        ("1/11/", None),
        ("1/12/", None),
    ],
)
def test_binding_of_path(value, path, expected):
    assert value(ids.binding_of_path("p"), p=path) == expected


def test_mets_base_path(value):
    assert value(ids.mets_base_path("p"), p="1/12/12/mets/12_METS.xml") == "1/12/12"


@pytest.mark.parametrize(
    "page, extension, expected",
    [(1, ".xml", "00001.xml"), (123456, ".jp2", "123456.jp2"), (0, "", "00000")],
)
def test_page_filename(value, page, extension, expected):
    assert value(files.page_filename("p", F.lit(extension)), p=page) == expected


@pytest.mark.parametrize(
    "xlink, expected",
    [
        ("file://./img/pr-00002.jp2", ".jp2"),
        ("a.b/c.tar.gz", ".tar.gz"),
        ("a.b/c", ""),
        (".hidden", ""),
        (".hidden.tif", ".tif"),
        ("a..b", "..b"),
        ("a.b.", ""),
        ("x/y.tif/", ".tif"),
    ],
)
def test_image_extension(value, xlink, expected):
    assert value(files.image_extension("x"), x=xlink) == expected


def test_urls(value):
    assert value(files.alto_url("u", "p"), u=BASE + "9", p=12) == BASE + "9/page-12.xml"
    url = files.image_url("u", "f")
    assert value(url, u=BASE + "9", f="00012.jp2") == BASE + "9/image/12"
    assert value(url, u=BASE + "9", f="12304560.jp2") == BASE + "9/image/12304560"
    assert value(url, u=BASE + "9", f="00000.jp2") is None


def test_file_download_location(value):
    def location(kind, **given):
        return value(
            files.file_download_location("u", "k", "f", **given),
            u=BASE + "9",
            k=kind,
            f="00001.xml",
        )

    assert location("alto") == "downloads/9/alto/00001.xml"
    assert location("alto", base_path="/data/") == "/data/9/alto/00001.xml"
    assert location("alto", file_dir="x", name="n") == "downloads/x/n"
    assert location("alto", file_dir="/abs") == "/abs/00001.xml"
    assert location("access_img") is None
    assert location("access_img", file_dir="img") == "downloads/img/00001.xml"


def test_temporary_and_batch_paths(value):
    assert value(files.tmp_path("p"), p="a/1.jp2") == "a/1.jp2.tmp"
    for batch in ("3", "12"):
        path = f"/tmp/set_1/batch_{batch}/1/12/12/mets/12_METS.xml"
        assert value(files.path_in_target("p"), p=path) == "/1/12/12/mets/12_METS.xml"


@pytest.mark.parametrize("size, expected", [(1, True), (0, False), (None, False)])
def test_is_present(value, size, expected):
    assert value(files.is_present(F.col("s").cast("bigint")), s=size) is expected


@pytest.mark.parametrize(
    "n, expected",
    [(1, 1), (10, 10), (100, 10), (499, 10), (500, 30), (10000, 30), (49999, 30), (50000, 100)],
)
def test_batch_size(value, n, expected):
    assert value(names.batch_size("n"), n=n) == expected


def test_names(value):
    assert value(names.folder_name("s"), s="a:b") == "a_b"
    assert value(names.subset_name("s", "p"), s="c1", p="13") == "c1_13"
    assert value(names.subset_name("s", "p"), s="c1", p="") == "c1"
    assert value(names.target_name("s", "p"), s="c1", p="") == "c1.zip"
    assert value(names.list_date("f"), f="binding_ids_2025-06-12") == datetime.date(2025, 6, 12)
    assert value(names.list_date("f"), f="binding_ids_x") is None
    assert value(names.capitalized("t"), t="access image FILE") == "Access image FILE"
    assert value(names.capitalized("t"), t="ALTO") == "ALTO"
    with pytest.raises(Exception, match="two letters"):
        value(names.capitalized("t"), t="a")
    assert value(names.snapshot_id("l"), l="snapshot 2f8df9e7 saved") == "2f8df9e7"
    assert value(names.snapshot_id("l"), l="processed 3 files") is None


@pytest.mark.parametrize(
    "archive, expected",
    [
        ("/data/c_13.zip", "13"),
        ("/data/my_set_7.zip", "7"),
        ("/data/c_x.zip", ""),
        ("/data/c.zip", ""),
        ("/data/c_13.zip/a_b", ""),
        ("/a.zip/c_13.zip", ""),
    ],
)
def test_archive_prefix(value, archive, expected):
    assert value(names.archive_prefix("a"), a=archive) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("3.2.1899", datetime.date(1899, 2, 3)),
        ("03.02.1899", datetime.date(1899, 2, 3)),
        ("1899", datetime.date(1899, 1, 1)),
        ("[1899]", None),
        ("31.2.1899", None),
        ("189", None),
        ("18990", None),
        ("0000", None),
        ("1899-02-03", None),
    ],
)
def test_partial_date(value, text, expected):
    assert value(dates.partial_date("t"), t=text) == expected


def test_since_is_inclusive_utc(value):
    for stamp, expected in [
        ("2024-05-01T00:00:00Z", True),
        ("2024-04-30T23:59:59Z", False),
        ("2024-05-01T01:00:00+02:00", False),
    ]:
        test = dates.since(F.col("t").cast("timestamp"), "2024-05-01")
        assert value(test, t=stamp) is expected
    assert value(dates.since("t", None), t="x") is True
