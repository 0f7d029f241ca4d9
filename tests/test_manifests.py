import datetime

import pytest
from conftest import BASE, image_group, manifest, rows

from bindery.operators import manifests

TEXTS = ("ALTOGRP", "Text", [(f'ID="A{i}"', [f"file://./alto/{i:05}.xml"]) for i in range(1, 6)])
OTHERS = [
    ("TARGETIMGGRP", "Target images", [('ID="T" SEQ="1"', ["file://./img/pr-00001.jp2"])]),
    ("RETAINEDIMGGRP", "Retained images", [('ID="R" SEQ="1"', ["file://./img/pr-00005.jp2"])]),
]


def docs(spark, *texts):
    return spark.createDataFrame(
        [(str(i), BASE + str(i), t) for i, t in enumerate(texts)],
        "binding_id string, dc_identifier string, xml string",
    )


def page_files(spark, *texts, **kwargs):
    return manifests.manifest_files(manifests.parse_manifests(docs(spark, *texts)), **kwargs)


@pytest.mark.parametrize("prefix", ["", "mets"])
def test_images_then_altos(spark, prefix):
    text = manifest([image_group(4), TEXTS, *OTHERS], prefix)
    found = manifests.in_manifest_order(page_files(spark, text)).collect()
    assert [(r["kind"], r["page_number"], r["filename"]) for r in found] == [
        *[("access_img", i, f"0000{i}.jp2") for i in range(1, 5)],
        *[("alto", i, f"0000{i}.xml") for i in range(1, 5)],
    ]
    urls = manifests.download_urls(page_files(spark, text)).collect()
    assert len(urls) == 8
    assert found[1]["download_url"] == BASE + "0/image/2"
    assert found[5]["download_url"] == BASE + "0/page-2.xml"
    assert manifests.files_of_kind(page_files(spark, text), "alto").count() == 4


@pytest.mark.parametrize(
    "use, group_id, expected",
    [
        ("Images", "IMGGRP", 1),
        ("reference", "ACIMGGRP", 1),
        ("reference", "IMGGRP", 1),
        ("images", "IMGGRP", 0),
        ("Images", "X", 0),
        ("Text", "IMGGRP", 0),
    ],
)
def test_image_groups(spark, use, group_id, expected):
    text = manifest([image_group(1, group_id, use)])
    assert page_files(spark, text).count() == 2 * expected


def test_page_numbers(spark):
    members = [
        ('SEQ="7" GROUPID="8"', ["a.tif"]),
        ('GROUPID="123456"', ["b.tar.gz"]),
        ('SEQ=" 9 "', ["c"]),
    ]
    found = page_files(spark, manifest([("IMGGRP", "Images", members)]))
    images = manifests.files_of_kind(found, "access_img")
    assert rows(images.select("page_number", "filename")) == [
        (7, "00007.tif"), (9, "00009"), (123456, "123456.tar.gz"),
    ]


def test_faults(spark):
    good = image_group(1)
    texts = {
        "two locations elsewhere": (
            [good, ("X", "Y", [('SEQ="1"', ["a", "b"])])], "location_count"),
        "no location": ([("IMGGRP", "Images", [('SEQ="1"', [])])], "location_count"),
        "no group id": ([good, (None, "Text", [('SEQ="1"', ["a"])])], "group_attributes"),
        "no use": ([good, ("X", None, [('SEQ="1"', ["a"])])], "group_attributes"),
        "no page": ([("IMGGRP", "Images", [('ID="1"', ["a"])])], "page_number"),
        "odd page": ([("IMGGRP", "Images", [('SEQ="i"', ["a"])])], "page_number"),
        "no page in texts": ([good, ("ALTOGRP", "Text", [('ID="1"', ["a"])])], None),
        "empty group without id": ([good, (None, None, [])], None),
        "no groups": ([], None),
    }
    made = [manifest(groups) for groups, _ in texts.values()]
    expected = [error for _, error in texts.values()]
    broken = [made[0][:-9], "", "text", None]
    other = ['<mets><fileSec><fileGrp ID="X" USE="Y"><file><FContent/></file></fileGrp></fileSec></mets>']
    parsed = manifests.parse_manifests(docs(spark, *made, *broken, *other))
    found = {int(r["binding_id"]): r["manifest_error"] for r in parsed.collect()}
    assert list(found[i] for i in range(len(found))) == [
        *expected, *["malformed"] * 4, "missing_location",
    ]
    assert manifests.faulty_manifests(parsed).count() == 11
    # Good documents are kept, faulty ones give nothing at all.
    kept = manifests.manifest_files(parsed, on_error="reject")
    assert rows(kept.select("binding_id").distinct()) == [("6",), ("7",)]
    with pytest.raises(Exception, match="location_count"):
        page_files(spark, made[0]).collect()


def test_children_of_any_name_count(spark):
    def one(*children):
        inner = "".join(f"<file SEQ='1'>{c}</file>" for c in children)
        return (
            '<mets xmlns:x="urn:x"><fileSec><fileGrp ID="IMGGRP" USE="Images">'
            f"{inner}</fileGrp></fileSec></mets>"
        )

    where = '<FLocat x:href="a.jp2"/>'
    texts = [
        one(where + "<x:other/>"),
        one(where + "<note>n</note>"),
        one('<x:place x:href="b.tif"/>'),
        one('<place href="b.tif"><deep href="c.tif"/></place>', where),
        one('<place href="b.tif"/>', "<place/>"),
        one("<!-- none -->" + where),
    ]
    parsed = manifests.parse_manifests(docs(spark, *texts))
    found = {int(r["binding_id"]): r["manifest_error"] for r in parsed.collect()}
    assert [found[i] for i in range(6)] == [
        "location_count", "location_count", None, None, "missing_location", None,
    ]
    kept = manifests.manifest_elements(parsed.where("manifest_error IS NULL"))
    assert rows(kept.select("binding_id", "position", "location")) == [
        ("2", 0, "b.tif"), ("3", 0, "b.tif"), ("3", 1, "a.jp2"), ("5", 0, "a.jp2"),
    ]


def test_nested_groups_are_not_read(spark):
    inner = '<fileGrp ID="IMGGRP" USE="Images"><file SEQ="1"><FLocat href="a.jp2"/></file></fileGrp>'
    nested = f'<mets><fileSec><fileGrp ID="O" USE="P">{inner}</fileGrp></fileSec></mets>'
    flat = f"<mets><fileSec>{inner}</fileSec></mets>"
    found = page_files(spark, nested, flat)
    assert rows(found.select("binding_id").distinct()) == [("1",)]


def test_elements_of_all_groups(spark):
    parsed = manifests.parse_manifests(docs(spark, manifest([image_group(4), TEXTS, *OTHERS])))
    found = manifests.manifest_elements(parsed)
    assert found.count() == 11
    assert found.where("location = 'file://./alto/00003.xml'").first()["position"] == 6


def test_manifest_parsing_does_not_shuffle(spark):
    plan = page_files(spark, manifest([]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_issue_dates(spark):
    issued = ["3.2.1899", " 03.02.1899\n", "1899", "[1899]", "31.2.1899", "", None]
    texts = [manifest([], "m" if i % 2 else "", date) for i, date in enumerate(issued)]
    dated = manifests.date_issued(docs(spark, *texts))
    found = {r["binding_id"]: r["date_issued"] for r in dated.collect()}
    third, first = datetime.date(1899, 2, 3), datetime.date(1899, 1, 1)
    assert found == {
        "0": third, "1": third, "2": first, "3": None, "4": None, "5": None, "6": None,
    }

    def between(start=None, end=None):
        return [r[0] for r in rows(manifests.issued_between(dated, start, end).select("binding_id"))]

    assert between() == ["0", "1", "2"]
    assert between("3.2.1899") == ["0", "1"]
    assert between("1899", "2.2.1899") == ["2"]
    assert between(end="1898") == []
    with pytest.raises(Exception, match="not a date"):
        between("nonsense")


def test_usual_form_reads_as_from_xml(spark, monkeypatch):
    """Documents are read alike by both readers, and plain ones by the fast one."""
    from pyspark.sql import functions as F

    from bindery.functions import mets

    where = '<FLocat x:href="a.jp2"/>'

    def one(inner, head="", tail="", use="Images", section="fileSec"):
        return (
            f'<mets xmlns:x="urn:x">{head}<{section}><fileGrp ID="IMGGRP" USE="{use}">{inner}'
            f"</fileGrp></{section}>{tail}</mets>"
        )

    usual = [
        manifest([image_group(3), TEXTS, *OTHERS], "mets", "1899"),
        one(f"<file SEQ='1'>\n {where}\n</file><file GROUPID='2' SEQ='x'>{where}</file>"),
        one(f'<file SEQ="1">{where}</file>', "<!-- <fileSec> --><a b='/>'>/></a>", "<c>&#65;</c>"),
        one('<file SEQ="1"><FLocat x:href="a&amp;lt;>b.jp2"></FLocat></file>'),
        one(f'<file ID="1">{where}</file>'),
        '<?xml version="1.0" encoding="latin1"?>' + one(f'<file SEQ="07">{where}</file>', use="Ö"),
        f'<mets><fileSec><fileGrp ID="A"><file>{where}</file></fileGrp></fileSec></mets>',
    ]
    others = [
        one(f'<file SEQ="1">{where}</file>')[:-1],
        one(f'<file SEQ="1">{where}</file>') + "junk",
        one(f'<file SEQ="1">{where}{where}</file>'),
        one(f'<file SEQ="1">text{where}</file>'),
        one(f'<file SEQ=" 1 ">{where}</file>'),
        one(f'<file SEQ="+1">{where}</file>'),
        one('<file SEQ="1"><FLocat href=""/></file>'),
        one('<file SEQ="1"><flocat href="a"/></file>'),
        one('<file SEQ="1"><FLocat href="a" x:href="b"/></file>'),
        one('<file SEQ="1"><FLocat href="a&#66;"/></file>'),
        one(f'<file SEQ="1">{where}</file>', section="filesec"),
        one(f'<file SEQ="1">{where}</file>', tail="<fileSec/>"),
        f"<a><b>{one(f'<file SEQ="1">{where}</file>')}</b></a>",
        f'<a><![CDATA[<!--]]><fileSec><fileGrp ID="I"><file>{where}</file></fileGrp></fileSec></a>',
        "<!DOCTYPE mets>" + one(f'<file SEQ="1">{where}</file>'),
        "<mets><fileSec/></mets>",
        "",
        None,
    ]
    texts = docs(spark, *usual, *others)
    read = texts.select("binding_id", mets.usual_elements(F.col("xml")).elements.isNotNull().alias("u"))
    assert [r["u"] for r in sorted(read.collect(), key=lambda r: int(r[0]))] == (
        [True] * len(usual) + [False] * len(others)
    )
    found = rows(manifests.parse_manifests(texts))
    none = F.lit(None).cast(f"struct<elements:{mets.ELEMENTS},manifest_error:string>")
    monkeypatch.setattr(mets, "usual_elements", lambda xml: none)
    assert found == rows(manifests.parse_manifests(texts))
