"""Sources that split what others read whole: XML in any encoding, planned paging, archive members, workbooks."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import types as T
from test_silver import NOW, feats

from tallgrass.plans import states
from tallgrass.sources import archives, features_api, files

# ---------------------------------------------------------------- XML


@pytest.fixture
def splits(spark):
    """Read files in splits of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    was = {k: spark.conf.get(k, None) for k in keys}

    def use(n):
        for k, v in zip(keys, (str(n), "1", "1"), strict=True):
            spark.conf.set(k, v)

    yield use
    for k, v in was.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("encoding,mark", [("utf-16-le", True), ("utf-16-be", True), ("utf-8", False)])
def test_xml_in_splits(spark, tmp_path, splits, encoding, mark):
    """The same rows for 1 split and for many, and for a file that is cut in the middle of an element or a character."""
    items = [f"<pool><pool_idn>{i}</pool_idn><pool_nam>Näme &amp; {i} 㰀㽟</pool_nam></pool>\n" for i in range(300)]
    items[7] = "<pool ><pool_idn>7</pool_idn>\n<pool_nam/></pool><pools><pool_idn>no</pool_idn></pools>"
    items[9] = "<pool/><pool><pool_idn>9</pool_idn><pool_nam>x</poolnam></pool>"
    text = "﻿" * mark + '<?xml version="1.0"?>\n<root>' + "".join(items) + "</root>"
    p = tmp_path / "pool.xml"
    read = lambda: sorted(((r.pool_idn, r.pool_nam) for r in files.records(spark, [str(p)], "pool", ["pool_idn", "pool_nam"]).collect()), key=repr)
    p.write_bytes(text.encode(encoding))
    size = p.stat().st_size
    splits(size + 1)
    whole = read()
    want = [(str(i), '' if i == 7 else f"Näme & {i} 㰀㽟") for i in range(300) if i != 9]
    assert whole == sorted(want, key=repr)
    splits(size // 50)
    assert files.records(spark, [str(p)], "pool", ["pool_idn"]).rdd.getNumPartitions() >= 50
    assert read() == whole
    splits(997)
    cut = text.encode(encoding)[: len(text[: text.index("Näme &amp; 250")].encode(encoding)) + 5]
    p.write_bytes(cut)
    assert read() == sorted([x for x in whole if int(x[0]) < 250], key=repr)
    p.write_bytes(cut[: cut.rindex("<pool_nam>".encode(encoding))])  # the same element, cut between its children
    assert len(read()) == 249


def test_first_line_is_bounded(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("a,b,c\n1,2,3\n" + "y" * 100_000)
    assert files.head(spark, str(p), "UTF-8") == "a,b,c"
    p.write_text("z" * 300_000)
    assert files.head(spark, str(p), "UTF-8", 1000) == "z" * 1000


# ---------------------------------------------------------------- paging

TOTAL, SIZE = 9_990, 10


def many_page(url, offset, count):
    """A service of 9,990 wells that grows by 25 once half of it has been read; url tells when."""
    n = TOTAL + 25 * (offset >= TOTAL // 2)
    rows = [{"attributes": {"api": i}} for i in range(offset, min(n, offset + count))]
    return {"features": rows, "exceededTransferLimit": offset + len(rows) < n}


def many_count(url):
    return TOTAL


def wrong_page(url, offset, count):
    return {"error": {"code": 500}} if offset else many_page(url, offset, count)


def full_page(url, offset, count):
    return many_page(url, offset, count + 1)


def reader(**options):
    base = {"url": "x", "page_size": str(SIZE), "fields": "api", "count": f"{__name__}:many_count", "fetch": f"{__name__}:many_page"}
    return features_api.Reader(base | options, T.StructType([T.StructField("api", T.StringType())]))


@pytest.mark.parametrize("tasks", [None, "7", "1"])
def test_pages_are_planned_by_count(tasks):
    """A thousand pages in as many tasks as allowed, and no row lost of a service that grows meanwhile."""
    r = reader(**({"tasks": tasks} if tasks else {}))
    plan = r.partitions()
    assert len(plan) == int(tasks or 999)
    assert sorted(int(x[0]) for p in plan for x in r.read(p)) == list(range(TOTAL + 25))


def test_pages_in_spark(spark, tmp_path):
    source = "def count(url):\n    return 9990\n\ndef page(url, offset, count):\n    at = range(offset, min(10015, offset + count))\n"
    source += "    return {'features': [{'attributes': {'api': i}} for i in at], 'exceededTransferLimit': offset + len(at) < 10015}\n"
    (tmp_path / "many_wells.py").write_text(source)
    spark.sparkContext.addPyFile(str(tmp_path / "many_wells.py"))
    features_api.register(spark)
    df = spark.read.format("features").options(url="x", page_size="10", fields="api", tasks="20", count="many_wells:count", fetch="many_wells:page").load()
    assert df.rdd.getNumPartitions() == 20 and df.distinct().count() == df.count() == 10015


@pytest.mark.parametrize("fetch", ["wrong_page", "full_page"])
def test_bad_pages_raise(fetch):
    r = reader(fetch=f"{__name__}:{fetch}")
    with pytest.raises(OSError):
        [list(r.read(p)) for p in r.partitions()[:3]]


# ---------------------------------------------------------------- archives


def test_members_equal_files(spark, tmp_path):
    text = "LEASE_NO}CYCLE_YEAR}NAME\r\n1}2024}Caf\xe9 \"x\"\r\n2}2023}\r\n\r\n3}}z\r\n"
    (tmp_path / "og_lease_cycle.dsv").write_bytes(text.encode("latin-1"))
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("pull/OG_LEASE_CYCLE_DATA_TABLE.dsv", "LEASE_NO\n9\n")
        z.writestr("pull/Og_Lease_Cycle.dsv", text.encode("latin-1"))
        z.writestr("pull/empty.dsv", "")
    columns = ["NAME", "LEASE_NO", "CYCLE_YEAR", "MISSING"]
    plain = files.delimited(spark, [str(tmp_path / "og_lease_cycle.dsv")], columns)
    got = archives.delimited(spark, str(tmp_path / "*.zip"), "OG_LEASE_CYCLE", columns)
    assert got.columns == plain.columns and sorted(got.collect(), key=repr) == sorted(plain.collect(), key=repr) and got.count() == 3
    everything = archives.lines(spark, str(tmp_path / "a.zip"))
    assert everything.rdd.getNumPartitions() == 3 and everything.count() == 7
    assert archives.delimited(spark, str(tmp_path / "a.zip"), "nothing_such", columns).count() == 0
    assert archives.lines(spark, str(tmp_path / "no.zip")).count() == 0
    assert {p.name for p in tmp_path.iterdir()} == {"a.zip", "og_lease_cycle.dsv"}


@pytest.mark.parametrize("name", ["../x.dsv", "/etc/x.dsv", "a/../../x.dsv", "C:\\x.dsv"])
def test_members_outside_are_refused(spark, tmp_path, name):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr(zipfile.ZipInfo(name), "A\n1\n")
    with pytest.raises(Exception, match="outside of the archive"):
        archives.lines(spark, str(tmp_path / "a.zip")).count()


# ---------------------------------------------------------------- workbooks

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def book(path, sheets, shared=(), from_1904=False):
    """A workbook by hand: ``sheets`` are name -> XML of the rows. Style 1 is a built-in date, 2 one of its own, 3 a number."""
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        of = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="{rel}"><workbookPr date1904="{int(from_1904)}"/><sheets>{of}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="rId{i}" Target="{"/xl/" * (i == 1)}worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/styles.xml", f'<styleSheet {NS}><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm;@"/><numFmt numFmtId="165" formatCode="0.0 &quot;days&quot;[Red]"/></numFmts>'
                   '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>')  # fmt: skip
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{''.join(f'<si>{s}</si>' for s in shared)}</sst>")
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {NS}><sheetData>{rows}</sheetData></worksheet>")


def test_workbook(spark, tmp_path):
    """Shared and rich strings, gaps in rows and columns, dates of both kinds of format, ids that are stored as numbers, errors, formulas."""
    shared = ["<t>id</t>", "<t>when</t>", "<r><t>ri</t></r><r><t>ch</t></r><rPh><t>hint</t></rPh>", '<t xml:space="preserve"> kept </t>']
    rows = (
        '<row r="3"><c r="A3" t="s"><v>0</v></c><c r="C3" t="s"><v>1</v></c><c r="AB3" t="s"><v>2</v></c><c r="AC3" t="inlineStr"><is><t>n</t></is></c></row>'
        '<row r="5"><c r="A5"><v>3.501700001E13</v></c><c r="B5"><v>1</v></c><c r="C5" s="1"><v>43835</v></c><c r="AB5" t="s"><v>3</v></c><c r="AC5" s="3"><v>1.50</v></c></row>'
        '<row r="6"><c r="C6" s="2"><v>43835.75</v></c><c r="AB6" t="e"><v>#N/A</v></c><c r="AC6" t="str"><f>A1</f><v>made</v></c></row>'
        '<row><c><v>7</v></c><c r="C7" s="1"><v>59</v></c><c r="AC7" t="b"><v>1</v></c></row><row r="9"/>'
    )
    book(tmp_path / "a.xlsx", {"Data": rows, "Other": '<row r="1"><c r="A1" t="inlineStr"><is><t>id</t></is></c></row><row r="2"><c r="A2"><v>5</v></c></row>'}, shared)
    got = {(r.sheet, r.row_no): r.cells for r in archives.sheets(spark, str(tmp_path / "*.xlsx")).collect()}
    assert got == {
        ("Data", 5): {"id": "35017000010000", "when": "2020-01-05", "rich": " kept ", "n": "1.50"}, ("Data", 6): {"when": "2020-01-05 18:00:00", "n": "made"},
        ("Data", 7): {"id": "7", "when": "1900-02-28", "n": "1"}, ("Data", 9): {}, ("Other", 2): {"id": "5"},
    }
    assert {tuple(r) for r in archives.workbook(spark, str(tmp_path / "a.xlsx"), ["id", "none"], "Data").collect()} == {("35017000010000", None), ("7", None)}
    book(tmp_path / "b.xlsx", {"D": '<row r="1"><c r="A1" t="inlineStr"><is><t>d</t></is></c></row><row r="2"><c r="A2" s="1"><v>0</v></c></row>'}, from_1904=True)
    assert archives.sheets(spark, str(tmp_path / "b.xlsx")).first().cells == {"d": "1904-01-01"}
    assert archives.sheets(spark, str(tmp_path / "c*.xlsx")).count() == 0


def test_completions_from_workbook(spark, tmp_path):
    """Oklahoma's completions come from the workbook in the pull's folder."""
    feats(tmp_path / "wells/w.json", [{"api": "3501712345", "welltype": "OIL", "wellstatus": "AC", "sh_lat": 35.5, "sh_lon": -98}])
    names = ["API_Number", "Well_Name", "Well_Number", "Operator_Name", "County", "Well_Type", "Well_Status", "Test_Date", "Oil_BBL_Per_Day", "Gas_MCF_Per_Day"]
    letters = "ABCDEFGHIJ"
    cell = lambda c, n, v: f'<c r="{c}{n}" t="inlineStr"><is><t>{v}</t></is></c>'
    head = "".join(cell(c, 1, v) for c, v in zip(letters, names, strict=True))
    row = '<c r="A2"><v>3.501700001E9</v></c>' + "".join(cell(c, 2, v) for c, v in zip("BCDEFG", ("First", "1", "Op", "017-CANADIAN", "OIL", "AC"), strict=True))
    row += '<c r="H2" s="1"><v>43835</v></c><c r="I2"><v>10</v></c><c r="J2"><v>0</v></c>'
    book(tmp_path / "completions.xlsx", {"Completions": f'<row r="1">{head}</row><row r="2">{row}</row>'})
    rows = {r.api_number: r for r in states.oklahoma(spark, str(tmp_path), NOW).collect()}
    r = rows["35-017-00001"]
    assert (r.production_date, r.oil_bbl, r.gas_mcf, r.well_name, r.county) == (dt.date(2020, 1, 1), 10.0, None, "FIRST 1", "CANADIAN")
