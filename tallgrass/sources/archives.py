"""Members of ZIP archives and sheets of workbooks as rows, straight from the archive: nothing is extracted to a disk.

``spark.read.format("archive")``: one partition per member, whose lines the task inflates and yields one by one. Options: ``path`` (an archive, or several
with commas between), ``member`` (a stem, see ``files.zip_entry``; else all members), ``encoding``. Archives of any size are read by
position, from local disks or whatever pyarrow has a file system for. A member that names a place outside the archive is an error.

A workbook is such an archive too, whose members are small enough for one task by the format's own bound on rows; its sheets come as rows of maps
from the header's names to text.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import delimiter, empty, listed, zip_entry


def opened(path: str):
    """A file that can be read at any position."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        system, at = pa.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
        return pa.PythonFile(system.open_input_file(at), "r")
    return open(path, "rb")


def members(archive: zipfile.ZipFile) -> list[str]:
    """Names of the files in an archive. One that leaves the archive's own folder is an error."""
    names = [i.filename for i in archive.infolist() if not i.is_dir()]
    for n in names:
        parts = n.replace("\\", "/").split("/")
        if ".." in parts or parts[0] == "" or re.match("[A-Za-z]:", n):
            raise ValueError(f"{archive.filename}: member {n!r} lies outside of the archive")
    return names


class Member(InputPartition):
    def __init__(self, path: str, name: str):
        self.path, self.name = path, name


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Member]:
        out = []
        for path in self.options["path"].split(","):
            with opened(path) as f, zipfile.ZipFile(f) as z:
                names = members(z)
                if wanted := self.options.get("member"):
                    names = [n for n in [zip_entry(names, wanted)] if n]
                out += [Member(path, n) for n in names]
        return out or [Member("", "")]

    def read(self, partition: Member) -> Iterator[tuple]:
        if not partition.path:
            return
        with opened(partition.path) as f, zipfile.ZipFile(f) as z, z.open(partition.name) as m:
            for i, line in enumerate(io.TextIOWrapper(m, self.options.get("encoding", "ISO-8859-1"), newline="\n")):
                yield partition.path, partition.name, i, line.rstrip("\r\n").lstrip("﻿") if i == 0 else line.rstrip("\r\n")


class Archive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return "archive string, member string, line_no long, value string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def lines(spark: SparkSession, path: str, member: str | None = None, encoding: str = "ISO-8859-1") -> DataFrame:
    """(archive, member, line_no, value) of the members of all archives that match ``path``."""
    spark.dataSource.register(Archive)
    found = listed(spark, path)
    if not found:
        return spark.createDataFrame([], "archive string, member string, line_no long, value string")
    df = spark.read.format("archive").option("path", ",".join(found)).option("encoding", encoding)
    return (df.option("member", member) if member else df).load()


def delimited(spark: SparkSession, path: str, member: str, columns: Sequence[str], tries: Sequence[str] = ("}", "|", ","), encoding: str = "ISO-8859-1") -> DataFrame:
    """``columns`` (upper case) of a delimited member, as ``files.delimited`` has them of a file; its rows may not span lines."""
    all_ = lines(spark, path, member, encoding)
    first = next((r.value for r in all_.filter("line_no = 0").limit(1).collect()), None)
    sep = first and delimiter(first, tries, columns)
    if not sep:
        return empty(spark, columns)
    names = [c.strip().strip('"').upper() for c in first.split(sep)]
    places = {c: i for i, c in reversed(list(enumerate(names)))}
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(len(names))), {"sep": sep})
    return all_.filter("line_no > 0 and trim(value) <> ''").select(fields.alias("f")).select(*(F.col(f"f.c{places[c]}").alias(c) for c in columns if c in places))


# ---------------------------------------------------------------- workbooks

# Fixed values of the format: numbers of the built-in date formats, and day 0 of either calendar.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
EPOCHS = {False: dt.datetime(1899, 12, 30), True: dt.datetime(1904, 1, 1)}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(node: ElementTree.Element) -> str:
    """The text of a string item: its own and that of its runs; phonetic hints are no text."""
    parts = [node.text or ""] if _local(node.tag) == "t" else []
    return "".join([*parts, *(_text(c) for c in node if _local(c.tag) != "rPh")])


def column_number(ref: str) -> int:
    """Column of a cell reference, from 0: A1 is 0, AA7 is 26."""
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def date_styles(z: zipfile.ZipFile, names: set[str]) -> set[int]:
    """Numbers of the cell styles that show dates."""
    if "xl/styles.xml" not in names:
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    custom = set()
    for f in root.iter():
        if _local(f.tag) == "numFmt" and re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")), re.I):
            custom.add(int(f.get("numFmtId")))
    cells = next((x for x in root if _local(x.tag) == "cellXfs"), [])
    return {i for i, x in enumerate(cells) if int(x.get("numFmtId", 0)) in DATE_FORMATS | custom}


def number_text(value: str, is_date: bool, from_1904: bool) -> str:
    """A stored number as text: dates as dates, with the time if there is one; whole numbers without a fraction, however they are stored."""
    x = float(value)
    if is_date:
        at = EPOCHS[from_1904] + dt.timedelta(days=x if from_1904 or x >= 60 else x + 1)  # the 1900 calendar has a 29 February that never was
        at = (at + dt.timedelta(microseconds=500_000)).replace(microsecond=0)
        return at.strftime("%Y-%m-%d" if x == int(x) else "%Y-%m-%d %H:%M:%S")
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else value


def sheet_rows(content: bytes, sheet: str | None) -> Iterator[tuple[str, int, dict[str, str]]]:
    """(sheet, row number, header -> text) of a workbook's rows below each sheet's first row with text. Cells without a value are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(members(z))
        shared = []
        if "xl/sharedStrings.xml" in names:
            with z.open("xl/sharedStrings.xml") as f:
                for _, x in ElementTree.iterparse(f):
                    if _local(x.tag) == "si":
                        shared.append(_text(x))
                        x.clear()
        dates = date_styles(z, names)
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        from_1904 = any(_local(x.tag) == "workbookPr" and x.get("date1904") in ("1", "true") for x in book.iter())
        targets = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in (x for x in book.iter() if _local(x.tag) == "sheet"):
            if sheet and s.get("name") != sheet:
                continue
            target = targets[next(v for k, v in s.attrib.items() if _local(k) == "id")]
            with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as f:
                header: dict[int, str] = {}
                n = 0
                for _, row in ElementTree.iterparse(f):
                    if _local(row.tag) != "row":
                        continue
                    n = int(row.get("r", n + 1))
                    cells: dict[int, str] = {}
                    for c in row:
                        at = column_number(c.get("r")) if c.get("r") else max(cells, default=-1) + 1
                        kind = c.get("t", "n")
                        v = next((x.text for x in c if _local(x.tag) == "v"), None)
                        if kind == "inlineStr":
                            v = next((_text(x) for x in c if _local(x.tag) == "is"), None)
                        elif v is not None and kind == "s":
                            v = shared[int(v)]
                        elif v is not None and kind == "n":
                            v = number_text(v, int(c.get("s", 0)) in dates, from_1904)
                        elif kind == "e":
                            v = None
                        if v is not None:
                            cells[at] = v
                    row.clear()
                    if header:
                        yield s.get("name"), n, {header[i]: v for i, v in cells.items() if i in header}
                    elif any(v.strip() for v in cells.values()):
                        header = {i: v.strip() for i, v in cells.items() if v.strip()}


def sheets(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(source_file, sheet, row_no, cells) of the rows of all workbooks that match ``path``: one task a workbook, which it streams row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.string())]
        names = ["source_file", "sheet", "row_no", "cells"]

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                for name, n, cells in sheet_rows(content, sheet):
                    rows.append((path.rpartition("/")[2], name, n, list(cells.items())))
                    if len(rows) == 5000:
                        yield out(rows)
                        rows = []
                yield out(rows)

    kind = "source_file string, sheet string, row_no long, cells map<string,string>"
    if not listed(spark, path):
        return spark.createDataFrame([], kind)
    files = spark.read.format("binaryFile").load(path).select("path", "content").repartition(len(listed(spark, path)))
    return files.mapInArrow(run, kind)


def workbook(spark: SparkSession, path: str, columns: Sequence[str], sheet: str | None = None) -> DataFrame:
    """``columns`` of the sheets' rows as text, NULL where a sheet lacks one. Rows with none of them are left out."""
    rows = sheets(spark, path, sheet).select(*(F.try_element_at("cells", F.lit(c)).alias(c) for c in columns))
    return rows.filter(F.coalesce(*columns).isNotNull())
