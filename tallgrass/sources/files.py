"""Raw-file readers. All columns are text; coercion comes later. Paths are whatever Hadoop reads."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in order."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return sorted(str(f.getPath()) for f in found or [])


def latest_pull(spark: SparkSession, root: str) -> str | None:
    """The last dated folder under ``root``; names sort as dates do."""
    dated = [p for p in listed(spark, f"{root}/*") if re.search(r"/\d{4}-?\d{2}-?\d{2}$", p)]
    return max(dated, default=None)


def empty(spark: SparkSession, columns: Iterable[str]) -> DataFrame:
    """No rows of text columns."""
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def header(spark: SparkSession, path: str, encoding: str) -> str:
    """The first line of a file; only that is read."""
    row = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path).head()
    return row[0].lstrip("﻿").rstrip("\r") if row else ""


def head(spark: SparkSession, path: str, encoding: str, most: int = 1 << 16) -> str:
    """The first line of a file, as far as its first ``most`` bytes hold it: no Spark job."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(p)
    try:
        text = jvm.java.lang.String(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, most)), encoding)
    finally:
        stream.close()
    return re.split("\r\n|\r|\n", str(text), maxsplit=1)[0].lstrip("\ufeff")


def delimiter(line: str, tries: Sequence[str], wanted: Sequence[str] = (), least: int = 1) -> str | None:
    """The first of ``tries`` that splits a header into ``least`` columns, ``wanted`` ones among them if given."""
    names = {w.upper() for w in wanted}
    for d in tries:
        got = [c.strip().strip('"').upper() for c in line.split(d)]
        if len(got) >= least and (not names or names & set(got)):
            return d
    return None


def delimited(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], tries: Sequence[str] = ("}", "|", ","), encoding: str = "ISO-8859-1") -> DataFrame:
    """``columns`` (upper case) of the first of ``paths`` that exists; columns it lacks are left out. No file gives no rows of all columns."""
    path = next((p for c in paths for p in listed(spark, c)), None)
    if path is None:
        return empty(spark, columns)
    line = header(spark, path, encoding)
    sep = delimiter(line, tries, columns)
    if sep is None:
        return empty(spark, columns)
    df = spark.read.csv(path, sep=sep, header=True, encoding=encoding, inferSchema=False)
    have = {c.strip().upper(): c for c in df.columns}
    return df.select(*(F.col(f"`{have[c]}`").alias(c) for c in columns if c in have))


def tables(spark: SparkSession, pattern: str, tries: Sequence[str] = (",", "\t", "|"), least: int = 3, encoding: str = "UTF-8") -> DataFrame | None:
    """All matching files as one table with their path in ``source_file``; files without ``least`` columns are left out. None without a file.

    Files with the same first line are read together: one scan a kind of header, however many files there are.
    """
    paths = listed(spark, pattern)
    if not paths:
        return None
    kinds: dict[str, list[str]] = {}
    for path in paths:
        kinds.setdefault(head(spark, path, encoding), []).append(path)
    out = None
    for line, group in sorted(kinds.items()):
        sep = delimiter(line, tries, least=least)
        if sep:
            df = spark.read.csv(sorted(group), sep=sep, header=True, encoding=encoding, enforceSchema=False)
            where = F.split(F.col("_metadata.file_path"), "/")
            df = df.select("*", F.element_at(where, -1).alias("source_file"), F.element_at(where, -2).alias("source_dir"))
            df = df.toDF(*(c.strip().lower() for c in df.columns))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def features(spark: SparkSession, pattern: str, attributes: Sequence[str]) -> DataFrame:
    """Attribute rows of ``{"features": [{"attributes": {...}}]}`` documents; no file gives no rows."""
    paths = listed(spark, pattern)
    if not paths:
        return empty(spark, attributes)
    inner = T.StructType([T.StructField(a, T.StringType()) for a in attributes])
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("attributes", inner)])))])
    rows = spark.read.schema(schema).json(paths, multiLine=True).select(F.explode("features").alias("f"))
    return rows.select("f.attributes.*")


def records(spark: SparkSession, paths: Sequence[str], tag: str, columns: Sequence[str], encoding: str | None = None) -> DataFrame:
    """One row per XML element ``tag`` of the first path that exists, its children as text.

    The file is cut at closing tags, as bytes, so that any number of tasks share it whatever its encoding and size: a split may begin in the
    middle of an element, or of a character. An element that the file's end cuts off, one that is no XML, and one without content (``<tag/>``) are
    left out; all others stay. Without ``encoding`` the file's byte-order mark tells it.
    """
    path = next((p for c in paths for p in listed(spark, c)), None)
    if path is None:
        return empty(spark, columns)
    encoding = encoding or encoding_of(spark, path)
    closer, bad = f"</{tag}>", "_bad"
    element = rf"(?s).*(<{re.escape(tag)}(?=[\s>/]).*)$"
    lines = spark.read.option("lineSep", closer).option("encoding", encoding).text(path)
    lines = lines.select(F.col("value").cast("binary").alias("value"), F.monotonically_increasing_id().alias("i"))
    rest = last_bytes(spark, path, closer.encode(encoding))
    if re.match(element, rest.decode(encoding, "replace")):
        cut = lines.filter(F.col("value") == F.lit(bytearray(rest))).agg(F.max("i")).first()[0]
        lines = lines.filter(F.col("i") != (-1 if cut is None else cut))
    text = F.regexp_extract(F.decode("value", encoding), element, 1)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, bad)])
    options = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "columnNameOfCorruptRecord": bad}
    found = lines.select(text.alias("e")).filter("e <> ''").select(F.from_xml(F.concat("e", F.lit(closer)), schema, options).alias("r"))
    return found.filter(F.col(f"r.{bad}").isNull()).select(*(F.col(f"r.`{c}`").alias(c) for c in columns))


def last_bytes(spark: SparkSession, path: str, behind: bytes, most: int = 1 << 20) -> bytes:
    """What stands behind the last ``behind`` in a file: the end is read, and more of it only if that has none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    size = store.getFileStatus(p).getLen()
    while True:
        stream = store.open(p)
        try:
            stream.seek(max(0, size - most))
            got = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        if behind in got or most >= size:
            return got.rpartition(behind)[2]
        most *= 8


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    """The first ``n`` bytes of a file of any size; no more is read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(p)
    try:
        got = [stream.read() for _ in range(n)]
    finally:
        stream.close()
    return bytes(b for b in got if b >= 0)


def encoding_of(spark: SparkSession, path: str) -> str:
    """Encoding by byte-order mark."""
    b = first_bytes(spark, path, 3)
    return "UTF-16LE" if b[:2] == b"\xff\xfe" else "UTF-16BE" if b[:2] == b"\xfe\xff" else "UTF-8"


def source_format(spark: SparkSession, folder: str) -> str:
    """``xml`` if a pull has the production XML at any usual depth, else ``text``."""
    base = f"{folder}/production"
    return "xml" if any(listed(spark, f"{base}/{at}wcproduction.xml") for at in ("", "*/", "*/*/")) else "text"


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """Write a small value as a JSON file, replacing an older one."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(p, True)
    try:
        out.write(bytearray(json.dumps(value, indent=2, default=str).encode()))
    finally:
        out.close()


def write_manifest(spark: SparkSession, folder: str, **facts) -> str:
    """Write ``facts`` of a pull as ``manifest.json`` in its folder, replacing an older one; its path."""
    path = f"{folder.rstrip('/')}/manifest.json"
    write_json(spark, path, facts)
    return path


def line_count(spark: SparkSession, pattern: str) -> int:
    """Data rows of all matching text files: lines without the header of each. No column is parsed."""
    paths = listed(spark, pattern)
    return max(0, spark.read.text(paths).count() - len(paths)) if paths else 0


def zip_entry(names: Iterable[str], wanted: str) -> str | None:
    """The member of an archive with that stem in any case; else one that contains it."""
    names, low = list(names), wanted.lower()
    stem = {n: n.rpartition("/")[2].rpartition(".")[0].lower() or n.rpartition("/")[2].lower() for n in names}
    return next((n for n in names if stem[n] == low), next((n for n in names if low in n.lower()), None))


def bytes_text(n: float) -> str:
    """A size for people."""
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if n < 1024 or unit == "TB":
            return f"{n:.1f} {unit}"
        n /= 1024
    return ""
