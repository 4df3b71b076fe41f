"""Removal of repeated substrings, with suffix arrays built by linear grouping.

A byte goes if a string of WINDOW bytes that covers it also starts anywhere else. Windows are dealt out first, so
that no suffix array spans the corpus: of each window, its anchor is the K-byte string in it with the least hash
(the leftmost of equal ones), so equal windows have equal anchors at equal places. The windows that share one
occurrence of an anchor make one stretch of text, its context. Only anchors that occur twice matter. Contexts that
are equal as a whole are repeated as a whole; the different ones of an anchor go through a suffix array together,
and windows with a common prefix of WINDOW bytes with a neighbour are repeated.

The suffix array (``java/RepeatedWindows.java``) is a loop over single bytes, too slow in Python; it is compiled at run
time by the compiler that Spark brings for its generated code, and runs as a Java function.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import U64, pieces, prefix_hash, small, span_hash, staged, swept, swept_query, text_key

WINDOW, K = 200, 80
#: An anchor with more different contexts than this is resolved by counting its windows, which needs no common task.
GROUP = 4096
_PLACE = 28
_SEGMENT = 1 << 25
_registered: set[str] = set()


def repeated_windows(spark: SparkSession) -> str:
    """Compile and register the Java function, once a Spark application; its name."""
    app = spark.sparkContext.applicationId
    if app not in _registered:
        jvm = spark.sparkContext._jvm
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
        compiler.cook(Path(__file__).with_name("java").joinpath("RepeatedWindows.java").read_text())
        jar = os.path.join(tempfile.mkdtemp(prefix="tallgrass-"), "repeated-windows.jar")
        with zipfile.ZipFile(jar, "w") as z:
            for name, code in dict(compiler.getBytecodes()).items():
                z.writestr(name.replace(".", "/") + ".class", bytes(code))
        spark.sql(f"ADD JAR '{jar}'")
        _registered.add(app)
    loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    made = loader.loadClass("tallgrass.RepeatedWindows").newInstance()
    kind = spark._jsparkSession.parseDataType(T.ArrayType(T.ArrayType(T.IntegerType())).json())
    spark._jsparkSession.udf().register("repeated_windows", made, kind)
    return "repeated_windows"


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def contexts(raw: np.ndarray, offs: np.ndarray, window: int = WINDOW, k: int = K) -> tuple[np.ndarray, ...]:
    """Row, first window start in the row, number of windows, anchor hash and context hash of every context."""
    found = []
    for base in range(0, max(1, len(raw)), _SEGMENT):
        b = raw[base : base + _SEGMENT + window - 1]
        if len(b) < window:
            continue
        s = prefix_hash(b.astype(np.int16) + 1)
        lo = np.arange(len(b) - k + 1)
        h = span_hash(s, lo, lo + k)
        keep = U64((1 << 64) - (1 << _PLACE))
        place = (sliding_min((h & keep) | lo.astype(U64), window - k + 1) & ~keep).astype(np.int64)
        start = base + np.arange(len(place))
        row = np.searchsorted(offs, start, "right") - 1
        whole = start + window <= offs[row + 1]
        new = whole.copy()
        new[1:] &= ~whole[:-1] | (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        ends = whole.copy()
        ends[:-1] &= ~whole[1:] | (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        first, last = np.flatnonzero(new), np.flatnonzero(ends)
        found.append((row[first], base + first - offs[row[first]], last - first + 1, h[place[first]], span_hash(s, first, last + window)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5


def context_table(docs: DataFrame, window: int) -> DataFrame:
    """Store the contexts (doc_id, text_hash, lo, n, anchor, context) of all rows of ``docs`` (doc_id, text)."""
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_hash"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, offs in pieces(batches, "text", 1_000_000):
            row, lo, n, anchor, context = contexts(raw, offs, window)
            row = pa.array(row)
            cols = [b.column("doc_id").take(row), b.column("text_hash").take(row), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32))]
            cols += [pa.array(anchor.astype(np.uint64).view(np.int64)), pa.array(context.astype(np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", "lo", "n", "anchor", "context"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return staged(keyed.mapInArrow(run, f"doc_id {kind}, text_hash long, lo int, n int, anchor long, context long"), "contexts")



def bytes_of(text: Column) -> Column:
    """UTF-8 bytes; null is empty."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def keyed_join(docs: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """``docs`` (with text_hash) and ``side`` by (doc_id, text_hash), null ids equal."""
    side = small(side.withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"}))
    return docs.join(side, docs.doc_id.eqNullSafe(F.col("_d")) & (docs.text_hash == F.col("_h")), how).drop("_d", "_h")


def repeated_spans(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(doc_id, text_hash, spans): the maximal runs [lo, hi) of bytes to remove, in order, of each text that has any."""
    key = ("doc_id", "text_hash")
    all_ = context_table(docs, window)
    # stored, so that the join stands alone and the rows of one common anchor can be split among tasks
    twice = staged(all_.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor"), "twice")
    again = staged(all_.join(twice, "anchor", "left_semi"), "repeated")
    one = F.min(F.struct(*key, "lo", "n")).alias("one")
    kinds = staged(again.groupBy("anchor", "context").agg(F.count("*").alias("c"), one), "kinds")
    whole = again.join(kinds.filter("c > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    spans = whole.select(*key, "lo", (F.col("lo") + F.col("n") + (window - 1)).alias("hi"))

    groups = kinds.groupBy("anchor").agg(F.count("*").alias("k"), F.count_if(F.col("c") == 1).alias("single")).filter("k > 1 and single > 0")
    mixed = kinds.join(groups.select("anchor", "k"), "anchor").select("anchor", "k", "one.*")
    asked = mixed.groupBy(*key).agg(F.collect_list(F.struct("anchor", "k", "lo", "n")).alias("asked"))
    texts = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_hash"))
    met = keyed_join(texts, staged(asked, "asked"), "inner").dropDuplicates(list(key))
    met = met.select(*key, "asked", bytes_of(F.col("text")).alias("_b"))
    cut = met.select(*key, F.inline(F.expr(f"transform(array(_b), b -> transform(asked, c -> struct(c.anchor, c.k, c.lo, substring(b, c.lo + 1, c.n + {window - 1}) as b)))[0]")))
    cut = staged(cut, "cut")

    f = repeated_windows(docs.sparkSession)
    lists = cut.filter(F.col("k") <= group).groupBy("anchor").agg(F.collect_list(F.struct(*key, "lo", "b")).alias("m"))
    runs = lists.select("m", F.expr(f"{f}(transform(m, x -> x.b), {window})").alias("r"))
    runs = runs.select(F.inline(F.arrays_zip("m", "r"))).filter("size(r) > 0").select("m.doc_id", "m.text_hash", "m.lo", "r")
    pairs = F.expr(f"transform(sequence(0, size(r) div 2 - 1), i -> struct(lo + r[2 * i] as lo, lo + r[2 * i + 1] + {window - 1} as hi))")
    spans = spans.unionByName(runs.select(*key, F.inline(pairs)))

    large = cut.filter(F.col("k") > group)
    starts = large.select(*key, "anchor", "lo", F.posexplode(F.expr(f"transform(sequence(1, length(b) - {window - 1}), i -> xxhash64(substring(b, i, {window})))")).alias("i", "w"))
    common = starts.groupBy("anchor", "w").agg(F.count("*").alias("c")).filter("c > 1").select("anchor", "w")
    hot = starts.join(common, ["anchor", "w"], "left_semi").select(*key, (F.col("lo") + F.col("i")).alias("lo"))
    spans = spans.unionByName(hot.withColumn("hi", F.col("lo") + window))

    # a span begins a run if it lies beyond all spans before it
    order = Window.partitionBy(*key).orderBy("lo")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("lo") > reach, F.lit(True)).cast("int")
    runs = spans.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = runs.groupBy(*key, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return runs.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def remove_repeats(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """``df`` (doc_id, text, ...) with ``spans`` (array of lo, hi: byte runs that repeat) and ``kept`` (binary: the other bytes).

    Null texts are empty; texts shorter than a window keep all; equal rows repeat each other; a null id is an id.
    Columns with the output names are replaced; no other column is touched. An empty table gives no rows.
    """
    df = df.drop("spans", "kept")
    with swept(df.sparkSession) as kept:
        found = kept(repeated_spans(df.select("doc_id", "text"), window))
    side = small(found.select(F.struct("doc_id", "text_hash").alias("spans_key"), "spans"))
    own = F.struct(df.doc_id, text_key(df.text).alias("text_hash"))
    out = df.join(side, own.eqNullSafe(side.spans_key), "left").drop(side.spans_key)
    out = out.withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<lo:int,hi:int>>)")))
    return without(out)


def without(df: DataFrame) -> DataFrame:
    """``df`` (text, spans) with ``kept``: the bytes of the text outside the spans, which are in order and apart."""
    # the bytes stand in an array of one, so that they are taken from the text once and not for every gap
    gap = "substring(b, if(i = 0, 0, spans[i - 1].hi) + 1, if(i = size(spans), octet_length(b), spans[i].lo) - if(i = 0, 0, spans[i - 1].hi))"
    gaps = f"transform(array(coalesce(cast(text as binary), binary(''))), b -> binary(array_join(transform(sequence(0, size(spans)), i -> string({gap})), '')))[0]"
    return df.withColumn("kept", F.expr(gaps))


@swept_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        size.alias("n_bytes"),
        F.expr("aggregate(spans, 0L, (a, x) -> a + x.hi - x.lo)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
