"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations only.

The index is a stored table of postings (document, term, position), written by the tasks that read the
documents, so that a document's postings lie together and building it needs no shuffle. It holds every word of every
document, so that one index serves any test set and proximity search. Every document also has one posting of the end
mark, at its length.

A phrase is looked up from its rarest terms: the posting lists of its rarest and second rarest term, each shifted
by the term's place, are intersected, and what is left is compared word by word. Lists of common terms are never
joined.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small, staged, swept_query, text_key

WINDOW = 10
#: Word separators after lower-casing, a fixed value.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The term that stands at each document's end.
END_TERM = 0


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null has none."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), SEPARATORS), "")



def build_index(docs: DataFrame) -> DataFrame:
    """Store the postings (doc_id, text_hash, term_id, pos) of ``docs`` (doc_id, text). Term ids are hashes; equal hashes of two
    terms only add candidates."""
    marked = F.concat(words_of(F.col("text")), F.array(F.lit("")))
    tokens = docs.select("doc_id", text_key(F.col("text")).alias("text_hash"), F.posexplode(marked).alias("pos", "term"))
    ids = F.when(F.col("term") == "", F.lit(END_TERM)).otherwise(F.xxhash64("term"))
    return staged(tokens.select("doc_id", "text_hash", ids.cast("long").alias("term_id"), "pos"), "postings")


def windows_of(items: DataFrame, width: int) -> DataFrame:
    """Distinct items' windows: (item_key, off, words); a shorter item is one window."""
    n = F.size("words")
    starts = F.when(n >= width, F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))).otherwise(F.array(F.lit(0)))
    at = items.filter(n > 0).select("item_key", "words", F.explode(starts).alias("off"))
    return at.select("item_key", "off", F.expr(f"slice(words, off + 1, {width})").alias("words"))


def phrase_hits(index: DataFrame, docs: DataFrame, tests: DataFrame, width: int = WINDOW) -> DataFrame:
    """Exact occurrences (doc_id, text_hash, start, len, item_id) of the windows of ``tests`` (item_id, text)."""
    items = tests.select("item_id", words_of(F.col("text")).alias("words"))
    items = staged(items.withColumn("item_key", F.xxhash64("words")), "items")
    windows = windows_of(items.select("item_key", "words").distinct(), width)
    parts = windows.select("item_key", "off", F.size("words").alias("len"), F.posexplode("words").alias("at", "term"))
    parts = parts.withColumn("term_id", F.xxhash64("term"))
    df = index.filter(F.col("term_id") != END_TERM).join(small(parts.select("term_id").distinct()), "term_id", "left_semi")
    df = df.groupBy("term_id").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("item_key", "off").orderBy("n", "at"))
    rare = parts.join(df, "term_id", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("rank", rank).filter("rank <= 2")
    one = F.max(F.when(F.col("rank") == 1, F.struct("term_id", (F.col("off") + F.col("at")).alias("at"), "n")))
    two = F.max(F.when(F.col("rank") == 2, F.struct("term_id", (F.col("off") + F.col("at")).alias("at"), "n")))
    plan = rare.groupBy("item_key", "off", "len").agg(one.alias("one"), two.alias("two")).filter("one.n > 0")
    plan = staged(plan, "plan")

    def shifted(side: str) -> DataFrame:
        """The posting lists of one rank's terms, shifted to where the item would begin."""
        places = plan.filter(F.col(side).isNotNull()).select("item_key", f"{side}.term_id", F.col(f"{side}.at").alias(side)).distinct()
        return index.join(small(places), "term_id").select("doc_id", "text_hash", "item_key", side, (F.col("pos") - F.col(side)).alias("begin"))

    first, second = shifted("one"), shifted("two")
    same = [first.doc_id.eqNullSafe(second.doc_id), *(first[c] == second[c] for c in ("text_hash", "item_key", "begin"))]
    both = first.join(second, same).select(first.doc_id, first.text_hash, first.item_key, first.begin, "one", "two")
    lone = plan.filter(F.col("two").isNull())
    keyed = plan.select("item_key", "off", "len", F.col("one.at").alias("one"), F.col("two.at").alias("two"))
    found = both.join(small(keyed), ["item_key", "one", "two"])
    alone = first.join(small(lone.select("item_key", "off", "len", F.col("one.at").alias("one"))), ["item_key", "one"])
    cols = ("doc_id", "text_hash", "item_key", "off", "len", (F.col("begin") + F.col("off")).alias("start"))
    left = found.select(*cols).unionByName(alone.select(*cols)).filter("start >= 0").distinct()
    left = staged(left, "candidates")

    asked = left.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item_key", "off", "len", "start")).alias("asked"))
    asked = small(asked.withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"}))
    texts = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_hash"))
    met = texts.join(asked, texts.doc_id.eqNullSafe(F.col("_d")) & (texts.text_hash == F.col("_h")))
    met = met.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", "asked", words_of(F.col("text")).alias("_w"))
    got = F.expr("transform(asked, c -> struct(c.item_key, c.off, c.len, c.start, slice(_w, c.start + 1, c.len) as got))")
    read = met.select("doc_id", "text_hash", F.inline(got))
    exact = read.join(small(windows), ["item_key", "off"]).filter(F.col("got") == F.col("words"))
    ids = items.select("item_key", "item_id").distinct()
    return exact.select("doc_id", "text_hash", "start", "len", "item_key").join(small(ids), "item_key").drop("item_key")


def proximity_hits(index: DataFrame, tests: DataFrame, span: int) -> DataFrame:
    """(item_id, doc_id, text_hash, pos): places of an item's rarest word with all the item's other words within ``span`` words of it."""
    items = tests.select("item_id", F.array_distinct(words_of(F.col("text"))).alias("words")).filter(F.size("words") > 0)
    parts = items.select("item_id", F.size("words").alias("need"), F.explode("words").alias("term")).withColumn("term_id", F.xxhash64("term"))
    n = index.filter(F.col("term_id") != END_TERM).groupBy("term_id").agg(F.count("*").alias("n"))
    ranked = parts.join(n, "term_id").withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("n", "term")))
    rare = ranked.filter("rank = 1").select("item_id", "need", "term_id")
    here = index.join(small(rare), "term_id").select("item_id", "need", "doc_id", "text_hash", F.col("pos").alias("at"))
    # each place looks in its own cell of ``span`` positions and the two beside it
    here = here.withColumn("cell", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda x: x + F.floor(F.col("at") / span))))
    others = index.join(small(ranked.filter("rank > 1").select("item_id", "term_id")), "term_id")
    others = others.withColumn("cell", F.floor(F.col("pos") / span)).withColumnRenamed("doc_id", "_d")
    near = here.join(others, ["item_id", "text_hash", "cell"], "left").filter(
        F.col("pos").isNull() | (here.doc_id.eqNullSafe(F.col("_d")) & (F.abs(F.col("pos") - F.col("at")) <= span))
    )
    met = near.groupBy("item_id", "doc_id", "text_hash", "at", "need").agg(F.count_distinct("term_id").alias("got"))
    return met.filter(F.col("got") == F.col("need") - 1).select("item_id", "doc_id", "text_hash", F.col("at").alias("pos"))


def decontaminate(docs: DataFrame, tests: DataFrame, width: int = WINDOW, index: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, n_words, n_hit, n_items, items (sorted ids as text).

    Null ids are ids like any other (an item's null id counts as ''); equal rows get equal results; a null text has
    no words; an item without words hits nothing; further columns are left out. ``index`` is that of ``docs``, if there is one already.
    """
    docs = docs.select("doc_id", "text")
    index = build_index(docs) if index is None else index
    hits = staged(phrase_hits(index, docs, tests, width), "hits")
    covered = hits.select("doc_id", "text_hash", F.explode(F.expr("sequence(start, start + len - 1)")).alias("pos"))
    covered = covered.distinct().groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_hit"))
    names = hits.select("doc_id", "text_hash", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i")).distinct()
    names = names.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list("i")).alias("items"))
    both = covered.join(names, covered.doc_id.eqNullSafe(names.doc_id) & (covered.text_hash == names.text_hash))
    both = both.select(covered.doc_id.alias("_d"), covered.text_hash.alias("_h"), "n_hit", "items")
    ends = index.filter(F.col("term_id") == END_TERM).select("doc_id", "text_hash", F.col("pos").cast("long").alias("n_words"))
    out = ends.join(small(both), ends.doc_id.eqNullSafe(F.col("_d")) & (ends.text_hash == F.col("_h")), "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"))


@swept_query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    out = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: DuckDB SQL for the contract query: every window of every item, looked up among all windows of all documents.
OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(list_slice(ws, i, i + 9), ' ') AS p
  FROM (SELECT item_id, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM b WHERE len(ws) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS p
  FROM (SELECT doc_id, ws, n, unnest(range(1, greatest(1, len(ws) - n + 2))) AS i FROM w, ns)),
h AS (SELECT doc_id, i, bw.n, item_id FROM dw JOIN bw ON dw.p = bw.p AND dw.n = bw.n),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT w.doc_id, cast(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN t ON t.doc_id = w.doc_id
"""
