"""Ranked lexical search over a two-level quantised index.

The index is a stored table of blocks of documents. Its first level has, for each term of a block, the documents that
hold it and one byte each: the impact g of the posting, divided by STEP and rounded up. Its second level has
the exact term frequencies and lengths. A search reads the first level alone for all documents: a sum of weights times
bytes bounds a document's score from above, and less STEP - 1 a posting from below. The kth largest lower bound of all
documents is an item's floor; every document whose upper bound reaches it is scored again from the second
level in whole numbers, and the k best of those are the result. No document is left out by any other rule.

Blocks are independent, so documents that share a term, however many, stay spread over all tasks; a task
sends out the k best of its blocks for each item. Items are dealt to passes of a bounded number of terms, so that what each task
gets of them is bounded too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import byte_table, modest, pieces, small, staged, swept_query, tidy, trimmed, word_hashes
from .katz import pack, unpack

K = 10
#: Every byte but 0-9, A-Z, a-z and those of other characters than ASCII's ends a term.
TERMS = byte_table(bytes(c for c in range(128) if not chr(c).isalnum()))
#: Width of a quantised impact: impacts are below 1,000,000, so that they fit a byte.
STEP = 4096
#: Of a block's texts (a longer text is a block by itself), and its rows at most: a row's number has 16 bits.
BLOCK_BYTES, BLOCK_ROWS = 8_000_000, 65_536
#: Terms of the items that a pass sends to all tasks; an item with more has a pass by itself.
PASS_TERMS = 200_000


@dataclass
class Index:
    """``blocks``: the stored table; ``docs``: the number N of documents with a term; ``terms``: their terms L, with repeats."""

    blocks: DataFrame
    docs: int
    terms: int


def lengths(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """The length factor m = 10 + (90 n N) div L of documents of n terms."""
    n = n.astype(np.int64)
    if 90 * int(n.max(initial=0)) * docs < 2**62:
        return 10 + 90 * n * docs // max(1, terms)
    return np.array([10 + 90 * int(x) * docs // terms for x in n], np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """g = (10**9 tf) div (1000 tf + 8 m): what a posting contributes, before its term's weight."""
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def build_index(docs: DataFrame) -> Index:
    """Index the rows of ``docs`` (doc_id: long, text); further columns are left out.

    Null texts and texts without terms are in no posting; repeated rows and repeated or null ids are documents each. Terms go by 64-bit hashes.
    A first pass counts terms, as impacts depend on the mean length of all documents; the second writes both levels at once.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    modest(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = total = 0
        for _, raw, offs in pieces(batches, "text"):
            n = np.diff(terms_of(raw, offs))
            rows, total = rows + int((n > 0).sum()), total + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([total])], ["docs", "terms"])

    with tidy(docs.sparkSession):
        n_docs, n_terms = docs.select("text").mapInArrow(count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, row, n in gathered(batches):
            order = np.argsort(words, kind="stable")  # within a term, rows ascend
            words, row = words[order], row[order]
            new = np.ones(len(words), bool)
            new[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(new)
            tf = np.diff(np.append(at, len(words)))
            words, row = words[at], row[at]
            begins = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1]))) if len(words) else at
            byte = -(-impacts(tf, lengths(n, n_docs, n_terms)[row]) // STEP)
            cols = [
                pa.array([pack(words[begins])]),
                pa.array([pack(np.append(begins, len(words)).astype(np.uint32))]),
                pa.array([pack(row.astype(np.uint16))]),
                pa.array([pack(byte.astype(np.uint8))]),
                pa.array([pack(tf.astype(np.uint16 if tf.max(initial=0) < 1 << 16 else np.int64))]),
                pa.array([pack(n)]),
                pa.array([ids], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["terms", "begins", "rows", "bytes", "tf", "n", "ids"])
        trimmed()

    kind = "terms binary, begins binary, rows binary, bytes binary, tf binary, n binary, ids array<long>"
    return Index(staged(docs.mapInArrow(blocks, kind), "lexical"), n_docs, n_terms)


def terms_of(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where each row's terms begin among all terms: ``word_hashes`` without the hashes."""
    if not len(raw):
        return np.zeros(len(offs), np.int64)
    inside = TERMS[raw] != 0
    first = np.zeros(len(raw) + 1, bool)
    first[offs] = True
    inside[1:] &= ~inside[:-1] | first[1:-1]
    return np.concatenate(([0], np.cumsum(inside)))[offs]


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, terms' hashes, terms' rows, rows' numbers of terms) of blocks of documents with a term."""
    ids: list = []
    words: list[np.ndarray] = []
    n: list[np.ndarray] = []
    size = 0

    def block() -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        counts = np.concatenate(n)
        return ids, np.concatenate(words), np.repeat(np.arange(len(counts)), counts), counts.astype(np.int64)

    for b, raw, offs in pieces(batches, "text"):
        h, at = word_hashes(raw, offs, TERMS)
        count = np.diff(at)
        if len(ids) + b.num_rows > BLOCK_ROWS or size and size + len(raw) > BLOCK_BYTES:
            yield block()
            ids, words, n, size = [], [], [], 0
        ids += [i for i, c in zip(b.column("doc_id").to_pylist(), count, strict=True) if c]
        words.append(h)
        n.append(count[count > 0])
        size += len(raw)
    if size:
        yield block()


def item_terms(items: DataFrame) -> DataFrame:
    """Store (i, item_id, terms) of each row of ``items`` (item_id, text) that has terms: i numbers rows, terms are its distinct hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, offs in pieces(batches, "text"):
            h, at = word_hashes(raw, offs, TERMS)
            terms = [np.unique(h[lo:hi]).view(np.int64) for lo, hi in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<long>").filter(F.size("terms") > 0)
    return staged(found.select(F.monotonically_increasing_id().alias("i"), "item_id", "terms"), "items")


class Asked:
    """The items of one pass: ``terms`` (sorted), and of each item (``which``) its terms' places among them and their weights."""

    def __init__(self, which: list[int], terms: list[np.ndarray]):
        self.which = np.array(which, np.int64)
        self.terms = np.unique(np.concatenate(terms)) if terms else np.zeros(0, np.uint64)
        self.places = [np.searchsorted(self.terms, t) for t in terms]
        self.weights = np.zeros(len(self.terms), np.int64)
        self.floors = np.ones(len(which), np.int64)

    def lists(self, r: dict) -> tuple[np.ndarray, np.ndarray]:
        """Where the posting lists of the terms begin and end in a block."""
        have, begins = unpack(r["terms"])[0], unpack(r["begins"])[0].astype(np.int64)
        at = np.minimum(np.searchsorted(have, self.terms), max(0, len(have) - 1))
        there = have[at] == self.terms if len(have) else np.zeros(len(self.terms), bool)
        return np.where(there, begins[at], 0), np.where(there, begins[at + 1], 0) if len(have) else np.zeros(len(at), np.int64)

    def bounds(self, r: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(item, its postings' places in the block, their weights, the rows' upper and lower bounds)."""
        lo, hi = self.lists(r)
        rows, byte = (unpack(r[c])[0] for c in ("rows", "bytes"))
        n = len(r["ids"])
        for j, terms in enumerate(self.places):
            terms = terms[(hi[terms] > lo[terms]) & (self.weights[terms] > 0)]
            if not len(terms):
                continue
            at = np.concatenate([np.arange(lo[t], hi[t]) for t in terms])
            w = np.repeat(self.weights[terms], hi[terms] - lo[terms])
            b = byte[at]
            upper = STEP * np.bincount(rows[at], w * b, n).astype(np.int64)
            yield j, at, w, upper, upper - (STEP - 1) * np.bincount(rows[at], np.where(b > 0, w, 0), n).astype(np.int64)


class Best:
    """The k best rows of each item seen by a task: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.of: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(self, j: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Rows with a score above 0 count."""
        good = score > 0
        new = score[good], ids[good], null[good]
        if j in self.of:
            new = tuple(np.concatenate(x) for x in zip(self.of[j], new, strict=True))
        if len(new[0]) > self.k:
            edge = np.partition(new[0], len(new[0]) - self.k)[len(new[0]) - self.k]
            new = tuple(x[new[0] >= edge] for x in new)
            keep = np.lexsort((new[1], new[2], -new[0]))[: self.k]
            new = tuple(x[keep] for x in new)
        self.of[j] = new

    def rows(self, which: np.ndarray) -> pa.RecordBatch:
        js = list(self.of)
        score, ids, null = (np.concatenate([self.of[j][x] for j in js]) if js else np.zeros(0, bool if x == 2 else np.int64) for x in range(3))
        i = np.repeat(which[js] if js else np.zeros(0, np.int64), [len(self.of[j][0]) for j in js])
        return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(ids.astype(np.int64), pa.int64(), mask=null.astype(bool)), pa.array(score.astype(np.int64))], ["i", "doc_id", "score"])


FIRST_LEVEL, SECOND_LEVEL = ("terms", "begins", "rows", "bytes", "ids"), ("tf", "n")


def weigh(index: Index, asked: Asked) -> None:
    """Set the weights of the terms: floor(1000 ln((2 N + 2) / (2 df + 1)))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(asked.terms), np.int64)
        for b in batches:
            for r in b.to_pylist():
                lo, hi = asked.lists(r)
                df += hi - lo
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["t", "df"])

    with tidy(index.blocks.sparkSession):
        found = index.blocks.select("terms", "begins").mapInArrow(run, "t long, df long").groupBy("t").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(len(asked.terms), np.int64)
    df[found.t.to_numpy(np.int64)] = found.df
    asked.weights = np.floor(1000 * np.log((2 * index.docs + 2) / (2 * df + 1))).astype(np.int64)
    asked.weights[df == 0] = 0


def one_pass(index: Index, asked: Asked, k: int) -> DataFrame:
    """(i, doc_id, score): each item's k best of every task, exact."""
    weigh(index, asked)
    kind = "i long, doc_id long, score long"

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for b in batches:
            for r in b.to_pylist():
                none = np.zeros(len(r["ids"]), np.int64)
                for j, _, _, _, low in asked.bounds(r):
                    best.add(j, low, none, none)
        yield best.rows(asked.which)

    order = Window.partitionBy("i").orderBy(F.desc("score"))
    with tidy(index.blocks.sparkSession):
        low = index.blocks.select(*FIRST_LEVEL).mapInArrow(lower, kind).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select("i", "score")
        floors = {r.i: r.score for r in low.toLocalIterator()}
    asked.floors = np.array([floors.get(int(i), 1) for i in asked.which], np.int64)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for b in batches:
            for r in b.to_pylist():
                rows = m = tf = None
                null = np.array([x is None for x in r["ids"]], bool)
                ids = np.array([x or 0 for x in r["ids"]], np.int64)
                for j, at, w, upper, _ in asked.bounds(r):
                    may = upper >= asked.floors[j]
                    if not may.any():
                        continue
                    if rows is None:  # the second level is unpacked only where it is asked for
                        rows, tf, m = unpack(r["rows"])[0], unpack(r["tf"])[0], lengths(unpack(r["n"])[0], index_docs, index_terms)
                    mine = may[rows[at]]
                    at, w = at[mine], w[mine]
                    score = np.zeros(len(m), np.int64)
                    np.add.at(score, rows[at], w * impacts(tf[at], m[rows[at]]))
                    best.add(j, score[may], ids[may], null[may])
        yield best.rows(asked.which)

    index_docs, index_terms = index.docs, index.terms
    return index.blocks.select(*FIRST_LEVEL, *SECOND_LEVEL).mapInArrow(exact, kind)


def search(index: Index, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 of each row of ``items`` (item_id, text).

    The score is the sum over the item's distinct terms of the term's weight times the impact. Ties go to the smaller doc_id, null ids
    last. An item without terms, or with none that a document holds, has no rows; repeated items are ranked each by itself; a null item_id
    is kept; an empty index or no items give no rows.
    """
    asked_for = item_terms(items)
    sizes = asked_for.select("i", F.size("terms").alias("n"))
    passes: list[list[int]] = []
    size = PASS_TERMS
    for r in sizes.orderBy("i").toLocalIterator():
        if size + r.n > PASS_TERMS:
            passes.append([])
            size = 0
        passes[-1].append(r.i)
        size += r.n
    parts = []
    for which in passes:
        rows = asked_for.filter(F.col("i").between(which[0], which[-1])).select("i", "terms").toPandas()
        terms = dict(zip(rows.i, rows.terms, strict=True))
        asked = Asked(which, [np.array(terms[i], np.int64).view(np.uint64) for i in which])
        found = one_pass(index, asked, k)
        parts.append(staged(found, "found") if len(passes) > 1 else found)
    spark = items.sparkSession
    found = parts[0] if parts else spark.createDataFrame([], "i long, doc_id long, score long")
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("i").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(small(asked_for.select("i", "item_id")), "i").select("item_id", "rank", "doc_id", "score")


@swept_query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: DuckDB SQL for the contract query: every document's score for every item.
OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ws FROM benchmark),
s AS (SELECT count(*) AS n, sum(len(ws)) AS l FROM d WHERE len(ws) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY r, term),
t AS (SELECT term, cast(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
m AS (SELECT r, doc_id, 10 + (90 * len(ws) * n) // l AS m FROM d, s WHERE len(ws) > 0),
q AS (SELECT i, item_id, unnest(ws) AS term FROM i),
x AS (
  SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
  FROM q JOIN p USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY i, item_id, r, doc_id)
SELECT item_id, cast(rank AS INTEGER) AS rank, doc_id, cast(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM x WHERE score > 0) WHERE rank <= 10
"""
