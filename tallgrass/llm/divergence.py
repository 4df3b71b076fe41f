"""Source divergence audit: how the sources of each language differ from each other and from the whole, term by term.

Every group (lang, source) is a vector of counts over its language's kept terms. Kept terms are dealt to segments of about
SEGMENT terms by hash and numbered within them in the order of their bytes; the groups of a language are dealt to about as many slots as each slot
holds groups. A tile is the vectors of one slot in one segment, compressed; it is made once and stays where the cached table of tiles
puts it. In each round of a round-robin tournament every slot meets one other slot of its language: the peer's tiles
move to it, and each meeting evaluates all pairs of their groups, both ways. What a round moves is half of the
tiles at most, and a task holds two of them. Segments are summed up at the end, as the sum over terms is one over segments; terms that
neither group of a pair has differ by one and the same value, which is added once.

Terms are ranked against the language's own vector, the sum of its groups': a task keeps a heap of the best
terms of each group of its tile, and the heaps of all segments are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import byte_table, modest, pieces, prefix_hash, small, span_hash, staged, swept, word_spans, words_at
from .katz import pack, unpack

RANKS, LEAST_DOCS, UNIT = 200, 3, 1_000_000_000
#: Every byte but A-Z, a-z and those of other characters than ASCII's ends a term.
LETTERS = byte_table(bytes(c for c in range(128) if not chr(c).isalpha()))
SEGMENT = 200_000
#: Terms' counts in a tile, about; a group's own terms in a segment may be more.
TILE_TERMS = 2_000_000


def counted(docs: DataFrame) -> DataFrame:
    """Store (lang, source, term, n, docs): occurrences of each term in each group, and documents that hold it. A group has a row with a null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, offs in pieces(batches, "text"):
            low, lo, hi, at = word_spans(raw, offs, LETTERS)
            pair, names = _numbered(b)
            h = span_hash(prefix_hash(low), lo, hi)
            row = np.repeat(np.arange(b.num_rows), np.diff(at))
            # once a row and term, then once a group and term
            order = np.lexsort((h, row))
            first = np.ones(len(order), bool)
            first[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
            k = np.flatnonzero(first)
            tf, word, of = np.diff(np.append(k, len(order))), order[k], pair[row[order[k]]]
            by = np.lexsort((h[word], of))
            word, of, tf = word[by], of[by], tf[by]
            new = np.ones(len(by), bool)
            new[1:] = (h[word][1:] != h[word][:-1]) | (of[1:] != of[:-1])
            g = np.flatnonzero(new)
            n, d = (np.add.reduceat(x, g) if len(g) else x for x in (tf, np.ones_like(tf)))
            terms = words_at(low, lo[word[g]], hi[word[g]]).cast(pa.string())
            none = len(names)
            cols = [pa.concat_arrays([pa.array([x[i] for x in names], pa.string()), pa.array([names[j][i] for j in of[g]], pa.string())]) for i in (0, 1)]
            cols.append(pa.concat_arrays([pa.nulls(none, pa.string()), terms]))
            cols += [pa.array(np.concatenate((np.zeros(none, np.int64), x.astype(np.int64)))) for x in (n, d)]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "n", "docs"])

    modest(docs.sparkSession)
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*empty).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return staged(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")


def _numbered(b: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[str, str]]]:
    """The number of each row's group among those of the batch, and the groups."""
    seen: dict[tuple[str, str], int] = {}
    rows = [seen.setdefault(x, len(seen)) for x in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), strict=True)]
    return np.array(rows, np.int64), list(seen)


def vocabulary(counts: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms (lang, term, seg, id, n), stored, and of each language (lang, v, total, segs, groups)."""
    kept = counts.filter(F.col("term").isNotNull()).groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = staged(kept.filter(F.col("docs") >= least_docs).drop("docs"), "kept")
    groups = counts.filter(F.col("term").isNull()).groupBy("lang").agg(F.count("*").alias("groups"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("total"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("v", "total")}
    langs = groups.join(langs, "lang", "left").withColumns(zero).withColumn("segs", F.ceil(F.greatest("v", F.lit(1)) / SEGMENT).cast("int"))
    langs = staged(langs, "langs")
    seg = F.pmod(F.xxhash64("term"), F.col("segs")).cast("int")
    by = Window.partitionBy("lang", "seg").orderBy("term")
    terms = kept.join(small(langs.select("lang", "segs")), "lang").withColumn("seg", seg).withColumn("id", F.row_number().over(by) - 1)
    return staged(terms.select("lang", "term", "seg", "id", "n"), "terms"), langs


def tiles(vectors: DataFrame) -> DataFrame:
    """Rows (lang, seg, slot, g, total, v, id, n) as rows (lang, seg, slot, tile). A group has a row with a null id, so that every tile names all its groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []

        def out() -> pa.RecordBatch:
            g, total, v, i, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            groups, first = np.unique(g, return_index=True)
            real = i >= 0
            begins = np.searchsorted(g[real], np.append(groups, np.iinfo(np.int64).max))
            steps = np.diff(i[real], prepend=0)  # small numbers, but at the begin of a group
            blob = pack(groups, total[first], v[:1], begins, steps.astype(np.int32), n[real])
            types = (pa.string(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, blob), types, strict=True)], ["lang", "seg", "slot", "tile"])

        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in ("lang", "seg", "slot")), strict=True))
            cols = [np.asarray(b.column(c)).astype(np.int64) for c in ("g", "total", "v", "id", "n")]
            lo = 0
            while lo < len(keys):
                hi = lo + 1
                while hi < len(keys) and keys[hi] == keys[lo]:
                    hi += 1
                if keys[lo] != key:
                    if parts:
                        yield out()
                    key, parts = keys[lo], []
                parts.append([c[lo:hi] for c in cols])
                lo = hi
        if parts:
            yield out()

    rows = vectors.withColumn("id", F.coalesce("id", F.lit(-1)))
    rows = rows.repartition("lang", "seg", "slot").sortWithinPartitions("lang", "seg", "slot", "g", "id")
    return rows.select("lang", "seg", "slot", "g", "total", "v", "id", "n").mapInArrow(run, "lang string, seg int, slot int, tile binary")


class Tile:
    """An unpacked tile: ``groups`` and, of each, (ids, p of those, p of a term without occurrences)."""

    def __init__(self, blob: bytes):
        self.groups, totals, (self.v,), begins, steps, counts = unpack(blob)
        ids = np.cumsum(steps.astype(np.int64))
        self.vectors = []
        for j, total in enumerate(totals):
            mine = slice(begins[j], begins[j + 1])
            self.vectors.append((ids[mine], share(counts[mine], int(total), int(self.v)), int(share(np.zeros(1, np.int64), int(total), int(self.v))[0])))


def share(count: np.ndarray, total: int, v: int) -> np.ndarray:
    """p = 1 + floor(10**9 (count + 1) / (total + v)), exact at any count."""
    if v == 0:
        return np.ones(len(count), np.int64)
    if int(count.max(initial=0)) < 9_000_000_000:
        return 1 + UNIT * (count + 1) // (total + v)
    return np.array([1 + UNIT * (int(c) + 1) // (total + v) for c in count], np.int64)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f = floor((p - q)**2 / q); p and q are at most 10**9 + 1, so squares fit 64 bits."""
    return (p - q) * (p - q) // q


def meeting(a: Tile, b: Tile) -> Iterator[tuple[int, int, int, int]]:
    """(group, peer, sum of f over the terms that one of them has, number of those terms), both ways."""
    top = 1 + max((int(ids[-1]) for t in (a, b) for ids, _, _ in t.vectors if len(ids)), default=-1)
    dense = np.zeros(top, np.int64)
    there, here = np.zeros(top, bool), np.zeros(top, bool)
    for x, (ids, p, p0) in zip(a.groups, a.vectors, strict=True):
        dense[:] = p0
        dense[ids] = p
        here[:] = False
        here[ids] = True
        for y, (other, q, q0) in zip(b.groups, b.vectors, strict=True):
            if x == y or a is b and x > y:
                continue
            np.copyto(there, here)
            there[other] = True
            only = here.copy()
            only[other] = False
            mine, alone = dense[other], dense[only]
            n = int(there.sum())
            yield int(x), int(y), int(gap(mine, q).sum() + gap(alone, q0).sum()), n
            yield int(y), int(x), int(gap(q, mine).sum() + gap(np.full(len(alone), q0), alone).sum()), n


def opponents(slots: int) -> list[list[tuple[int, int]]]:
    """The rounds of a round-robin tournament: one player stays, the others move on by one place each round."""
    ring = list(range(slots + slots % 2))
    rounds = []
    for _ in range(len(ring) - 1):
        pairs = ((ring[i], ring[-1 - i]) for i in range(len(ring) // 2))
        rounds.append([tuple(sorted(p)) for p in pairs if max(p) < slots])
        ring.insert(1, ring.pop())
    return rounds


def audit(docs: DataFrame, ranks: int = RANKS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank) of each group of ``docs`` (lang, source, text).

    Part ``pair``: item is each other source of the language, value how far the group is from it; all ranks. Part ``term``: the ``ranks``
    terms that set the group off most from its language. Ties go to the item that is less by its bytes. Nulls are '';
    a group without terms has pairs but no terms; a language of one source has no pairs; one that keeps no term has pairs of value 0.
    Repeated rows count as often as they are there; an empty table gives no rows. The table that is returned is stored; all others are
    deleted.
    """
    with swept(docs.sparkSession) as kept:
        return kept(_audit(docs, ranks, least_docs))


def _audit(docs: DataFrame, ranks: int, least_docs: int) -> DataFrame:
    spark = docs.sparkSession
    counts = counted(docs)
    terms, langs = vocabulary(counts, least_docs)
    joined = counts.filter(F.col("term").isNotNull()).join(terms.select("lang", "term", "seg", "id"), ["lang", "term"])
    joined = staged(joined.select("lang", "source", "seg", "id", F.col("n").alias("c")), "postings")
    totals = joined.groupBy("lang", "source").agg(F.sum("c").alias("total"), F.count("*").alias("held"))
    named = counts.filter(F.col("term").isNull()).select("lang", "source").join(totals, ["lang", "source"], "left").join(small(langs.select("lang", "v", "segs", "groups")), "lang")
    load = F.ceil(F.sum(F.coalesce("held", F.lit(0)) / F.col("segs")).over(Window.partitionBy("lang")) / TILE_TERMS)
    slots = F.least("groups", F.greatest(F.ceil(F.sqrt("groups")), load)).cast("int")
    g = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    named = named.withColumns({"g": g.cast("long"), "slots": slots, "total": F.coalesce("total", F.lit(0))})
    named = staged(named.withColumn("slot", F.pmod("g", "slots").cast("int")).select("lang", "source", "g", "slot", "slots", "total", "v", "segs"), "groups")
    frame = named.withColumn("seg", F.explode(F.sequence(F.lit(0), F.col("segs") - 1)))
    frame = frame.select("lang", "seg", "slot", "g", "total", "v", F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("n"))
    vectors = joined.join(small(named), ["lang", "source"]).select("lang", "seg", "slot", "g", "total", "v", F.col("id").cast("long").alias("id"), F.col("c").alias("n"))
    home = staged(tiles(vectors.unionByName(frame)), "tiles")
    whole = terms.join(small(langs.select("lang", "v", "total")), "lang")
    whole = tiles(whole.select("lang", "seg", F.lit(0).alias("slot"), F.lit(0).cast("long").alias("g"), "total", "v", F.col("id").cast("long").alias("id"), "n"))
    whole = staged(whole.select("lang", "seg", F.col("tile").alias("peer")), "whole")

    resident = home.repartition("lang", "seg", "slot").persist()
    try:
        sums = staged(_tournament(spark, resident, named), "sums")
        best = staged(_terms(resident, whole, ranks), "heaps")
    finally:
        resident.unpersist()

    return _pairs(sums, named).unionByName(_ranked(best, named, terms, ranks))


def _tournament(spark: SparkSession, resident: DataFrame, named: DataFrame) -> DataFrame:
    """(lang, g, peer, f, n) summed over segments: all pairs of groups, both ways."""
    kind = "lang string, g long, peer long, f long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                a = Tile(r["tile"])
                out = list(meeting(a, a if r["peer"] is None else Tile(r["peer"])))
                cols = [pa.array([x[i] for x in out], pa.int64()) for i in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(out), pa.string()), *cols], ["lang", "g", "peer", "f", "n"])

    parts = [staged(resident.select("lang", "tile", F.lit(None).cast("binary").alias("peer")).mapInArrow(run, kind), "round")]
    most = named.agg(F.max("slots")).first()[0] or 0
    for turn in filter(None, opponents(most)):
        meet = spark.createDataFrame(turn, "slot int, slot_of_peer int")
        # a language with fewer slots than the largest plays those of its meetings that both sides exist for
        peers = resident.select("lang", "seg", F.col("slot").alias("slot_of_peer"), F.col("tile").alias("peer")).join(F.broadcast(meet), "slot_of_peer").drop("slot_of_peer")
        met = resident.join(peers.hint("shuffle_hash"), ["lang", "seg", "slot"])
        parts.append(staged(met.select("lang", "tile", "peer").mapInArrow(run, kind), "round"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("lang", "g", "peer").agg(F.sum("f").alias("f"), F.sum("n").alias("n"))


def _terms(resident: DataFrame, whole: DataFrame, ranks: int) -> DataFrame:
    """(lang, seg, g, id, value): of each group and segment, the ``ranks`` terms with the greatest value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                tile, peer = Tile(r["tile"]), Tile(r["peer"])
                every = peer.vectors[0][1]  # the language has all kept terms, so places are ids
                rows = []
                for g, (ids, p, _) in zip(tile.groups, tile.vectors, strict=True):
                    q = every[ids]
                    above = p > q
                    heap: list[tuple[int, int]] = []
                    for value, i in zip(gap(p, q)[above].tolist(), ids[above].tolist(), strict=True):
                        if len(heap) < ranks:
                            heapq.heappush(heap, (value, -i))
                        elif (value, -i) > heap[0]:
                            heapq.heapreplace(heap, (value, -i))
                    rows += [(r["lang"], r["seg"], int(g), -i, value) for value, i in heap]
                types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], ["lang", "seg", "g", "id", "value"])

    return resident.join(whole, ["lang", "seg"]).select("lang", "seg", "tile", "peer").mapInArrow(run, "lang string, seg int, g long, id long, value long")


def _pairs(sums: DataFrame, named: DataFrame) -> DataFrame:
    """The part ``pair``: the sums over terms that one of the two has, and the rest of the kept terms, which all differ by the same."""
    of = small(named.select("lang", "g", "source", "v", F.expr(f"1 + if(v = 0, 0, {UNIT} div greatest(1, total + v))").alias("p0")))
    peer = small(named.select("lang", F.col("g").alias("peer"), F.col("source").alias("item"), F.expr(f"1 + if(v = 0, 0, {UNIT} div greatest(1, total + v))").alias("q0")))
    both = sums.join(of, ["lang", "g"]).join(peer, ["lang", "peer"])
    value = F.expr("f + (v - n) * ((p0 - q0) * (p0 - q0) div q0)")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    return both.withColumn("rank", F.row_number().over(order))


def _ranked(best: DataFrame, named: DataFrame, terms: DataFrame, ranks: int) -> DataFrame:
    """The part ``term``: the heaps of all segments, merged."""
    words = best.join(terms.select("lang", "seg", "id", F.col("term").alias("item")), ["lang", "seg", "id"]).join(small(named.select("lang", "g", "source")), ["lang", "g"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = words.select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= ranks)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB SQL for the contract query.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, cast(1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (coalesce(n.n, 0) + v.v) AS HUGEINT) AS p
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
w AS (SELECT k.lang, k.term, cast(1 + (1000000000::HUGEINT * (k.c + 1)) // (v.n + v.v) AS HUGEINT) AS q FROM k JOIN v USING (lang)),
pv AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, cast(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, cast(((p - q) * (p - q)) // q AS BIGINT) AS value
  FROM p JOIN w USING (lang, term) WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, cast(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
