"""N-gram Jaccard join: documents whose word shingles overlap by 80 % or more, and their components.

Equal sets are one node. Nodes meet in tiles, one per shingle of a node's prefix: in one fixed order of all shingles,
two sets that overlap enough share one of their first ``n - ceil(0.8 n) + 1``. The order puts frequent shingles last,
so that a passage that many documents share makes no tile but for documents that hold little else. Which
are frequent is counted over all documents and kept as a bitmap of fixed size; a wrong bit only changes the order.

A pair would meet in as many tiles as it shares. So shingles with the same nodes make one tile, every node has a home,
the largest of its tiles, two nodes with the same home are compared there only, and a tile whose nodes all have one other home
is dropped. A tile of more than BLOCK nodes or BLOCK_BYTES of bitmaps is split into size bands, and these into blocks;
blocks of one band or of neighbouring ones meet in pairs. In a tile, sizes, then bit counts of hashed signatures bound every
pair's overlap from above; no pair leaves the tile before it has passed them.

Components need not every link (``links`` returns each): a tile first offers a spanning forest of the pairs that
passed, the likeliest first, and the exact intersection of sorted shingle arrays decides. Where all of a tile's offers
link, its other pairs are connected as well. The other tiles are gone through once more, and offer every pair that passed and is
not yet connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, U64, forget, mix, pieces, small, staged, swept_query, text_key, trimmed, word_hashes
from .components import components

WORDS = 5
#: A token that more nodes have is frequent; the bound doubles until at most MARKS tokens are, so that the marks' table stays nearly empty.
FREQUENT, MARKS = 24, 1 << 20
#: Bounds of what meets in one task; larger tiles are split.
BLOCK, BLOCK_BYTES = 4096, 8_000_000
#: So many sets are compared with one pivot in one task; a pivot with more goes to several.
GROUP = 5000
_TOKEN = U64((1 << 48) - 1)
_HOT_BITS = 24
_MUL = np.random.default_rng(11).integers(1, 1 << 63, 8, np.uint64) * U64(2) + U64(1)


def shingles(raw: np.ndarray, offs: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Each row's sorted distinct shingle hashes; fewer words than a shingle are one."""
    h, at = word_hashes(raw, offs, SPACES)
    n = len(h) - words + 1
    s = np.zeros(max(n, 0), U64)
    for i in range(words):
        if n > 0:
            s += h[i : i + n] * _MUL[i]
    s = mix(s)
    out = []
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        if hi - lo >= words:
            out.append(np.unique(s[lo : hi - words + 1]))
        elif hi > lo:
            out.append(mix(np.sum(h[lo:hi] * _MUL[: hi - lo], keepdims=True, dtype=U64) + U64(hi - lo) * _MUL[7]))
        else:
            out.append(np.zeros(0, U64))
    return out


def node_name(s: np.ndarray) -> bytes:
    """96 bits that name a set."""
    a = np.sum(mix(s ^ _MUL[5]), dtype=U64) + U64(len(s))
    b = np.sum(mix(s + _MUL[6]), dtype=U64)
    return a.tobytes() + b.tobytes()[:4]


def prefix_size(n: int) -> int:
    """How many of its first shingles a set of n is looked up by."""
    return n - (4 * n + 4) // 5 + 1


def signature(s: np.ndarray) -> np.ndarray:
    """A bitmap with one bit set for each shingle; its size, a power of two, is four times the set's or more. The upper half laid
    on the lower one is the bitmap of half the size."""
    bits = np.zeros(1 << max(10, int(4 * len(s) - 1).bit_length()), bool)
    bits[(s >> U64(20)).astype(np.int64) & (len(bits) - 1)] = True
    return np.packbits(bits)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_key(F.col("text")).alias("text_hash"), "text")


def document_sets(docs: DataFrame) -> DataFrame:
    """Store (doc_id, text_hash, node, n, bits, low) of every row: its set's name, size and signature, and a little more than a
    prefix of its tokens in plain order. All but n are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, offs in pieces(batches, "text"):
            names, sizes, bits, low = [], [], [], []
            for s in shingles(raw, offs):
                p = prefix_size(len(s))
                some = len(s) > 0
                names.append(node_name(s) if some else None)
                sizes.append(len(s))
                bits.append(signature(s).tobytes() if some else None)
                low.append(np.sort(s & _TOKEN)[: p + p // 8 + 8].astype(np.int64))
            cols = [b.column(0), b.column(1), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary()), lists(low)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", "node", "n", "bits", "low"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return staged(keyed(docs).mapInArrow(run, f"doc_id {kind}, text_hash long, node binary, n long, bits binary, low array<long>"), "sets")


def representatives(sets: DataFrame) -> DataFrame:
    """Store, for each node, one document (doc_id, text_hash), n, bits and low."""
    one = sets.filter("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash", "n", "bits", "low")).alias("r"))
    return staged(one.select("node", "r.*"), "representatives")


def lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(arrays).astype(np.int64)))


def frequent(reps: DataFrame) -> np.ndarray:
    """Marks (2**24, by a token's low bits) of the frequent tokens of the nodes' plain prefixes. Any marks give right results; these keep tiles small."""
    t = staged(reps.select(F.explode("low").alias("t")).groupBy("t").agg(F.count("*").alias("c")).filter(F.col("c") > FREQUENT), "frequent")
    # double is how often the bound can be doubled and the token stay frequent
    double = F.floor(F.log2((F.col("c") - 1) / FREQUENT)).cast("int")
    found = {r.j: r.n for r in t.groupBy(double.alias("j")).agg(F.count("*").alias("n")).collect()}  # at most 60 rows
    least = next(j for j in range(64) if sum(n for k, n in found.items() if k >= j) <= MARKS)
    cells = t.filter(double >= least).select(F.col("t").bitwiseAND(F.lit((1 << _HOT_BITS) - 1)).cast("int").alias("t")).distinct().toArrow()
    forget(t)
    marks = np.zeros(1 << _HOT_BITS, bool)
    marks[np.asarray(cells.column("t"))] = True
    return marks


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of ``nodes`` (node, doc_id, text_hash)."""
    side = small(nodes.select("node", F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")))
    d = keyed(docs)
    met = d.join(side, d.doc_id.eqNullSafe(F.col("_d")) & (d.text_hash == F.col("_h")))
    return met.select("node", "text").dropDuplicates(["node"])


def tiles(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """Store (t, k, node): the k nodes of every tile of two nodes or more. Shingles with the same nodes make one tile, named
    by its nodes."""
    marks = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent(reps)))

    def hot(t: np.ndarray, packed: np.ndarray) -> np.ndarray:
        cell = t.astype(np.int64) & ((1 << _HOT_BITS) - 1)
        return (packed[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low, n = b.column("low"), b.column("n").to_pylist()
            values, at = np.asarray(low.flatten()), np.concatenate(([0], np.cumsum(np.asarray(low.value_lengths()))))
            cold = ~hot(values, marks.value)
            out = []
            for i, size in enumerate(n):
                v = values[at[i] : at[i + 1]][cold[at[i] : at[i + 1]]]
                p = prefix_size(size)
                out.append(v[:p] if len(v) >= p else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column("node"), lists(out)], ["node", "prefix"])

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, offs in pieces(batches, "text"):
            out = []
            for s in shingles(raw, offs):
                t = np.sort(s & _TOKEN)
                out.append(t[np.argsort(hot(t, marks.value), kind="stable")][: prefix_size(len(t))])
            yield pa.RecordBatch.from_arrays([b.column("node"), lists(out)], ["node", "prefix"])

    schema = "node binary, prefix array<long>"
    some = staged(reps.select("node", "n", "low").mapInArrow(plain, schema), "prefixes")
    rest = reps.select("node", "doc_id", "text_hash").join(some.filter("size(prefix) = 0").select("node"), "node", "left_semi")
    prefixes = some.unionByName(texts_of(docs, rest).mapInArrow(full, schema))
    rows = prefixes.select("node", F.explode("prefix").alias("t"))
    w = Window.partitionBy("t")
    named = rows.withColumns({"k": F.count("*").over(w), "h": F.bit_xor(F.xxhash64("node")).over(w)}).filter("k > 1")
    out = staged(named.select(F.xxhash64("h", "k").alias("t"), "k", "node").distinct(), "tiles")
    forget(some)
    return out


def with_homes(met: DataFrame, reps: DataFrame) -> DataFrame:
    """Store (t, k, node, home, n) of the tiles in which some pair is to be compared."""
    home = met.groupBy("node").agg(F.max(F.struct("k", "t")).alias("m")).select("node", F.col("m.t").alias("home"))
    rows = met.join(home.join(reps.select("node", "n"), "node"), "node")
    rows = staged(rows.select("t", "k", "node", "home", "n"), "homes")
    elsewhere = rows.groupBy("t").agg(F.min("home").alias("a"), F.max("home").alias("z")).filter("a = z and a <> t").select("t")
    out = staged(rows.join(elsewhere, "t", "left_anti"), "tiles")
    forget(rows)
    return out


def placed(rows: DataFrame) -> DataFrame:
    """Store (s, side, t, node, home, n): each row of ``with_homes`` in the meetings s that it takes part in.

    side 0: all pairs of the meeting are compared; 1 and 2: each row of one side with each of the other. Rows without another
    of a size that allows a link are left out.
    """
    width = F.greatest(F.lit(128), F.col("n"))  # bytes of a signature, at most
    sized = rows.withColumns({"w": width, "band": F.floor(F.log(F.col("n")) / F.log(F.lit(1.25))).cast("int")})
    large = sized.groupBy("t").agg(F.count("*").alias("c"), F.sum("w").alias("b")).filter((F.col("c") > BLOCK) | (F.col("b") > BLOCK_BYTES)).select("t")
    large = staged(large, "large")
    slim = ("s", "side", "t", "node", "home", "n")
    by_size = Window.partitionBy("t").orderBy("n")  # at most BLOCK rows
    alone = (F.coalesce(4 * F.lead("n").over(by_size) > 5 * F.col("n"), F.lit(True))) & (F.coalesce(5 * F.lag("n").over(by_size) < 4 * F.col("n"), F.lit(True)))
    whole = sized.join(large, "t", "left_anti").withColumns({"alone": alone, "s": F.xxhash64("t"), "side": F.lit(0)}).filter("not alone").select(*slim)
    if large.isEmpty():
        return staged(whole, "placed")
    parts = sized.join(large, "t", "left_semi")
    of = parts.groupBy("t", "band").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("w") / BLOCK_BYTES)).cast("int").alias("blocks"))
    of = staged(of, "bands")
    out = None
    for other in (0, 1, -1):  # the same band, the one above, the one below
        near = of.select("t", (F.col("band") - other).alias("band"), F.col("blocks").alias("others"))
        x = parts.join(of, ["t", "band"]).join(near, ["t", "band"])
        x = x.withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
        if other == 0:
            name, side = ("t", "band", F.lit(0), F.least("i", "j"), F.greatest("i", "j")), F.when(F.col("i") == F.col("j"), 0).when(F.col("i") < F.col("j"), 1).otherwise(2)
        elif other == 1:
            name, side = ("t", "band", F.lit(1), "i", "j"), F.lit(1)
        else:
            name, side = ("t", F.col("band") - 1, F.lit(1), "j", "i"), F.lit(2)
        x = x.withColumns({"s": F.xxhash64(*name), "side": side.cast("int")}).select(*slim)
        out = x if out is None else out.unionByName(x)
    return staged(whole.unionByName(out), "placed")


def passed(t: int, side: np.ndarray, home: np.ndarray, comp: np.ndarray, n: np.ndarray, bits: list[bytes]) -> tuple[np.ndarray, ...]:
    """Rows i, j of one meeting, in ascending order of n, whose sizes and signatures allow a link, and how far they do."""
    wide = np.array([len(x) for x in bits])
    of = []
    for m in np.unique(wide):
        a, b, c = np.searchsorted(wide, (m, m + 1, 2 * m + 1))
        table = np.frombuffer(b"".join(bits[a:c]), np.uint8)
        lower, upper = table[: (b - a) * m].reshape(-1, m), table[(b - a) * m :].reshape(-1, 2, m)
        table = np.concatenate((lower, upper[:, 0] | upper[:, 1])).view(np.uint64)
        ones = np.bitwise_count(table).sum(axis=1, dtype=np.int64)
        ends = np.searchsorted(n, n[a:b] * 5 // 4, "right")
        for i in range(a, b):
            j = np.arange(i + 1, ends[i - a])
            fit = comp[j] != comp[i]
            if home[i] != t:
                fit &= home[j] != home[i]
            if side[i]:
                fit &= side[j] != side[i]
            j = j[fit]
            if not len(j):
                continue
            both = np.bitwise_count(table[j - a] & table[i - a]).sum(axis=1, dtype=np.int64)
            most = np.minimum(n[i] - ones[i - a] + both, n[j] - ones[j - a] + both)
            slack = 9 * most - 4 * (n[i] + n[j])
            keep = slack >= 0
            if keep.any():
                j = j[keep]
                of.append((np.full(len(j), i), j, slack[keep] / (n[i] + n[j])))
    return tuple(np.concatenate(x) for x in zip(*of, strict=True)) if of else (np.zeros(0, np.int64),) * 3


def forest(i: np.ndarray, j: np.ndarray, slack: np.ndarray, comp: np.ndarray) -> list[int]:
    """Which of the pairs (i, j) make a spanning forest over ``comp``, those with most slack first."""
    above = np.arange(comp.max() + 1).tolist()
    left = len(np.unique(comp[np.concatenate((i, j))])) - 1
    kept = []
    for k in np.argsort(-slack, kind="stable").tolist():
        x, y = comp[i[k]], comp[j[k]]
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        while above[y] != y:
            above[y] = above[above[y]]
            y = above[y]
        if x != y:
            above[x] = y
            kept.append(k)
            if len(kept) == left:
                break
    return kept


def offered(rows: DataFrame, reps: DataFrame, labels: DataFrame | None, every: bool) -> DataFrame:
    """Store (s, x, y): pairs of ``rows`` (of ``placed``), x < y, that sizes and signatures let pass and ``labels`` (node, comp) don't
    connect; of each meeting a spanning forest, or every one."""
    rows = rows.join(reps.select("node", "bits"), "node")
    rows = rows.join(labels, "node", "left") if labels is not None else rows.withColumn("comp", F.lit(None).cast("binary"))
    rows = rows.select("s", "t", "side", "home", "n", "node", F.coalesce("comp", "node").alias("comp"), "bits")
    rows = rows.repartition("s").sortWithinPartitions("s", "t", "n")

    def meeting(s: int, t: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(parts)
        names = table.column("node").to_pylist()
        seen: dict[bytes, int] = {}
        comp = np.array([seen.setdefault(x, len(seen)) for x in table.column("comp").to_pylist()])
        i, j, slack = passed(t, *(np.asarray(table.column(c)) for c in ("side", "home")), comp, np.asarray(table.column("n")), table.column("bits").to_pylist())
        if not len(i):
            return None
        if not every:
            k = forest(i, j, slack, comp)
            i, j = i[k], j[k]
        two = [sorted((names[a], names[b])) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([s] * len(two), pa.int64()), *(pa.array([x[k] for x in two], pa.binary()) for k in (0, 1))], ["s", "x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for b in batches:
            s, t = np.asarray(b.column("s")), np.asarray(b.column("t"))
            cuts = np.flatnonzero((s[1:] != s[:-1]) | (t[1:] != t[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(s)], strict=True):
                if lo == hi:
                    continue
                if key != (s[lo], t[lo]):
                    if len(parts) and (out := meeting(*key, parts)):
                        yield out
                    key, parts = (s[lo], t[lo]), []
                parts.append(b.slice(lo, hi - lo))
        if parts and (out := meeting(*key, parts)):
            yield out
        trimmed()

    return staged(rows.mapInArrow(run, "s long, x binary, y binary"), "offered")


def verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """Store those of ``pairs`` (x, y: nodes) that link: the intersection of sorted arrays decides."""
    left = staged(pairs.select("x", "y").distinct(), "pairs")
    # all x of one y meet in a group, at most GROUP of them; each group has y's text once
    sized = left.join(left.groupBy("y").agg(F.count("*").alias("k")), "y")
    part = F.pmod(F.xxhash64("x"), F.ceil(F.col("k") / GROUP)).cast("int").alias("part")
    sized = sized.select("x", "y", part)
    pivot = F.lit(True).alias("pivot")
    asked = sized.select(F.col("x").alias("node"), "y", "part", F.lit(False).alias("pivot")).unionByName(sized.select(F.col("y").alias("node"), "y", "part", pivot).distinct())
    asked = staged(reps.select("node", "doc_id", "text_hash").join(asked, "node"), "asked")
    side = small(asked.withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"}))
    d = keyed(docs)
    met = d.join(side, d.doc_id.eqNullSafe(F.col("_d")) & (d.text_hash == F.col("_h"))).select("y", "part", "pivot", "node", "text")
    met = met.repartition("y", "part").sortWithinPartitions("y", "part", F.desc("pivot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, other = None, np.zeros(0, U64)
        for b, raw, offs in pieces(batches, "text"):
            keep = []
            for s, y, first in zip(shingles(raw, offs), b.column("y").to_pylist(), b.column("pivot").to_pylist(), strict=True):
                if first:
                    here, other = y, s
                    keep.append(False)
                    continue
                assert y == here
                i = len(np.intersect1d(s, other, assume_unique=True))
                keep.append(100 * i >= 80 * (len(s) + len(other) - i))
            out = b.select(["node", "y"]).filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(out.columns, ["x", "y"])

    return staged(met.mapInArrow(run, "x binary, y binary"), "linked")


def met_in_tiles(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """``placed`` of all nodes."""
    met = tiles(docs, reps)
    homes = with_homes(met, reps)
    out = placed(homes)
    forget(met, homes)
    return out


def links(docs: DataFrame) -> DataFrame:
    """All links between different sets: (x_doc_id, x_text_hash, y_doc_id, y_text_hash), each once.

    A set stands under the first (null first) doc_id and text_hash of the rows of ``docs`` (doc_id, text) that have it; rows
    with equal sets are not listed as links. The result grows with the square of a family of near copies.
    """
    docs = docs.select("doc_id", "text")
    reps = representatives(document_sets(docs))
    found = verified(docs, reps, offered(met_in_tiles(docs, reps), reps, None, True))
    x, y = (reps.select(F.col("node").alias(c), F.col("doc_id").alias(f"{c}_doc_id"), F.col("text_hash").alias(f"{c}_text_hash")) for c in "xy")
    return found.join(x, "x").join(y, "y").select("x_doc_id", "x_text_hash", "y_doc_id", "y_text_hash")


def link_components(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, comp) of every node that is linked with another; comp is the least node of its component."""
    reps = representatives(sets)
    rows = met_in_tiles(docs, reps)
    first = offered(rows, reps, None, False)
    linked = verified(docs, reps, first)
    labels = components(linked)
    failed = staged(first.join(linked, ["x", "y"], "left_anti"), "failed")
    if not failed.isEmpty():
        rest = offered(rows.join(failed.select("s").distinct(), "s", "left_semi"), reps, labels, True)
        more = verified(docs, reps, rest.join(failed.select("x", "y").distinct(), ["x", "y"], "left_anti"))
        if not more.isEmpty():
            labels = components(linked.unionByName(more))
    forget(rows, reps)
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, n_shingles, component (its name) and component_id
    (the smallest doc_id in it).

    A row without words is linked with nothing: component is null and component_id its own doc_id. Null ids stay
    out of the minimum; rows with equal ids but different texts are different documents; further columns are left out. Texts of
    any length count whole; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    sets = document_sets(docs)
    labels = link_components(docs, sets)
    named = sets.select("doc_id", "text_hash", "node", "n").join(labels, "node", "left").withColumn("component", F.coalesce("comp", "node"))
    least = named.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "component", "left")
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component", own.alias("component_id"))


@swept_query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_shingles", "component_id")
