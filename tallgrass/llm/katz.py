"""Language-model scoring: a bigram model with Katz backoff.

``P(w | h)`` of a pair seen in training is its Good-Turing discounted count over the history's count; of an unseen
pair it is ``alpha(h) P(w)``; ``P(w)`` is discounted in the same way and leaves its rest to the unknown word. alpha(h) is
the mass that the history's discounts free over the mass of the words it has not been seen with, so every
history's probabilities sum to 1 exactly. A history that training lacks has alpha 1.

Words and pairs go by 64-bit hashes. Counting and scoring a pair need all its occurrences at one place, so pairs are
dealt to buckets of bounded size by their hash, in packed blobs with the documents that hold them; a frequent history
spreads over all buckets. Each bucket becomes one row of a stored table: pairs, counts and occurrences. From it
come the counts of counts, each document's sums, the histories' freed masses, and the unseen pairs, whose alpha
follows by a join on the history.

Word counts reach the readers of documents in one sorted array of at most ``BROADCAST_WORDS`` entries (12 bytes each).
Where training has more words, the array holds the most frequent ones. The others, many words but few of the tokens,
go to the buckets as hashes, and each bucket gets the numbers of its own ones by a join. They are numbered by falling
count, so that a number tells the count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, U64, mix, pieces, staged, swept_query, word_hashes

TOP = 5
#: What a count above TOP gives up, so that every history keeps some mass for unseen words.
FREED = 0.01
END, START, UNKNOWN = U64(0xE4D), U64(0x57A47), U64(0xFFFFFFFFFFFFFFFF)
BROADCAST_WORDS = 8_000_000
#: Of a piece of the corpus. A row's number in its piece has 16 bits. The number of packed blobs is that of pieces times
#: that of buckets, so it grows with the square of the corpus: both are as large as an executor's memory allows.
PIECE_BYTES, PIECE_ROWS = 2_000_000, 60_000
BUCKET_EVENTS = 1_000_000


def discounts(n: list[int]) -> np.ndarray:
    """Katz's discount ratios of counts 0 to TOP + 1 (the last: of a count above TOP, with ``FREED``), from the number n[r - 1] of types with count r."""
    d = np.ones(TOP + 1)
    tail = (TOP + 1) * n[TOP] / n[0] if n[0] else 1.0
    for r in range(1, TOP + 1):
        if n[0] and n[r - 1] and tail < 1:
            d[r] = ((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail)
        if not 0 < d[r] < 1 - FREED / r:
            d[r] = 1 - 0.5 / r if r == 1 else 1 - FREED / r
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return np.where(c <= TOP, d[np.minimum(c, TOP)] * c, c - FREED)


@dataclass
class Unigrams:
    n: int
    v: int
    docs: int
    d: np.ndarray
    unknown: float

    def p(self, c: np.ndarray) -> np.ndarray:
        """P(w) of words with training counts c; 0: the unknown word."""
        return np.where(c > 0, discounted(c, self.d) / max(self.n, 1), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """History and token of every place of all rows, each row ending with END, and the places' rows."""
    h, at = word_hashes(raw, offs, SPACES)
    size = np.diff(at) + 1
    ends = np.cumsum(size)
    cur = np.empty(int(ends[-1]) if len(ends) else 0, U64)
    is_end = np.zeros(len(cur), bool)
    is_end[ends - 1] = True
    cur[~is_end], cur[is_end] = h, END
    prev = np.empty_like(cur)
    prev[1:] = cur[:-1]
    prev[ends - size] = START
    return prev, cur, np.repeat(np.arange(len(size)), size)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(rows' batches, their tokens) of about PIECE_BYTES of text each, and PIECE_ROWS rows at most."""
    parts, toks, size, rows = [], [], 0, 0
    for b, raw, offs in pieces(batches, "text", rows=PIECE_ROWS):
        if rows + b.num_rows > PIECE_ROWS:
            yield parts, toks
            parts, toks, size, rows = [], [], 0, 0
        parts.append(b.drop_columns(["text"]) if hasattr(b, "drop_columns") else b.select([c for c in b.schema.names if c != "text"]))
        prev, cur, row = tokens(raw, offs)
        toks.append((prev, cur, row + rows))
        rows, size = rows + b.num_rows, size + len(raw)
        if size >= PIECE_BYTES:
            yield parts, toks
            parts, toks, size, rows = [], [], 0, 0
    if parts:
        yield parts, toks


def count_words(docs: DataFrame) -> DataFrame:
    """Store (w, c): the training counts of all tokens of ``docs`` (held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, toks in gathered(batches):
            held = np.concatenate([np.asarray(p.column("held_out")) for p in parts])
            row = np.concatenate([t[2] for t in toks])
            w, c = np.unique(np.concatenate([t[1] for t in toks])[~held[row]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c.astype(np.int64))], ["w", "c"])

    seen = docs.select("held_out", "text").mapInArrow(run, "w long, c long")
    return staged(seen.groupBy("w").agg(F.sum("c").alias("c")), "unigrams")


def unigrams(words: DataFrame) -> Unigrams:
    """The unigram distribution from ``count_words``."""
    ends = F.sum(F.when(F.col("w") == int(END), F.col("c")))
    of = [F.count_if(F.col("c") == r) for r in range(1, TOP + 2)]
    r = words.agg(F.sum("c"), F.count("*"), ends, *of).first()
    n, v, docs, of = r[0] or 0, r[1] or 0, r[2] or 0, list(r[3:])
    d = discounts(of)
    if not n:
        return Unigrams(0, 0, 0, d, 1.0)
    freed = words.agg(F.sum(F.when(F.col("c") <= TOP, F.element_at(F.lit([float(1 - x) for x in d[1:]]), F.least("c", F.lit(TOP)).cast("int")) * F.col("c")).otherwise(F.lit(FREED)))).first()[0]
    return Unigrams(n, v, docs, d, freed / n)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob."""
    head = b"".join(a.dtype.str.encode() + b":%d;" % a.nbytes for a in arrays)
    return zstandard.compress(b"%d;" % len(arrays) + head + b"".join(a.tobytes() for a in arrays), 1)


def unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(blob)
    n, at = data.split(b";", 1)[0], 0
    heads = data.split(b";", int(n) + 1)[1 : int(n) + 1]
    at = len(n) + 1 + sum(len(h) + 1 for h in heads)
    out = []
    for h in heads:
        kind, size = h.decode().split(":")
        out.append(np.frombuffer(data, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


@dataclass
class Rare:
    """The words beyond the array: numbered by falling count; ``ends``: where each of the ``counts`` ends."""

    counts: np.ndarray
    ends: np.ndarray

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The counts of word numbers."""
        return self.counts[np.searchsorted(self.ends, numbers, "right")]


def rare_words(words: DataFrame, most: int) -> tuple[DataFrame, Rare]:
    """Store (w, number) of the words with a count of at most ``most``."""
    stored = staged(words.filter(F.col("c") <= most).orderBy(F.desc("c"), "w"), "rare")
    of = sorted(((r.c, r.n) for r in stored.groupBy("c").agg(F.count("*").alias("n")).collect()), reverse=True)
    files = stored.withColumns({"f": F.col("_metadata.file_name"), "r": F.col("_metadata.row_index")})
    first = files.groupBy("f").agg(F.count("*").alias("n"))
    first = first.select("f", (F.sum("n").over(Window.orderBy("f")) - F.col("n")).alias("first"))
    numbered = files.join(F.broadcast(first), "f").select("w", (F.col("first") + F.col("r")).alias("number"))
    return numbered, Rare(np.array([c for c, _ in of], np.int64), np.cumsum([n for _, n in of]))


def cut_of(words: DataFrame, n: int) -> int:
    """The smallest power of two that at most ``n`` words' counts pass."""
    powers = [1 << k for k in range(63)]
    above = words.agg(*(F.count_if(F.col("c") > x) for x in powers)).first()
    return next(x for x, many in zip(powers, above, strict=True) if many <= n)


def places(u: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``u`` would be among the sorted ``hashes``, and whether it is there."""
    if not len(hashes):
        return np.zeros(len(u), np.int64), np.zeros(len(u), bool)
    at = np.searchsorted(hashes, u)
    at[at == len(hashes)] = 0
    return at, hashes[at] == u


def bucket_of(h: np.ndarray, w: np.ndarray, n_buckets: int) -> np.ndarray:
    """The buckets of pairs of hashes."""
    return ((mix(h * U64(0x9E3779B97F4A7C15) + mix(w)) >> U64(33)) % U64(n_buckets)).astype(np.uint16 if n_buckets <= 65536 else np.uint32)


def piece_rows(piece: int, held: np.ndarray, toks: list, hashes: np.ndarray, counts: np.ndarray, wide: bool, uni: Unigrams, n_buckets: int) -> Iterator[tuple]:
    """First (n_tokens, n_known, base) of the piece's rows; then (bucket, piece, blob): its pairs, how many rows hold
    each, which, and how often (below 0: in a held-out row). If ``wide``, there are words beyond the array: the rows' n_known
    and base are without them, and a blob ends with their hashes, which its ids from len(hashes) + 2 on number. Empties ``toks``."""
    prev, cur, row = (np.concatenate([t[i] for t in toks]) for i in range(3))
    toks.clear()
    n, k = len(held), len(hashes)
    u, back = np.unique(cur, return_inverse=True)
    at, known = places(u, hashes)
    c = np.zeros(len(u), np.int64)
    c[known] = counts[at[known]]
    ids = np.where(known, at, k).astype(np.uint32)
    beyond = u[~known]
    if wide:
        ids[~known] = np.arange(k + 2, k + 2 + len(beyond))
    base = np.where(known | (not wide), uni.base(c), 0.0)
    yield np.bincount(row, minlength=n), np.bincount(row, known[back], n).astype(np.int64), np.bincount(row, base[back], n)
    bucket = bucket_of(prev, cur, n_buckets)
    pair = ids[back].astype(U64)
    begin = prev == START
    pair[1:] |= pair[:-1] << U64(32)
    pair[begin] = pair[begin] & U64(0xFFFFFFFF) | U64(k + 1) << U64(32)
    del prev, cur, back, begin
    # rows ascend, and stable sorts keep that
    order = np.argsort(pair, kind="stable")
    order = order[np.argsort(bucket[order], kind="stable")]
    pair, r, bucket = pair[order], row[order], bucket[order]
    new_pair = np.ones(len(order), bool)
    new_pair[1:] = (pair[1:] != pair[:-1]) | (bucket[1:] != bucket[:-1])
    new_doc = new_pair.copy()
    new_doc[1:] |= r[1:] != r[:-1]
    at = np.flatnonzero(new_doc)
    tf = np.diff(np.append(at, len(order))).astype(np.int32)
    r = r[at]
    tf[held[r]] *= -1
    r = r.astype(np.uint16)
    first = np.flatnonzero(new_pair)
    begin = np.searchsorted(at, first)
    many = np.diff(np.append(begin, len(at))).astype(np.uint32)
    h, w, bucket = (pair[first] >> U64(32)).astype(np.uint32), pair[first].astype(np.uint32), bucket[first]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, np.int64)
    for p0, p1 in zip(cuts.tolist(), [*cuts[1:].tolist(), len(first)]):
        e0, e1 = begin[p0], begin[p1] if p1 < len(begin) else len(at)
        arrays = [h[p0:p1], w[p0:p1], many[p0:p1], r[e0:e1], tf[e0:e1]]
        if wide:
            both = np.concatenate(arrays[:2])
            out = np.flatnonzero(both >= k + 2)
            own, number = np.unique(both[out], return_inverse=True)
            both[out] = k + 2 + number
            arrays = [both[: p1 - p0], both[p1 - p0 :], *arrays[2:], beyond[own - (k + 2)]]
        yield int(bucket[p0]), piece, pack(*arrays)


MODEL = "bucket int, pairs binary, events binary, pieces array<long>, n array<long>"


def bucket_model(key: tuple, table: pa.Table, known: int, others: pa.Table | None) -> pa.Table:
    """One bucket's row: its distinct pairs with training counts, and who holds them. known: the array's size;
    others: (w, number) of the bucket's words beyond it."""
    if others is not None:
        hashes, numbers = np.asarray(others.column("w")).view(U64), np.asarray(others.column("number"))
        by = np.argsort(hashes)
        hashes, numbers = hashes[by], numbers[by]
    parts, pieces_ = [], []
    for piece, blob in zip(table.column("piece").to_pylist(), table.column("blob"), strict=True):
        h, w, *rest = unpack(blob.as_py())
        if others is not None:
            at, found = places(rest.pop(), hashes)
            ids = np.full(len(found), known, np.uint32)
            ids[found] = known + 2 + numbers[at[found]]
            h, w = h.copy(), w.copy()
            for x in (h, w):
                out = np.flatnonzero(x >= known + 2)
                x[out] = ids[x[out] - (known + 2)]
        parts.append((h, w, *rest, len(pieces_)))
        pieces_.append(piece)
    pair = np.concatenate([p[0].astype(U64) << U64(32) | p[1] for p in parts])
    many, row, tf = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
    piece = np.repeat(np.array([p[5] for p in parts], np.uint32), [len(p[3]) for p in parts])
    del parts
    pair, name = np.unique(pair, return_inverse=True)
    event = np.repeat(name.astype(np.uint32), many)
    c = np.bincount(event, np.maximum(tf, 0), len(pair)).astype(np.int64)
    of = [int((c == r).sum()) for r in range(1, TOP + 2)]
    by = np.argsort(event, kind="stable")
    many = np.bincount(event, minlength=len(pair)).astype(np.uint32)
    pairs = pack((pair >> U64(32)).astype(np.uint32), pair.astype(np.uint32), c.astype(np.uint32), many)
    events = pack(piece[by], row[by], np.abs(tf[by]).astype(np.uint32))
    cols = [[key[0].as_py()], [pairs], [events], [pieces_], [of]]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.table([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], ["bucket", "pairs", "events", "pieces", "n"])


def summed(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sums of ``values`` by key."""
    u, back = np.unique(keys, return_inverse=True)
    return u, [np.bincount(back, v, len(u)) for v in values]


class Scorer:
    """Reads the model table's rows; ``counts`` are those of the array's words, of the unknown word and of START."""

    def __init__(self, uni: Unigrams, d: np.ndarray, rare: Rare | None, counts: np.ndarray):
        self.uni, self.d, self.rare, self.counts = uni, d, rare, counts

    def count(self, ids: np.ndarray) -> np.ndarray:
        """The training counts of word ids."""
        out = self.counts[np.minimum(ids, len(self.counts) - 1)].astype(np.int64)
        if self.rare is not None:
            k = np.flatnonzero(ids >= len(self.counts))
            out[k] = self.rare.of(ids[k].astype(np.int64) - len(self.counts))
        return out

    def pairs(self, blob: bytes) -> tuple[np.ndarray, ...]:
        h, w, c, many = unpack(blob)
        return h.astype(U64), c.astype(np.int64), many, self.count(h), self.count(w)

    def documents(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(piece, blob): partial scores of a piece's rows, in one blob; an unseen pair's score lacks alpha. With words
        beyond the array, also their part of n_known and base."""
        held: list = []

        def out() -> pa.RecordBatch:
            ids, piece = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            u, sums = summed(piece.astype(np.int64) << 16 | np.concatenate([x[1] for x in held]), [np.concatenate(x) for x in zip(*(x[2] for x in held), strict=True)])
            cuts = np.searchsorted(u >> 16, np.arange(len(ids) + 1))
            blobs = [pack((u[lo:hi] & 65535).astype(np.uint16), *(x[lo:hi] for x in sums)) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(blobs, pa.binary())], ["piece", "blob"])

        size = 0
        for b in batches:
            for i in range(b.num_rows):
                blob = b.column("pairs")[i].as_py()
                _, c, many, hc, wc = self.pairs(blob)
                piece, row, tf = unpack(b.column("events")[i].as_py())
                values = [np.log10(np.where(c > 0, discounted(c, self.d) / np.maximum(hc, 1), self.uni.p(wc)))]
                if self.rare is not None:
                    beyond = unpack(blob)[1] >= len(self.counts) - 2
                    values += [beyond & (wc > 0), np.where(beyond, self.uni.base(wc), 0.0)]
                ids = np.asarray(b.column("pieces")[i].as_py(), np.int64)
                u, v = summed(piece.astype(np.int64) << 16 | row, [tf * np.repeat(x, many) for x in values])
                held.append((ids[u >> 16], u & 65535, v))
                size += len(u)
                if size > 3_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def histories(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(h, seen, mass): by history, its seen pairs' discounted shares and their words' unigram probabilities."""
        for b in batches:
            for i in range(b.num_rows):
                h, c, _, hc, wc = self.pairs(b.column("pairs")[i].as_py())
                s = c > 0
                u, v = summed(h[s], [discounted(c[s], self.d) / hc[s], self.uni.p(wc[s])])
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), *map(pa.array, v)], ["h", "seen", "mass"])

    def unseen(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(piece, row, h, tf) of the unseen pairs whose history training has."""
        for b in batches:
            for i in range(b.num_rows):
                h, c, many, hc, _ = self.pairs(b.column("pairs")[i].as_py())
                piece, row, tf = unpack(b.column("events")[i].as_py())
                at = np.repeat(np.arange(len(c)), many)
                k = np.flatnonzero(((c == 0) & (hc > 0))[at])
                ids = np.asarray(b.column("pieces")[i].as_py(), np.int64)
                arrays = [ids[piece[k]], row[k].astype(np.int64), h[at[k]].view(np.int64), tf[k].astype(np.int64)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["piece", "row", "h", "tf"])


def piece_scores(key: tuple, table: pa.Table) -> pa.Table:
    """(piece, row, score, known, more) from one piece's partial blobs."""
    parts = [unpack(x.as_py()) for x in table.column("blob")]
    u, v = summed(np.concatenate([p[0] for p in parts]).astype(np.int64), [np.concatenate(x) for x in zip(*(p[1:] for p in parts), strict=True)])
    score, known, more = v if len(v) == 3 else (v[0], np.zeros(len(u)), np.zeros(len(u)))
    cols = [pa.array([key[0].as_py()] * len(u), pa.int64()), pa.array(u), pa.array(score), pa.array(np.rint(known).astype(np.int64)), pa.array(more)]
    return pa.table(cols, ["piece", "row", "score", "known", "more"])


def scored(docs: DataFrame, held_out: Column, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Training takes the rows where ``held_out`` is false. Null texts are empty: one end token. With no training rows
    every token is unknown, at probability 1. Equal rows are scored alike; further columns are left out.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", held_out.alias("held_out"), "text")
    words = count_words(docs)
    uni = unigrams(words)
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-uni.n // BUCKET_EVENTS))
    wide = uni.v > broadcast_words
    names = f"doc_ids array<{kind}>, outs array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>"
    schema = f"bucket int, piece long, blob binary, {names}"
    id_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()

    of_rows = {"doc_ids": pa.list_(id_type), "outs": pa.list_(pa.bool_()), "n_tokens": pa.list_(pa.int64()), "n_known": pa.list_(pa.int64()), "base": pa.list_(pa.float64())}

    def rows_of(piece: int, parts: list, toks: list) -> Iterator[pa.RecordBatch]:
        held = np.concatenate([np.asarray(p.column("held_out")) for p in parts])
        ids = [x for p in parts for x in p.column("doc_id").to_pylist()]
        made = piece_rows(piece, held, toks, *vocab.value, wide, uni, n_buckets)
        stats = next(made)
        none = (None,) * len(of_rows)
        rows = [(-1 - piece % n_buckets, piece, None, ids, held.tolist(), *(x.tolist() for x in stats))]
        rows += [(*r, *none) for r in made]
        kinds = [pa.int32(), pa.int64(), pa.binary(), *of_rows.values()]
        cols = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(cols, ["bucket", "piece", "blob", *of_rows])

    cut = cut_of(words, broadcast_words) if wide else 0
    table = words.filter(F.col("c") > cut).select("w", F.col("c").cast("int" if uni.n < 2**31 else "long").alias("c")).toArrow()
    w, c = np.asarray(table.column("w")).view(U64), np.asarray(table.column("c"))
    by = np.argsort(w)
    vocab = spark.sparkContext.broadcast((w[by], c[by]))
    counts = spark.sparkContext.broadcast(np.append(c[by], np.array((0, uni.docs), c.dtype)))
    known = len(by)
    del table, w, c, by

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for k, (parts, toks) in enumerate(gathered(batches)):
            yield from rows_of(base + k, parts, toks)

    blobs = docs.mapInArrow(run, schema).groupBy("bucket")

    def with_others(key: tuple, table: pa.Table, others: pa.Table | None) -> pa.Table:
        if key[0].as_py() >= 0:
            out = bucket_model(key, table, known, others).append_column("piece", pa.nulls(1, pa.int64()))
            for name, k in of_rows.items():
                out = out.append_column(name, pa.nulls(1, k))
            return out
        n = table.num_rows
        cols = [table.column("bucket"), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))]
        return pa.table([*cols, *(table.column(c) for c in ("piece", *of_rows))], ["bucket", "pairs", "events", "pieces", "n", "piece", *of_rows])

    def model_of(key: tuple, table: pa.Table) -> pa.Table:
        return with_others(key, table, None)

    rare = None
    if not wide:
        grouped_model = blobs.applyInArrow(model_of, f"{MODEL}, piece long, {names}")
    else:
        numbers, rare = rare_words(words, cut)

        def beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, toks in gathered(batches):
                prev, cur = (np.concatenate([t[i] for t in toks]) for i in (0, 1))
                u, back = np.unique(cur, return_inverse=True)
                w = np.flatnonzero(~places(u, vocab.value[0])[1][back])
                h = w[w < len(cur) - 1] + 1
                h = h[prev[h] != START]
                bucket = np.concatenate([bucket_of(prev[x], cur[x], n_buckets) for x in (w, h)]).astype(np.int32)
                found = pa.table([pa.array(bucket), pa.array(np.concatenate((cur[w], prev[h])).view(np.int64))], ["bucket", "w"])
                yield from found.group_by(["bucket", "w"]).aggregate([]).combine_chunks().to_batches()

        own = docs.select("held_out", "text").mapInArrow(beyond, "bucket int, w long").distinct().join(numbers, "w").select("bucket", "w", "number")

        grouped_model = blobs.cogroup(own.groupBy("bucket")).applyInArrow(with_others, f"{MODEL}, piece long, {names}")
    model = staged(grouped_model, "bigrams")
    pairs = model.filter("bucket >= 0").select("pairs", "events", "pieces", "n")
    of = pairs.agg(*(F.sum(F.element_at("n", r)) for r in range(1, TOP + 2))).first()
    scorer = (uni, discounts([x or 0 for x in of]), rare)

    def reader(name: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from getattr(Scorer(*scorer, counts.value), name)(batches)

        return run

    sums = pairs.mapInArrow(reader("documents"), "piece long, blob binary").groupBy("piece").applyInArrow(piece_scores, "piece long, row long, score double, known long, more double")
    alpha = pairs.select("pairs").mapInArrow(reader("histories"), "h long, seen double, mass double").groupBy("h")
    alpha = alpha.agg(F.log10((1 - F.sum("seen")) / (1 - F.sum("mass"))).alias("alpha"))
    lacking = pairs.mapInArrow(reader("unseen"), "piece long, row long, h long, tf long").join(alpha, "h", "left")
    lacking = lacking.groupBy("piece", "row").agg(F.sum(F.col("tf") * F.coalesce("alpha", F.lit(0.0))).alias("score"), F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("more"))
    total = sums.unionByName(lacking).groupBy("piece", "row").agg(*(F.sum(x).alias(x) for x in ("score", "known", "more")))
    rows = model.filter("bucket < 0").select("piece", F.posexplode(F.arrays_zip(*of_rows)).alias("row", "d"))
    rows = rows.select("piece", F.col("row").cast("long").alias("row"), "d.*")
    out = rows.join(total, ["piece", "row"])
    train = F.lit(uni.n).cast("long").alias("train_tokens")
    return out.select(F.col("doc_ids").alias("doc_id"), F.col("outs").alias("held_out"), "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"), train, (F.col("base") + F.col("more")).alias("base_score"), "score")


@swept_query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scored(docs, F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False)))
