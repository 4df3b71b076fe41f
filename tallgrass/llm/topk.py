"""Exact top-k inner products with Fagin's threshold algorithm.

Vectors stand in blocks of bounded size; of each block every dimension has its rows sorted by value. A query walks
its dimensions' lists from their best end (the top for a positive weight, the bottom for a negative one), scores
each row when it first shows, and stops in a block once no unseen row can reach its kth best score: an unseen row
scores at most the sum of the weights times the values reached. Query blocks meet the first vector block alone; the kth
score found there is a query's floor in all other blocks, where it stops earlier and leaves only rows that reach
the floor, k at most. The best k of all are the result.

Queries whose walk a floor cannot end before most of a block has shown are taken together: all rows of the block get
their scores in one product. A task holds the lists of a group of vector blocks and reads the query blocks; both sides
are dealt to the tasks by number. They are not joined: a join's side that repeats each query block for every group could
be taken for small, by the size of its files, and be broadcast through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import BROADCAST_ROWS, staged, swept_query

K, EVERY, SCALE = 20, 20, 64
BLOCK, QUERIES = 8192, 512
STEP = 32
#: A task holds at most so many vector blocks of 64 dimensions (fewer of more dimensions), and reads at most so many query blocks.
GROUP, PART = 16, 512
#: The floor of a query that has none yet.
NONE = -(2**63)


def exact(most: float) -> type:
    """The narrowest type in which sums of products of whole numbers are exact if none passes ``most``; beyond floats, Python's numbers."""
    return np.float32 if most < 2.0**24 else np.float64 if most < 2.0**52 else object


def whole(x: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers as ``kind``."""
    if kind is not object:
        return x.astype(kind, copy=False)
    return x if x.dtype == object else np.array([int(y) for y in x.ravel()], object).reshape(x.shape)


class Lists:
    """The sorted lists of one block. v: rows x dimensions (whole numbers), ids: the rows' ids."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, v = ids[by], v[by]
        self.v = whole(v, exact(np.abs(v).max(initial=0) ** 2 * max(1, v.shape[1])))
        self.order = np.argsort(v, axis=0, kind="stable").T.astype(np.int32)  # dimensions x rows, ascending
        self.sorted = np.take_along_axis(v, self.order.T, axis=0).T.copy()

    def best(self, query_id: int, q: np.ndarray, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but the query's own, of those that score ``floor`` or more: higher scores first, then smaller ids."""
        n = len(self.ids)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = np.zeros(n, bool)
        most = np.abs(q).max(initial=0) * np.abs(self.sorted[:, [0, -1]]).max(initial=0) * max(1, len(q)) if n else 0
        kinds = [np.float32, np.float64, object]
        kind = max(exact(most), self.v.dtype.type if self.v.dtype != object else object, key=kinds.index)
        weights, v = whole(q, kind), whole(self.v, kind)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, kind)
        depth, step, left = 0, STEP, n
        while left:
            to = min(n, depth + step)
            new = np.zeros(n, bool)
            if len(up) + len(down):
                new[self.order[up, n - to : n - depth].ravel()] = True
                new[self.order[down, depth:to].ravel()] = True
            else:
                new[:] = True
                to = n
            new &= ~seen
            seen |= new
            got = np.flatnonzero(new)
            left -= len(got)
            # rows scattered over most of the block are read in one sweep, few ones by themselves
            score = (v @ weights)[got] if 4 * len(got) > n else v[got] @ weights
            other = self.ids[got] != query_id
            rows, scores = np.concatenate((rows, got[other])), np.concatenate((scores, score[other]))
            if len(rows) > k:
                edge = np.partition(scores, len(scores) - k)[len(scores) - k]
                good = np.flatnonzero(scores >= edge)
                keep = good[np.lexsort((rows[good], -scores[good]))[:k]]
                rows, scores = rows[keep], scores[keep]
            depth, step = to, step * 2
            least = max(floor, scores.min()) if len(rows) >= k else floor
            if least > -np.inf and left:
                reached = np.concatenate((self.sorted[up, n - depth], self.sorted[down, depth - 1]))
                bound = np.concatenate((weights[up], weights[down])) @ whole(reached, kind if kind is object else np.float64)
                if bound < least:
                    break
        keep = np.lexsort((rows, -scores))[:k]
        keep = keep[scores[keep] >= floor]
        return self.ids[rows[keep]], scores[keep].astype(np.int64)

    def opening(self, query_id: int, q: np.ndarray, k: int) -> int:
        """The kth score of the rows that the first step of a walk shows, or ``NONE``."""
        seen = np.zeros(len(self.ids), bool)
        seen[self.order[q > 0, -STEP:].ravel()] = True
        seen[self.order[q < 0, :STEP].ravel()] = True
        rows = np.flatnonzero(seen & (self.ids != query_id))
        return int(np.partition(self.v[rows].astype(np.float64) @ q, len(rows) - k)[len(rows) - k]) if len(rows) >= k else NONE

    def meet(self, asked: np.ndarray, q: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``best`` of many queries: the query's row, id and score, in no order. asked, q, floors: the queries' ids, weights and floors."""
        n, width = self.v.shape
        most = np.abs(q).max(axis=1, initial=0) * max(1.0, float(np.abs(self.sorted[:, [0, -1]]).max(initial=0))) * max(1, width)
        plain = (most < 2.0**52) & (self.v.dtype != object)
        low = floors.copy()
        for i in np.flatnonzero(plain & (low == NONE)):
            low[i] = self.opening(asked[i], q[i], k)
        walks = ~plain
        if plain.any():
            # where the lists have shown at most a quarter of the rows
            depth = max(1, n // (4 * max(1, width)))
            bound = np.maximum(q[plain], 0) @ self.sorted[:, n - depth].astype(np.float64) + np.minimum(q[plain], 0) @ self.sorted[:, depth - 1].astype(np.float64)
            walks[plain] = bound < low[plain]
        out = []
        for i in np.flatnonzero(walks):
            ids, scores = self.best(asked[i], q[i], k, -np.inf if low[i] == NONE else int(low[i]))
            out.append((np.full(len(ids), i), ids, scores))
        rest = np.flatnonzero(~walks)
        if len(rest):
            i, ids, scores = self.swept(asked[rest], whole(q[rest], exact(most[rest].max())), low[rest], k)
            out.append((rest[i], ids, scores))
        return tuple(np.concatenate([o[j] for o in out]) for j in range(3))

    def swept(self, asked: np.ndarray, q: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``meet``, by the scores of all rows in the type of ``q``."""
        scores = q @ whole(self.v, q.dtype.type).T
        lo, hi = np.searchsorted(self.ids, asked, "left"), np.searchsorted(self.ids, asked, "right")
        for i in np.flatnonzero(hi > lo):
            scores[i, lo[i] : hi[i]] = -np.inf
        # a floor that this type rounds is beyond all scores here
        least = np.where(low == NONE, np.finfo(q.dtype).min, low).astype(q.dtype)
        hit = scores >= least[:, None]
        many = np.flatnonzero(hit.sum(axis=1) > k)
        if len(many):
            least[many] = np.partition(scores[many], len(self.ids) - k, axis=1)[:, len(self.ids) - k]
            hit[many] = scores[many] >= least[many, None]
        i, row = np.nonzero(hit)
        found = scores[i, row]
        # of the rows with just the kth score, those with the smallest ids
        tie = found == least[i]
        before = np.concatenate(([0], np.cumsum(tie)))
        nth = before[1:] - before[np.searchsorted(i, np.arange(len(asked)))][i]
        keep = ~tie | (nth <= (k - np.bincount(i[~tie], minlength=len(asked)))[i])
        return i[keep], self.ids[row[keep]], found[keep].astype(np.int64)


def top(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of each query among what blocks gave; ``floors`` are raised to the kth."""
    i, ids, scores = (np.concatenate([f[j] for f in found]) for j in range(3))
    by = np.lexsort((ids, ~scores, i))
    i, ids, scores = i[by], ids[by], scores[by]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    last = nth == k - 1
    floors[i[last]] = np.maximum(floors[i[last]], scores[last])
    return i[nth < k], ids[nth < k], scores[nth < k]


#: The types that a block's numbers are sent in, narrowest first.
KINDS = ("int8", "int16", "int32", "float64")


def packed(df: DataFrame, size: int, tasks: int) -> DataFrame:
    """Rows (id, v: array of whole doubles, floor) as blocks (n: 0, 1, ..., ids, vectors, width, kind, floors) of at most ``size`` rows, made by at most ``tasks`` tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list[np.ndarray] = []
        floors: list[int] = []
        task, made = TaskContext.get().partitionId(), count()

        def block() -> pa.RecordBatch:
            width = max(map(len, rows))
            m = np.zeros((len(rows), width))
            for i, r in enumerate(rows):
                m[i, : len(r)] = r
            kind = next(k for k in KINDS if k == KINDS[-1] or np.abs(m).max(initial=0) < np.iinfo(k).max)
            blobs = (np.array(ids, np.int64), m.astype(kind), np.array(floors, np.int64))
            cols = [pa.array([x.tobytes()]) for x in blobs]
            cols = [pa.array([task]), pa.array([next(made)]), *cols[:2], pa.array([width], pa.int32()), pa.array([kind]), cols[2]]
            return pa.RecordBatch.from_arrays(cols, ["task", "r", "ids", "vectors", "width", "kind", "floors"])

        for b in batches:
            v = b.column("v")
            values, at = np.asarray(v.flatten()), np.concatenate(([0], np.cumsum(np.asarray(v.value_lengths()))))
            for i, (k, f) in enumerate(zip(b.column("id").to_pylist(), b.column("floor").to_pylist(), strict=True)):
                ids.append(k)
                floors.append(f)
                rows.append(values[at[i] : at[i + 1]])
                if len(rows) == size:
                    yield block()
                    ids, rows, floors = [], [], []
        if rows:
            yield block()

    blocks = staged(df.coalesce(tasks).mapInArrow(run, "task long, r long, ids binary, vectors binary, width int, kind string, floors binary"), "blocks")
    first = blocks.groupBy("task").agg(F.count("*").alias("c"))
    first = first.select("task", (F.sum("c").over(Window.orderBy("task")) - F.col("c")).alias("first"))
    # a row for each task; the blocks themselves never go through the driver
    blocks, first = (blocks, F.broadcast(first)) if tasks <= BROADCAST_ROWS else (blocks.hint("merge"), first)
    return blocks.join(first, "task").select((F.col("first") + F.col("r")).alias("n"), "ids", "vectors", "width", "kind", "floors")


def matrix(blob: bytes, kind: str, rows: int, width: int, filled: int) -> np.ndarray:
    """A block's vectors as doubles, filled up with zeros to ``filled`` columns."""
    return np.pad(np.frombuffer(blob, kind).astype(np.float64).reshape(rows, width), ((0, 0), (0, filled - width)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best vectors by inner product, itself left out.

    Both tables are (id: long, v: array of whole doubles); shorter vectors count as filled up with zeros. Rows that share
    an id are candidates each, and as queries ranked together; none of them meets its own id. Fewer than k candidates
    give fewer rows; ties go to the smaller id.
    """
    spark = vectors.sparkSession
    n, n_queries = vectors.count(), queries.count()
    none = F.lit(NONE).cast("long").alias("floor")
    blocks = staged(packed(vectors.select("id", "v", none), BLOCK, max(1, -(-n // BLOCK))).drop("floors"), "vectors")  # full blocks, however small the input's partitions
    n_blocks, width = blocks.agg(F.count("*"), F.max("width")).first()
    if not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    tasks = 2 * spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, lists, wide = None, [], [], None
        for b in batches:
            for at in range(b.num_rows):
                r = {x: b.column(x)[at].as_py() for x in b.schema.names}
                if r["cell"] != cell:
                    cell, held, wide = r["cell"], [], None
                if not r["asks"]:
                    held.append(r)
                    continue
                w = max(r["width"], *(h["width"] for h in held))
                if w != wide:
                    each = ((np.frombuffer(h["ids"], np.int64), h) for h in held)
                    lists, wide = [Lists(ids, matrix(h["vectors"], h["kind"], len(ids), h["width"], w)) for ids, h in each], w
                asked, floors = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["floors"], np.int64).copy()
                q = matrix(r["vectors"], r["kind"], len(asked), r["width"], w)
                found = [(np.zeros(0, np.int64),) * 3]
                for block in lists:
                    found = [top([*found, block.meet(asked, q, floors, k)], floors, k)]
                i, ids, scores = found[0]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (asked[i], ids, scores)], ["query_id", "vec_id", "score"])

    def met(asked: DataFrame, first: int, last: int) -> DataFrame:
        """Rows of ``asked`` (id, floor, v) against the blocks ``first`` to ``last``."""
        each = max(1, min(GROUP, GROUP * 64 // max(width, 1), (last - first + 1) // tasks))
        groups = -(-(last - first + 1) // each)
        sent = -(-n_queries // QUERIES)
        parts = max(1, -(-sent // PART), min(sent, tasks // groups))
        shared = ("ids", "vectors", "width", "kind")
        mine = blocks.filter(F.col("n").between(first, last)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        mine = mine.select((F.floor((F.col("n") - first) / each) * parts + F.col("part")).cast("int").alias("cell"), F.lit(False).alias("asks"), *shared, F.lit(None).cast("binary").alias("floors"))
        theirs = packed(asked.select("id", "v", "floor"), QUERIES, max(1, -(-n_queries // (4 * QUERIES))))
        theirs = theirs.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        theirs = theirs.select((F.col("group") * parts + F.col("n") % parts).cast("int").alias("cell"), F.lit(True).alias("asks"), *shared, "floors")
        dealt = mine.unionByName(theirs).repartitionById(groups * parts, "cell").sortWithinPartitions("cell", "asks")
        return dealt.mapInArrow(run, "query_id long, vec_id long, score long")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = met(queries.select("id", "v", none), 0, 0)
    if n_blocks > 1:
        found = staged(found, "first")
        floors = ranked(found).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        asked = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE).cast("long")))
        found = found.unionByName(met(asked, 1, n_blocks - 1))
    return ranked(found)


def quantised(df: DataFrame, id_col: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v): floor(scale * x) of each component as a double. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part; all other rows do, whether or not they share an id."""
    finite = F.forall(F.col(column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = df.filter(F.col(id_col).isNotNull() & F.col(column).isNotNull()).filter(finite)
    # doubles of 2**52 or more are whole, and may be beyond the longs that floor() gives
    floored = F.transform(F.col(column).cast(T.ArrayType(T.DoubleType())), lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return ok.select(F.col(id_col).cast("long").alias("id"), floored.alias("v"))


@swept_query
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.filter(F.col("id") % EVERY == 0))


#: DuckDB SQL for the contract query.
OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, cast(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, cast(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
