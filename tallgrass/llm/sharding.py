"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

A uniform permutation of all rows puts a hypergeometric number of each source partition's rows into each
target block. Those counts are drawn exactly first, down a binary tree over the partitions whose every node
has its own seed, so that any task can draw its own partition's row of the matrix again from the partition
sizes alone. Then rows are permuted within their partition and dealt out by those counts, exchanged, and
permuted again within their block. Nothing depends on timing: a task that runs again deals alike.

A shard is cut into blocks of about ``block_rows`` rows, so that no task holds a whole shard.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_dir

N_SHARDS = 24
BLOCK_ROWS = 50_000
#: A source partition is at most so many neighbouring rows of one file: the most that a task permutes at once.
PART_ROWS = 1_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn from good + bad are good. Beyond numpy's range: inversion around the mode."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n)) if n and good + bad else 0
    if not n or not good:
        return 0
    total, lo, hi = good + bad, max(0, n - bad), min(n, good)
    mean = n * good / total
    sd = (mean * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    lo, hi = max(lo, int(mean - 14 * sd - 4)), min(hi, int(mean + 14 * sd + 4))
    k = np.arange(lo, hi, dtype=np.float64)
    steps = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    p = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(p, rng.random() * p[-1], "right"))


def multivariate(rng: np.random.Generator, sizes: np.ndarray, n: int) -> np.ndarray:
    """Counts of ``n`` rows drawn without replacement from classes of the given sizes.

    numpy draws from up to a thousand million rows; more are dealt to two halves of the classes first.
    """
    if len(sizes) == 1:
        return np.array([n], np.int64)
    if sizes.sum() < 1_000_000_000:
        return rng.multivariate_hypergeometric(sizes, n, method="marginals")
    mid = len(sizes) // 2
    k = hypergeometric(rng, int(sizes[:mid].sum()), int(sizes[mid:].sum()), n)
    return np.concatenate((multivariate(rng, sizes[:mid], k), multivariate(rng, sizes[mid:], n - k)))


def targets(total: int, n_shards: int, block_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of all shards: their sizes, shards and first slots. Shard sizes differ by one row at most."""
    size, shard, first = [], [], []
    for s in range(n_shards):
        m = total // n_shards + (s < total % n_shards)
        k = max(1, -(-m // block_rows))
        b = np.array([m // k + (i < m % k) for i in range(k)], np.int64)
        size.append(b)
        shard.append(np.full(k, s))
        first.append(np.cumsum(b) - b)
    return np.concatenate(size), np.concatenate(shard), np.concatenate(first)


@lru_cache(maxsize=8)
def _row(ends: bytes, part: int, n_shards: int, block_rows: int, seed: int) -> np.ndarray:
    """The matrix row of one source partition; ``ends``: running row counts of the partitions."""
    e = np.frombuffer(ends, np.int64)
    counts = targets(int(e[-1]), n_shards, block_rows)[0]
    lo, hi = 0, len(e)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        start = int(e[lo - 1]) if lo else 0
        left = multivariate(np.random.default_rng([seed, lo, hi]), counts, int(e[mid - 1]) - start)
        counts, lo, hi = (left, lo, mid) if part < mid else (counts - left, mid, hi)
    return counts


def shard_table(spark: SparkSession, path: str, n_shards: int = N_SHARDS, seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns of the Parquet table at ``path`` plus ``shard`` (int) and ``slot`` (long).

    Shard sizes differ by one row at most; slots are gapless from 0 in each shard; every order of all rows is
    as likely as any other, over the seeds. A row's source partition is its place of PART_ROWS rows in its file.
    Defined results: an empty table gives no rows; null values, repeated rows and texts of any length move like
    any other row, as the draw looks at positions only; columns called shard or slot are replaced, all others stay as they are.
    What the driver holds and sends out is each file's path and row count, and 8 bytes a source partition.
    """
    rows = spark.read.parquet(path)
    rows = rows.drop("shard", "slot")
    files = rows.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).toPandas().sort_values("f")
    if files.empty:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    parts = -(-files.n.to_numpy(np.int64) // PART_ROWS)
    index = spark.sparkContext.broadcast(dict(zip(files.f, np.cumsum(parts) - parts, strict=True)))
    sizes = np.concatenate([np.diff(np.append(np.arange(0, n, PART_ROWS), n)) for n in files.n])
    ends = spark.sparkContext.broadcast(np.cumsum(sizes).tobytes())

    @F.pandas_udf("part long, block int")
    def dealt_to(file: pd.Series, at: pd.Series) -> pd.DataFrame:
        at = at.to_numpy(np.int64)
        part = file.map(index.value).to_numpy(np.int64) + at // PART_ROWS
        out = np.zeros(len(at), np.int32)
        for k in np.unique(part):
            mine = part == k
            out[mine] = _dealt(ends.value, int(k), n_shards, block_rows, seed)[at[mine] % PART_ROWS]
        return pd.DataFrame({"part": part, "block": out})

    size, shard, first = targets(int(files.n.sum()), n_shards, block_rows)
    blocks = spark.createDataFrame(pd.DataFrame({"block": np.arange(len(size), dtype=np.int32), "shard": shard.astype(np.int32), "first": first}))
    dealt = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"),
        dealt_to(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("to"),
        F.col("_metadata.row_index").alias("at"),
    ).select("row", "at", "to.part", "to.block")
    # the second permutation goes by a hash of the place, ties by the place itself
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "part", "at", F.lit("second")), "part", "at")
    # as many tasks as blocks: what a task holds does not grow with the table
    placed = dealt.repartition(len(size), "block").withColumn("n", F.row_number().over(order))
    return placed.join(blocks, "block").select("row.*", "shard", (F.col("first") + F.col("n") - 1).alias("slot"))


@lru_cache(maxsize=2)
def _dealt(ends: bytes, part: int, n_shards: int, block_rows: int, seed: int) -> np.ndarray:
    """The block of each row of one source partition: its matrix row, spelled out and permuted locally."""
    counts = _row(ends, part, n_shards, block_rows, seed)
    return np.random.default_rng([seed, part, 2**31]).permutation(np.repeat(np.arange(len(counts), dtype=np.int32), counts))


def shard_rows(df: DataFrame, n_shards: int = N_SHARDS, seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``shard_table`` for any DataFrame: it is written to the shared folder first, so that its partitions stay fixed."""
    import uuid

    path = f"{shared_dir(df.sparkSession)}/shuffle-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return shard_table(df.sparkSession, path, n_shards, seed, block_rows)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query: where each document goes, under the law ``rows``."""
    out = shard_table(spark, f"{sf_dir}/documents.parquet")
    text = F.col("text")
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
