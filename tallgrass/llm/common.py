"""What the training-data operators share: staged tables and vectorised text primitives."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64
BATCH_BYTES = 1_000_000
ROWS = 1000

# ---------------------------------------------------------------- staged tables


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where unset, an own one if the master is local, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tallgrass-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def modest(spark: SparkSession) -> None:
    """Hand Python at most ROWS rows at a time, unless the session asks for a number of its own: texts can be long."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries made and run in here delete their shuffle files when they end, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    if was is None:
        yield
        return
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)


_scopes: list[list[str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. Within ``swept`` it is deleted at the end."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def swept(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete what is staged in here at the end. The function that it gives stages a table that outlives it."""
    mine: list[str] = []
    _scopes.append(mine)

    def kept(df: DataFrame) -> DataFrame:
        out = staged(df, "result")
        mine.remove(out.staged_at)
        if len(_scopes) > 1:
            _scopes[-2].append(out.staged_at)
        return out

    try:
        yield kept
    finally:
        _scopes.remove(mine)
        for path in mine:
            deleted(spark, path)


def swept_query(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query whose result is stored, and whose other staged tables are deleted."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with swept(spark) as kept:
            return kept(query(spark, sf_dir))

    return run


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here, any executor may be lost."""
    spark = df.sparkSession
    modest(spark)
    path = shared_path(spark, name)
    with tidy(spark):
        df.select("*").write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete what ``staged`` wrote; nothing may read these tables any more."""
    for df in tables:
        deleted(df.sparkSession, df.staged_at)


#: Tables of at most so many rows and bytes are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32_000_000


def width_of(kind: T.DataType, col: Column) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.greatest(F.size(col), F.lit(0)) * 32 + 16
    return F.lit(16)


def small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if a count of its rows and bytes shows that it is small."""
    each = sum((width_of(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields), F.lit(16))
    with tidy(df.sparkSession):
        n, size = df.select(each.alias("b")).limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.sum("b")).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def trimmed() -> None:
    """Give a Python worker's free memory back: workers stay, and the next task may be another operator's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def text_key(text: Column) -> Column:
    """Hash of a text. With doc_id it names a row; equal rows share it and share every result."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


# ---------------------------------------------------------------- vectorised text


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string or binary array; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
        kind = np.int32
    else:
        kind = np.int64
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, off, data = col.buffers()
    offs = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES, rows: int = 10 * ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches that hold about ``limit`` bytes of ``column`` (one row at least, ``rows`` at most), with its buffers."""
    for b in batches:
        raw, offs = buffers(b.column(column))
        lo = 0
        while lo < b.num_rows:
            hi = min(lo + rows, max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1))
            yield b.slice(lo, hi - lo), raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            lo = hi
    trimmed()


def byte_table(delimiters: bytes) -> np.ndarray:
    """Byte -> lower-cased byte (A-Z only); 0 for a delimiter. Byte 0 maps to 1 where it is no delimiter."""
    t = np.arange(256, dtype=np.int64)
    t[65:91] += 32
    t[0] = 256
    t[list(delimiters)] = 0
    return t.astype(np.int16)


SPACES = byte_table(b" \t\n\v\f\r")

_BASE, _INV = U64(0x9E3779B97F4A7C15), U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}
_values = np.random.default_rng(7).integers(1, 1 << 63, 257, np.uint64) * U64(2) + U64(1)
_values[0] = 0


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64."""
    if len(_powers["up"]) <= n:
        for k, x in (("up", _BASE), ("down", _INV)):
            a = np.full(max(n + 1, 1 << 16), x, U64)
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every bit of a 64-bit hash."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def prefix_hash(b: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span. b: values 0 to 256."""
    s = np.zeros(len(b) + 1, U64)
    np.cumsum(_values[b] * powers(len(b))[0][: len(b)], out=s[1:])
    return s


def span_hash(s: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Position-independent hash of each span [lo, hi)."""
    return mix((s[hi] - s[lo]) * powers(len(s))[1][lo] + (hi - lo).astype(U64))


def word_spans(raw: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, the spans [lo, hi) of all words in text order, and where each row's words begin and end among them."""
    if not len(raw):
        return np.zeros(0, np.int16), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    b = table[raw]
    inside = b != 0
    first = np.zeros(len(raw) + 1, bool)
    first[offs] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    lo, hi = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return b, lo, hi, np.searchsorted(lo, offs)


def word_hashes(raw: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in text order, and where each row's words begin and end among them."""
    b, lo, hi, at = word_spans(raw, offs, table)
    return span_hash(prefix_hash(b), lo, hi), at


def words_at(b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """The words at spans of ``word_spans``' bytes, as strings."""
    size = hi - lo
    ends = np.cumsum(size)
    at = np.repeat(lo - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
    data = pa.py_buffer(b[at].astype(np.uint8).tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(lo), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64).tobytes()), data])


def arrow_type_names(df: DataFrame) -> str:
    """The schema of ``df`` as DDL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

