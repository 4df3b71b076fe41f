"""Quality classifier: ordinal cumulative-link regression on graded ratings.

``P(grade > k | x) = sigmoid(w . x - t_k)`` with one weight vector over hashed words, shared by all grades, and
thresholds t_0 < t_1 < ... kept in order by construction. x marks which hashed words a text has (all of the text).
From the link come a text's expected grade and the probability of its tail, on which rows are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, arrow_type_names, modest, pieces, text_key, word_hashes

BITS = 18
#: Bound of the training sample: rated rows a grade.
SAMPLE_PER_GRADE = 3000
#: The sample is chosen from each of so many parts of a grade first.
PARTS = 64
STEPS, SPARSE = 300, 3e-5


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, z: np.ndarray) -> np.ndarray:
        """Rows x thresholds: P(grade > k)."""
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds, -40, 40)))


def features(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed word, once for each word that a row has."""
    h, at = word_hashes(raw, offs, SPACES)
    row = np.repeat(np.arange(len(offs) - 1, dtype=np.uint64), np.diff(at))
    key = np.unique(row << np.uint64(BITS) | h & np.uint64((1 << BITS) - 1))
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)


def scaled(n: np.ndarray) -> np.ndarray:
    """Weight of each word of a text with ``n`` distinct ones."""
    return 1 / np.sqrt(np.maximum(n, 1))


def fit(rows: list[np.ndarray], grades: np.ndarray, shares: np.ndarray) -> Model:
    """Maximum likelihood with a penalty SPARSE on absolute weights, which rare words do not overcome, by accelerated
    proximal gradient steps of the length that the data's curvature allows.

    rows: each text's hashed words. shares: of each grade among all ratings; the sample counts in that proportion.
    """
    k, n = len(shares), len(rows)
    if not n or k < 2:
        return Model(np.zeros(1 << BITS), np.arange(max(1, k - 1), dtype=float))
    sizes = np.array([len(r) for r in rows])
    col, row = np.concatenate(rows), np.repeat(np.arange(n), sizes)
    val = scaled(sizes)[row]
    y = grades[:, None] > np.arange(k - 1)
    weight = (shares[grades] / np.maximum(np.bincount(grades, minlength=k)[grades], 1))[:, None]

    def back(d: np.ndarray) -> np.ndarray:
        return np.bincount(col, d[row] * val, 1 << BITS)

    u = np.ones(n)
    for _ in range(20):  # the largest curvature, by power iteration
        u = np.bincount(row, back(u * weight[:, 0])[col] * val, n)
        top = float(np.linalg.norm(u)) or 1.0
        u /= top
    step = 1 / (0.25 * (k - 1) * top)
    w = ahead = np.zeros(1 << BITS)
    t = ahead_t = np.arange(k - 1) - 1.0
    for i in range(1, STEPS + 1):
        z = np.bincount(row, ahead[col] * val, n)
        d = (1 / (1 + np.exp(-np.clip(z[:, None] - ahead_t, -40, 40))) - y) * weight
        new = ahead - step * back(d.sum(axis=1))
        new = np.sign(new) * np.maximum(np.abs(new) - step * SPARSE, 0)
        new_t = np.maximum.accumulate(ahead_t + min(step, 2.0) * d.sum(axis=0)) + 1e-6 * np.arange(k - 1)
        ahead, ahead_t = new + i / (i + 3) * (new - w), new_t + i / (i + 3) * (new_t - t)
        w, t = new, new_t
    return Model(w, t)


def train(docs: DataFrame, ratings: DataFrame, n_grades: int) -> Model:
    """Fit on ``docs`` (doc_id, text) with ``ratings`` (doc_id, grade 0 to n_grades - 1; of several the least counts; of several texts the one with the least hash).

    The sample is bounded: the SAMPLE_PER_GRADE rated ids of each grade with the smallest hash. Null ids and null grades take no part;
    repeated rows count once; null and empty texts teach the thresholds alone; texts of any length count whole, as the set of their hashed
    words. Without ratings, or without documents, the model has no weights, and thresholds 0, 1, ...
    """
    rated = ratings.filter(F.col("grade").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("grade").alias("grade"))
    counts = {r.grade: r.n for r in rated.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    shares = np.array([counts.get(g, 0) for g in range(n_grades)], float) / max(1, sum(counts.values()))
    # a grade may have any share of the rows: the least of each part first, then the least of those
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    parts = rated.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS)))
    least = parts.withColumn("k", F.row_number().over(Window.partitionBy("grade", "part").orderBy(*order))).filter(F.col("k") <= SAMPLE_PER_GRADE)
    few = least.withColumn("k", F.row_number().over(Window.partitionBy("grade").orderBy(*order))).filter(F.col("k") <= SAMPLE_PER_GRADE).select("doc_id", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, offs in pieces(batches, "text"):
            row, col = features(raw, offs)
            at = np.searchsorted(row, np.arange(len(offs)))
            words = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(col.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), b.column("grade"), words], ["doc_id", "h", "grade", "words"])

    picked = docs.select("doc_id", text_key(F.col("text")).alias("h"), "text").join(F.broadcast(few), "doc_id")  # at most SAMPLE_PER_GRADE rows a grade
    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = picked.mapInArrow(run, f"doc_id {kind}, h long, grade int, words array<int>").groupBy("doc_id").agg(F.min(F.struct("h", "grade", "words")).alias("m"))
    got = sets.select("doc_id", "m.*").orderBy("doc_id").toArrow()
    return fit([np.asarray(x) for x in got.column("words").to_pylist()], np.asarray(got.column("grade"), dtype=np.int64), shares)


def rate(df: DataFrame, model: Model, least: int) -> DataFrame:
    """``df`` with ``expected_grade``, ``tail_prob``, the probability of grade ``least`` or better, and ``lowest_prob``, that of grade 0.

    Null and empty texts have no words: their grade follows from the thresholds alone. Columns with the output
    names are replaced. Equal texts get equal ratings, texts of any length count whole, an empty table gives no rows.
    """
    df = df.drop("expected_grade", "tail_prob", "lowest_prob")
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b, raw, offs in pieces(batches, "text"):
            row, col = features(raw, offs)
            z = np.bincount(row, m.weights[col], len(offs) - 1) * scaled(np.bincount(row, minlength=len(offs) - 1))
            p = m.tails(z)
            made = [pa.array(p.sum(axis=1)), pa.array(p[:, least - 1]), pa.array(1 - p[:, 0])]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, "expected_grade", "tail_prob", "lowest_prob"])

    return df.mapInArrow(run, arrow_type_names(df) + ", expected_grade double, tail_prob double, lowest_prob double")


def grades(labels: DataFrame) -> DataFrame:
    """Ratings of ``labels``: 0 toxic, 1 of low quality, 2 good."""
    toxic, good = F.coalesce(F.col("toxic"), F.lit(0)) == 1, F.col("quality") == 1
    return labels.select("doc_id", F.when(toxic, 0).when(good, 2).when(F.col("quality").isNotNull(), 1).alias("grade"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade, probability of the best grade, of being toxic, and whether it is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    modest(spark)
    model = train(docs, grades(spark.read.parquet(f"{sf_dir}/labels.parquet")), 3)
    out = rate(docs, model, 2)
    return out.select("doc_id", "expected_grade", "tail_prob", F.col("lowest_prob").alias("toxic_prob"), (F.col("tail_prob") >= 0.5).alias("keep"))
