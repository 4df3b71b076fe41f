"""Language identification with a blended-spectrum string kernel.

The kernel of two texts blends n-gram presence kernels, n = 1 to 3 (bytes of the lower-cased UTF-8):
``k(x, z) = mean over n of |P_n(x) and P_n(z)| / sqrt(|P_n(x)| |P_n(z)|)`` with P_n(x) the set of x's n-grams. Only
those of the landmark texts have a column; the others of a text count in its norm. Nyström: kernel values against the landmarks, whitened by their own kernel
matrix, are the features of a one-versus-rest ridge regression. Scoring a batch is one product of its
presence matrix with the landmarks' per n, and one with the regression weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_type_names, modest, pieces

UNKNOWN = "und"
#: Bounds of the training sample: texts a language, landmarks a language. Training and scoring read whole texts.
SAMPLE_PER_LANG, LANDMARKS_PER_LANG = 1000, 24
SIZES = (1, 2, 3)
RIDGE = 1e-3
ROWS = 128


@dataclass
class Model:
    langs: list[str]
    slots: list[np.ndarray]  # per n: n-gram code -> column, -1 for none
    marks: list[np.ndarray]  # per n: columns x landmarks, scaled by the landmarks' norms
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray


def codes(raw: np.ndarray, n: int) -> np.ndarray:
    """The n-gram codes of a byte string."""
    out = raw.astype(np.int32)
    for i in range(1, n):
        out = (out[:-1] << 8) | raw[i:]
    return out


def presence(slots: np.ndarray, width: int, n: int, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows x n-grams: 1 where a row has the n-gram; and how many distinct n-grams without a column each row has."""
    m = np.zeros((len(offs) - 1, width), np.float32)
    if len(raw) < n:
        return m, np.zeros(len(m), np.int64)
    code = codes(raw, n)
    col = slots[code]
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(col)]
    inside = np.arange(len(col)) + n <= offs[1:][row]
    ok = (col >= 0) & inside
    m[row[ok], col[ok]] = 1
    other = (col < 0) & inside
    return m, np.bincount(np.unique(row[other] << 24 | code[other]) >> 24, minlength=len(m))


def grams(raw: np.ndarray) -> list[np.ndarray]:
    """The distinct n-gram codes of a text, per n: all that the kernel sees of it."""
    return [np.unique(codes(raw, n)) if len(raw) >= n else np.zeros(0, np.int32) for n in SIZES]


def presence_of(slots: np.ndarray, width: int, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``presence`` of rows given as sets of codes."""
    m, others = np.zeros((len(sets), width), np.float32), np.zeros(len(sets), np.int64)
    for i, s in enumerate(sets):
        col = slots[s]
        m[i, col[col >= 0]] = 1
        others[i] = (col < 0).sum()
    return m, others


def blended(model: Model, presences: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Kernel values against all landmarks of rows with these presence matrices and counts of other n-grams, one pair per n."""
    out = 0.0
    for (p, others), marks in zip(presences, model.marks, strict=True):
        out = out + (p @ marks) / np.sqrt(np.maximum(p.sum(axis=1) + others, 1))[:, None].astype(np.float32)
    return out / len(presences)


def kernel(model: Model, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Kernel values of rows against all landmarks."""
    if not model.slots:
        return np.zeros((len(offs) - 1, 0), np.float32)
    return blended(model, [presence(s, len(m), n, raw, offs) for n, s, m in zip(SIZES, model.slots, model.marks, strict=True)])


def scores(model: Model, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows x languages: the regressions' values, as shares that sum to 1."""
    out = []
    for lo in range(0, len(offs) - 1, ROWS):
        o = offs[lo : lo + ROWS + 1]
        out.append(kernel(model, raw[o[0] : o[-1]], o - o[0]) @ model.weights + model.bias)
    z = np.exp(np.clip(np.concatenate(out), -1, 2) * 8) if out else np.zeros((0, len(model.langs)))
    return z / np.maximum(z.sum(axis=1, keepdims=True), 1e-12)


def fit(texts: list[bytes], langs: list[str]) -> Model:
    """Learn from lower-cased texts and their languages."""
    return fit_sets([grams(np.frombuffer(t, np.uint8)) for t in texts], langs)


def fit_sets(texts: list[list[np.ndarray]], langs: list[str]) -> Model:
    """Learn from the ``grams`` of texts and their languages."""
    names = sorted(set(langs))
    if not names:
        return Model([UNKNOWN], [], [], np.zeros((0, 1)), np.ones(1))
    y = np.array([names.index(x) for x in langs])
    marks = np.concatenate([np.flatnonzero(y == k)[:LANDMARKS_PER_LANG] for k in range(len(names))])
    slots, mats = [], []
    for j, n in enumerate(SIZES):
        known = np.unique(np.concatenate([texts[i][j] for i in marks]))
        s = np.full(256**n, -1, np.int16 if len(known) < 32_000 else np.int32)
        s[known] = np.arange(len(known))
        slots.append(s)
        p, _ = presence_of(s, len(known), [texts[i][j] for i in marks])
        mats.append(np.ascontiguousarray((p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))).T))
    model = Model(names, slots, mats, np.zeros((len(marks), len(names))), np.zeros(len(names)))
    k = []
    for lo in range(0, len(texts), ROWS):
        part = texts[lo : lo + ROWS]
        k.append(blended(model, [presence_of(s, len(m), [t[j] for t in part]) for j, (s, m) in enumerate(zip(slots, mats, strict=True))]))
    c = np.concatenate(k).astype(np.float64)
    w, v = np.linalg.eigh(c[marks])
    keep = w > 1e-6 * w.max()
    white = v[:, keep] / np.sqrt(w[keep])
    f = c @ white
    mean, target = f.mean(axis=0), np.eye(len(names))[y]
    g = f - mean
    beta = np.linalg.solve(g.T @ g + RIDGE * len(f) * np.eye(g.shape[1]), g.T @ (target - target.mean(axis=0)))
    model.weights = (white @ beta).astype(np.float32)
    model.bias = (target.mean(axis=0) - mean @ beta).astype(np.float32)
    return model


def train(docs: DataFrame) -> Model:
    """Fit on a bounded sample of rows (text, lang) with known language: the SAMPLE_PER_LANG texts of each language
    with the smallest text hash. Whole texts count; only their sets of n-grams reach the driver, at most 16.8 million numbers a text, of any
    length. Repeated rows count once; without a labelled text the model knows no language."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("h"))
    best = Window.partitionBy("lang").orderBy("h")
    least = known.select("lang", "h").distinct().withColumn("k", F.row_number().over(best)).filter(F.col("k") <= SAMPLE_PER_LANG)
    bounds = least.groupBy("lang").agg(F.max("h").alias("top")).collect()
    if not bounds:
        return fit([], [])
    top = F.coalesce(*(F.when(F.col("lang") == r.lang, F.lit(r.top)) for r in bounds))
    columns = [f"g{n}" for n in SIZES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, offs in pieces(batches, "t"):
            sets = [grams(raw[lo:hi]) for lo, hi in zip(offs[:-1], offs[1:], strict=True)]
            cols = [pa.array([s[j].astype(np.int32).tobytes() for s in sets], pa.binary()) for j in range(len(SIZES))]
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("h"), *cols], ["lang", "h", *columns])

    picked = known.filter(F.col("h") <= top).select("lang", "h", F.lower("text").alias("t"))
    sets = picked.mapInArrow(run, "lang string, h long, " + ", ".join(f"{c} binary" for c in columns))
    got = sets.groupBy("lang", "h").agg(F.min(F.struct(*columns)).alias("g")).select("lang", "h", "g.*").toPandas().sort_values(["h", "lang"])
    return fit_sets([[np.frombuffer(x, np.int32) for x in row] for row in zip(*(got[c] for c in columns), strict=True)], list(got.lang))


def predict(df: DataFrame, model: Model) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1); only ``text`` is looked at, all of it.

    Null texts and texts without a letter are ``und`` with score 0. Equal texts get equal results, and an empty table gives no
    rows. Columns with the output names are replaced.
    """
    df = df.drop("lang_pred", "score")
    names = df.columns
    lowered = "_t" + "_" * max(map(len, names))  # no column's name
    asked = df.withColumn(lowered, F.when(F.col("text").rlike(r"\p{L}"), F.lower("text")))
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema = arrow_type_names(df) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b, raw, offs in pieces(batches, lowered):
            p = scores(m, raw, offs)
            best, none = p.argmax(axis=1), np.asarray(b.column(lowered).is_null())
            lang = [UNKNOWN if z else m.langs[i] for z, i in zip(none, best, strict=True)]
            score = np.where(none, 0.0, p[np.arange(len(best)), best]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    return asked.mapInArrow(run, schema)


def held_out():
    """Rows that the contract keeps out of training: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    modest(spark)
    model = train(docs.filter(~held_out()).select("text", "lang"))
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")
