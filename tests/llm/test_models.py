"""Learned operators: held-out accuracy, normalisation, and awkward inputs."""

import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallgrass.llm import katz, langid, quality

SF = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"


def test_language(spark):
    out = langid.op4_language_id(spark, SF).toPandas()
    d = pd.read_parquet(f"{SF}/documents.parquet")
    m = out.merge(d, on="doc_id")
    assert (m.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in m.doc_id]).all()
    assert (m[m.held_out].lang_pred == m[m.held_out].lang).mean() > 0.98
    assert m.score.between(0, 1).all()


def test_language_of_awkward_texts(spark, docs, none):
    d = spark.createDataFrame([("the cat and the dog are here with that", "en"), ("der Hund und die Katze sind nicht hier", "de"), ("x", None)], "text string, lang string")
    model = langid.train(d)
    got = {r.doc_id: r for r in langid.predict(docs.withColumn("score", F.lit("s")), model).collect()}
    assert got[5].lang_pred == got[6].lang_pred == got[13].lang_pred == "und" and got[5].score == 0.0
    assert got[1].lang_pred == "en" and got[20].lang_pred == "de"
    assert langid.predict(none, model).count() == 0
    nothing = langid.train(d.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_language_learns_from_whole_texts(spark):
    """A text that opens in another language teaches what follows as well."""
    head = "zq " * 9000
    d = spark.createDataFrame([(head + "the cat and the dog are here with that", "en"), (head + "der Hund und die Katze sind nicht hier", "de")], "text string, lang string")
    asked = spark.createDataFrame([(1, "the dog and that cat"), (2, "die Katze und der Hund nicht")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(asked, langid.train(d)).collect()}
    assert got == {1: "en", 2: "de"}


def test_language_stage_rejects_junk(spark):
    """Junk with letters does not pass the pipeline's first stage; nearly all labelled texts do."""
    import random

    import corpus_pipeline

    r = random.Random(1)
    kinds = ["abcdefghijklmnopqrstuvwxyz    ", "0123456789abcdef", "{}[]();=+-*<>_xyzij0123456789  "]
    junk = [(-1 - i, "".join(r.choice(kinds[i % 3]) for _ in range(1500)), None) for i in range(60)]
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text", "lang").filter("doc_id >= 0")
    out = corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(junk, "doc_id long, text string, lang string")), LARGER)
    kept = [x.doc_id for x in out.select("doc_id").collect()]
    assert sum(i < 0 for i in kept) <= 1 and sum(i >= 0 for i in kept) > 0.99 * docs.count()


def test_kernel_is_positive():
    texts = [b"der hund lief", b"the cat sat", b"le chat noir"]  # in the order of their languages' names
    m = langid.fit(texts, ["de", "en", "fr"])
    k = langid.kernel(m, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    assert np.allclose(k, k.T, atol=1e-5) and np.allclose(np.diag(k), 1, atol=1e-5) and np.linalg.eigvalsh(k).min() > -1e-5


def test_kernel_is_the_stated_one():
    """Against the formula over plain sets, for texts that share only some n-grams with the landmarks, or none."""
    marks = [b"der hund lief nach haus", b"the cat sat on a mat", b"le chat noir"]
    m = langid.fit(marks, ["de", "en", "fr"])
    asked = [b"the dog sat", b"", b"xx", b"a", "zoë ğ".encode(), b"lief lief lief noir", bytes(range(1, 255))]
    k = langid.kernel(m, np.frombuffer(b"".join(asked), np.uint8), np.cumsum([0, *map(len, asked)]))
    grams = lambda t, n: {t[i : i + n] for i in range(len(t) - n + 1)}
    want = [[sum(len(grams(x, n) & grams(z, n)) / math.sqrt(max(1, len(grams(x, n)) * len(grams(z, n)))) for n in (1, 2, 3)) / 3 for z in marks] for x in asked]
    assert np.allclose(k, want, atol=1e-6)


def test_quality(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    rated = quality.grades(spark.read.parquet(f"{LARGER}/labels.parquet"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = quality.train(docs, rated.filter(~fold), 3)
    assert (np.diff(model.thresholds) > 0).all()
    out = quality.rate(docs.select("doc_id", "text"), model, 2).join(rated.filter(fold), "doc_id").toPandas()
    assert ((out.expected_grade > 1.5) == (out.grade == 2)).mean() > 0.9
    toxic = out[out.grade == 0]
    assert (toxic.expected_grade < 1.5).mean() > 0.85
    assert (out[out.grade == 2].tail_prob > 0.5).mean() > 0.93


def test_quality_of_awkward_texts(docs, none):
    model = quality.fit([], np.zeros(0, np.int64), np.zeros(3))
    out = quality.rate(docs, model, 2).collect()
    assert len(out) == docs.count() and all(0 <= r.expected_grade <= 2 for r in out)
    assert quality.rate(none, model, 2).count() == 0


def test_quality_tells_toxic_from_poor(spark):
    out = quality.op2_quality(spark, LARGER).join(quality.grades(spark.read.parquet(f"{LARGER}/labels.parquet")), "doc_id").toPandas()
    assert np.allclose(out.toxic_prob, 1 - (out.expected_grade - out.tail_prob))  # P(grade > 0) + P(grade > 1) is the expected grade
    toxic, poor = (out[out.grade == g].toxic_prob for g in (0, 1))
    assert (toxic.to_numpy()[:, None] > poor.to_numpy()).mean() > 0.8


def expected_scores(rows, held):
    tok = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for _, t in rows]
    c, b, ch = Counter(), Counter(), Counter()
    for t, h in zip(tok, held):
        if not h:
            c.update(t)
            b.update(zip(["<s>", *t], t))
            ch.update(["<s>", *t[:-1]])
    n, v = sum(c.values()), len(c)

    def of(x):
        k = Counter(x.values())
        return [k[r] for r in range(1, 7)]

    d1, d2 = katz.discounts(of(c)), katz.discounts(of(b))
    cut = lambda r, d: float(katz.discounted(np.array(r), d))
    unknown = sum(r - cut(r, d1) for r in c.values()) / n
    p1 = lambda w: cut(c[w], d1) / n if c[w] else unknown
    after = defaultdict(list)
    for (h, w), r in b.items():
        after[h].append((w, r))
    alpha = {h: (1 - sum(cut(r, d2) for _, r in x) / ch[h]) / (1 - sum(p1(w) for w, _ in x)) for h, x in after.items()}
    for h in list(after)[:20]:  # exactly normalised
        seen = {w for w, _ in after[h]}
        assert abs(sum(cut(r, d2) / ch[h] for _, r in after[h]) + alpha[h] * (sum(p1(w) for w in c if w not in seen) + unknown) - 1) < 1e-9
    out = []
    for (i, _), t, h in zip(rows, tok, held):
        s = sum(math.log10(cut(b[p, w], d2) / ch[p] if b[p, w] else alpha.get(p, 1.0) * p1(w)) for p, w in zip(["<s>", *t], t))
        out.append((i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), s))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [katz.BROADCAST_WORDS, 0])
def test_katz(docs, limit):
    """With limit 0 word counts travel by joins."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = [i is not None and i % 4 == 3 for i, _ in rows]
    out = katz.scored(docs, F.coalesce(F.col("doc_id") % 4 == 3, F.lit(False)), limit)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    want = expected_scores(rows, held)
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=lambda r: (repr(r[0]), r[2], r[6])), sorted(want, key=lambda r: (repr(r[0]), r[2], r[6]))):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-6


@pytest.mark.parametrize("limit", [1, 40])
def test_katz_words_beyond_the_array(docs, limit, monkeypatch):
    """The array holds the most frequent words only; buckets are many, and each piece sends each of them one blob at most."""
    monkeypatch.setattr(katz, "BUCKET_EVENTS", 50)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = [i is not None and i % 4 == 3 for i, _ in rows]
    out = katz.scored(docs, F.coalesce(F.col("doc_id") % 4 == 3, F.lit(False)), limit)
    order = lambda r: (repr(r[0]), r[2], r[6])
    got, want = sorted(map(tuple, out.collect()), key=order), sorted(expected_scores(rows, held), key=order)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-6


def test_katz_many_buckets_cost_little():
    """A piece of 400,000 tokens over 5,000 buckets; the words' counts were gathered anew for every bucket."""
    raw, n = "".join(f"w{i * i % 70_001} " for i in range(400_000)).encode(), 400
    raw, offs = np.frombuffer(raw, np.uint8), np.linspace(0, len(raw), n + 1).astype(np.int64)
    toks, held = [katz.tokens(raw, offs)], np.arange(n) % 7 == 2
    w, c = np.unique(toks[0][1], return_counts=True)
    uni = katz.Unigrams(int(c.sum()), len(w), n, np.ones(6), 0.1)
    began = time.process_time()
    stats, *blobs = katz.piece_rows(0, held, list(toks), w[c > 8], c[c > 8], True, uni, 5000)
    assert time.process_time() - began < 5
    assert stats[0].sum() == len(toks[0][1]) and len({b[0] for b in blobs}) == len(blobs)
    assert sum(int(np.abs(katz.unpack(b[2])[4]).sum()) for b in blobs) == len(toks[0][1])


@pytest.mark.parametrize("rows", [70_000, 50_000])
def test_katz_pieces_number_their_rows_in_16_bits(rows):
    """Whatever the batch's size, no piece has more rows than a row number can tell apart."""
    batch = pa.record_batch({"doc_id": pa.array(range(rows)), "held_out": pa.array([False] * rows), "text": pa.array([""] * rows)})
    sizes = []
    for parts, toks in katz.gathered(iter([batch, batch])):
        row = np.concatenate([t[2] for t in toks])
        sizes.append(sum(p.num_rows for p in parts))
        assert (np.sort(row) == np.arange(sizes[-1])).all() and sizes[-1] <= 65_536
    assert sum(sizes) == 2 * rows


def test_katz_query(spark):
    """The contract's columns, with its held-out remainder, against the plain version."""
    d = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    rows = list(zip(d.doc_id.tolist(), d.text.tolist()))
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    want = {r[0]: r for r in expected_scores(rows, held)}
    out = katz.op7_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(rows) and any(held)
    for r in out:
        w = want[r.doc_id]
        assert tuple(r)[:5] == tuple(w)[:5] and abs(r.base_score - w[5]) < 1e-6 and abs(r.score - w[6]) < 1e-6


def test_katz_of_nothing(docs, none):
    assert katz.scored(none, F.lit(False)).count() == 0
    out = katz.scored(docs, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in out)


def test_pack():
    a = [np.arange(5, dtype=np.uint32), np.zeros(0, np.uint16), np.array([2**63], np.uint64)]
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(a, katz.unpack(katz.pack(*a))))


# ---------------------------------------------------------------- against plain formulas


def plain_kernel(a, b):
    grams = lambda t, n: {t[i : i + n] for i in range(len(t) - n + 1)}
    return sum(len(grams(a, n) & grams(b, n)) / math.sqrt(max(1, len(grams(a, n)) * len(grams(b, n)))) for n in (1, 2, 3)) / 3


def test_language_is_nystroem_ridge(monkeypatch):
    """Predictions against ridge regression in its dual form, with the Nystroem kernel k(x, L) K(L, L)^-1 k(L, y) spelled out over plain sets."""
    monkeypatch.setattr(langid, "LANDMARKS_PER_LANG", 3)
    rng = np.random.default_rng(5)
    alphabets = {"de": "abcdeäöü ", "en": "abcfgh ", "fr": "abéèij "}
    texts = [("".join(rng.choice(list(alphabets[x]), rng.integers(3, 40))).encode(), x) for x in rng.choice(list(alphabets), 60)]
    asked = [b"", b"abc", "äö é".encode(), *(t for t, _ in texts[:10])]
    model = langid.fit([t for t, _ in texts], [x for _, x in texts])
    got = langid.scores(model, np.frombuffer(b"".join(asked), np.uint8), np.cumsum([0, *map(len, asked)]))
    langs = sorted(alphabets)
    marks = [t for x in langs for t in [t for t, y in texts if y == x][:3]]
    inverse = np.linalg.pinv(np.array([[plain_kernel(a, b) for b in marks] for a in marks]), rcond=1e-6)
    near = lambda ts: np.array([[plain_kernel(t, m) for m in marks] for t in ts])
    c, y = near([t for t, _ in texts]), np.array([[x == k for k in langs] for _, x in texts], float)
    g = c @ inverse @ c.T
    centre = np.eye(len(g)) - 1 / len(g)
    dual = np.linalg.solve(centre @ g @ centre + langid.RIDGE * len(g) * np.eye(len(g)), y - y.mean(axis=0))
    to = near(asked) @ inverse @ c.T
    z = y.mean(axis=0) + (to - g.mean(axis=0)) @ centre @ dual
    share = np.exp(8 * np.clip(z, -1, 2))
    assert model.langs == langs and np.allclose(got, share / share.sum(axis=1, keepdims=True), atol=2e-3)


def test_quality_is_the_penalised_optimum(monkeypatch):
    """No small step of any weight or threshold improves the plain penalised likelihood, which is convex."""
    monkeypatch.setattr(quality, "STEPS", 6000)
    monkeypatch.setattr(quality, "SPARSE", 1e-3)
    rng = np.random.default_rng(2)
    words = np.array([11, 222, 3333, 44444, 55555, 7])
    grades = rng.integers(0, 3, 120)
    rows = [np.unique(words[(rng.random(6) < 0.25 + 0.2 * (np.arange(6) % 3 == g))]) for g in grades]
    shares = np.array([0.2, 0.3, 0.5])
    m = quality.fit(rows, grades, shares)
    counts = np.bincount(grades)

    def loss(w, t):
        total = quality.SPARSE * sum(abs(x) for x in w.values())
        for r, g in zip(rows, grades, strict=True):
            z = sum(w[x] for x in r) / math.sqrt(max(1, len(r)))
            for k in range(2):
                p = 1 / (1 + math.exp(t[k] - z))
                total -= shares[g] / counts[g] * math.log(p if g > k else 1 - p)
        return total

    w, t = {x: m.weights[x] for x in words}, list(m.thresholds)
    best = loss(w, t)
    assert m.thresholds[0] < m.thresholds[1] and np.count_nonzero(m.weights) <= 6 and any(w.values())
    for step in (-0.01, 0.01):
        assert all(loss(w | {x: w[x] + step}, t) > best - 1e-7 for x in words)
        assert all(loss(w, [v + step * (i == k) for i, v in enumerate(t)]) > best - 1e-7 for k in range(2))
    assert best < loss(dict.fromkeys(words, 0.0), t) - 0.01


def test_ratings_are_the_stated_ones(spark, docs):
    """Every rating from plain sets of words, and thresholds alone for texts without any."""
    d = spark.createDataFrame([(i, f"good fine word{i}" if i % 3 == 2 else f"bad poor word{i}" if i % 3 else f"vile toxic word{i}") for i in range(90)], "doc_id long, text string")
    model = quality.train(d, spark.createDataFrame([(i, i % 3) for i in range(90)], "doc_id long, grade int"), 3)
    asked = docs.unionByName(d, allowMissingColumns=True).unionByName(d.limit(0), allowMissingColumns=True)
    for r in quality.rate(asked, model, 2).collect():
        words = {x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))}
        hashed = [np.unique(quality.features(np.frombuffer(x, np.uint8), np.array([0, len(x)]))[1]) for x in words]
        cols = {int(h[0]) for h in hashed}
        z = sum(model.weights[c] for c in cols) / math.sqrt(max(1, len(cols)))
        tails = [1 / (1 + math.exp(x - z)) for x in model.thresholds]
        assert abs(r.expected_grade - sum(tails)) < 1e-9 and abs(r.tail_prob - tails[1]) < 1e-9 and abs(r.lowest_prob - 1 + tails[0]) < 1e-9
    assert quality.rate(docs.limit(0), model, 2).count() == 0
    nothing = quality.train(d.limit(0), spark.createDataFrame([], "doc_id long, grade int"), 3)
    assert not nothing.weights.any() and list(nothing.thresholds) == [0, 1]
