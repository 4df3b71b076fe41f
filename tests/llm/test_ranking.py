"""Lexical search and the divergence audit against plain Python, on awkward rows, with blocks, passes, segments and tiles made small."""

import math
import os
import re
from collections import Counter

import pytest

from tallgrass.llm import divergence, lexical
from tallgrass.llm.common import shared_dir


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# ---------------------------------------------------------------- lexical search


def best(docs, items, k=10):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(t))

    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "the quick brown fox"), (2, "ONE one two"), (3, ""), (4, None), (None, "w5x5 and w6x6 W7x7"), (5, "no-such-word"), (6, "Köln ß é"), (6, "silent river"), (7, "the " * 5000)]


@pytest.mark.parametrize("block,passes", [(8_000_000, 200_000), (300, 3)])
def test_search(spark, docs, monkeypatch, block, passes):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "PASS_TERMS", passes)
    copies = docs.unionByName(docs.filter("doc_id = 4").withColumn("doc_id", docs.doc_id + 100))
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, rank int")
    got = lexical.search(lexical.build_index(copies), items, 4).collect()
    want = best([(r.doc_id, r.text) for r in copies.collect()], ITEMS, 4)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == want and len(want) > 15


def test_search_of_nothing(spark, docs, none):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical.search(lexical.build_index(none), items).count() == 0
    assert lexical.search(lexical.build_index(docs), items.limit(0)).count() == 0


def test_bounds_hold():
    """The byte bounds enclose the exact score, however long the text is and however often a term occurs."""
    import numpy as np

    rng = np.random.default_rng(0)
    tf, m = rng.integers(1, 10**6, 5000), 10 + rng.integers(0, 10**7, 5000)
    g = lexical.impacts(tf, m)
    byte = -(-g // lexical.STEP)
    assert byte.max() < 256 and (byte * lexical.STEP >= g).all() and (byte * lexical.STEP - (lexical.STEP - 1) * (byte > 0) <= g).all()
    n = np.array([1, 10**6])
    assert lexical.lengths(n, 10**12, 10**15).tolist() == [10 + 90 * int(x) * 10**12 // 10**15 for x in n]


# ---------------------------------------------------------------- divergence


def audited(rows, ranks):
    def terms(t):
        return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t))

    out = []
    for lang in {r[0] or "" for r in rows}:
        mine = [(s or "", Counter(terms(t))) for g, s, t in rows if (g or "") == lang]
        df = Counter(t for _, c in mine for t in c)
        kept = [t for t in df if df[t] >= 3]
        counts = {s: Counter() for s, _ in mine}
        for s, c in mine:
            counts[s].update({t: n for t, n in c.items() if df[t] >= 3})
        every = sum(counts.values(), Counter())

        def p(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        shares, whole = {s: p(c) for s, c in counts.items()}, p(every)
        for s, a in shares.items():
            pairs = sorted((-sum((a[t] - b[t]) ** 2 // b[t] for t in kept), x.encode()) for x, b in shares.items() if x != s)
            words = sorted((-((a[t] - whole[t]) ** 2 // whole[t]), t.encode()) for t in kept if counts[s][t] and a[t] > whole[t])[:ranks]
            out += [(lang, s, part, x.decode(), -v, r) for part, found in (("pair", pairs), ("term", words)) for r, (v, x) in enumerate(found, 1)]
    return sorted(out)


def corpus(spark):
    words = ["wald", "see", "straße", "Berg", "fluß", "x1y", "zeta", "an", "Zug", "été"]
    rows = [("de", f"s{i % 7}", " ".join(words[(i * k) % 10] for k in range(1, 2 + i % 9))) for i in range(60)]
    rows += [("de", "s1", "wald " * 3000), ("de", "leer", ""), ("de", "leer2", None), ("de", None, "see see"), (None, "s1", "one two"), ("", "s2", "one"), ("fr", "s", "un"), ("fr", "t", "deux"), ("en", "only", "a b a"), ("en", "only", "a b"), ("en", "only", "A")]
    rows += [("de", "s3", "12 34 !!"), ("de", "s3", "Wald_See")] * 2
    return rows, spark.createDataFrame([(*r, 1, "t") for r in rows], "lang string, source string, text string, n int, term string").repartition(3)


@pytest.mark.parametrize("segment,tile", [(200_000, 2_000_000), (3, 2)])
def test_audit(spark, monkeypatch, segment, tile):
    monkeypatch.setattr(divergence, "SEGMENT", segment)
    monkeypatch.setattr(divergence, "TILE_TERMS", tile)
    rows, df = corpus(spark)
    got = divergence.audit(df, ranks=4).collect()
    assert sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got) == audited(rows, 4)
    left = os.listdir(shared_dir(spark).removeprefix("file:"))
    assert not [x for x in left if x.startswith(("counts", "tiles", "round", "sums", "heaps", "postings", "kept", "terms"))]


def test_audit_of_nothing(spark):
    assert divergence.audit(corpus(spark)[1].limit(0)).count() == 0


@pytest.mark.parametrize("n", range(9))
def test_every_pair_meets_once(n):
    met = [p for turn in divergence.opponents(n) for p in turn]
    assert sorted(met) == [(a, b) for a in range(n) for b in range(a + 1, n)]
    assert all(len({x for p in turn for x in p}) == 2 * len(turn) for turn in divergence.opponents(n))


def test_shares_are_exact_beyond_64_bits():
    import numpy as np

    c = np.array([0, 9_100_000_000, 10**15])
    assert divergence.share(c, 10**15 + 10, 3).tolist() == [1 + 10**9 * (int(x) + 1) // (10**15 + 13) for x in c]
