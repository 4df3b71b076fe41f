"""Operators with exact results, against plain Python on small inputs and on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallgrass.llm import bpe, chat, components, decontam, jaccard, langid, sharding, substrings, topk
from tallgrass.llm.common import staged

SF = "/root/testdata/sf0.001"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def pairs(df, *cols):
    return sorted(((tuple(r[c] for c in cols)) for r in df.select(*cols).collect()), key=repr)


# ---------------------------------------------------------------- sharding


def test_shards(spark, docs, tmp_path):
    out = sharding.shard_rows(docs, 5, block_rows=2).collect()
    assert len(out) == docs.count()
    sizes = Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    assert pairs(docs, "doc_id", "text") == sorted(((r.doc_id, r.text) for r in out), key=repr)


def test_shards_of_nothing(none):
    assert sharding.shard_rows(none, 3).count() == 0


def test_shuffle_is_uniform_and_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 3000, 1, 7).write.parquet(path)
    one = {r.id: (r.shard, r.slot) for r in sharding.shard_table(spark, path, 10, seed=1).collect()}
    assert one == {r.id: (r.shard, r.slot) for r in sharding.shard_table(spark, path, 10, seed=1).collect()}
    assert one != {r.id: (r.shard, r.slot) for r in sharding.shard_table(spark, path, 10, seed=2).collect()}
    got = np.array([one[i][0] for i in range(3000)])
    table = np.array([[(got[p * 428 : (p + 1) * 428] == s).sum() for s in range(10)] for p in range(7)])
    assert ((table - 42.8) ** 2 / 42.8).sum() < 110  # chi square, 54 degrees of freedom


def test_shuffle_of_split_files(spark, tmp_path, monkeypatch):
    """Files of one name in two folders, cut into source partitions, beside columns named like the operator's own."""
    monkeypatch.setattr(sharding, "PART_ROWS", 7)
    for k in "ab":
        spark.range(100 * (k == "b"), 100 * (k == "b") + 50).select("id", *(F.lit(c).alias(c) for c in ("row", "block", "at", "part", "n.x"))).coalesce(1).write.parquet(str(tmp_path / k))
        (f,) = (tmp_path / k).glob("*.parquet")
        f.rename(tmp_path / k / "same.parquet")
    out = [sharding.shard_table(spark, f"{tmp_path}/[ab]", 6, block_rows=4).collect() for _ in range(2)]
    assert sorted(out[0]) == sorted(out[1]) and {r.id for r in out[0]} == {*range(50), *range(100, 150)}
    assert all((r["row"], r["block"], r["at"], r["part"], r["n.x"]) == ("row", "block", "at", "part", "n.x") for r in out[0])
    assert {(r.shard, r.slot) for r in out[0]} == {(s, i) for s in range(6) for i in range(17 if s < 4 else 16)}


def test_large_draws():
    rng = np.random.default_rng(0)
    x = [sharding.hypergeometric(rng, 2_000_000_000, 6_000_000_000, 1_000_000) for _ in range(300)]
    assert abs(np.mean(x) - 250_000) < 150 and 300 < np.std(x) < 580
    assert sharding.multivariate(rng, np.array([10**9, 10**9, 5]), 1000).sum() == 1000
    assert sharding.hypergeometric(rng, 0, 10**10, 5) == 0


# ---------------------------------------------------------------- decontamination


def expected_hits(docs, items, width=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))

    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1)) if w else ():
            wins.setdefault(tuple(w[k : k + width]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w, hit, who = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (m := wins.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    who |= m
        out.append((d, len(w), len(hit), sorted(who)))
    return sorted(out, key=repr)


def test_decontamination(spark, docs):
    items = [(1, "Jumps over the LAZY dog, while seven wise owls watch from an old oak"), (2, "one two"), (3, ""), (None, "w5x5 w6x6 w7x7"), (4, "the"), (5, "no such words here"), (6, "one two")]
    tests = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_hit int")
    got = decontam.decontaminate(docs, tests)
    want = expected_hits([(r.doc_id, r.text) for r in docs.collect()], items)
    assert pairs(got, "doc_id", "n_words", "n_hit", "items") == want


def test_decontamination_of_nothing(spark, docs, none):
    tests = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(docs, tests).filter("n_hit > 0").count() == 0
    assert decontam.decontaminate(none, tests).count() == 0


def test_proximity(spark):
    d = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a x x x x x x x x h"), (3, "h a")], "doc_id long, text string")
    t = spark.createDataFrame([(7, "a h"), (8, "zz a")], "item_id long, text string")
    got = decontam.proximity_hits(decontam.build_index(d), t, 7)
    assert pairs(got, "item_id", "doc_id") == [(7, 1), (7, 3)]


def test_index_serves_other_tests(spark, docs, monkeypatch):
    """The index that decontamination stores holds words that its benchmark lacks, for other test sets and proximity search."""
    kept, build = [], decontam.build_index
    monkeypatch.setattr(decontam, "build_index", lambda *a: kept.append(build(*a)) or kept[-1])
    first, other = (spark.createDataFrame([(1, t)], "item_id long, text string") for t in ("one two", "seven wise owls"))
    decontam.decontaminate(docs, first).count()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = decontam.decontaminate(docs, other, index=kept[0])
    assert len(kept) == 1 and pairs(got, "doc_id", "n_words", "n_hit", "items") == expected_hits(rows, [(1, "seven wise owls")])
    near = decontam.proximity_hits(kept[0], spark.createDataFrame([(1, "quick dawn")], "item_id long, text string"), 30)
    assert {1, 2, 3, 4, 17} <= {r.doc_id for r in near.collect()}


# ---------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return path, t


def test_bpe(spark, docs, tokenizer):
    path, t = tokenizer
    odd = [(100 + i, x) for i, x in enumerate(("a<|startoftext|>b<|endoftext|>", "ΑΣ ΣΑΣ don't We'LL 'S", "ﬁ Å é 漢字 ０1٢½ \x1c \x85 ​", "a" * 5000, "ǅ İ"))]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    for r in bpe.encode_decode(df, path).collect():
        e = t.encode(r.text or "", add_special_tokens=False)
        assert list(np.frombuffer(r.token_ids, "<u4")) == e.ids
        assert r.decoded == t.decode(e.ids, skip_special_tokens=False)


def test_bpe_random(tokenizer):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    path, t = tokenizer
    v, cache = bpe.loaded(path)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet="abcdeinoprst'ABΣσ .,!1é", max_size=60))
    def same(text):
        assert list(np.frombuffer(v.encode(text, cache), "<u4")) == t.encode(text, add_special_tokens=False).ids

    same()


def test_bpe_chunks():
    text = "ab cd " * 50 + "e" * 300
    assert "".join(bpe.chunks(text, 40)) == text and len(list(bpe.chunks(text, 40))) > 5


# ---------------------------------------------------------------- n-gram Jaccard join


def expected_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if a and sets[j] and 100 * k >= 80 * (len(a) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    groups = {}
    for i, s in enumerate(sets):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(s), least[find(i)]) for i, s in enumerate(sets)), key=repr)


def test_jaccard(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert pairs(jaccard.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == expected_components(rows)


def test_jaccard_of_nothing(none):
    assert jaccard.near_duplicates(none).count() == 0


@pytest.mark.parametrize(("frequent", "block", "size"), [(64, 4096, 8_000_000), (2, 4096, 8_000_000), (64, 3, 8_000_000), (2, 4096, 600)])
def test_jaccard_families(spark, monkeypatch, frequent, block, size):
    """Chains and families of near copies around the threshold, with passages that many documents share, in whole and split tiles."""
    for name, value in (("FREQUENT", frequent), ("BLOCK", block), ("BLOCK_BYTES", size)):
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(3)
    shared = [f"s{i}" for i in range(40)]
    rows = []
    for fam in range(6):
        words = [f"f{fam}w{i}" for i in range(int(rng.integers(20, 120)))]
        for _ in range(12):
            w = list(words)
            for _ in range(int(rng.integers(0, 5))):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(1000)}"
            if rng.random() < 0.4:
                w = w + shared if rng.random() < 0.5 else shared + w
            words = w if fam % 2 else words  # odd families are chains
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert pairs(jaccard.near_duplicates(df), "doc_id", "n_shingles", "component_id") == expected_components(rows)


@pytest.mark.parametrize("marks", [0, 2, 1 << 20])
def test_jaccard_with_few_marks(spark, docs, monkeypatch, marks):
    """However few tokens may be marked as frequent, the result is the same."""
    monkeypatch.setattr(jaccard, "MARKS", marks)
    monkeypatch.setattr(jaccard, "FREQUENT", 1)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert pairs(jaccard.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == expected_components(rows)


def test_jaccard_links(spark, monkeypatch):
    """Every link of a family of near copies, not only those that connect it."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:at] + [f"e{at}"] + words[at + 1 :]) for at in (5, 20, 35, 50)] + [" ".join(words), " ".join(words), " ".join(words[:58]), "one two", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in enumerate(texts) if t and i != 5 and t != "one two"}
    want = sorted((i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    for block in (4096, 2):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        got = [tuple(sorted((r.x_doc_id, r.y_doc_id))) for r in jaccard.links(df).collect()]
        assert sorted(got) == want and len(want) > len(sets)
    assert jaccard.links(df.limit(0)).count() == 0


def test_signatures_bound_overlaps_from_above():
    """Whatever links passes the bound, at equal and at doubled signature sizes."""
    rng = np.random.default_rng(5)
    for n in (5, 60, 255, 257, 1000, 1500, 2100):
        sets = [np.unique(rng.integers(0, 1 << 63, n, np.uint64))]
        sets += [np.unique(np.concatenate((sets[0][rng.random(n) < keep], rng.integers(0, 1 << 63, int(n * more), np.uint64)))) for keep in (1, 0.95, 0.9, 0.8, 0.5) for more in (0, 0.05, 0.1, 0.24)]
        sets.sort(key=len)
        m = len(sets)
        i, j, slack = jaccard.passed(1, np.zeros(m, int), np.ones(m, int), np.arange(m), np.array([len(s) for s in sets]), [jaccard.signature(s).tobytes() for s in sets])
        both = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
        want = {(a, b) for a in range(m) for b in range(a + 1, m) if 100 * both(a, b) >= 80 * len(np.union1d(sets[a], sets[b]))}
        assert want <= set(zip(i.tolist(), j.tolist(), strict=True)) and want
        assert len(jaccard.forest(i, j, slack, np.arange(m))) <= m - 1


@pytest.mark.parametrize("few", [200_000, 0])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components, "BROADCAST_ROWS", few)
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (5, 5)]
    got = dict(components.components(spark.createDataFrame(links, "x long, y long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# ---------------------------------------------------------------- repeated substrings


def expected_cuts(rows, w=200):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(b[i : i + w] for b in texts for i in range(len(b) - w + 1))
    out = []
    for (d, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - w + 1):
            if count[b[i : i + w]] > 1:
                gone[i : i + w] = b"\1" * w
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((d, [tuple(s) for s in spans], bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [4096, 1])
def test_substrings(spark, docs, monkeypatch, group):
    """With group 1 every anchor takes the way of those with very many contexts."""
    rng = np.random.default_rng(5)
    passage = bytes(rng.integers(97, 123, 320, np.uint8)).decode()
    extra = [(200 + i, bytes(rng.integers(97, 123, int(rng.integers(0, 500)), np.uint8)).decode() + passage[int(rng.integers(0, 90)) :] + str(i)) for i in range(12)]
    df = docs.select("doc_id", "text").filter("coalesce(length(text), 0) < 5000").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    monkeypatch.setattr(substrings.repeated_spans, "__defaults__", (200, group))
    got = [(r.doc_id, [tuple(s) for s in r.spans], bytes(r.kept)) for r in substrings.remove_repeats(df).collect()]
    assert sorted(got, key=repr) == expected_cuts([(r.doc_id, r.text) for r in df.collect()])


def test_substrings_of_nothing(none):
    assert substrings.remove_repeats(none.select("doc_id", "text")).count() == 0


def test_suffix_array(spark):
    """The linear construction against sorting, over small alphabets."""
    substrings.repeated_windows(spark)
    cls = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass("tallgrass.RepeatedWindows")
    method = next(m for m in cls.getMethods() if m.getName() == "suffixArray")
    gateway = spark.sparkContext._gateway
    rng = np.random.default_rng(1)
    for n, k in ((1, 1), (30, 1), (40, 2), (200, 2), (300, 3), (500, 26)):
        x = rng.integers(0, k, n).tolist()
        a = gateway.new_array(gateway.jvm.int, n)
        for i, v in enumerate(x):
            a[i] = v
        args = gateway.new_array(gateway.jvm.Object, 1)
        args[0] = a
        assert list(method.invoke(None, args)) == sorted(range(n), key=lambda i: x[i:])


# ---------------------------------------------------------------- top-k


def test_topk(spark):
    rng = np.random.default_rng(2)
    v = [(i, rng.normal(0, 0.2, 6).round(1).tolist()) for i in range(300)]
    v += [(1000, None), (1001, [0.1, None] + [0.0] * 4), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6), (None, [0.1] * 6), (1020, [0.0] * 6), (1040, [0.3]), (1060, [])]
    df = spark.createDataFrame([(i, x, 1) for i, x in v], "vec_id long, embedding array<double>, rank int")
    vecs = staged(topk.quantised(df), "q")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(vecs, vecs.filter("id % 20 = 0"), 7).collect()}
    use = {i: np.floor(64 * np.array(x + [0.0] * (6 - len(x)))) for i, x in v if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)}
    use[1040][1:] = 0
    for q in [i for i in use if i % 20 == 0]:
        best = sorted(((-int(use[q] @ use[j]), j) for j in use if j != q))[:7]
        assert [got[q, r + 1] for r in range(7)] == [(j, -s) for s, j in best]


def test_topk_stops_early(monkeypatch):
    rng = np.random.default_rng(4)
    v = np.floor(64 * rng.normal(0, 0.3, (5000, 2)))
    lists = topk.Lists(np.arange(5000), v)
    ids, scores = lists.best(-1, v[0], 5)
    want = sorted(((-s, i) for i, s in enumerate((v @ v[0]).astype(int).tolist())))[:5]
    assert list(zip((-scores).tolist(), ids.tolist())) == want


def test_topk_of_few(spark):
    two = spark.createDataFrame([(0, [1.0]), (20, [2.0])], "id long, v array<double>")
    assert pairs(topk.top_k(two, two), "query_id", "rank", "vec_id") == [(0, 1, 20), (20, 1, 0)]
    assert topk.top_k(two.limit(0), two.limit(0)).count() == 0


def test_topk_of_repeated_ids(spark, monkeypatch):
    """Rows that share an id all count, as queries and as candidates, as in the SQL."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(6)
    v = [(int(i), rng.normal(0, 0.5, 3).round(1).tolist()) for i in rng.integers(0, 41, 120)]
    vecs = staged(topk.quantised(spark.createDataFrame(v, "vec_id long, embedding array<double>")), "q")
    got = {}
    for r in sorted(topk.top_k(vecs, vecs.filter("id % 20 = 0"), 9).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    use = [(i, np.floor(64 * np.array(x))) for i, x in v]
    for q in {i for i, _ in v if i % 20 == 0}:
        best = sorted((-int(a @ b), j) for i, a in use if i == q for j, b in use if j != q)[:9]
        assert got[q] == [(j, -s) for s, j in best]


# ---------------------------------------------------------------- chat


def test_chat(spark):
    fixed = "</s>[INST] ok [/INST]"
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"), (3, 0, "assistant", fixed), (3, 1, "assistant", "<\x1b/s> [\x1b\x1bINST]"),
        (None, 0, "user", "q"), (4, 0, "us</s>er", " [/INST] <s"), (5, 0, "assistant", ""), (6, None, "assistant", "é😀" * 10),
    ]
    df = spark.createDataFrame([(*r, "y") for r in rows], "conv_id long, turn long, role string, text string, rounds string")
    turns = chat.format_turns(df)
    assert turns.filter("parsed_role <> coalesce(role, '') or parsed_text <> coalesce(text, '')").count() == 0
    got = {r.conv_id: r for r in chat.conversations(turns).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0))
        said = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    for r in turns.collect():
        span = r.rendered[r.loss_from : r.loss_to]
        assert chat.unescape(span) == (r.text or "" if r.role == "assistant" else "")
    assert chat.conversations(chat.format_turns(df.limit(0))).count() == 0


def test_chat_random():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    piece = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\x1b", "<", "[", "/", "s>", "INST]", " ", "a", "<\x1bs>"])
    text = st.lists(piece, max_size=12).map("".join)

    @settings(max_examples=500, deadline=None)
    @given(st.lists(st.tuples(text, text), min_size=1, max_size=4))
    def whole(turns):
        rendered = "".join(chat.render_turn(*t)[0] for t in turns)
        assert [(r, t) for r, t, _, _ in chat.parse(rendered)] == turns

    whole()


# ---------------------------------------------------------------- pipeline


def test_every_code_point(tokenizer):
    """Each stands beside letters, digits and signs, and twice; ids as the library's."""
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    vocab = bpe.Vocabulary(tokenizer[0])
    cache = bpe.Cache(vocab)
    for lo in range(0, len(points), 1024):
        texts = [f"a{c}b 1{c}2 {c}{c} .{c}!" for c in map(chr, points[lo : lo + 1024])]
        want = [e.ids for e in tokenizer[1].encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(vocab.encode(t, cache), "<u4").tolist() for t in texts] == want


def test_pipeline(spark, tmp_path, tokenizer):
    """All stages against plain Python, with planted junk, near copies, repeated passages and benchmark passages."""
    import random

    import corpus_pipeline

    r = random.Random(1)
    d = pd.read_parquet(f"{SF}/documents.parquet")
    b = pd.read_parquet(f"{SF}/benchmark.parquet")
    long = d[d.text.str.len() > 400].text.tolist()
    item = max(b.text.dropna(), key=len)
    junk = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(1500)), "".join(r.choice("0123456789abcdef") for _ in range(1500)), "12 34 !", None]
    new = [*junk, long[0] + " and one end", long[1][:300] + " " + " ".join(long[2].split()[::-1]), item + " " + " ".join(long[3].split()[::-1])]
    extra = d.iloc[[0] * len(new)].assign(text=new, doc_id=np.arange(len(new)) + int(d.doc_id.max()) + 1)
    first = int(extra.doc_id.iloc[0])
    extra["lang"] = [None] * len(junk) + [d.lang.iloc[0]] * (len(new) - len(junk))  # junk has no label to learn from
    pd.concat([d, extra], ignore_index=True).astype(d.dtypes.to_dict()).to_parquet(tmp_path / "documents.parquet")
    b.to_parquet(tmp_path / "benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    scored = langid.predict(docs, langid.train(docs.select("text", "lang"))).collect()
    rows = sorted((x.doc_id, x.text) for x in scored if x.lang_pred != "und" and x.score >= corpus_pipeline.LEAST_SCORE)
    assert not {i for i, _ in rows} & {first + 2, first + 3} and len(rows) > 0.9 * len(d)
    keep = {i for i, _, least in expected_components(rows) if i == least}
    assert len(keep) < len(rows)
    cuts = [(i, kept.decode(errors="ignore")) for i, _, kept in expected_cuts([x for x in rows if x[0] in keep])]
    rows = [x for x in cuts if x[1]]
    clean = {i for i, _, n_hit, _ in expected_hits(rows, list(zip(b.item_id, b.text))) if not n_hit}
    assert len(clean) < len(rows)
    want = {i: tokenizer[1].encode(t, add_special_tokens=False).ids for i, t in rows if i in clean}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {x.doc_id: list(np.frombuffer(x.token_ids, "<u4")) for x in got} == want


def test_stages_leave_columns_alone(spark, tmp_path):
    """Columns named like those of the operators, nulls, empty texts, repeated rows, and a U+FFFD of a text's own."""
    import corpus_pipeline

    pd.read_parquet(f"{SF}/benchmark.parquet").to_parquet(tmp_path / "benchmark.parquet")
    names = ("doc_id", "text", "lang", "text_hash", "spans", "kept", "score", "lang_pred", "_t", "key", "c1", "row", "node", "n.x", "n_chars")
    twice = "ä" + "so this is a passage that stands in two of the texts and is cut from both of them " * 4
    texts = ["one short text with a mark \ufffd in it " + twice, "another text of some words \x1a1 \ufffd " + twice, "a third one, quite alone here", "a third one, quite alone here", "", None]
    rows = [(i if i != 3 else 2, t, "en", *("x" for _ in names[3:-1]), 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in names[3:-1]) + ", n_chars int")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.names == docs.schema.names and all(set(r[3:-1]) == {"x"} for r in out.collect())
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    left = {r.doc_id: r.text for r in corpus_pipeline.repeated_substrings(spark, docs, str(tmp_path)).collect()}
    assert left == {0: texts[0].replace(" " + twice, ""), 1: texts[1].replace(" " + twice, ""), 2: texts[2]}  # the blank before it repeats, too
    assert sorted(str(r.text) for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()) == sorted(map(str, [*texts[:3], *texts[4:]]))


# ---------------------------------------------------------------- contract queries


def test_sharding_query(spark):
    out = sharding.op1_sharding(spark, SF).toPandas()
    d = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text
    assert len(out) == len(d) and set(out.shard) <= set(range(24)) and out.groupby("shard").size().agg(lambda s: s.max() - s.min()) <= 1
    for r in out.itertuples():
        b = (d[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(b) + 8, zlib.crc32(b))


def test_substring_query(spark):
    out = {r.doc_id: r for r in substrings.op8_substring_dedup(spark, SF).collect()}
    d = pd.read_parquet(f"{SF}/documents.parquet")
    for i, spans, kept in expected_cuts(list(zip(d.doc_id, d.text))):
        assert (out[i].n_spans, out[i].n_removed, out[i].kept_sha256) == (len(spans), sum(b - a for a, b in spans), hashlib.sha256(kept).hexdigest())


def test_bpe_query(spark, tokenizer):
    out = {r.doc_id: r for r in bpe.op5_bpe(spark, SF).collect()}
    for i, t in pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]].itertuples(index=False):
        ids = tokenizer[1].encode(t or "", add_special_tokens=False).ids
        decoded = tokenizer[1].decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == want


def test_jaccard_query(spark):
    d = pd.read_parquet(f"{SF}/documents.parquet")
    got = pairs(jaccard.op6_jaccard_join(spark, SF), "doc_id", "n_shingles", "component_id")
    assert got == expected_components(list(zip(d.doc_id.tolist(), d.text.tolist())))


def test_chat_query(spark, tmp_path):
    """Digests against the source's turns; conversation -7, also beside one of that id in the table."""
    d = pd.read_parquet(f"{SF}/conversations.parquet")
    more = pd.DataFrame({"conv_id": [-7, -7, -8], "turn": [1, 0, 0], "role": ["assistant", "user", "assistant"], "text": ["b [/INST] </s>", None, "x<\x1bs>"]})
    d = pd.concat([d[list(more.columns)], more], ignore_index=True).astype(d[list(more.columns)].dtypes.to_dict())
    d.to_parquet(tmp_path / "conversations.parquet")
    fixed = "</s>[INST] ok [/INST]"
    groups = [(int(k), list(zip(g.role, g.text.map(lambda t: t or "")))) for k, g in d.sort_values(["conv_id", "turn"], kind="stable").groupby("conv_id")]
    groups.append((-7, [("user", fixed), ("assistant", fixed)]))

    def digest(turns):
        loss = "".join(t for r, t in turns if r == "assistant")
        return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()

    got = pairs(chat.op10_chat_formatting(spark, str(tmp_path)), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert got == sorted(((k, *digest(t)) for k, t in groups), key=repr)


# ---------------------------------------------------------------- repairs


def test_topk_of_empty_vectors(spark):
    """A block whose vectors are all empty: every score is 0."""
    df = spark.createDataFrame([(i, []) for i in range(5)], "id long, v array<double>")
    got = topk.top_k(df, df.filter("id < 2"), 2)
    assert pairs(got, "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 0), (0, 2, 2, 0), (1, 1, 0, 0), (1, 2, 2, 0)]


def test_topk_beyond_floats(spark, monkeypatch):
    """Scores that doubles cannot tell apart, and more than one block."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "STEP", 2)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-(2**30), 2**30, 6)]) for i in range(60)] + [(60 + i, [2.0**30, 2.0**29 + i, 1.0, float(i), 2.0**30 - i, 2.0**30]) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = topk.top_k(df, df.filter("id >= 50"), 4)
    want = []
    for i, q in rows[50:]:
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(q, v, strict=True)), j) for j, v in rows if j != i)[:4]
        want += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    assert max(abs(w[3]) for w in want) > 2**53
    assert pairs(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    with pytest.raises(Exception, match="too large|OverflowError|out of"):
        huge = spark.createDataFrame([(1, [1e12]), (2, [1e12])], "id long, v array<double>")
        topk.top_k(huge, huge).collect()


def test_topk_broadcasts_no_queries(spark, monkeypatch):
    """What is repeated for many blocks, 5 MB here, is broadcast neither whole nor in part, however small its files are."""
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = np.random.default_rng(8)
    m = rng.integers(-100, 100, (6400, 64)).astype(float)
    vecs = staged(spark.createDataFrame([(i, x) for i, x in enumerate(m.tolist())], "id long, v array<double>"), "q")
    keys = {"spark.sql.maxBroadcastTableSize": "3m", "spark.sql.autoBroadcastJoinThreshold": "256k"}  # between the queries' 51 KB and the blocks' 410 KB
    was = {x: spark.conf.get(x) for x in keys}
    try:
        for x, y in keys.items():
            spark.conf.set(x, y)
        got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(vecs, vecs.filter("id % 10 = 0"), 5).collect()}
    finally:
        for x, y in was.items():
            spark.conf.set(x, y)
    assert len(got) == 640 * 5
    for q in range(0, 6400, 10):
        scores = (m @ m[q]).astype(int)
        best = [j for j in np.lexsort((np.arange(6400), -scores)) if j != q][:5]
        assert [got[q, r + 1] for r in range(5)] == [(j, scores[j]) for j in best]


def test_topk_floors_beyond_doubles(spark, monkeypatch):
    """The first block's kth score, 2**53 + 3, is no double; a row of another block with just that score and a smaller id is not lost."""
    monkeypatch.setattr(topk, "BLOCK", 2)
    rows = [(30, [2.0**52, 3.0]), (40, [1.0, 0.0]), (10, [2.0**52, 3.0]), (50, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").coalesce(1)
    asked = spark.createDataFrame([(1, [2.0, 1.0])], "id long, v array<double>")
    assert pairs(topk.top_k(df, asked, 1), "query_id", "rank", "vec_id", "score") == [(1, 1, 10, 2**53 + 3)]


@pytest.mark.parametrize("blocks", [1, 3])
def test_topk_of_blocks(monkeypatch, blocks):
    """Queries of a block at once against all scores: ties, repeated ids, queries of zeros, few and many dimensions, sweeps and walks."""
    rng = np.random.default_rng(9)
    for width in (1, 2, 8, 64):
        n, k = 300 * blocks, 7
        v = np.floor(rng.normal(0, 9, (n, width)))
        v[rng.random(n) < 0.4] = v[0]
        ids, asked, q = rng.integers(0, n, n), np.arange(20), np.floor(rng.normal(0, 9, (20, width)))
        q[3] = 0
        floors, found = np.full(20, topk.NONE), [(np.zeros(0, np.int64),) * 3]
        for at in range(0, n, 300):
            found = [topk.top([*found, topk.Lists(ids[at : at + 300], v[at : at + 300]).meet(asked, q, floors, k)], floors, k)]
        i, got, scores = found[0]
        for x in range(20):
            want = sorted((-int(v[j] @ q[x]), int(ids[j])) for j in range(n) if ids[j] != asked[x])[:k]
            assert list(zip((-scores[i == x]).tolist(), got[i == x].tolist(), strict=True)) == want


def test_many_spans_of_long_texts(spark):
    """Two texts of 6 MB that share 24,000 passages: the work is linear in spans."""
    import time

    rng = np.random.default_rng(1)
    shared = [rng.integers(97, 123, 210).astype(np.uint8).tobytes().decode() for _ in range(24_000)]
    texts = ["".join(s + f"{a}{i:07d}" + "xyz"[i % 3] * 32 for i, s in enumerate(shared)) for a in "AB"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = [(i, [(k * 250, k * 250 + 210) for k in range(24_000)]) for i in range(2)]
    spans = spark.createDataFrame([(i, lo, hi) for i, x in found for lo, hi in x], "doc_id long, lo int, hi int")
    began = time.time()
    out = df.join(spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans")), "doc_id")
    kept = {r.doc_id: bytes(r.kept) for r in substrings.without(out).select("doc_id", "kept").collect()}
    assert time.time() - began < 40
    for i, t in enumerate(texts):
        assert kept[i].decode() == "".join(t[k * 250 + 210 : (k + 1) * 250] for k in range(24_000))
    began = time.time()
    got = {r.doc_id: r.spans for r in substrings.repeated_spans(df).collect()}
    assert time.time() - began < 120
    # what follows a passage differs in its first byte only
    assert all([(s.lo, s.hi) for s in got[i]] == [(max(0, lo - 39), hi) for lo, hi in x] for i, x in found)


def test_bpe_sequences(tokenizer):
    """Marks after each other in both orders, and two-part compositions, give the library's ids whatever its version of Unicode."""
    import unicodedata

    path, tokenizer = tokenizer
    vocab, cache = bpe.loaded(path)
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    marks = [chr(i) for i in points if unicodedata.combining(chr(i))]
    probes = []
    for i in points:
        parts = unicodedata.decomposition(chr(i)).split()
        if len(parts) == 2 and "<" not in parts[0]:
            a, b = (chr(int(x, 16)) for x in parts)
            probes += [a + b, a + "̣" + b, b + a, chr(i) + "́"]
    for m in marks:
        probes += [x for o in "゙̣́ͅ" for x in ("a" + m + o, "a" + o + m)]
    assert len(probes) > 10_000
    step = 400
    wrong = []
    for k in range(0, len(probes), step):
        part = probes[k : k + step]
        if np.frombuffer(vocab.encode(" ".join(part), cache), "<u4").tolist() != tokenizer.encode(" ".join(part), add_special_tokens=False).ids:
            wrong += [p for p in part if np.frombuffer(vocab.encode(p, cache), "<u4").tolist() != tokenizer.encode(p, add_special_tokens=False).ids]
    assert wrong == []


@pytest.mark.parametrize("query", ["op3_decontamination", "op6_jaccard_join", "op7_lm_scoring", "op8_substring_dedup", "op9_topk", "op13_lexical_search", "pipeline"])
def test_only_results_stay(spark, query):
    """Of the tables on the way nothing is left in the shared folder."""
    import os

    import __spark_entry__
    from tallgrass.llm.common import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = __spark_entry__.queries()[query](spark, SF)
    assert out.count() > 0
    made = set(os.listdir(folder)) - before
    assert len(made) == 1 and out.staged_at.endswith(made.pop())
