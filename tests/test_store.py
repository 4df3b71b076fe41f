"""Commits are whole or not there, wherever they break off; keyed tables rewrite what they touch."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_layers import silver

from tallgrass.operators import gold
from tallgrass.sources import store as stores
from tallgrass.sources.store import Conflict, Store, upsert


class Killed(Exception):
    pass


def test_build_killed_anywhere(spark, tmp_path, monkeypatch):
    """A build that breaks off between any two steps leaves the old tables or the new ones, all of them."""
    root = str(tmp_path)
    gold.build(silver(spark, 3), root)
    facts = lambda: {n: gold.opened(spark, root)[n].count() for n in gold.FACTS}
    old = facts()
    new = {k: v // 3 * 5 for k, v in old.items()}
    for at in range(1, 20):
        done = []

        def step(self, what, at=at, done=done):
            done.append(what)
            if len(done) == at:
                raise Killed

        monkeypatch.setattr(Store, "step", step)
        try:
            gold.build(silver(spark, 5), root)
            break
        except Killed:
            now = facts()
            assert now == (new if done[-1] == "renamed" else old)
            if now == new:
                break
    assert {"write production_monthly", "draft", "rename", "renamed"} <= set(done) and facts() == new


def test_readers_keep_their_snapshot(spark, tmp_path):
    before = gold.build(silver(spark, 3), str(tmp_path))["production_monthly"]
    after = gold.build(silver(spark, 5), str(tmp_path))["production_monthly"]
    assert (before.count(), after.count()) == (6, 10)
    assert gold.opened(spark, str(tmp_path), 0)["production_monthly"].count() == 6
    assert Store(spark, str(tmp_path)).vacuum() and gold.opened(spark, str(tmp_path))["production_monthly"].count() == 10


def test_states_are_pruned(spark, tmp_path):
    out = gold.build(silver(spark, 3), str(tmp_path))["production_monthly"].filter("state = 'TX'")
    assert "PartitionFilters: [isnotnull(state" in out._jdf.queryExecution().toString()


def test_conflicts(spark, tmp_path):
    """Of two commits from one snapshot, those to different parts both succeed, those to the same do not."""
    s = Store(spark, str(tmp_path))
    rows = lambda *k: spark.createDataFrame([(x, n) for x, n in k], "p string, n int")
    s.commit(s.snapshot(), {"t": s.write("t", rows(("a", 1), ("b/c %", 1)), F.col("p"))})
    base = s.snapshot()
    assert set(base.parts("t")) == {"a", "b/c %"}
    one, two, three = (s.write("t", rows(x), F.col("p")) for x in (("a", 2), ("b/c %", 2), ("a", 3)))
    s.commit(base, {"t": one})
    assert s.commit(base, {"t": two}).number == 2
    with pytest.raises(Conflict):
        s.commit(base, {"t": three})
    assert sorted(tuple(r) for r in s.read("t").collect()) == [("a", 2), ("b/c %", 2)]
    with pytest.raises(KeyError):
        s.read("u")


def files(root):
    return {str(p): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(root).rglob("*.parquet")}


def test_upsert(spark, tmp_path):
    """Newest of repeated keys wins, also within the new rows; the files of buckets without new rows stay byte for byte."""
    s = Store(spark, str(tmp_path))
    kind = "id string, at int, v string, m map<string,int>"
    first = [(f"k{i}", 5, "old", {"a": i}) for i in range(200)] + [(None, 5, "old", None)]
    upsert(s, "t", spark.createDataFrame(first, kind), ["id"], ["at"], buckets=16)
    before, parts = files(tmp_path), s.snapshot().parts("t")
    news = [("k1", 6, "new", None), ("k1", 7, "newest", None), ("k1", 7, "newest", None), ("k2", 4, "late", None), ("k3", 5, "same", None), (None, 9, "none", None), ("n", None, "added", None)]
    upsert(s, "t", spark.createDataFrame(news, kind).withColumn("more", F.lit(1)), ["id"], ["at"], source=("x", 3))
    got = {r.id: (r.at, r.v, r.more) for r in s.read("t").collect()}
    assert s.read("t").count() == len(got) == 202
    assert [got[k] for k in ("k1", "k2", "k3", None, "n", "k4")] == [(7, "newest", 1), (5, "old", None), (5, "same", 1), (9, "none", 1), (None, "added", 1), (5, "old", None)]
    now = s.snapshot().parts("t")
    same = {p for p in parts if now[p] == parts[p]}
    assert 16 - len(same) <= 5 and {k: v for k, v in files(tmp_path).items() if k in before} == before
    assert upsert(s, "t", spark.createDataFrame(news, kind), ["id"], ["at"], source=("x", 3)).number == s.snapshot().number == 1
    upsert(s, "t", s.read("t").limit(0), ["id"], ["at"])
    assert s.read("t").count() == 202


def test_parts_need_their_name(spark, tmp_path):
    with pytest.raises(ValueError):
        Store(spark, str(tmp_path)).write("t", spark.range(1).withColumn(stores.PART, F.lit(1)), F.lit("a"))
