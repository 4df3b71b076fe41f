"""Layer reports, the gold build, the economics chain, and pulls: encodings, manifests, formats."""

import datetime as dt
import json

import numpy as np
from test_silver import NOW, xml

from tallgrass.operators import decline, economics, gold, layers
from tallgrass.plans import states
from tallgrass.schema import conform
from tallgrass.sources import files


def silver(spark, months=14):
    rows = [("TX", "well", f"42-001-0000{w}", dt.date(2020 + m // 12, m % 12 + 1, 1), 1000.0 * w / (1 + 0.05 * m), 500.0) for w in (1, 2) for m in range(months)]
    return conform(spark.createDataFrame(rows, "state string, entity_type string, api_number string, production_date date, oil_bbl double, gas_mcf double"))


def test_reports(spark):
    good = silver(spark)
    bronze = spark.range(30)
    got = {r.check_name: (r.failures, r.passed) for r in layers.bronze_to_silver(bronze, good, "TX").collect()}
    assert got == {"row_count_comparison": (0, True), "required_fields": (0, True), "value_ranges": (0, True), "dedup_integrity": (0, True)}
    bad = good.unionByName(good.limit(1)).replace({500.0: -1.0}, subset=["gas_mcf"])
    got = {r.check_name: (r.failures, r.passed) for r in layers.bronze_to_silver(spark.range(100), bad, "TX").collect()}
    assert got == {"row_count_comparison": (1, False), "required_fields": (0, True), "value_ranges": (29, False), "dedup_integrity": (2, False)}
    none = layers.bronze_to_silver(spark.range(0), good.limit(0), "TX")
    assert all(r.passed and r.total_rows == 0 for r in none.collect())
    assert layers.line(none) == "[PASSED] bronze_to_silver (TX): 4/4 checks passed, 0 failed (0 rows)"
    stg = gold.staging(good)
    m, d = gold.production_monthly(stg), gold.decline_curve_inputs(stg)
    assert layers.line(layers.silver_to_gold(good, m, d)) == "[PASSED] silver_to_gold (ALL): 5/5 checks passed, 0 failed (28 rows)"
    off = layers.silver_to_gold(good, m.filter("production_month <> 6").unionByName(m.limit(1)))
    assert {r.check_name for r in off.filter("not passed").collect()} == {"reconcile_total_oil_bbl", "reconcile_total_gas_mcf", "pk_production_monthly", "month_completeness"}


def test_build_replaces(spark, tmp_path):
    for months in (3, 14):
        out = gold.build(silver(spark, months), str(tmp_path))
        assert out["production_monthly"].count() == 2 * months == spark.table("decline_curve_inputs").count() == spark.table("stg_production").count()
        assert out["production_monthly"].schema.names == gold.production_monthly(spark.table("stg_production")).schema.names
    assert gold.build(silver(spark).limit(0), str(tmp_path))["production_monthly"].count() == 0
    assert {r.entities for r in gold.measures(gold.production_monthly(gold.staging(silver(spark)))).collect()} == {2}


def test_from_history_to_value(spark):
    """The chain equals its steps done by hand, and a well with too little history keeps its status."""
    rows = silver(spark, 24).unionByName(silver(spark, 2).filter("api_number like '%1'").withColumns({"api_number": decline.F.lit("42-001-00009")}))
    terms = economics.Terms(nri=0.8, oil_price=70.0, gas_price=3.0, loe_monthly=2000.0)
    out = {r.api_number: r for r in economics.evaluate(rows, ["api_number", "state"], "production_date", "oil_bbl", "gas_mcf", terms, months=240).collect()}
    assert out["42-001-00009"].status != "fitted" and out["42-001-00009"].pv10 is None
    y = np.array([1000.0 / (1 + 0.05 * m) for m in range(24)])
    fit = decline.fit_arps(y[decline.decline_start(y)[0] :])
    t = np.linspace(0, 240, 240 * 200 + 1)
    q = decline.rate(t, fit["qi"], fit["di"], fit["b"], fit["d_min"])
    oil = ((q[1:] + q[:-1]) / 2 * np.diff(t)).reshape(240, 200).sum(axis=1)
    gas = oil / fit["qi"] * 500.0
    net = (oil * 70 + gas * 3) * 0.8 * (1 - 0.046) - 2000
    last = int(np.argmax(net <= 0)) + 1 if (net <= 0).any() else 240
    r = out["42-001-00001"]
    assert (r.economic_limit_month or 240) == last
    assert np.isclose(r.eur_oil_bbl, oil[:last].sum(), rtol=1e-5) and np.isclose(r.eur_gas_mcf, gas[:last].sum(), rtol=1e-5)
    assert np.isclose(r.pv10, (net / 1.1 ** (np.arange(1, 241) / 12))[:last].sum(), rtol=1e-5)


def test_production_in_any_encoding(spark, tmp_path):
    """Of two pools the greater number is kept, not the later name."""
    rows = [dict(zip(states.NM_PRODUCTION, (30, 15, 1, pool, 7, "O", oil, 28, 2024, 1))) for pool, oil in ((100, 5), (90, 8))]
    for k, encoding in enumerate(("utf-8", "utf-8-sig", "utf-16-le", "utf-16-be")):
        root = tmp_path / str(k)
        xml(root / "production/wcproduction/wcproduction.xml", "wcproduction", rows)
        xml(root / "production/pool/pool.xml", "pool", [{"pool_idn": 100, "pool_nam": "A"}, {"pool_idn": 90, "pool_nam": "Z"}])
        for f in root.glob("production/*/*.xml"):
            text = f.read_text().replace(' encoding="utf-8"', "")
            f.write_bytes(("\ufeff" if "16" in encoding else "").encode(encoding) + text.encode(encoding))
        (r,) = states.new_mexico(spark, str(root), NOW).collect()
        assert (r.oil_bbl, r.field_name) == (5.0, "A")
        assert files.source_format(spark, str(root)) == "xml"


def test_pulls(spark, tmp_path):
    assert files.source_format(spark, str(tmp_path)) == "text"
    path = files.write_manifest(spark, str(tmp_path), pull_date="2026-01-02", wells=3)
    assert json.load(open(path)) == {"pull_date": "2026-01-02", "wells": 3}
    files.write_manifest(spark, str(tmp_path), wells=4)
    assert json.load(open(path)) == {"wells": 4}
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text(("A,B,C\n" if i < 2 else "C,A,B\n") + f"{i},2,3\n{i},5,6\n")
    (tmp_path / "no.csv").write_text("a\n1\n")
    t = files.tables(spark, f"{tmp_path}/f*.csv")
    assert sorted((r.a, r.c, r.source_file) for r in t.collect()) == [("0", "3", "f0.csv"), ("0", "6", "f0.csv"), ("1", "3", "f1.csv"), ("1", "6", "f1.csv"), ("2", "2", "f2.csv"), ("5", "2", "f2.csv")]
    assert files.line_count(spark, f"{tmp_path}/f*.csv") == 6 and files.line_count(spark, f"{tmp_path}/x*.csv") == 0
    assert files.tables(spark, f"{tmp_path}/no.csv") is None and files.first_bytes(spark, path, 2) == b"{\n"
