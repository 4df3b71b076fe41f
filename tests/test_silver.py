"""Raw files to gold, on files of the regulators' shapes; expected values derived by hand."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.operators import gold, quality
from tallgrass.plans import states
from tallgrass.schema import SILVER, SILVER_COLUMNS

NOW = dt.datetime(2026, 1, 2)


def xml(path, tag, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    body = "".join(f"<{tag}>" + "".join(f"<{k}>{v}</{k}>" for k, v in r.items()) + f"</{tag}>" for r in rows)
    path.write_text(f'<?xml version="1.0" encoding="utf-8"?><root>{body}</root>')


def feats(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"features": [{"attributes": r} for r in rows]}, indent=1))


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    tx = root / "tx"
    tx.mkdir()
    head = "}".join(states.TX_CYCLE)
    one = [f"01}}00001}}Lone Star}}2024}}{m}}}100}}Alpha Co}}Trend}}{o}}}{g}}}{c}}}{h}" for m, o, g, c, h in ((1, 1500, 200, 50, 25), (2, 1400, 190, 45, 22), (3, 1300, 180, 40, 20))]
    two = [f"02}}00002}}Big Bend}}2024}}{m}}}200}}Beta Co}}Shelf}}0}}{g}}}0}}0" for m, g in ((1, 5000), (2, 4800), (3, 4600))]
    (tx / "OG_LEASE_CYCLE.dsv").write_text("\n".join([head, *one, *two]), encoding="latin-1")
    (tx / "OG_WELL_COMPLETION.dsv").write_text("}".join(states.TX_COMPLETION) + "\nO}01}00001}001}301}00001}Midland}A\nG}02}00002}001}479}00001}Webb}A\n")
    (tx / "OG_OPERATOR_DW.dsv").write_text("OPERATOR_NO}OPERATOR_NAME\n100}Alpha Co\n")
    feats(tx / "wells/wells_batch_0001.json", [{"API": "30100001", "GIS_LAT83": 31.9, "GIS_LONG83": -102.1}])

    nm = root / "nm"
    wells = ((15, 100, 1001, "OIL", (800, 750, 700), (150, 140, 130), (200, 190, 180)), (25, 200, 1002, "GAS", (50, 45, 40), (3000, 2800, 2600), (100, 95, 90)))
    rows = []
    for county, pool, op, _, oil, gas, water in wells:
        for m in range(3):
            for kind, v in (("O", oil), ("G", gas), ("W", water)):
                rows.append(dict(zip(states.NM_PRODUCTION, (30, county, 1, pool, op, kind, v[m], 28, 2024, m + 1))))
    xml(nm / "production/wcproduction/wcproduction.xml", "wcproduction", rows)
    xml(nm / "production/ogrid/ogrid.xml", "ogrid", [{"ogrid_cde": 1001, "ogrid_nam": "Gamma"}, {"ogrid_cde": 1002, "ogrid_nam": "Delta"}])
    xml(nm / "production/pool/pool.xml", "pool", [{"pool_idn": 100, "pool_nam": "North"}])
    hist = [{"api_st_cde": 30, "api_cnty_cde": c, "api_well_idn": 1, "pool_idn": p, "wc_stat_cde": "A", "well_typ_cde": t, "well_nbr_idn": f"W {c}", "eff_dte": "2024-01-01"} for c, p, _, t, *_ in wells]
    xml(nm / "production/wchistory/wchistory.xml", "wchistory", hist)
    feats(nm / "wells/wells_batch_0001.json", [{"id": "3001500001", "well_name": "other", "county": "Eddy", "pool": "x", "latitude": 32.4, "longitude": -104.2}])

    ok = root / "ok"
    ok.mkdir()
    (ok / "rbdms.csv").write_text("API_NO,Well_Name,Oper,County,Oil,Gas,Days,Year,Month\n3501712345,Plains,Eps,017-Canadian,\"1,000\",20,31,2024,1\n3501712345,Plains,Eps,017-Canadian,900,-5,31,2024,2\nbad,x,y,z,1,1,1,2024,1\n")
    feats(ok / "wells/w.json", [{"api": "3501712345", "welltype": "OIL", "wellstatus": "AC", "sh_lat": 35.5, "sh_lon": -98}])
    return root


@pytest.fixture(scope="module")
def silver(spark, raw):
    tx = states.texas(spark, str(raw / "tx"), NOW)
    nm = states.new_mexico(spark, str(raw / "nm"), NOW)
    return tx.unionByName(nm).cache()


def test_expected_months(silver):
    monthly = gold.production_monthly(gold.staging(silver))
    assert silver.columns == SILVER_COLUMNS
    assert monthly.count() == 12
    got = {r.entity_key: r for r in monthly.groupBy("entity_key").agg(
        F.sort_array(F.collect_list(F.struct("production_date", "total_oil_bbl", "total_gas_mcf", "water_bbl"))).alias("m"),
        F.min("initial_gor").alias("gor"), F.min("vintage").alias("v"), F.min("county").alias("c"), F.min("basin").alias("b"), F.min("entity_type").alias("t")).collect()}
    want = {
        "42-301-00001": ([1550, 1445, 1340], [225, 212, 200], [None] * 3, 145.2, "MIDLAND", None),
        "42-479-00001": ([0, 0, 0], [5000, 4800, 4600], [None] * 3, None, "WEBB", None),
        "30-015-00001": ([800, 750, 700], [150, 140, 130], [200, 190, 180], 187.5, "EDDY", "Permian"),
        "30-025-00001": ([50, 45, 40], [3000, 2800, 2600], [100, 95, 90], 60000.0, "LEA", "Permian"),
    }
    for key, (oil, gas, water, gor, county, basin) in want.items():
        r = got[key]
        assert [x.total_oil_bbl for x in r.m] == oil and [x.total_gas_mcf for x in r.m] == gas and [x.water_bbl for x in r.m] == water
        assert (r.gor, r.v, r.c, r.b, r.t) == (gor, 2024, county, basin, "well")


def test_gold_tests_pass(silver):
    stg = gold.staging(silver)
    out = quality.summary(quality.gold_tests(stg, gold.production_monthly(stg), gold.decline_curve_inputs(stg))).collect()
    assert len(out) == 12 and all(r.passed for r in out)
    pct = gold.decline_curve_inputs(stg).filter("api_number = '30-015-00001'").orderBy("production_date").collect()
    assert [r.oil_rate_pct_of_initial for r in pct] == [100.0, 93.75, 87.5]


def test_enrichment(silver):
    r = silver.filter("api_number = '30-015-00001'").first()
    assert (r.well_name, r.field_name, r.operator, r.latitude) == ("W 15", "NORTH", "GAMMA", 32.4)
    assert silver.filter("api_number = '42-301-00001'").first().latitude == 31.9


def test_oklahoma(spark, raw):
    done = spark.createDataFrame([("3501700001", "First", "1", "Op", "017-CANADIAN", "OIL", "AC", "01/05/2020", "10", "0", None)],
        "API_Number string, Well_Name string, Well_Number string, Operator_Name string, County string, Well_Type string, Well_Status string, Test_Date string, "
        "Oil_BBL_Per_Day string, Gas_MCF_Per_Day string, Water_BBL_Per_Day string")
    rows = {(r.api_number, str(r.production_date)): r for r in states.oklahoma(spark, str(raw / "ok"), NOW, done).collect()}
    assert set(rows) == {("35-017-12345", "2024-01-01"), ("35-017-00001", "2020-01-01")}  # the negative month is invalid
    r = rows["35-017-12345", "2024-01-01"]
    assert (r.oil_bbl, r.county, r.basin, r.well_type, r.latitude) == (1000.0, "CANADIAN", "Anadarko", "OIL", 35.5)
    assert rows["35-017-00001", "2020-01-01"].gas_mcf is None


def test_texas_rejects_bad_batches(spark, raw, tmp_path):
    import shutil

    shutil.copytree(raw / "tx", tmp_path / "tx")
    p = tmp_path / "tx/OG_LEASE_CYCLE.dsv"
    p.write_text(p.read_text().replace("}1500}", "}-1500}"))
    with pytest.raises(quality.BatchRejected):
        states.texas(spark, str(tmp_path / "tx"), NOW)


def test_missing_files_give_no_rows(spark, tmp_path):
    assert states.texas(spark, str(tmp_path), NOW).count() == 0
    assert states.new_mexico(spark, str(tmp_path), NOW).count() == 0


def test_write_and_read(spark, silver, tmp_path):
    states.write_silver(silver, str(tmp_path / "s"))
    states.write_silver(silver.filter("state = 'TX'").limit(2), str(tmp_path / "s"))
    back = states.read_silver(spark, str(tmp_path / "s"))
    assert back.groupBy("state").count().orderBy("state").collect() == [("NM", 6), ("TX", 2)]
    assert [f.dataType for f in back.schema] == [f.dataType for f in SILVER]


def test_utf16_xml(spark, tmp_path):
    from tallgrass.sources import files

    p = tmp_path / "ogrid.xml"
    p.write_bytes("﻿<root><ogrid><ogrid_cde>1</ogrid_cde></ogrid></root>".encode("utf-16-le"))
    assert files.encoding_of(spark, str(p)) == "UTF-16LE"
    assert files.records(spark, [str(p)], "ogrid", ["ogrid_cde"], "UTF-16LE").collect()[0][0] == "1"


def test_feature_service(spark):
    from tallgrass.sources import features_api

    features_api.register(spark)
    df = spark.read.format("features").options(url="x", pages=3, page_size=2, fields="api,lat", fetch="tallgrass.sources.features_api:sample_page").load()
    assert sorted(r.api for r in df.collect()) == ["0", "1", "2", "3", "4"]


def capped_page(url, offset, count):
    """A service of seven wells that sends at most two a page, whatever is asked."""
    rows = [{"attributes": {"api": i}} for i in range(offset, min(7, offset + min(count, 2)))]
    return {"features": rows} | ({"exceededTransferLimit": True} if offset + len(rows) < 7 else {})


def stuck_page(url, offset, count):
    """A service that says there is more but sends nothing."""
    return {"features": [], "exceededTransferLimit": True}


@pytest.mark.parametrize("fetch", ["sample", "capped"])
@pytest.mark.parametrize("pages", [None, 1, 2, 9])
def test_feature_service_without_known_page_count(pages, fetch):
    """``pages`` is a plan only: every well comes once, with fewer pages planned than there are and with short pages."""
    from tallgrass.sources import features_api

    name, n = ("tallgrass.sources.features_api:sample_page", 5) if fetch == "sample" else (f"{__name__}:capped_page", 7)
    options = {"url": "x", "page_size": "3", "fields": "api", "fetch": name} | ({"pages": str(pages)} if pages else {})
    reader = features_api.Reader(options, T.StructType([T.StructField("api", T.StringType())]))
    assert sorted(r[0] for p in reader.partitions() for r in reader.read(p)) == [str(i) for i in range(n)]


def test_feature_service_that_sends_nothing_more():
    from tallgrass.sources import features_api

    options = {"url": "x", "pages": "1", "page_size": "3", "fields": "api", "fetch": f"{__name__}:stuck_page"}
    reader = features_api.Reader(options, T.StructType([T.StructField("api", T.StringType())]))
    with pytest.raises(OSError):
        list(reader.read(reader.partitions()[0]))


def test_streamed_silver(spark, silver, tmp_path):
    """A batch rewrites only the months it brings; older snapshots stay until they are vacuumed."""
    from tallgrass.sources.store import Store
    from tallgrass.streaming.silver import current, ingest, vacuum

    src, store, cp = (str(tmp_path / x) for x in ("in", "store", "cp"))
    assert current(spark, store).count() == 0
    silver.coalesce(1).write.parquet(src)
    ingest(spark, src, store, cp).awaitTermination()
    new = silver.filter("production_date = '2024-02-01' and county = 'EDDY'").withColumns({"oil_bbl": F.lit(1.0), "ingested_at": F.lit("2027-01-01").cast("timestamp")})
    new.unionByName(silver.limit(1).withColumns({"entity_type": F.lit("unit"), "production_date": F.lit("2031-01-01").cast("date")})).coalesce(1).write.mode("append").parquet(src)
    ingest(spark, src, store, cp).awaitTermination()
    out = current(spark, store)
    assert out.count() == 12 and out.filter("oil_bbl = 1").count() == 1 and out.columns == SILVER_COLUMNS
    assert current(spark, store, 0).filter("oil_bbl = 1").count() == 0
    first, second = (Store(spark, store).snapshot(n).parts("silver") for n in (0, 1))
    assert {k for k in second if first.get(k) != second[k]} == {"NM-2024-02"}
    assert vacuum(spark, store) == [] and current(spark, store).count() == 12 and Store(spark, store).numbers() == [1]


def test_streams_replayed_and_restarted(spark, silver, tmp_path):
    """A batch that runs again, and a stream that starts again with a new checkpoint, leave the same rows; so do rows that come through another stream."""
    from tallgrass.sources.store import Store
    from tallgrass.streaming.silver import current, ingest, merge

    src, more, store = (str(tmp_path / x) for x in ("in", "more", "store"))
    rows = lambda: sorted(current(spark, store).drop("ingested_at").collect(), key=repr)
    silver.coalesce(1).write.parquet(src)
    ingest(spark, src, store, str(tmp_path / "a")).awaitTermination()
    want = rows()
    ingest(spark, src, store, str(tmp_path / "b")).awaitTermination()
    assert rows() == want and len(Store(spark, store).snapshot().sources) == 2
    late = silver.filter("county = 'EDDY'").withColumns({"oil_bbl": F.lit(7.0), "ingested_at": F.lit("2027-01-01").cast("timestamp")})
    late.coalesce(1).write.parquet(more)
    ingest(spark, more, store, str(tmp_path / "c")).awaitTermination()
    assert len(rows()) == len(want) and sum(r.oil_bbl == 7 for r in rows()) == late.count()
    (stream,) = (k for k, n in Store(spark, store).snapshot().sources.items() if Store(spark, store).snapshot(1).sources.get(k) is None)
    before = Store(spark, store).numbers()
    merge(Store(spark, store), late.withColumn("oil_bbl", F.lit(8.0)), (stream, 0))
    assert Store(spark, store).numbers() == before and not any(r.oil_bbl == 8 for r in rows())
