import datetime as dt

from pyspark.sql import functions as F

from tallgrass.operators import dedup, gold, quality
from tallgrass.schema import SILVER, conform

D = dt.date(2024, 1, 1)


def rows(spark, *changes):
    base = {"state": "NM", "entity_type": "well", "api_number": "30-015-12345", "production_date": D, "oil_bbl": 1000.0, "gas_mcf": 500.0, "water_bbl": 200.0, "days_produced": 30, "ingested_at": dt.datetime(2024, 3, 1)}
    data = [{**base, **c} for c in changes]
    return spark.createDataFrame([tuple(d.get(f.name) for f in SILVER) for d in data], "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in SILVER) + ">")


def test_rules(spark):
    df = rows(spark, {}, {"oil_bbl": -1.0}, {"days_produced": 32}, {"production_date": None}, {"api_number": "x"}, {"state": None}, {"entity_type": "Well"}, {"entity_type": "lease"}, {"oil_bbl": None, "api_number": None})
    bad = {(r.check_name, r.column_name): r.bad_row_count for r in quality.validate_batch(df).collect()}
    assert {k: v for k, v in bad.items() if v} == {
        ("non_negative_volumes", "oil_bbl"): 1, ("days_produced_range", "days_produced"): 1, ("production_date_range", "production_date"): 1, ("api_number_format", "api_number"): 1,
        ("state_values", "state"): 1, ("entity_type_values", "entity_type"): 1, ("lease_fields_consistency", "lease_number"): 1,
    }
    assert quality.valid_rows(df).count() == 2
    assert {r.column_name for r in quality.bad_samples(df).collect()} >= {"oil_bbl", "api_number"}


def test_missing_columns_pass(spark):
    assert quality.validate_batch(spark.createDataFrame([(1.0,)], "oil_bbl double")).filter("not passed").count() == 0


def test_empty_batch(spark):
    assert {r.pass_rate for r in quality.validate_batch(rows(spark, {}).limit(0)).collect()} == {1.0}
    assert quality.retention(0, 0) and quality.retention(10, 9) and not quality.retention(10, 8)


def test_latest_wins(spark):
    lease = {"entity_type": "lease", "api_number": None, "lease_number": "1", "district": "08", "state": "TX"}
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    df = rows(spark, {"ingested_at": old, "oil_bbl": 1.0}, {"ingested_at": new, "oil_bbl": 2.0}, {"ingested_at": None, "oil_bbl": 3.0}, {**lease, "ingested_at": old, "oil_bbl": 4.0}, {**lease, "ingested_at": new, "oil_bbl": 5.0}, {**lease, "district": None, "oil_bbl": 6.0}, {"entity_type": "unit"})
    assert sorted(r.oil_bbl for r in dedup.deduplicate(df).collect()) == [2.0, 5.0, 6.0]
    assert dedup.unkeyed(df).count() == 1


def test_entity_types(spark):
    leases = spark.createDataFrame([("1 ", "08", None), ("2", "08", None), ("3", "08", None)], "lease_number string, district string, api_number string")
    comp = spark.createDataFrame([("1", "08", "a"), ("1", "08", "a"), ("2", "08", "a"), ("2", "08", "b"), ("3", "08", None)], "LEASE_NO string, DISTRICT_NO string, API_NO string")
    got = {r.lease_number.strip(): (r.entity_type, r.api_number) for r in dedup.assign_entity_type(leases, comp).collect()}
    assert got == {"1": ("well", "a"), "2": ("lease", None), "3": ("lease", None)}


def test_reconcile(spark):
    s = spark.createDataFrame([("a", 100.0), ("b", 100.0), (None, 5.0)], "k string, v double")
    g = spark.createDataFrame([("a", 100.5), ("b", 90.0), (None, 5.0), ("c", 1.0)], "k string, v double")
    assert {(r.k, r.status) for r in quality.reconcile_volumes(s, g, ["k"], ["v"]).collect()} == {("b", "both"), ("c", "gold_only")}


def test_gaps(spark):
    dates = [dt.date(2024, m, 1) for m in (1, 2, 5, 6)]
    df = spark.createDataFrame([("w", "TX", d) for d in dates] + [(None, "TX", dates[0])], "entity_key string, state string, production_date date")
    (r,) = quality.month_gaps(df).collect()
    assert (r.gap_count, r.max_gap_days) == (1, 90)


def test_gold_tests_find_faults(spark):
    stg = gold.staging(conform(rows(spark, {}, {"oil_bbl": -5.0, "api_number": "30-015-00002"}, {"api_number": None}, {"production_date": dt.date(2999, 1, 1)})))
    monthly = gold.production_monthly(stg)
    out = {r.test_name: r.violations for r in quality.summary(quality.gold_tests(stg, monthly.withColumn("reported_month_index", F.col("reported_month_index") + 1), gold.decline_curve_inputs(stg))).collect()}
    assert out["negative_volume"] == 1 and out["null_entity_key"] == 1 and out["future_date"] == 1 and out["month_index_sequential"] == 3


def test_generic_tests(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("z", None)], "s string, n int")
    got = {r.test_name: (r.failures, r.passed) for r in quality.generic_tests(df, ["s", "n"], {"s": ["a", "b"], "n": [1, 2]}, [["s", "n"], ["n"]]).collect()}
    assert got == {"not_null_s": (1, False), "not_null_n": (1, False), "accepted_values_s": (1, False), "accepted_values_n": (0, True), "unique_s_n": (1, False), "unique_n": (1, False)}
    assert all(r.passed for r in quality.generic_tests(df.limit(0), ["s"], {"s": ["a"]}, [["s"]]).collect())
