"""Reserves operations from a registered well to booked reserves."""

import numpy as np
from pyspark.sql import functions as F
from test_layers import silver

from tallgrass import schema
from tallgrass.operators import economics, gold, reserves


def test_from_well_to_booking(spark):
    monthly = gold.production_monthly(gold.staging(silver(spark, 24))).cache()
    t = reserves.tables(spark)
    key = "42-001-00001"
    wells = reserves.register_well(reserves.register_well(t["properties"], monthly, key), monthly, key)
    (w,) = reserves.get_well(wells, key).collect()
    assert (w.api_number, w.state, str(w.first_prod_date)) == (key, "TX", "2020-01-01") and schema.broken_keys(wells, "properties").count() == 0
    decks = reserves.set_price_deck(reserves.set_price_deck(t["price_decks"], "d", "D", [(1, 1)] * 5), "d", "D", [(60, 2), (70, 3)])
    assert [(r.month_index, r.oil_price, r.oil_differential) for r in reserves.get_price_deck(decks, "d").collect()] == [(1, 60.0, 0.0), (2, 70.0, 0.0)]
    cases = reserves.fit_decline(t["cases"], monthly, key, "c", "base", loe_monthly=2000.0, nri=0.8)
    assert reserves.fit_decline(cases, monthly.limit(0), key, "x", "none").count() == 1
    cases, series = reserves.generate_forecast(cases, t["forecast_series"], reserves.set_price_deck(decks, "d", "D", [(70, 3)]), "c", "d", 240)
    (c,) = reserves.list_cases(cases, key).collect()
    terms = economics.Terms(nri=0.8, oil_price=70.0, gas_price=3.0, loe_monthly=2000.0)
    want = economics.evaluate(monthly.filter(F.col("entity_key") == key), ["entity_key"], "production_date", "total_oil_bbl", "total_gas_mcf", terms, months=240).first()
    assert np.allclose([c.pv10, c.npv, c.eur_oil_bbl, c.eur_gas_mcf], [want.pv10, want.npv, want.eur_oil_bbl, want.eur_gas_mcf]) and c.price_deck_id == "d"
    assert series.count() == 240 and series.columns == [f.split()[0] for f in schema.RESERVES["forecast_series"].split(", ")] and schema.broken_keys(series, "forecast_series").count() == 0
    booked, rest = reserves.book_reserves(cases, monthly, "c", "PDP")
    made = monthly.filter(F.col("entity_key") == key).agg(F.sum("total_oil_bbl")).first()[0]
    assert booked.first().reserve_category == "PDP" and np.isclose(rest.first().remaining_oil_bbl, max(0, c.eur_oil_bbl - made))


def test_migration_and_keys(spark):
    old = spark.createDataFrame([("a", None), ("b", ""), ("b", "2"), (None, "3")], "node_id string, schema_version string")
    new = schema.migrated(old, "node_id string, schema_version string, is_valid boolean", {"schema_version": "1.0", "is_valid": True})
    assert sorted(map(tuple, new.fillna("").collect())) == [("", "3", True), ("a", "1.0", True), ("b", "1.0", True), ("b", "2", True)]
    assert sorted((r.node_id or "", r.n_rows) for r in schema.broken_keys(new, "embeddings").collect()) == [("", 1), ("b", 2)]
