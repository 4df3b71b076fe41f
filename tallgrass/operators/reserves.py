"""Operations on the reserves tables (``schema.RESERVES``): wells, price decks, cases, forecasts. Each returns the table's new rows or state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RESERVES, migrated
from . import decline
from .papers import upsert


def register_well(properties: DataFrame, monthly: DataFrame, entity_key: str) -> DataFrame:
    """``properties`` with the well's header as its latest month has it; one that is there already is replaced."""
    of = monthly.filter(F.col("entity_key") == entity_key)
    head = ("api_number", "well_name", "operator", "state", "county", "field_name", "basin", "well_type")
    last = of.groupBy("entity_key").agg(F.max_by(F.struct(*head), "production_date").alias("h"), F.min("production_date").alias("first_prod_date"))
    now = F.current_timestamp()
    new = last.select(F.col("entity_key").alias("property_id"), "h.*", "first_prod_date", now.alias("created_at"), now.alias("updated_at"))
    return upsert(properties, migrated(new, RESERVES["properties"]), "property_id")


def get_well(properties: DataFrame, property_id: str) -> DataFrame:
    """One property."""
    return properties.filter(F.col("property_id") == property_id)


def set_price_deck(decks: DataFrame, deck_id: str, name: str, prices: Sequence[tuple[float, float]]) -> DataFrame:
    """``decks`` with these monthly (oil, gas) prices in place of the deck's."""
    rows = [(deck_id, name, i, float(o), float(g)) for i, (o, g) in enumerate(prices, 1)]
    new = decks.sparkSession.createDataFrame(rows, "price_deck_id string, deck_name string, month_index int, oil_price double, gas_price double")
    new = migrated(new.withColumn("created_at", F.current_timestamp()), RESERVES["price_decks"], {"oil_differential": 0.0, "gas_differential": 0.0})
    return decks.filter(F.col("price_deck_id") != deck_id).unionByName(new)


def get_price_deck(decks: DataFrame, deck_id: str) -> DataFrame:
    """A deck's months in order."""
    return decks.filter(F.col("price_deck_id") == deck_id).orderBy("month_index")


def fit_decline(cases: DataFrame, monthly: DataFrame, entity_key: str, case_id: str, name: str, model: str = "hyperbolic", **terms) -> DataFrame:
    """``cases`` with a case fitted to the well's oil, or the case replaced; ``terms`` sets further columns. A well that cannot be fitted adds none."""
    rows = monthly.filter(F.col("entity_key") == entity_key)
    fit = decline.fit_wells(rows, ["entity_key"], "production_date", "total_oil_bbl", model).filter("status = 'fitted'")
    at = rows.groupBy("entity_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("production_date", "total_gas_mcf"))), lambda x: x["total_gas_mcf"]).alias("gas"))
    new = fit.join(at, "entity_key").select(
        F.lit(case_id).alias("case_id"), F.col("entity_key").alias("property_id"), F.lit(name).alias("case_name"), F.lit(model).alias("decline_model"), F.col("qi").alias("qi_oil"),
        F.try_element_at("gas", F.col("peak_index") + 1).alias("qi_gas"), "di", "b", "d_min", F.current_timestamp().alias("created_at"),
    )
    return upsert(cases, migrated(new.withColumns({k: F.lit(v) for k, v in terms.items()}), RESERVES["cases"]), "case_id")


def generate_forecast(cases: DataFrame, series: DataFrame, decks: DataFrame, case_id: str, deck_id: str, months: int = 600) -> tuple[DataFrame, DataFrame]:
    """(``cases``, ``series``) after the case's forecast at the deck's prices; the deck's last month holds on. Costs, interest and
    rates are the case's own (net revenue interest 1, tax 0.046 and discount 0.1 unless set)."""
    case = cases.filter(F.col("case_id") == case_id)
    flow = decline.forecast(case, months).join(F.broadcast(case.select("case_id", "loe_monthly", "nri", "tax_rate", "discount_rate")), "case_id")
    deck = decks.filter(F.col("price_deck_id") == deck_id)
    last = deck.agg(F.max("month_index").alias("last"))  # one row
    flow = flow.crossJoin(last).withColumn("at", F.least("month_index", "last")).join(F.broadcast(deck.select(F.col("month_index").alias("at"), "oil_price", "gas_price", "oil_differential", "gas_differential")), "at", "left")
    gross = F.col("oil_bbl") * (F.col("oil_price") - F.col("oil_differential")) + F.col("gas_mcf") * (F.col("gas_price") - F.col("gas_differential"))
    flow = flow.withColumn("gross_revenue", gross).withColumn("net_revenue", F.col("gross_revenue") * F.coalesce("nri", F.lit(1.0)))
    flow = flow.withColumns({"tax": F.col("net_revenue") * F.coalesce("tax_rate", F.lit(0.046)), "opex": F.coalesce("loe_monthly", F.lit(0.0))})
    flow = flow.withColumn("net_cash_flow", F.col("net_revenue") - F.col("tax") - F.col("opex"))
    flow = flow.withColumn("discount_factor", F.pow(1 + F.coalesce("discount_rate", F.lit(0.1)), -F.col("month_index") / 12))
    flow = flow.withColumn("discounted_cash_flow", F.col("net_cash_flow") * F.col("discount_factor"))
    limit = flow.agg(F.min(F.when(F.col("net_cash_flow") <= 0, F.col("month_index"))).alias("limit_month"))
    flow = flow.crossJoin(limit).withColumn("is_economic_limit", F.coalesce(F.col("month_index") == F.col("limit_month"), F.lit(False)))  # one row
    new = migrated(flow, RESERVES["forecast_series"])
    life = flow.filter(F.col("month_index") <= F.coalesce("limit_month", F.col("month_index")))
    value = life.groupBy("case_id").agg(
        F.max_by("cumulative_oil_bbl", "month_index").alias("eur_oil_bbl"), F.max_by("cumulative_gas_mcf", "month_index").alias("eur_gas_mcf"),
        F.sum("discounted_cash_flow").alias("pv10"), F.sum("net_cash_flow").alias("npv"), F.first("limit_month").alias("economic_limit_month"),
    )
    done = case.drop("eur_oil_bbl", "eur_gas_mcf", "pv10", "npv", "economic_limit_month", "price_deck_id").join(value, "case_id").withColumn("price_deck_id", F.lit(deck_id))
    return upsert(cases, migrated(done, RESERVES["cases"]), "case_id"), series.filter(F.col("case_id") != case_id).unionByName(new)


def book_reserves(cases: DataFrame, monthly: DataFrame, case_id: str, category: str) -> tuple[DataFrame, DataFrame]:
    """(``cases`` with the case's category set, its remaining oil and gas: EUR less what was produced)."""
    booked = cases.withColumn("reserve_category", F.when(F.col("case_id") == case_id, F.lit(category)).otherwise(F.col("reserve_category")))
    made = monthly.groupBy(F.col("entity_key").alias("property_id")).agg(F.sum("total_oil_bbl").alias("oil"), F.sum("total_gas_mcf").alias("gas"))
    left = cases.filter(F.col("case_id") == case_id).join(made, "property_id", "left")
    rest = lambda eur, x: F.greatest(F.col(eur) - F.coalesce(x, F.lit(0.0)), F.lit(0.0))
    return booked, left.select("case_id", rest("eur_oil_bbl", "oil").alias("remaining_oil_bbl"), rest("eur_gas_mcf", "gas").alias("remaining_gas_mcf"))


def list_cases(cases: DataFrame, property_id: str) -> DataFrame:
    """All cases of a well, by name."""
    return cases.filter(F.col("property_id") == property_id).orderBy("case_name", "case_id")


def tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Empty reserves tables."""
    return {name: spark.createDataFrame([], ddl) for name, ddl in RESERVES.items()}
