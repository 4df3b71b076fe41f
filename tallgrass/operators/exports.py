"""Report extracts over the gold tables. Top-k lists are joined back once, never queried key by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import latest


def latest_year(monthly: DataFrame) -> Column:
    """The last production year, as a scalar subquery."""
    return monthly.agg(F.max("production_year").alias("y")).select("y").scalar()


def top(df: DataFrame, keys: list[str], measure: Column, k: int) -> DataFrame:
    """The ``k`` keys with the greatest measure (ties: smaller keys)."""
    ranked = df.groupBy(*keys).agg(measure.alias("_m")).orderBy(F.desc("_m"), *keys).limit(k)
    return F.broadcast(ranked.select(*keys))  # at most k rows


def well_history(monthly: DataFrame, k: int = 5) -> DataFrame:
    """Monthly history of the wells with the greatest cumulative oil."""
    wells = monthly.filter((F.col("entity_type") == "well") & F.col("cumulative_oil_bbl").isNotNull())
    best = top(wells, ["entity_key"], F.max("cumulative_oil_bbl"), k)
    return monthly.join(best, "entity_key", "left_semi").select(
        "entity_key", "state", "well_name", "operator", "county", F.col("production_date").cast("string").alias("production_date"),
        "reported_month_index", "total_oil_bbl", "total_gas_mcf", "cumulative_oil_bbl", "cumulative_gas_mcf",
    )


def _yearly(df: DataFrame, keys: list[str], water: bool = False) -> DataFrame:
    sums = [F.sum("total_oil_bbl").alias("oil"), F.sum("total_gas_mcf").alias("gas")] + ([F.sum("water_bbl").alias("water")] if water else [])
    return df.groupBy(*keys).agg(*sums, F.count("*").alias("entities"))


def top_counties(monthly: DataFrame, k: int = 12, years: int = 4) -> DataFrame:
    """Yearly totals, over the last years, of the counties with most oil in the last one."""
    last = latest_year(monthly)
    best = top(monthly.filter((F.col("production_year") == last) & F.col("county").isNotNull()), ["county", "state"], F.sum("total_oil_bbl"), k)
    recent = monthly.filter(F.col("production_year") >= last - (years - 1))
    return _yearly(recent.join(best, ["county", "state"], "left_semi"), ["county", "state", "production_year"], True)


def top_dimension(monthly: DataFrame, dimension: str, more: list[str], k: int = 10, years: int = 8) -> DataFrame:
    """Yearly totals of the operators or fields with most oil over the last years."""
    recent = monthly.filter(F.col("production_year") >= latest_year(monthly) - (years - 1))
    best = top(recent.filter(F.col(dimension).isNotNull()), [dimension], F.sum("total_oil_bbl"), k)
    return _yearly(recent.join(best, dimension, "left_semi"), [dimension, *more, "state", "production_year"])


def decline_curves(decline: DataFrame, k: int = 5, months: int = 60) -> DataFrame:
    """First months of the wells with the greatest initial oil rate."""
    best = top(decline.filter("initial_oil_rate > 0"), ["api_number", "state"], F.max("initial_oil_rate"), k)
    return decline.filter(F.col("months_on_production") <= months).join(best, ["api_number", "state"], "left_semi").select(
        "api_number", "state", "well_name", "county", "field_name", "months_on_production", "total_oil_bbl", "total_gas_mcf",
        "initial_oil_rate", "oil_rate_pct_of_initial", "cumulative_oil",
    )


def state_totals(monthly: DataFrame) -> DataFrame:
    """Oil and gas by state and year."""
    return monthly.groupBy("state", "production_year").agg(F.sum("total_oil_bbl").alias("oil"), F.sum("total_gas_mcf").alias("gas"))


def county_map(monthly: DataFrame, years: int = 3) -> DataFrame:
    """Totals by county over the last years, at the mean place of its reports."""
    recent = monthly.filter((F.col("production_year") >= latest_year(monthly) - (years - 1)) & F.col("county").isNotNull())
    totals = recent.groupBy("county", "state").agg(
        F.sum("total_oil_bbl").alias("total_oil"), F.sum("total_gas_mcf").alias("total_gas"), F.sum("water_bbl").alias("total_water"), F.count("*").alias("total_entities")
    )
    placed = monthly.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    places = placed.groupBy("county", "state").agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lng"))
    return totals.join(places, ["county", "state"], "left")


def county_years(monthly: DataFrame) -> DataFrame:
    """Totals by county and year."""
    return _yearly(monthly.filter(F.col("county").isNotNull()), ["county", "state", "production_year"])


def state_months(monthly: DataFrame, years: int = 8) -> DataFrame:
    """Totals by state and month over the last years."""
    recent = monthly.filter(F.col("production_year") >= latest_year(monthly) - (years - 1))
    by = recent.groupBy("state", F.col("production_date").cast("string").alias("production_date"))
    return by.agg(F.sum("total_oil_bbl").alias("oil"), F.sum("total_gas_mcf").alias("gas"))


def latest_wells(monthly: DataFrame) -> DataFrame:
    """Each placed well's last month, shortened for a map."""

    def text(c: str, n: int | None = 30) -> Column:
        return F.coalesce(F.substring(c, 1, n) if n else F.col(c), F.lit(""))

    def whole(c: str) -> Column:
        return F.round(F.coalesce(c, F.lit(0.0))).cast("int")

    placed = monthly.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col("entity_type") == "well"))
    last = latest(placed, ["entity_key", "state"], F.desc("production_date"))
    return last.select(
        F.col("entity_key").alias("id"), "state", text("well_name").alias("name"), text("operator").alias("op"), text("county", None).alias("county"),
        F.round("latitude", 4).alias("lat"), F.round("longitude", 4).alias("lng"), text("well_type", None).alias("type"), text("basin").alias("basin"),
        text("field_name").alias("field"), text("well_status", None).alias("status"), F.coalesce("vintage", F.lit(0)).alias("vintage"),
        whole("initial_gor").alias("gor"), whole("cumulative_oil_bbl").alias("oil"), whole("cumulative_gas_mcf").alias("gas"),
        whole("cumulative_water_bbl").alias("water"), F.coalesce("reported_month_index", F.lit(0)).alias("months"),
    )


def as_records(df: DataFrame, name: str) -> DataFrame:
    """One row (name, json): the rows as a JSON array. For extracts of bounded size."""
    return df.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*df.columns)))).alias("json")).select(F.lit(name).alias("name"), "json")


def as_columns(df: DataFrame, order: str) -> DataFrame:
    """One row of arrays, one per column, all in the order of ``order``. For extracts of bounded size."""
    rows = df.agg(F.array_sort(F.collect_list(F.struct(order, *(c for c in df.columns if c != order)))).alias("r"))
    return rows.select(F.size("r").alias("n"), *(F.col(f"r.{c}").alias(c) for c in df.columns))


def well_series(monthly: DataFrame, well: str) -> DataFrame:
    """One row of arrays: a well's months in order."""
    one = monthly.filter(F.col("entity_key") == well)
    return as_columns(one.select(F.col("production_date").cast("string").alias("production_date"), "total_oil_bbl", "total_gas_mcf", "water_bbl"), "production_date")
