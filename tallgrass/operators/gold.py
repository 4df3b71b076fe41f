"""Silver to gold: staging, the monthly fact table, and decline-curve inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..sources.store import Store

IDENTITY = ("state", "entity_type", "api_number", "lease_number", "district")
DESCRIPTIVE = ("well_name", "operator", "county", "field_name", "basin", "well_type", "well_status")
PLACE = ("latitude", "longitude")


def entity_key() -> Column:
    """Wells go by API number, leases by district and number; NULL if a part is missing."""
    lease = F.concat(F.lit("TX-LEASE:"), F.col("district"), F.lit("-"), F.col("lease_number"))
    return F.when(F.col("entity_type") == "well", F.col("api_number")).when(F.col("entity_type") == "lease", lease)


def staging(silver: DataFrame) -> DataFrame:
    """Silver with entity_key, year, month and totals that count NULL as 0."""
    zero = F.lit(0.0)
    return silver.withColumns(
        {
            "entity_key": entity_key(),
            "production_year": F.year("production_date"),
            "production_month": F.month("production_date"),
            "total_oil_bbl": F.coalesce("oil_bbl", zero) + F.coalesce("condensate_bbl", zero),
            "total_gas_mcf": F.coalesce("gas_mcf", zero) + F.coalesce("casinghead_gas_mcf", zero),
        }
    )


def running(value: str, over: WindowSpec) -> Column:
    """Sum from the first row to this one."""
    return F.sum(value).over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def ratio(part: Column, whole: Column, scale: float, digits: int) -> Column:
    """``part / whole * scale``, rounded; NULL unless whole is positive."""
    return F.when(whole > 0, F.round(part / whole * scale, digits))


def production_monthly(stg: DataFrame) -> DataFrame:
    """One row per entity and month: indices, vintage, gas-oil ratio of the peaks, cumulatives.

    All windows share one partitioning, so the table takes one exchange and one sort. A row without entity_key is an entity by itself, so that
    such rows do not meet in one task.
    """
    stg = stg.withColumn("_alone", F.when(F.col("entity_key").isNull(), F.monotonically_increasing_id()))
    entity = Window.partitionBy("entity_key", "state", "_alone")
    months = entity.orderBy("production_date")
    first = F.min("production_date").over(entity)
    producing = F.when((F.col("total_oil_bbl") > 0) | (F.col("total_gas_mcf") > 0), F.col("production_date"))
    peak_oil, peak_gas = (F.max(c).over(entity) for c in ("total_oil_bbl", "total_gas_mcf"))
    since = (F.year("production_date") - F.year("_first")) * 12 + F.month("production_date") - F.month("_first") + 1
    base = stg.withColumns({"_first": first, "_oil": peak_oil, "_gas": peak_gas, "_began": F.min(producing).over(entity)})
    return base.select(
        "entity_key", *IDENTITY, *DESCRIPTIVE, *PLACE, "production_date", "production_year", "production_month",
        F.row_number().over(months).cast("long").alias("reported_month_index"),
        since.cast("long").alias("calendar_months_on_production"),
        F.year("_began").alias("vintage"),
        ratio(F.col("_gas"), F.col("_oil"), 1000, 1).alias("initial_gor"),
        "total_oil_bbl", "total_gas_mcf", "oil_bbl", "condensate_bbl", "gas_mcf", "casinghead_gas_mcf", "water_bbl", "days_produced",
        running("total_oil_bbl", months).alias("cumulative_oil_bbl"),
        running("total_gas_mcf", months).alias("cumulative_gas_mcf"),
        running("water_bbl", months).alias("cumulative_water_bbl"),
        "source_file", "ingested_at",
    )


def decline_curve_inputs(stg: DataFrame) -> DataFrame:
    """Producing months of wells, with initial rates, rates in percent of them, and cumulatives."""
    well = Window.partitionBy("api_number", "state").orderBy("production_date")
    whole = well.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    keep = (F.col("entity_type") == "well") & F.col("api_number").isNotNull() & ((F.col("total_oil_bbl") > 0) | (F.col("total_gas_mcf") > 0))
    rows = stg.filter(keep).withColumns(
        {
            "months_on_production": F.row_number().over(well).cast("long"),
            "initial_oil_rate": F.first("total_oil_bbl").over(whole),
            "initial_gas_rate": F.first("total_gas_mcf").over(whole),
            "cumulative_oil": running("total_oil_bbl", well),
            "cumulative_gas": running("total_gas_mcf", well),
            "cumulative_water": running("water_bbl", well),
        }
    )
    return rows.select(
        "entity_key", "api_number", "state", *DESCRIPTIVE, *PLACE, "production_date", "production_year", "production_month",
        "months_on_production", "total_oil_bbl", "total_gas_mcf", "water_bbl", "days_produced", "initial_oil_rate", "initial_gas_rate",
        ratio(F.col("total_oil_bbl"), F.col("initial_oil_rate"), 100, 2).alias("oil_rate_pct_of_initial"),
        "cumulative_oil", "cumulative_gas", "cumulative_water",
    )


def rollup(monthly: DataFrame, dimension: str, *more: str) -> DataFrame:
    """Monthly totals by a dimension (county, operator, field_name) and state; rows without it stay out.

    Entities are summed first, then counted: no row is expanded for the distinct counts, and a dimension that holds a large share
    of the rows reaches the second step as one row an entity, itself summed before it is sent.
    """
    sums = ("total_oil_bbl", "total_gas_mcf", "oil_bbl", "condensate_bbl", "gas_mcf", "casinghead_gas_mcf", "water_bbl")
    dims = (dimension, "state", *more, "production_date")
    kind = F.col("entity_type")
    entities = monthly.filter(F.col(dimension).isNotNull()).groupBy(*dims, "entity_key").agg(
        F.max(F.coalesce(kind == "well", F.lit(False))).alias("well"), F.max(F.coalesce(kind == "lease", F.lit(False))).alias("lease"), *(F.sum(c).alias(c) for c in sums)
    )
    there = F.col("entity_key").isNotNull()
    return entities.groupBy(*dims).agg(
        F.count("entity_key").alias("entity_count"),
        F.count_if(there & F.col("well")).alias("well_count"),
        F.count_if(there & F.col("lease")).alias("lease_count"),
        *(F.sum(c).alias(c) for c in sums),
    )


# ---------------------------------------------------------------- build

FACTS = ("production_monthly", "decline_curve_inputs")


def build(silver: DataFrame, root: str) -> dict[str, DataFrame]:
    """Create or replace all gold tables under ``root``, and views of the same names over them and the staging view.

    Facts are partitioned by state. All tables become visible with one commit of the store: until then, and whenever a build breaks
    off, readers find the tables of the last build; a table that was opened before stays readable. An empty silver table gives empty
    tables of the same columns.
    """
    spark = silver.sparkSession
    stg = staging(silver)
    stg.createOrReplaceTempView("stg_production")
    made = {"production_monthly": production_monthly(stg), "decline_curve_inputs": decline_curve_inputs(stg)}
    made |= {"schema_registry": schema_registry(spark), "schema_registry_columns": schema_registry_columns(spark, made)}
    store = Store(spark, root)
    base = store.snapshot()
    changes = {name: store.write(name, df, partitioned=("state",) if name in FACTS else ()) for name, df in made.items()}
    store.commit(base, changes)
    return opened(spark, root)


def opened(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The gold tables of the last build, or of snapshot ``number``, and views of the same names over them. They stay as they are through later builds."""
    store = Store(spark, root)
    at = store.snapshot(number)
    out = {name: store.read(name, at) for name in at.tables}
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out


def detail_measures(stg: DataFrame) -> DataFrame:
    """Daily rates, gas-oil ratio and water cut of each row of staging; NULL where the divisor is 0 or not reported."""
    oil, gas, water, days = F.col("total_oil_bbl"), F.col("total_gas_mcf"), F.col("water_bbl"), F.col("days_produced")

    def over(x: Column, y: Column) -> Column:
        return F.try_divide(x, y.cast("double"))

    return stg.withColumns(
        {
            "oil_rate_bbl_per_day": over(oil, days),
            "gas_rate_mcf_per_day": over(gas, days),
            "gor": over(gas, oil) * 1000,
            "water_cut_pct": over(water, water + oil) * 100,
        }
    )


def measures(monthly: DataFrame) -> DataFrame:
    """What a dashboard shows of each state: entities, totals, peaks and mean first volumes."""
    entity = monthly.groupBy("state", "entity_key").agg(
        F.sum("total_oil_bbl").alias("oil"), F.sum("total_gas_mcf").alias("gas"), F.max("total_oil_bbl").alias("peak"), F.min_by("total_oil_bbl", "production_date").alias("first_oil")
    )
    return entity.groupBy("state").agg(
        F.count("entity_key").alias("entities"), F.sum("oil").alias("total_oil_bbl"), F.sum("gas").alias("total_gas_mcf"), F.max("peak").alias("peak_oil_bbl"), F.avg("first_oil").alias("mean_first_oil_bbl")
    )


# ---------------------------------------------------------------- self-description

TABLES = [
    ("production_monthly", "All production facts, one row per entity and month", "entity_key, state, production_date", "monthly"),
    ("decline_curve_inputs", "Producing months of wells, ready for decline-curve analysis", "api_number, state, production_date", "monthly"),
    ("schema_registry", "What each gold table is for", "table_name", "static"),
    ("schema_registry_columns", "What each column of the gold tables holds", "table_name, column_name", "static"),
]
COLUMN_NOTES = {
    "entity_key": "API number of a well, TX-LEASE:district-number of a lease",
    "production_year": "year of production_date",
    "production_month": "month of production_date",
    "reported_month_index": "1, 2, 3, ... over an entity's reported months",
    "calendar_months_on_production": "months since the entity's first one, gaps included, from 1",
    "vintage": "first year with oil or gas",
    "initial_gor": "peak gas over peak oil, times 1000; NULL without oil",
    "total_oil_bbl": "oil and condensate",
    "total_gas_mcf": "gas and casinghead gas",
    "cumulative_oil_bbl": "running total_oil_bbl",
    "cumulative_gas_mcf": "running total_gas_mcf",
    "cumulative_water_bbl": "running water_bbl",
    "months_on_production": "1, 2, 3, ... over a well's producing months",
    "initial_oil_rate": "total_oil_bbl of the first producing month",
    "initial_gas_rate": "total_gas_mcf of the first producing month",
    "oil_rate_pct_of_initial": "oil in percent of initial_oil_rate",
    "cumulative_oil": "running oil over producing months",
    "cumulative_gas": "running gas over producing months",
    "cumulative_water": "running water over producing months",
}


def schema_registry(spark) -> DataFrame:
    """One row per gold table, stamped with the time of the query."""
    return spark.createDataFrame(TABLES, "table_name string, description string, primary_key string, grain string").withColumn("updated_at", F.current_timestamp())


def schema_registry_columns(spark, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of ``tables``: type, nullability, place and description."""
    from ..schema import DESCRIPTIONS

    notes = DESCRIPTIONS | COLUMN_NOTES
    rows = [
        (t, f.name, f.dataType.simpleString(), f.nullable, i, notes.get(f.name, "No description available"))
        for t, df in tables.items()
        for i, f in enumerate(df.schema, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, nullable boolean, ordinal_position int, description string")
