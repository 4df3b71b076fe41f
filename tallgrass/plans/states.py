"""Raw files of the three regulators to silver. Each function returns one lazy plan; actions happen at checks and writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    api_from_parts, basin_of, county_of_fips, county_of_label, county_of_path, first_of_month, normalize_api, number, parsed_date, present, tx_api, volume,
    well_status, well_type,
)
from ..operators import dedup, quality
from ..schema import conform
from ..sources import archives, files

TX_CYCLE = (
    "DISTRICT_NO LEASE_NO LEASE_NAME CYCLE_YEAR CYCLE_MONTH OPERATOR_NO OPERATOR_NAME FIELD_NAME "
    "LEASE_OIL_PROD_VOL LEASE_GAS_PROD_VOL LEASE_COND_PROD_VOL LEASE_CSGD_PROD_VOL"
).split()
TX_COMPLETION = "OIL_GAS_CODE DISTRICT_NO LEASE_NO WELL_NO API_COUNTY_CODE API_UNIQUE_NO COUNTY_NAME WELL_14B2_STATUS_CODE".split()
NM_PRODUCTION = "api_st_cde api_cnty_cde api_well_idn pool_idn ogrid_cde prd_knd_cde prod_amt prodn_day_num prodn_yr prodn_mth".split()
UPPER = ("well_name", "operator", "county", "field_name")


def stamped(df: DataFrame, state: str, source: str, as_of: dt.datetime) -> DataFrame:
    """With the lineage columns, and names in upper case."""
    cols: dict[str, Column] = {"state": F.lit(state), "ingested_at": F.lit(as_of).cast("timestamp")}
    if "source_file" not in df.columns:
        cols["source_file"] = F.lit(source)
    cols |= {c: F.upper(F.trim(c)) for c in UPPER if c in df.columns}
    return df.withColumns(cols)


def first_row(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per non-null key."""
    return dedup.latest(df.filter(F.col(key).isNotNull()), [key], *order)


def texas(spark: SparkSession, folder: str, as_of: dt.datetime, least_valid: float = 0.95) -> DataFrame:
    """Lease cycles with well attributes, operators and coordinates. Leases with one API number are wells.

    Too many invalid rows reject the batch (``BatchRejected``); after that, rows that silver cannot hold (no date) go.
    """

    def read(name: str, cols: list[str]) -> DataFrame:
        return files.delimited(spark, [f"{folder}/{name}.dsv", f"{folder}/{name}.csv"], cols)

    cycle, comp, ops = read("OG_LEASE_CYCLE", TX_CYCLE), read("OG_WELL_COMPLETION", TX_COMPLETION), read("OG_OPERATOR_DW", ["OPERATOR_NO", "OPERATOR_NAME"])
    if "OPERATOR_NAME" not in cycle.columns or cycle.filter(F.col("OPERATOR_NAME").isNotNull()).isEmpty():
        names = first_row(ops.select(F.col("OPERATOR_NO"), F.col("OPERATOR_NAME")), "OPERATOR_NO", F.desc("OPERATOR_NAME"))
        cycle = cycle.drop("OPERATOR_NAME").join(names, "OPERATOR_NO", "left")
    comp = comp.withColumns({"API_NO": tx_api(F.col("API_COUNTY_CODE"), F.col("API_UNIQUE_NO")), "LEASE_NO": F.trim("LEASE_NO"), "DISTRICT_NO": F.trim("DISTRICT_NO")})
    typed = comp.withColumns({"well_type": well_type(F.col("OIL_GAS_CODE"), "TX"), "well_status": well_status(F.col("WELL_14B2_STATUS_CODE"), "TX"), "county": F.trim("COUNTY_NAME")})
    attrs = dedup.lease_attributes(typed.withColumnsRenamed({"LEASE_NO": "lease_number", "DISTRICT_NO": "district", "API_NO": "api_number"}))

    rows = cycle.select(
        F.trim("LEASE_NO").alias("lease_number"), F.trim("DISTRICT_NO").alias("district"), F.col("LEASE_NAME").alias("well_name"), F.col("OPERATOR_NAME").alias("operator"),
        F.col("FIELD_NAME").alias("field_name"), first_of_month(F.col("CYCLE_YEAR"), F.col("CYCLE_MONTH")).alias("production_date"),
        *(volume(cycle, s).alias(t) for s, t in (("LEASE_OIL_PROD_VOL", "oil_bbl"), ("LEASE_GAS_PROD_VOL", "gas_mcf"), ("LEASE_COND_PROD_VOL", "condensate_bbl"), ("LEASE_CSGD_PROD_VOL", "casinghead_gas_mcf"))),
    )
    rows = rows.join(attrs, ["lease_number", "district"], "left").withColumn("api_number", F.nullif(F.col("api_numbers"), F.lit("")))
    rows = dedup.assign_entity_type(rows, comp)
    wells = files.features(spark, f"{folder}/wells/*.json", ["API", "GIS_LAT83", "GIS_LONG83"])
    wells = wells.select(normalize_api(F.col("API"), "TX").alias("_api"), number(F.col("GIS_LAT83")).alias("latitude"), number(F.col("GIS_LONG83")).alias("longitude"))
    wells = first_row(wells, "_api", F.asc_nulls_last("latitude"), "longitude")
    rows = rows.join(wells, F.split("api_numbers", ";")[0] == F.col("_api"), "left")
    rows = rows.withColumn("api_number", F.when(F.col("entity_type") == "well", F.col("api_number")))
    silver = conform(stamped(rows, "TX", "OG_LEASE_CYCLE", as_of))
    quality.accept(silver, least_valid, as_of.date())
    return dedup.deduplicate(silver.filter(F.col("production_date").isNotNull()))


def new_mexico(spark: SparkSession, folder: str, as_of: dt.datetime, sum_pools: bool = False) -> DataFrame:
    """Production by product kind, pool and operator as wells' months, with operators, pools, histories and well master.

    A well-month keeps one pool's volumes, the one with the greatest number; ``sum_pools`` adds them up instead.
    """

    def ref(name: str, cols: str) -> DataFrame:
        base = f"{folder}/production"
        return files.records(spark, [f"{base}/{name}/{name}.xml", f"{base}/*/{name}.xml"], name, cols.split())

    prod = files.records(spark, [f"{folder}/production/wcproduction/wcproduction.xml", f"{folder}/production/*/wcproduction.xml"], "wcproduction", NM_PRODUCTION)
    prod = prod.withColumns({c: number(F.col(c)) for c in ("prod_amt", "prodn_day_num")}).withColumn("seq", F.monotonically_increasing_id())
    prod = prod.withColumns(
        {
            "api_number": api_from_parts(F.col("api_st_cde"), F.col("api_cnty_cde"), F.col("api_well_idn")),
            "production_date": first_of_month(F.col("prodn_yr"), F.col("prodn_mth"), 1900, 2100),
            "county": county_of_fips(F.col("api_cnty_cde")),
        }
    )
    rows = dedup.pivot_kinds(prod, ["api_number", "pool_idn", "ogrid_cde", "county", "production_date"], "prd_knd_cde", "prod_amt", "prodn_day_num", "seq")
    operators = first_row(ref("ogrid", "ogrid_cde ogrid_nam"), "ogrid_cde", F.desc("ogrid_nam")).select("ogrid_cde", F.col("ogrid_nam").alias("operator"))
    pools = first_row(ref("pool", "pool_idn pool_nam"), "pool_idn", F.desc("pool_nam")).select("pool_idn", F.col("pool_nam").alias("field_name"))
    hist = ref("wchistory", "api_st_cde api_cnty_cde api_well_idn pool_idn wc_stat_cde well_typ_cde well_nbr_idn eff_dte")
    hist = hist.withColumn("api_number", api_from_parts(F.col("api_st_cde"), F.col("api_cnty_cde"), F.col("api_well_idn")))
    hist = dedup.latest(hist, ["api_number", "pool_idn"], F.desc_nulls_last("eff_dte"), "well_nbr_idn")
    hist = hist.select("api_number", "pool_idn", well_status(F.col("wc_stat_cde"), "NM").alias("well_status"), well_type(F.col("well_typ_cde"), "NM").alias("well_type"), F.col("well_nbr_idn").alias("well_name"))
    rows = rows.join(operators, "ogrid_cde", "left").join(pools, "pool_idn", "left").join(hist, ["api_number", "pool_idn"], "left")
    if sum_pools:
        sums = {c: F.sum(c).over(_month()) for c in ("oil_bbl", "gas_mcf", "water_bbl")}
        rows = rows.withColumns(sums)
    order = [F.desc_nulls_last(c) for c in ("ogrid_cde", "oil_bbl", "gas_mcf", "water_bbl")]
    rows = dedup.latest(rows, ["api_number", "production_date"], F.desc_nulls_last(number(F.col("pool_idn"))), *order)
    names = ["id", "well_name", "ogrid_name", "county", "pool", "type", "status", "latitude", "longitude"]
    m = files.features(spark, f"{folder}/wells/*.json", names)
    master = m.select(
        normalize_api(F.col("id"), "NM").alias("api_number"), "well_name", F.col("ogrid_name").alias("operator"), "county", F.col("pool").alias("field_name"),
        well_type(F.col("type"), "NM").alias("well_type"), well_status(F.col("status"), "NM").alias("well_status"), number(F.col("latitude")).alias("latitude"), number(F.col("longitude")).alias("longitude"),
    )
    return _finish(rows, first_row(master, "api_number", F.asc_nulls_last("well_name"), "operator"), "NM", "wcproduction.xml", as_of)


def _month():
    from pyspark.sql.window import Window

    return Window.partitionBy("api_number", "production_date")


def new_mexico_legacy(spark: SparkSession, pattern: str, as_of: dt.datetime) -> DataFrame:
    """County spreadsheets exported as text, columns found by their usual names; the county is the folder's."""
    t = files.tables(spark, pattern)
    if t is None:
        return conform(files.empty(spark, ["state"]))
    names = {
        "api": ("api", "api_no", "api no", "api number", "well_api", "apino"), "well_name": ("well_name", "well name", "wellname", "well", "name"),
        "operator": ("operator", "operator_name", "operator name", "ogrid_name", "oper"), "oil": ("oil", "oil_bbl", "oil bbl", "oil(bbl)", "oilbbl"),
        "gas": ("gas", "gas_mcf", "gas mcf", "gas(mcf)", "gasmcf"), "water": ("water", "water_bbl", "water bbl", "water(bbl)", "waterbbl"),
        "days": ("days", "days_produced", "days produced", "proddays"), "year": ("year", "prod_year", "production_year", "proxyear"),
        "month": ("month", "prod_month", "proxymonth", "mo"), "date": ("production_month", "prod_date", "date", "production_date"),
    }
    rows = _aliased(t, names, "NM").withColumn("county", county_of_path(F.col("source_dir")))
    return _finish(rows, None, "NM", pattern, as_of)


OK_NAMES = {
    "api": ("api", "api_no", "api_number", "apino", "well_api"), "well_name": ("well_name", "wellname", "name", "lease_name"), "operator": ("operator", "operator_name", "oper", "company"),
    "county": ("county", "county_name"), "type": ("well_type", "welltype", "type"), "status": ("well_status", "wellstatus", "status"),
    "oil": ("oil", "oil_bbl", "oil_prod", "oil_volume", "oil production"), "gas": ("gas", "gas_mcf", "gas_prod", "gas_volume", "gas production"),
    "water": ("water", "water_bbl", "water_prod", "water_volume"), "days": ("days", "days_produced", "producing_days", "prod_days"),
    "year": ("year", "prod_year", "production_year", "rpt_year"), "month": ("month", "prod_month", "production_month", "rpt_month"),
    "date": ("production_date", "prod_date", "date", "report_date"), "latitude": ("latitude", "lat", "sh_lat"), "longitude": ("longitude", "lon", "long", "sh_lon"),
}


def _aliased(t: DataFrame, names: dict[str, tuple[str, ...]], state: str) -> DataFrame:
    """Silver-like rows of a table whose columns go by any of several names."""
    at = {k: present(t, v) for k, v in names.items()}

    def text(k: str) -> Column:
        return F.col(f"`{at[k]}`") if at.get(k) else F.lit(None).cast("string")

    if at.get("year") and at.get("month"):
        date = first_of_month(text("year"), text("month"), 1900, 2100)
    else:
        date = parsed_date(t, at["date"]) if at.get("date") else F.lit(None).cast("date")
    return t.select(
        normalize_api(text("api"), state).alias("api_number"), text("well_name").alias("well_name"), text("operator").alias("operator"), text("county").alias("county"),
        well_type(text("type"), state).alias("well_type"), well_status(text("status"), state).alias("well_status"), date.alias("production_date"),
        number(text("oil")).alias("oil_bbl"), number(text("gas")).alias("gas_mcf"), number(text("water")).alias("water_bbl"), number(text("days")).cast("int").alias("days_produced"),
        number(text("latitude")).alias("latitude"), number(text("longitude")).alias("longitude"), "source_file", "source_dir",
    )


def oklahoma(spark: SparkSession, folder: str, as_of: dt.datetime, completions: DataFrame | None = None) -> DataFrame:
    """Production text files, or without one the wells themselves (this month, no volumes), and completions' first rates.

    Completions are read from the folder's workbooks (``*.xlsx``), unless they are given as a table of text columns; a rate of 0 is not reported.
    """
    wells = files.features(spark, f"{folder}/wells/*.json", ["api", "well_name", "well_num", "operator", "county", "welltype", "symbol_class", "wellstatus", "sh_lat", "sh_lon"])
    master = wells.select(
        normalize_api(F.col("api"), "OK").alias("api_number"), F.nullif(F.trim(F.concat_ws(" ", "well_name", "well_num")), F.lit("")).alias("well_name"), "operator",
        county_of_label(F.col("county")).alias("county"), F.lit(None).cast("string").alias("field_name"), well_type(F.coalesce("welltype", "symbol_class"), "OK").alias("well_type"),
        well_status(F.col("wellstatus"), "OK").alias("well_status"), number(F.col("sh_lat")).alias("latitude"), number(F.col("sh_lon")).alias("longitude"),
    )
    master = first_row(master, "api_number", F.asc_nulls_last("well_name"), "operator")
    t = files.tables(spark, f"{folder}/*.csv", encoding="ISO-8859-1")
    if t is not None:
        rows = _aliased(t, OK_NAMES, "OK").withColumn("county", county_of_label(F.col("county")))
    else:
        rows = master.withColumns({"production_date": F.lit(as_of.date().replace(day=1)), "source_file": F.lit("wells"), "source_dir": F.lit("wells")})
    if completions is None and files.listed(spark, f"{folder}/*.xlsx"):
        completions = archives.workbook(spark, f"{folder}/*.xlsx", OK_COMPLETIONS)
    if completions is not None:
        rows = rows.unionByName(_completions(completions), allowMissingColumns=True)
    return _finish(rows, master, "OK", "rbdms", as_of)


#: The columns of the completion workbook that are used, all as text.
OK_COMPLETIONS = (
    "API_Number", "Well_Name", "Well_Number", "Operator_Name", "Operator_Number", "County", "Well_Type", "Well_Status", "Test_Date", "First_Prod", "Well_Completion",
    "Oil_BBL_Per_Day", "Gas_MCF_Per_Day", "Water_BBL_Per_Day", "Formation_Name", "OTC_Prod_Unit_No", "Surf_Lat_Y", "Surf_Long_X",
)


def _completions(c: DataFrame) -> DataFrame:
    """First rates of completions with any: one day of production in the month of the first date column that dates any row after 1950."""
    rates = {"Oil_BBL_Per_Day": "oil_bbl", "Gas_MCF_Per_Day": "gas_mcf", "Water_BBL_Per_Day": "water_bbl"}
    dates = [d for d in ("Test_Date", "First_Prod", "Well_Completion") if d in c.columns]
    parsed = {d: parsed_date(c, d) for d in dates}
    hits = c.agg(*(F.count_if(p >= F.lit(dt.date(1950, 1, 1))).alias(d) for d, p in parsed.items())).first() if dates else {}
    best = next((d for d in dates if hits[d]), None)
    c = c.withColumns({t: F.nullif(volume(c, s), F.lit(0.0)) for s, t in rates.items()})
    keep = F.greatest(*(F.coalesce(t, F.lit(0.0)) for t in rates.values())) > 0
    return c.filter(keep).select(
        normalize_api(F.col("API_Number"), "OK").alias("api_number"), F.trim(F.concat_ws(" ", "Well_Name", "Well_Number")).alias("well_name"), F.col("Operator_Name").alias("operator"),
        county_of_label(F.col("County")).alias("county"), well_type(F.col("Well_Type"), "OK").alias("well_type"), well_status(F.col("Well_Status"), "OK").alias("well_status"),
        (parsed[best] if best else F.lit(None).cast("date")).alias("production_date"), *rates.values(), F.lit(1).alias("days_produced"), F.lit("completions").alias("source_file"),
    )


def _finish(rows: DataFrame, master: DataFrame | None, state: str, source: str, as_of: dt.datetime) -> DataFrame:
    """Enrichment, basins, lineage, latest rows, valid ones."""
    rows = rows.filter(F.col("api_number").isNotNull() & F.col("production_date").isNotNull())
    if master is not None:
        for c in master.columns:
            if c not in rows.columns:
                rows = rows.withColumn(c, F.lit(None).cast(master.schema[c].dataType))
        rows = dedup.enrich(rows, master, "api_number", [c for c in master.columns if c != "api_number"])
    rows = rows.withColumns({"entity_type": F.lit("well"), "basin": basin_of(F.col("county"), state)})
    silver = conform(stamped(rows, state, source, as_of))
    order = [F.desc_nulls_last(c) for c in ("field_name", "source_file", "oil_bbl", "gas_mcf", "water_bbl")]
    latest = dedup.latest(silver, ["api_number", "state", "production_date"], F.desc_nulls_last("ingested_at"), *order)
    return quality.valid_rows(latest, as_of.date())


def write_silver(df: DataFrame, root: str) -> None:
    """Replace the states' partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("state").parquet(root)


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """The silver table; a filter on ``state`` reads its folders only."""
    return conform(spark.read.parquet(root))
