"""Fixed schemas of the layers. NULL means not reported; 0 means a reported zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D = T.StringType(), T.DoubleType()
_SILVER = [
    ("state", _S, "two-letter state code"),
    ("entity_type", _S, "well or lease"),
    ("api_number", _S, "NN-NNN-NNNNN; NULL for leases"),
    ("lease_number", _S, "lease; NULL for wells"),
    ("district", _S, "regulator's district; Texas only"),
    ("well_name", _S, "as reported"),
    ("operator", _S, "reporting company"),
    ("county", _S, "county, upper case"),
    ("field_name", _S, "field"),
    ("basin", _S, "basin, where the county has one"),
    ("well_type", _S, "normalised type"),
    ("well_status", _S, "normalised status"),
    ("latitude", _D, "WGS84 degrees"),
    ("longitude", _D, "WGS84 degrees"),
    ("production_date", T.DateType(), "first day of the month"),
    ("oil_bbl", _D, "crude oil, barrels"),
    ("gas_mcf", _D, "gas-well gas, thousand cubic feet"),
    ("condensate_bbl", _D, "condensate, barrels; Texas only"),
    ("casinghead_gas_mcf", _D, "casinghead gas; Texas only"),
    ("water_bbl", _D, "produced water, barrels"),
    ("days_produced", T.IntegerType(), "days on production, 0 to 31"),
    ("source_file", _S, "raw file"),
    ("ingested_at", T.TimestampType(), "UTC time of ingestion"),
]
REQUIRED = ("state", "entity_type", "production_date")
VOLUMES = ("oil_bbl", "gas_mcf", "condensate_bbl", "casinghead_gas_mcf", "water_bbl")
SILVER = T.StructType([T.StructField(n, t, n not in REQUIRED, {"comment": c}) for n, t, c in _SILVER])
SILVER_COLUMNS = [f.name for f in SILVER]
DESCRIPTIONS = {n: c for n, _, c in _SILVER}

WELL_KEY = ("api_number", "state", "production_date")
LEASE_KEY = ("lease_number", "district", "state", "production_date")


def conform(df: DataFrame) -> DataFrame:
    """Exactly the silver columns, in order and type; missing ones are NULL, others go."""
    have = set(df.columns)
    cols: list[Column] = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in SILVER]
    return df.select(*cols)


RESERVES = {
    "properties": "property_id string, api_number string, well_name string, operator string, state string, county string, field_name string, basin string, "
    "well_type string, wi double, nri double, spud_date date, first_prod_date date, notes string, created_at timestamp, updated_at timestamp",
    "cases": "case_id string, property_id string, case_name string, reserve_category string, decline_model string, qi_oil double, qi_gas double, di double, b double, d_min double, "
    "eur_oil_bbl double, eur_gas_mcf double, pv10 double, npv double, economic_limit_month int, price_deck_id string, loe_monthly double, nri double, tax_rate double, discount_rate double, created_at timestamp",
    "forecast_series": "case_id string, month_index int, oil_bbl double, gas_mcf double, cumulative_oil_bbl double, cumulative_gas_mcf double, "
    "gross_revenue double, net_revenue double, tax double, opex double, net_cash_flow double, discount_factor double, discounted_cash_flow double, is_economic_limit boolean",
    "price_decks": "price_deck_id string, deck_name string, month_index int, oil_price double, gas_price double, oil_differential double, gas_differential double, created_at timestamp",
}
EMBEDDINGS = (
    "node_id string, node_type string, parent_doc_id string, domain_tags array<string>, confidence float, content_json string, embed_text string, "
    "embedding array<float>, embedded_at timestamp, model string, is_valid boolean, validation_errors_json string, paper_dir string"
)

#: Primary keys of the stored tables; parts of a key are never NULL.
KEYS = {
    "properties": ("property_id",), "cases": ("case_id",), "forecast_series": ("case_id", "month_index"), "price_decks": ("price_deck_id", "month_index"), "embeddings": ("node_id",),
}


def broken_keys(df: DataFrame, table: str) -> DataFrame:
    """Rows of ``table``'s key that are NULL in part or that more than one row has, with how many."""
    keys = KEYS[table]
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(null | (F.col("n_rows") > 1))


def migrated(df: DataFrame, ddl: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """``df`` with exactly the columns of ``ddl``: missing ones added, all NULLs and empty texts of ``defaults``' columns filled, types cast."""
    fields = T.StructType.fromDDL(ddl).fields
    out = []
    for f in fields:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if defaults and f.name in defaults:
            fill = F.lit(defaults[f.name]).cast(f.dataType)
            c = F.coalesce(F.nullif(c, F.lit("")) if isinstance(f.dataType, T.StringType) else c, fill)
        out.append(c.alias(f.name))
    return df.select(*out)
