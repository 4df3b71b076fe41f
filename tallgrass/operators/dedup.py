"""Latest-wins deduplication, entity types, attributes, product kinds, enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import LEASE_KEY, WELL_KEY


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key under ``order``; NULL keys are equal. Ordering must be total to be repeatable."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def deduplicate(df: DataFrame, seq: str | None = None) -> DataFrame:
    """One row per well-month and lease-month: the latest ``ingested_at`` (NULL is oldest), then the highest ``seq``.

    Both kinds take one exchange: keys that the other kind uses are blanked. Rows of neither kind go, as in the
    contract of the silver layer; ``unkeyed`` lists them.
    """
    kinds = df.filter(F.col("entity_type").isin("well", "lease"))
    keys = {f"_{c}": F.when(F.col("entity_type") == kind, F.col(c)) for kind, cs in (("well", WELL_KEY[:1]), ("lease", LEASE_KEY[:2])) for c in cs}
    order = [F.desc_nulls_last("ingested_at")] + ([F.desc(seq)] if seq else [])
    return latest(kinds.withColumns(keys), ["entity_type", "state", "production_date", *keys], *order).drop(*keys)


def unkeyed(df: DataFrame) -> DataFrame:
    """Rows that ``deduplicate`` drops for their entity_type."""
    return df.filter(~F.coalesce(F.col("entity_type").isin("well", "lease"), F.lit(False)))


def assign_entity_type(rows: DataFrame, completions: DataFrame) -> DataFrame:
    """Leases with exactly one API number among ``completions`` (LEASE_NO, DISTRICT_NO, API_NO) become wells of that number."""
    lease, district = F.trim("LEASE_NO").alias("_lease"), F.trim("DISTRICT_NO").alias("_district")
    wells = completions.groupBy(lease, district).agg(F.count_distinct("API_NO").alias("_wells"), F.min("API_NO").alias("_api"))
    met = rows.join(wells, (F.trim("lease_number") == F.col("_lease")) & (F.trim("district") == F.col("_district")), "left")
    single = F.coalesce(F.col("_wells") == 1, F.lit(False))
    typed = {"entity_type": F.when(single, "well").otherwise("lease"), "api_number": F.when(single, F.col("_api")).otherwise(F.col("api_number"))}
    return met.withColumns(typed).drop("_lease", "_district", "_wells", "_api")


def lease_attributes(completions: DataFrame) -> DataFrame:
    """By lease: its API numbers joined by ';' and the commonest county, type and status (the lowest of equals)."""
    pick = {c: F.mode(c, True) for c in ("county", "well_type", "well_status")}
    apis = F.array_join(F.array_sort(F.collect_set("api_number")), ";")
    return completions.groupBy("lease_number", "district").agg(
        apis.alias("api_numbers"), pick["county"].alias("county"),
        F.coalesce(pick["well_type"], F.lit("OTHER")).alias("well_type"), F.coalesce(pick["well_status"], F.lit("OTHER")).alias("well_status"),
    )


def pivot_kinds(rows: DataFrame, keys: Sequence[str], kind: str, amount: str, days: str, seq: str) -> DataFrame:
    """One row per key from one per product kind (O, G, W): the last reported amount of each, the most days of any.

    One aggregation serves all kinds. NULL keys form a group. Keys with none of the kinds stay out.
    """
    of = F.upper(F.trim(F.col(kind)))
    rows = rows.filter(of.isin("O", "G", "W"))

    def last(code: str) -> Column:
        return F.max_by(amount, F.when((of == code) & F.col(amount).isNotNull(), F.col(seq)))

    return rows.groupBy(*keys).agg(
        last("O").alias("oil_bbl"), last("G").alias("gas_mcf"), last("W").alias("water_bbl"), F.max(days).alias("days_produced")
    )


def enrich(rows: DataFrame, master: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill NULL ``columns`` of ``rows`` from ``master``, which has each key once."""
    side = master.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    out = rows.join(side, key, "left")
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*(f"_{c}" for c in columns)).select(rows.columns)
