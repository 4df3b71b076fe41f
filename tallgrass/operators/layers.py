"""Reports of what holds between two layers: one row a check, and one line for people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import WELL_KEY
from . import quality
from .gold import staging

REPORT = ("layer", "state", "check_name", "failures", "passed", "total_rows")


def _row(layer: str, state: str, name: str, failures: DataFrame, total: DataFrame) -> DataFrame:
    """``failures`` (one row, one column) and ``total`` (one row ``total_rows``) as a report row."""
    out = failures.toDF("failures").crossJoin(total)  # two single rows
    return out.select(F.lit(layer).alias("layer"), F.lit(state).alias("state"), F.lit(name).alias("check_name"), F.col("failures").cast("long"), (F.col("failures") == 0).alias("passed"), F.col("total_rows"))


def bronze_to_silver(bronze: DataFrame, silver: DataFrame, state: str, least: float = 0.9, today=None) -> DataFrame:
    """Row retention, required fields, value ranges and repeated keys of one state's silver rows.

    ``bronze`` is the state's raw table; of it only the row count is taken, which needs no column. Without raw rows nothing can be
    lost. ``failures`` counts lost rows beyond what ``least`` allows as 1, NULLs of required columns, failed values, and rows that
    share a key.
    """
    rows = silver.filter(F.col("state") == state)
    total = rows.agg(F.count("*").alias("total_rows"))
    lost = bronze.agg(F.count("*").alias("b")).crossJoin(total)  # two single rows
    lost = lost.select(F.when((F.col("b") > 0) & (F.col("total_rows") < F.col("b") * least), 1).otherwise(0))
    parts = {
        "row_count_comparison": lost,
        "required_fields": quality.required_fields(rows).agg(F.sum("null_count")),
        "value_ranges": quality.validate_batch(rows, today).agg(F.sum("bad_row_count")),
        "dedup_integrity": quality.dedup_integrity(rows).agg(F.sum("duplicate_rows")),
    }
    out = None
    for name, failures in parts.items():
        row = _row("bronze_to_silver", state, name, failures, total)
        out = row if out is None else out.unionByName(row)
    return out


def silver_to_gold(silver: DataFrame, monthly: DataFrame, decline: DataFrame | None = None, max_gap: int = 1) -> DataFrame:
    """Volumes by state, unique keys, and gaps between months, of the gold tables that are there."""
    stg = staging(silver)
    total = silver.agg(F.count("*").alias("total_rows"))
    parts = {f"reconcile_{v}": quality.reconcile_volumes(stg, monthly, ["state"], [v]).agg(F.count("*")) for v in ("total_oil_bbl", "total_gas_mcf")}
    parts["pk_production_monthly"] = quality.repeated_keys(monthly, ["entity_key", "state", "production_date"]).agg(F.count("*"))
    parts["month_completeness"] = quality.month_gaps(monthly, max_gap).agg(F.count("*"))
    if decline is not None:
        parts["pk_decline_curve_inputs"] = quality.repeated_keys(decline, list(WELL_KEY)).agg(F.count("*"))
    out = None
    for name, failures in parts.items():
        row = _row("silver_to_gold", "ALL", name, failures, total)
        out = row if out is None else out.unionByName(row)
    return out


def line(report: DataFrame) -> str:
    """A report in one line."""
    r = report.agg(F.first("layer").alias("layer"), F.first("state").alias("state"), F.count_if("passed").alias("good"), F.count("*").alias("n"), F.max("total_rows").alias("rows")).first()
    return f"[{'PASSED' if r.good == r.n else 'FAILED'}] {r.layer} ({r.state}): {r.good}/{r.n} checks passed, {r.n - r.good} failed ({r.rows} rows)"
