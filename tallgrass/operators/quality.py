"""Validation rules, layer checks, reconciliation, and gold tests. Every check is one pass over its input."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.identifiers import API_PATTERN
from ..schema import LEASE_KEY, REQUIRED, VOLUMES, WELL_KEY


def rules(df: DataFrame, today: dt.date | None = None) -> dict[tuple[str, str], Column]:
    """(check, column) -> whether a row passes; checks of missing columns are left out, so every row passes them."""
    today = today or dt.date.today()
    c, yes = F.col, F.lit(True)
    known = F.lit(False)
    all_ = {("non_negative_volumes", v): F.coalesce(c(v) >= 0, yes) for v in VOLUMES}
    all_ |= {
        ("days_produced_range", "days_produced"): F.coalesce(c("days_produced").between(0, 31), yes),
        ("production_date_range", "production_date"): F.coalesce(c("production_date").between(dt.date(1900, 1, 1), today), known),
        ("api_number_format", "api_number"): F.coalesce(c("api_number").rlike(API_PATTERN), yes),
        ("state_values", "state"): F.coalesce(c("state").isin("TX", "NM", "OK"), known),
        ("entity_type_values", "entity_type"): F.coalesce(c("entity_type").isin("well", "lease"), known),
        ("lease_fields_consistency", "lease_number"): F.coalesce(c("entity_type") != "lease", yes) | c("lease_number").isNotNull(),
    }
    have = set(df.columns)
    needs = {"lease_number": {"lease_number", "entity_type"}}
    return {k: v for k, v in all_.items() if needs.get(k[1], {k[1]}) <= have}


def validate_batch(df: DataFrame, today: dt.date | None = None) -> DataFrame:
    """One row per check and column: total and failed rows and pass rate (1 if empty)"""
    checks = rules(df, today)
    total = F.count("*").alias("total")
    bad = [F.count_if(~ok).alias(f"bad_{i}") for i, ok in enumerate(checks.values())]
    row = df.agg(total, *bad)
    each = F.array(*(F.struct(F.lit(k[0]).alias("check_name"), F.lit(k[1]).alias("column_name"), F.col(f"bad_{i}").alias("bad_row_count")) for i, k in enumerate(checks)))
    out = row.select("total", F.inline(each))
    rate = F.when(F.col("total") > 0, 1 - F.col("bad_row_count") / F.col("total")).otherwise(1.0)
    return out.select("check_name", "column_name", "total", "bad_row_count", rate.alias("pass_rate"), (F.col("bad_row_count") == 0).alias("passed"))


def bad_samples(df: DataFrame, samples: int = 5, today: dt.date | None = None) -> DataFrame:
    """Up to ``samples`` rows (check_name, column_name, value) of the least bad values of each check."""
    checks = rules(df, today)
    bad = [F.when(~ok, F.struct(F.lit(k[0]).alias("check_name"), F.lit(k[1]).alias("column_name"), F.col(k[1]).cast("string").alias("value"))) for k, ok in checks.items()]
    rows = df.select(F.explode(F.array_compact(F.array(*bad))).alias("b")).select("b.*").distinct()
    w = Window.partitionBy("check_name", "column_name").orderBy("value")
    return rows.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= samples).drop("k")


def valid(df: DataFrame, today: dt.date | None = None) -> Column:
    """Whether a row passes every rule."""
    keep = F.lit(True)
    for ok in rules(df, today).values():
        keep = keep & ok
    return keep


def valid_rows(df: DataFrame, today: dt.date | None = None) -> DataFrame:
    """Rows that pass every rule."""
    return df.filter(valid(df, today))


class BatchRejected(ValueError):
    """Too few rows of a batch are valid."""


def accept(df: DataFrame, least: float, today: dt.date | None = None) -> DataFrame:
    """``df``, unless less than ``least`` of its rows pass every rule."""
    total, good = df.agg(F.count("*"), F.count_if(valid(df, today))).first()
    if total and good / total < least:
        raise BatchRejected(f"{good} of {total} rows are valid; {least:.0%} are required")
    return df


def required_fields(df: DataFrame) -> DataFrame:
    """One row per required column (leases also need their number, wells theirs): its NULLs."""
    needs = {c: F.col(c).isNull() for c in REQUIRED if c in df.columns}
    if "entity_type" in df.columns:
        for kind, c in (("lease", "lease_number"), ("well", "api_number")):
            if c in df.columns:
                needs[c] = (F.col("entity_type") == kind) & F.col(c).isNull()
    row = df.agg(*(F.count_if(x).alias(k) for k, x in needs.items()))
    each = F.array(*(F.struct(F.lit(k).alias("column_name"), F.col(k).alias("null_count")) for k in needs))
    return row.select(F.inline(each)).withColumn("passed", F.col("null_count") == 0)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with how many; NULLs are equal."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def generic_tests(df: DataFrame, not_null: Sequence[str] = (), accepted: dict[str, Sequence] | None = None, unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """One row per test of any table: columns without NULLs, columns with only the ``accepted`` values (NULL passes), and keys
    that no two rows share (failures: rows beyond the first of a key)."""
    single = {f"not_null_{c}": F.col(c).isNull() for c in not_null}
    single |= {f"accepted_values_{c}": ~F.coalesce(F.col(c).isin(*values), F.lit(True)) for c, values in (accepted or {}).items()}
    out = None
    if single:
        row = df.agg(*(F.count_if(x).alias(k) for k, x in single.items()))
        out = row.select(F.explode(F.create_map(*(x for k in single for x in (F.lit(k), F.col(k))))).alias("test_name", "failures"))
    for keys in unique:
        beyond = df.groupBy(*(F.col(f"`{k}`").alias(f"key_{i}") for i, k in enumerate(keys))).agg((F.count("*") - 1).alias("beyond_first"))
        rows = beyond.agg(F.coalesce(F.sum("beyond_first"), F.lit(0)).alias("failures"))
        row = rows.select(F.lit("unique_" + "_".join(keys)).alias("test_name"), "failures")
        out = row if out is None else out.unionByName(row)
    return out.withColumn("passed", F.col("failures") == 0)


def dedup_integrity(df: DataFrame) -> DataFrame:
    """One row per entity type: how many rows share their key with another."""
    out = None
    for kind, keys in (("well", WELL_KEY), ("lease", LEASE_KEY)):
        part = repeated_keys(df.filter(F.col("entity_type") == kind), keys).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("duplicate_rows"))
        part = part.select(F.lit(kind).alias("entity_type"), "duplicate_rows")
        out = part if out is None else out.unionByName(part)
    return out


def retention(before: int, after: int, least: float = 0.9) -> bool:
    """Whether enough rows survived; nothing to lose is enough."""
    return not before or after / before >= least


def reconcile_volumes(silver: DataFrame, gold: DataFrame, keys: Sequence[str], volumes: Sequence[str], tolerance: float = 0.01) -> DataFrame:
    """Groups whose sums differ by more than ``tolerance`` of silver's, or that one side lacks. NULL keys are a group."""

    def sums(df: DataFrame, side: str) -> DataFrame:
        named = [F.col(k).alias(f"{side}_{k}") for k in keys]
        return df.groupBy(*named).agg(*(F.coalesce(F.sum(v), F.lit(0.0)).alias(f"{side}_{v}") for v in volumes)).withColumn(f"{side}_in", F.lit(True))

    on = [F.col(f"s_{k}").eqNullSafe(F.col(f"g_{k}")) for k in keys]
    both = sums(silver, "s").join(sums(gold, "g"), on, "full_outer")
    status = F.when(F.col("s_in").isNull(), "gold_only").when(F.col("g_in").isNull(), "silver_only").otherwise("both")
    off = F.lit(False)
    for v in volumes:
        off = off | (F.abs(F.col(f"s_{v}") - F.col(f"g_{v}")) / F.greatest(F.abs(F.col(f"s_{v}")), F.lit(1e-10)) > tolerance)
    out = both.withColumn("status", status).filter((F.col("status") != "both") | off)
    return out.select(*(F.coalesce(f"s_{k}", f"g_{k}").alias(k) for k in keys), "status", *(f"{s}_{v}" for v in volumes for s in "sg"))


def month_gaps(df: DataFrame, max_gap: int = 1, entity: str = "entity_key") -> DataFrame:
    """Entities with a step of more than 31 * ``max_gap`` days between months: how many and the longest."""
    w = Window.partitionBy(entity, "state").orderBy("production_date")
    step = F.datediff("production_date", F.lag("production_date").over(w))
    rows = df.filter(F.col(entity).isNotNull() & F.col("state").isNotNull()).withColumn("gap_days", step).filter(F.col("gap_days") > 31 * max_gap)
    return rows.groupBy(entity, "state").agg(F.count("*").alias("gap_count"), F.max("gap_days").alias("max_gap_days"))


def gold_tests(stg: DataFrame, monthly: DataFrame, decline: DataFrame, today: dt.date | None = None) -> dict[str, DataFrame]:
    """Test name -> its violations; a test passes if it has none."""
    today = today or dt.date.today()
    key = ["entity_key", "state", "production_date"]
    well = ["api_number", "state", "production_date"]
    lease = F.concat(F.lit("TX-LEASE:"), F.col("district"), F.lit("-"), F.col("lease_number"))

    def index(df: DataFrame, keys: list[str], column: str) -> DataFrame:
        stats = df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        return stats.filter((F.col("low") != 1) | (F.col("high") != F.col("n")))

    negative = F.lit(False)
    for v in VOLUMES:
        negative = negative | F.coalesce(F.col(v) < 0, F.lit(False))
    totals = reconcile_volumes(stg, monthly, ["state"], ["total_oil_bbl", "total_gas_mcf"], 0.0)
    off = (F.abs(F.col("s_total_oil_bbl") - F.col("g_total_oil_bbl")) > 0.01) | (F.abs(F.col("s_total_gas_mcf") - F.col("g_total_gas_mcf")) > 0.01)
    wells = stg.filter(F.col("entity_type") == "well").select(*well)
    counts = stg.agg(F.count("*").alias("silver")).crossJoin(monthly.agg(F.count("*").alias("gold")))  # two single rows
    return {
        "null_entity_key": monthly.filter(F.col("entity_key").isNull()),
        "well_key_format": monthly.filter((F.col("entity_type") == "well") & (F.col("entity_key") != F.col("api_number"))),
        "lease_key_format": monthly.filter((F.col("entity_type") == "lease") & (F.col("entity_key") != lease)),
        "negative_volume": monthly.filter(negative),
        "future_date": monthly.filter(F.col("production_date") > F.lit(today)),
        "orphan_gold": monthly.select(*key).join(stg.select(*key), key, "left_anti"),
        "month_index_sequential": index(monthly, key[:2], "reported_month_index"),
        "calendar_months_positive": monthly.filter(F.col("calendar_months_on_production") < 1),
        "volumes_reconcile": totals.filter((F.col("status") != "both") | off),
        "decline_well_only": decline.select(*well).join(wells, well, "left_anti"),
        "decline_complete": index(decline, well[:2], "months_on_production"),
        "row_counts_equal": counts.filter("silver <> gold"),
    }


def gold_test_counts(stg: DataFrame, monthly: DataFrame, decline: DataFrame, today: dt.date | None = None) -> DataFrame:
    """``summary(gold_tests(...))`` with one aggregate a table: tests of single rows share a pass, only the joins stand apart."""
    today = today or dt.date.today()
    key, well = ["entity_key", "state", "production_date"], ["api_number", "state", "production_date"]
    lease = F.concat(F.lit("TX-LEASE:"), F.col("district"), F.lit("-"), F.col("lease_number"))
    totals = ("total_oil_bbl", "total_gas_mcf")

    def broken(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
        stats = df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        return stats.agg(F.count_if((F.col("low") != 1) | (F.col("high") != F.col("n"))).alias(name))

    negative = F.lit(False)
    for v in VOLUMES:
        negative = negative | F.coalesce(F.col(v) < 0, F.lit(False))
    rows = {
        "null_entity_key": F.col("entity_key").isNull(),
        "well_key_format": (F.col("entity_type") == "well") & (F.col("entity_key") != F.col("api_number")),
        "lease_key_format": (F.col("entity_type") == "lease") & (F.col("entity_key") != lease),
        "negative_volume": negative,
        "future_date": F.col("production_date") > F.lit(today),
        "calendar_months_positive": F.col("calendar_months_on_production") < 1,
    }
    # both sides of each comparison are summed by state first; what meets is one row a state
    sides = [df.groupBy("state").agg(F.count("*").alias(f"{s}_n"), *(F.coalesce(F.sum(v), F.lit(0.0)).alias(f"{s}_{v}") for v in totals)) for df, s in ((stg, "s"), (monthly, "g"))]
    both = sides[0].join(sides[1].withColumnRenamed("state", "g_state"), F.col("state").eqNullSafe(F.col("g_state")), "full_outer")
    off = F.col("s_n").isNull() | F.col("g_n").isNull()
    for v in totals:
        off = off | (F.abs(F.col(f"s_{v}") - F.col(f"g_{v}")) > 0.01)
    counts = F.when(F.coalesce(F.sum("s_n"), F.lit(0)) != F.coalesce(F.sum("g_n"), F.lit(0)), 1).otherwise(0)
    wells = stg.filter(F.col("entity_type") == "well").select(*well)
    each = [
        monthly.agg(*(F.count_if(x).alias(k) for k, x in rows.items())),
        both.agg(F.count_if(off).alias("volumes_reconcile"), counts.cast("long").alias("row_counts_equal")),
        monthly.select(*key).join(stg.select(*key), key, "left_anti").agg(F.count("*").alias("orphan_gold")),
        decline.select(*well).join(wells, well, "left_anti").agg(F.count("*").alias("decline_well_only")),
        broken(monthly, key[:2], "reported_month_index", "month_index_sequential"),
        broken(decline, well[:2], "months_on_production", "decline_complete"),
    ]
    out = None
    for df in each:
        named = df.select(F.explode(F.create_map(*(x for c in df.columns for x in (F.lit(c), F.col(c))))).alias("test_name", "violations"))
        out = named if out is None else out.unionByName(named)
    return out.withColumn("passed", F.col("violations") == 0)


def summary(tests: dict[str, DataFrame]) -> DataFrame:
    """One row per test: violations and whether it passed."""
    out = None
    for name, df in tests.items():
        row = df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("test_name"), "violations", (F.col("violations") == 0).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out
