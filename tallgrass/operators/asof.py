"""As-of joins: each fact with the version of a dimension that was valid at its time, without a range join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, valid_from: str, columns: Sequence[str], valid_to: str | None = None, period: str = "year") -> DataFrame:
    """``facts`` with ``columns`` of the version of the same ``keys`` that is the last with ``valid_from`` <= ``at``; NULL without one, or once ``valid_to`` is reached.

    Both sides are laid together and sorted by time within key and ``period``, and the last version is carried forward, so a key with many facts
    is split by time. What a period begins with is found from one row a key and period, and joined to the facts on just that. Facts with a
    NULL key or time have no version and meet nobody. Of versions that begin at the same time, the one with the greatest hash counts. Columns of
    ``facts`` that are called like one of ``columns`` are replaced.
    """
    facts = facts.drop(*columns)
    here = F.lit(True)
    for c in (*keys, at):
        here = here & F.col(c).isNotNull()
    kept = F.struct(*(F.col(c) for c in columns), F.col(valid_to if valid_to else valid_from).alias("_until")).alias("_v")
    tie = F.xxhash64(*columns).alias("_tie")
    known = versions.filter(F.col(valid_from).isNotNull()).dropna(subset=list(keys)).select(*keys, F.col(valid_from).alias("_at"), tie, kept)
    known = known.withColumn("_period", F.date_trunc(period, "_at"))
    row = F.struct(*(F.col(f"`{c}`") for c in facts.columns)).alias("_row")
    asked = facts.filter(here).select(*keys, F.col(at).alias("_at"), F.date_trunc(period, F.col(at)).alias("_period"), row)

    both = asked.withColumn("_side", F.lit(1)).unionByName(known.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    time = Window.partitionBy(*keys, "_period").orderBy("_at", "_side", "_tie")
    within = both.withColumn("_v", F.last("_v", True).over(time.rowsBetween(Window.unboundedPreceding, Window.currentRow))).filter("_side = 1")

    last = known.groupBy(*keys, "_period").agg(F.max_by("_v", F.struct("_at", "_tie")).alias("_before")).withColumn("_side", F.lit(1))
    periods = asked.select(*keys, "_period").distinct().withColumn("_side", F.lit(0))
    earlier = Window.partitionBy(*keys).orderBy("_period", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = periods.unionByName(last, allowMissingColumns=True).withColumn("_before", F.last("_before", True).over(earlier))
    carried = carried.filter("_side = 0 and _before is not null").drop("_side")

    found: Column = F.coalesce("_v", "_before")
    out = within.join(carried, [*keys, "_period"], "left").select("_row", "_at", found.alias("_v"))
    if valid_to:
        out = out.withColumn("_v", F.when(F.col("_v._until").isNull() | (F.col("_at") < F.col("_v._until")), F.col("_v")))
    out = out.select("_row.*", *(F.col(f"_v.{c}").alias(c) for c in columns))
    none = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns]
    return out.unionByName(facts.filter(~here).select("*", *none))
