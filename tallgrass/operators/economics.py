"""Cash flows, economic limit, EUR and PV10 of forecasts. All per case, in one aggregation over its months."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import decline


@dataclass(frozen=True)
class Terms:
    """Prices and costs; differentials are taken off the prices."""

    nri: float
    oil_price: float
    gas_price: float
    loe_monthly: float
    tax_rate: float = 0.046
    ad_valorem_annual: float = 0.0
    oil_differential: float = 0.0
    gas_differential: float = 0.0
    discount_rate: float = 0.10


def cash_flows(forecast: DataFrame, terms: Terms) -> DataFrame:
    """``forecast`` with revenue, tax, opex, net cash flow, discount factor and discounted cash flow of each month."""
    gross = F.col("oil_bbl") * (terms.oil_price - terms.oil_differential) + F.col("gas_mcf") * (terms.gas_price - terms.gas_differential)
    out = forecast.withColumn("gross_revenue", gross).withColumn("net_revenue", F.col("gross_revenue") * terms.nri)
    out = out.withColumns({"tax": F.col("net_revenue") * terms.tax_rate, "opex": F.lit(terms.loe_monthly + terms.ad_valorem_annual / 12)})
    out = out.withColumn("net_cash_flow", F.col("net_revenue") - F.col("tax") - F.col("opex"))
    out = out.withColumn("discount_factor", F.pow(F.lit(1 + terms.discount_rate), -F.col("month_index") / 12))
    return out.withColumn("discounted_cash_flow", F.col("net_cash_flow") * F.col("discount_factor"))


def _limit() -> Column:
    return F.min(F.when(F.col("net_cash_flow") <= 0, F.col("month_index")))


def economic_limit(forecast: DataFrame, terms: Terms) -> DataFrame:
    """(case_id, economic_limit_month): the first month without profit; NULL if there is none."""
    return cash_flows(forecast, terms).groupBy("case_id").agg(_limit().alias("economic_limit_month"))


def valuation(forecast: DataFrame, terms: Terms) -> DataFrame:
    """One row per case: economic limit, EUR at it (of the whole forecast without one), PV10 and undiscounted NPV.

    The limit month itself counts, although it no longer pays.
    """
    from pyspark.sql.window import Window

    flows = cash_flows(forecast, terms).withColumn("economic_limit_month", _limit().over(Window.partitionBy("case_id")))
    life = flows.filter(F.col("month_index") <= F.coalesce("economic_limit_month", F.col("month_index")))
    return life.groupBy("case_id").agg(
        F.first("economic_limit_month").alias("economic_limit_month"),
        F.max_by("cumulative_oil_bbl", "month_index").alias("eur_oil_bbl"),
        F.max_by("cumulative_gas_mcf", "month_index").alias("eur_gas_mcf"),
        F.sum("discounted_cash_flow").alias("pv10"),
        F.sum("net_cash_flow").alias("npv"),
    )


def evaluate(rows: DataFrame, keys: list[str], order: str, oil: str, gas: str, terms: Terms, model: str = "hyperbolic", months: int = 600) -> DataFrame:
    """From history to value, one row a well: fit on its oil from the latest peak on, forecast, economic limit, EUR and PV10.

    The gas forecast starts at the well's gas in its peak month and declines with the oil. Histories are handled one well in
    a task's memory at a time; a well that cannot be fitted keeps its status and has no values.
    """
    fits = decline.fit_wells(rows, keys, order, oil, model)
    at = rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce(gas, F.lit(0.0)).alias("g")))), lambda x: x["g"]).alias("_gas"))
    fits = fits.join(at, keys).withColumn("qi_gas", F.try_element_at("_gas", F.col("peak_index") + 1)).drop("_gas")
    case = F.to_json(F.struct(*keys)).alias("case_id")
    cases = fits.filter("status = 'fitted'").select(case, F.lit(model).alias("decline_model"), F.col("qi").alias("qi_oil"), "qi_gas", "di", "b", "d_min")
    values = valuation(decline.forecast(cases, months), terms)
    return fits.withColumn("case_id", case).join(values, "case_id", "left").drop("case_id")
