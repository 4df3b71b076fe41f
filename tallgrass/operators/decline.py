"""Arps decline: forecasts in closed form, fitting, peak detection, outliers.

Rates are monthly. A nominal annual decline ``di`` is ``a = di / 12`` a month. With exponent b the volume up to month t is
``q/((1-b)a) (1 - (1+b a t)^(1-1/b))``, in the limits ``q/a (1 - e^(-a t))`` (b = 0) and ``q/a ln(1 + a t)`` (b = 1). Once the
instantaneous decline falls to the terminal one, the rest is exponential (Arps 1945; Robertson 1988).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EXPONENT = {"exponential": 0.0, "harmonic": 1.0}


def nominal(di: Column, kind: str = "nominal") -> Column:
    """Nominal annual decline from ``di``: as it is, or from secant effective decline of a hyperbolic year."""
    if kind == "nominal":
        return di
    b = F.col("b")
    return F.when(b == 0, -F.log(1 - di)).otherwise((F.pow(1 - di, -b) - 1) / b)


#: Days of a mean month.
MONTH_DAYS = 30.4375


def create_model(decline_model: Column, qi_oil: Column, di: Column, b: Column | None = None, d_min: Column | None = None, qi_gas: Column | None = None) -> Column:
    """A case's curves as a struct (oil, gas) of structs (decline_model, qi: monthly, qi_daily, di, b, d_min): exponential has no exponent and no
    terminal decline, harmonic the exponent 1. Gas shares the oil's decline; it is NULL unless its initial rate is above 0."""
    exponent = F.coalesce(*(F.when(decline_model == m, F.lit(x)) for m, x in EXPONENT.items()), F.lit(0.0) if b is None else b)
    least = F.when(decline_model == "exponential", F.lit(0.0)).otherwise(F.lit(0.05) if d_min is None else d_min)

    def curve(qi: Column) -> Column:
        return F.struct(decline_model.alias("decline_model"), qi.alias("qi"), (qi / MONTH_DAYS).alias("qi_daily"), di.alias("di"), exponent.alias("b"), least.alias("d_min"))

    gas = F.lit(0.0) if qi_gas is None else qi_gas
    return F.struct(curve(qi_oil).alias("oil"), F.when(gas > 0, curve(gas)).alias("gas"))


def terms(a: Column, b: Column, a_min: Column) -> dict[str, Column]:
    """What a curve's volumes need that does not depend on the month: the month from which decline is terminal (NULL: never), the rate there, and
    the factor and exponent of the hyperbolic part."""
    bounded = (b > 0) & (a_min > 0)
    turn = F.when(bounded, F.greatest((a / F.when(bounded, a_min).otherwise(1.0) - 1) / (F.when(bounded, b).otherwise(1.0) * a), F.lit(0.0)))
    some = F.when(b == 0, 1.0).otherwise(b)
    at_turn = F.when(b == 1, 1 / (1 + a * turn)).otherwise(F.pow(1 + b * a * turn, -1 / some))
    return {"_turn": turn, "_tail": at_turn / F.when(bounded, a_min).otherwise(1.0), "_power": 1 - 1 / some, "_scale": 1 / (F.when(b == 1, 1.0).otherwise(1 - b) * a)}


def unit_volume(t: Column) -> Column:
    """Cumulative volume up to month ``t`` at an initial rate of 1, from columns a, b, a_min and ``terms``."""
    a, b, turn = F.col("a"), F.col("b"), F.col("_turn")
    u = F.least(t, turn)  # least() passes over NULL
    hyperbolic = (
        F.when(b == 0, (1 - F.exp(-a * u)) / a)
        .when(b == 1, F.log(1 + a * u) / a)
        .when(F.abs(b - 1) < 1e-3, F.expm1((b - 1) / b * F.log1p(b * a * u)) / (a * (b - 1)))  # the plain form cancels here
        .otherwise(F.col("_scale") * (1 - F.pow(1 + b * a * u, F.col("_power"))))
    )
    return F.when(t > turn, hyperbolic + F.col("_tail") * (1 - F.exp(-F.col("a_min") * (t - turn)))).otherwise(hyperbolic)


def forecast(cases: DataFrame, months: int = 600, kind: str = "nominal") -> DataFrame:
    """One row per case and month from ``cases`` (case_id, decline_model, qi_oil, qi_gas, di, b, d_min).

    Exponential sets b to 0 and has no terminal decline, harmonic sets it to 1. Without initial gas rate gas is 0. What depends on the case alone
    is computed once a case; oil and gas share the volumes at a rate of 1.
    """
    b = F.coalesce(*(F.when(F.col("decline_model") == m, F.lit(x)) for m, x in EXPONENT.items()), F.col("b")).alias("b")
    c = cases.select("case_id", "qi_oil", "qi_gas", b, "di", "d_min").withColumns({"a": nominal(F.col("di"), kind) / 12, "a_min": F.col("d_min") / 12})
    c = c.withColumns(terms(F.col("a"), F.col("b"), F.col("a_min"))).withColumn("month_index", F.explode(F.sequence(F.lit(1), F.lit(months))))
    t = F.col("month_index").cast("double")
    c = c.withColumns({"_now": unit_volume(t), "_before": unit_volume(t - 1)})
    out = {}
    for name, q in (("oil_bbl", F.col("qi_oil")), ("gas_mcf", F.when(F.col("qi_gas") > 0, F.col("qi_gas")).otherwise(F.lit(0.0)))):
        out |= {f"cumulative_{name}": q * F.col("_now"), name: q * (F.col("_now") - F.col("_before"))}
    return c.withColumns(out).select("case_id", "month_index", "oil_bbl", "gas_mcf", "cumulative_oil_bbl", "cumulative_gas_mcf")


# ---------------------------------------------------------------- history


def smoothed(x: np.ndarray, window: int) -> np.ndarray:
    """Centred mean, the ends repeated outwards; short series stay."""
    if window <= 1 or len(x) < window:
        return x
    half = window // 2
    return np.convolve(np.pad(x, half, mode="edge"), np.ones(window), "valid")[: len(x)] / window


def decline_start(production, significance: float = 0.5, window: int = 3) -> tuple[int, float]:
    """Index and value of the latest significant peak. Fewer than 3 producing months raise ValueError."""
    x = np.nan_to_num(np.asarray(production, float), nan=0.0)
    if np.count_nonzero(x) < 3:
        raise ValueError("at least 3 non-zero months are needed")
    s = smoothed(x, window)
    left = np.concatenate(([True], s[1:] >= s[:-1]))
    right = np.concatenate((s[:-1] >= s[1:], [True]))
    peaks = np.flatnonzero(left & right & (x > 0))
    if not len(peaks):
        peaks = np.array([int(x.argmax())])
    islands = np.split(peaks, np.flatnonzero(np.diff(peaks) > window) + 1)
    best = [int(i[x[i].argmax()]) for i in islands]
    best = [i for i in best if x[i] >= x.max() * significance] or [int(x.argmax())]
    return best[-1], float(x[best[-1]])


def outliers(production, window: int = 3, threshold: float = 0.3) -> np.ndarray:
    """Marks months below ``threshold`` of the median of the positive months around; series shorter than the window have none."""
    x = np.asarray(production, float)
    marks = np.zeros(len(x), bool)
    if len(x) < window:
        return marks
    half = window // 2
    for i in range(len(x)):
        near = x[max(0, i - half) : i + half + 1]
        near = near[near > 0]
        if len(near):
            marks[i] = np.isnan(x[i]) or x[i] < threshold * np.median(near)
    return marks


def flag_outliers(rows: DataFrame, keys: list[str], order: str, value: str, window: int = 3, threshold: float = 0.3) -> DataFrame:
    """``rows`` with ``is_outlier``, under the rule of ``outliers``, as window functions: no Python."""
    half = window // 2
    w = Window.partitionBy(*keys)
    x = F.col(value)
    around = F.array_sort(F.collect_list(F.when(x > 0, x)).over(w.orderBy(order).rowsBetween(-half, half)))
    n = F.size(around)
    near = F.when(n > 0, (F.get(around, F.floor((n - 1) / 2).cast("int")) + F.get(around, F.floor(n / 2).cast("int"))) / 2)
    low = x.isNull() | (x < threshold * near)
    long = F.count("*").over(w) >= window
    return rows.withColumn("is_outlier", F.coalesce(long & near.isNotNull() & low, F.lit(False)))


# ---------------------------------------------------------------- fitting

BOUNDS = ((0.001, 5.0), (0.001, 5.0), (0.001, 2.0))  # qi in multiples of the first rate (its low end: a rate), di, b


def rate(t: np.ndarray, qi: float, di: float, b: float, d_min: float) -> np.ndarray:
    """Rate at month ``t``."""
    a, m = di / 12, d_min / 12
    if b < 1e-9:
        return qi * np.exp(-a * t)
    turn = max(0.0, (a / m - 1) / (b * a)) if m > 0 else np.inf
    q = qi * (1 + b * a * np.minimum(t, turn)) ** (-1 / b)
    return q * np.exp(-m * np.maximum(t - turn, 0)) if np.isfinite(turn) else q


def fit_arps(production, months=None, model: str = "hyperbolic", d_min: float = 0.05) -> dict:
    """Least squares of monthly rates within bounds: projected Levenberg-Marquardt steps from several exponents.

    Months that are not positive stay out; fewer than 3 others raise ValueError.
    """
    y = np.asarray(production, float)
    t = np.arange(1, len(y) + 1, dtype=float) if months is None else np.asarray(months, float)
    ok = np.nan_to_num(y, nan=0.0) > 0
    y, t = y[ok], t[ok]
    if len(y) < 3:
        raise ValueError("at least 3 non-zero months are needed to fit")
    fixed = EXPONENT.get(model)
    terminal = 0.0 if model == "exponential" else d_min
    low = np.array([BOUNDS[0][0], BOUNDS[1][0], BOUNDS[2][0]])
    high = np.array([BOUNDS[0][1] * y[0], BOUNDS[1][1], BOUNDS[2][1]])
    free = 2 if fixed is not None else 3

    def curve(p: np.ndarray) -> np.ndarray:
        return rate(t, p[0], p[1], fixed if fixed is not None else p[2], terminal)

    best, cost = None, np.inf
    for b0 in (0.5,) if fixed is not None else (0.2, 0.5, 0.8, 1.2):
        p, damp = np.clip(np.array([y[0], 0.5, b0]), low, high), 1e-2
        r = curve(p) - y
        for _ in range(200):
            j = np.empty((len(t), free))
            for k in range(free):
                step = np.zeros(3)
                step[k] = 1e-6 * max(abs(p[k]), 1e-3)
                if p[k] + step[k] > high[k]:
                    step = -step
                j[:, k] = (curve(p + step) - curve(p)) / step[k]
            h, g = j.T @ j, j.T @ r
            # what stands at a bound and would go beyond it is held there
            move = ~((p[:free] <= low[:free]) & (g > 0) | (p[:free] >= high[:free]) & (g < 0))
            if not move.any():
                break
            h, g = h[np.ix_(move, move)], g[move]
            trial = p.copy()
            trial[:free][move] -= np.linalg.lstsq(h + damp * np.diag(np.diag(h) + 1e-12), g, rcond=None)[0]
            trial = np.clip(trial, low, high)
            new = curve(trial) - y
            if new @ new < r @ r:
                done = r @ r - new @ new < 1e-12 * (r @ r + 1e-12)
                p, r, damp = trial, new, max(damp / 3, 1e-9)
                if done:
                    break
            else:
                damp *= 4
                if damp > 1e9:
                    break
        if r @ r < cost:
            best, cost = p, float(r @ r)
    b = fixed if fixed is not None else float(best[2])
    resid = rate(t, best[0], best[1], b, d_min) - y
    spread = float(((y - y.mean()) ** 2).sum())
    return {"qi": float(best[0]), "di": float(best[1]), "b": b, "d_min": d_min, "r_squared": 1 - float(resid @ resid) / spread if spread else 1.0, "rmse": float(np.sqrt((resid**2).mean()))}


FIT = "qi double, di double, b double, d_min double, r_squared double, rmse double, peak_index int, peak_value double, months_used int, status string"


def fit_wells(rows: DataFrame, keys: list[str], order: str, value: str, model: str = "hyperbolic") -> DataFrame:
    """One row per well: its history trimmed to the latest peak, cleaned of outliers, and fitted. A well that cannot be
    fitted has a status, and no job fails on it."""
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    names = [x.split()[0] for x in FIT.split(", ")]

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order)[value].to_numpy(float)
        out = dict.fromkeys(names)
        try:
            at, peak = decline_start(x)
            y = x[at:]
            keep = ~outliers(y)
            t = np.arange(1, len(y) + 1)[keep]
            out |= fit_arps(y[keep], t, model) | {"peak_index": at, "peak_value": peak, "months_used": int(keep.sum()), "status": "fitted"}
        except ValueError as e:
            out["status"] = str(e)
        return pd.DataFrame([{**dict(zip(keys, key, strict=True)), **out}])

    return rows.select(*keys, order, value).groupBy(*keys).applyInPandas(one, f"{kinds}, {FIT}")


def peaks(rows: DataFrame, keys: list[str], order: str, value: str, significance: float = 0.5, window: int = 3) -> DataFrame:
    """One row per well: index (from 0) and value of the peak its decline starts at, under the rule of ``decline_start``; NULL with fewer
    than 3 producing months.

    Window functions only: one exchange by well and one sort serve the smoothing, its plateaus, the islands of peaks and all sums.
    """
    x, i, n = F.col("_x"), F.col("_i"), F.col("_n")
    well = Window.partitionBy(*keys)
    time = well.orderBy("_o")
    before, ahead = window // 2, window - 1 - window // 2
    h = rows.select(*keys, F.col(order).alias("_o"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("_x"))
    whole = time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    h = h.withColumns(
        {
            "_i": F.row_number().over(time) - 1, "_n": F.count("*").over(whole), "_top": F.max("_x").over(whole), "_producing": F.count_if(x != 0).over(whole),
            "_first": F.first("_x").over(whole), "_last": F.last("_x").over(whole), "_near": F.sum("_x").over(time.rowsBetween(-before, ahead)),
        }
    )
    # the ends are repeated outwards
    ends = F.col("_first") * F.greatest(before - i, F.lit(0)) + F.col("_last") * F.greatest(i + ahead - (n - 1), F.lit(0))
    smooth = F.when((n < window) | F.lit(window <= 1), x).otherwise((F.col("_near") + ends) / window)
    h = h.withColumn("_s", smooth).withColumns({"_was": F.lag("_s").over(time), "_next": F.lead("_s").over(time)})
    peak = (x > 0) & (F.col("_was").isNull() | (F.col("_s") >= F.col("_was"))) & (F.col("_next").isNull() | (F.col("_s") >= F.col("_next")))
    h = h.withColumn("_peak", peak).withColumn("_prior", F.last(F.when(F.col("_peak"), i), True).over(time.rowsBetween(Window.unboundedPreceding, -1)))
    begins = F.col("_peak") & (F.col("_prior").isNull() | (i - F.col("_prior") > window))
    h = h.withColumn("_island", F.sum(begins.cast("int")).over(time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # of each island its highest peak, and of all months the highest; of equals the first
    height = F.struct(x.alias("x"), (-i).alias("i"))
    islands = h.groupBy(*keys, "_island").agg(
        F.max(F.when(F.col("_peak"), height)).alias("_best"), F.max(height).alias("_any"), F.max("_top").alias("_top"), F.max("_producing").alias("_producing")
    )
    good = F.when(F.col("_best.x") >= F.col("_top") * significance, F.struct(F.col("_island"), F.col("_best")))
    wells = islands.groupBy(*keys).agg(F.max(good).alias("_good"), F.max("_any").alias("_any"), F.max("_producing").alias("_producing"))
    best = F.when(F.col("_producing") >= 3, F.coalesce("_good._best", "_any"))
    return wells.select(*keys, (-best.getField("i")).cast("int").alias("peak_index"), best.getField("x").alias("peak_value"))
