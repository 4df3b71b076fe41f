import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.operators import decline, economics


@pytest.mark.parametrize(
    ("series", "want"),
    [
        ([1000, 800, 650, 530, 430, 350, 280, 230], (0, 1000)),
        ([200, 400, 700, 1000, 850, 700, 570, 460], (3, 1000)),
        ([1000, 800, 640, 510, 410, 330, 260, 200, 700, 900, 700, 580, 460], (9, 900)),
        ([1000, 800, 640, 510, 410, 330, 260, 300, 280, 230, 180], (0, 1000)),
    ],
)
def test_decline_start(series, want):
    assert decline.decline_start(series) == want


def test_too_short():
    with pytest.raises(ValueError, match="at least 3"):
        decline.decline_start([100, 0, 0, 0])
    with pytest.raises(ValueError, match="at least 3"):
        decline.fit_arps([100, 0, 90])


def test_outliers():
    assert np.flatnonzero(decline.outliers([1000, 850, 720, 0, 520, 440, 370, 315])).tolist() == [3]
    assert not decline.outliers([1000, 0], window=3).any()


def test_fit():
    t = np.arange(1, 37)
    f = decline.fit_arps(500 * np.exp(-0.4 * t / 12), model="exponential")
    assert f["r_squared"] > 0.95 and abs(f["qi"] - 500) < 150 and abs(f["di"] - 0.4) < 0.02
    y = 800 * (1 + 0.9 * 0.7 / 12 * t) ** (-1 / 0.9)
    h = decline.fit_arps(y)
    assert h["r_squared"] > 0.999 and abs(h["b"] - 0.9) < 0.2
    assert decline.fit_arps([500, 450, 0, 380, 340, 0, 280, 250])["r_squared"] > 0.9


def case(spark, model="hyperbolic", qg=0.0, di=0.6):
    return spark.createDataFrame([("c", model, 1000.0, qg, di, 0.8, 0.05)], "case_id string, decline_model string, qi_oil double, qi_gas double, di double, b double, d_min double")


@pytest.mark.parametrize("model", ["exponential", "hyperbolic", "harmonic"])
def test_forecast_shape(spark, model):
    rows = decline.forecast(case(spark, model, 500.0), 600).orderBy("month_index").collect()
    oil = np.array([r.oil_bbl for r in rows])
    assert len(rows) == 600 and (np.diff(oil) < 1e-9).all() and oil[0] < 1000
    assert np.allclose(np.cumsum(oil), [r.cumulative_oil_bbl for r in rows])
    assert np.allclose([r.gas_mcf for r in rows], oil / 2)


def test_terminal_decline(spark):
    rows = decline.forecast(case(spark), 600).orderBy("month_index").collect()
    late = np.array([r.oil_bbl for r in rows[-24:]])
    assert np.allclose(late[1:] / late[:-1], np.exp(-0.05 / 12), atol=1e-6)


def test_economics(spark):
    f = decline.forecast(case(spark, "exponential"), 360)
    t = economics.Terms(0.8, 70.0, 3.0, 9000.0)
    v = economics.valuation(f, t).first()
    flows = economics.cash_flows(f, t).orderBy("month_index").collect()
    limit = next(r.month_index for r in flows if r.net_cash_flow <= 0)
    assert v.economic_limit_month == limit == economics.economic_limit(f, t).first().economic_limit_month
    assert v.eur_oil_bbl == flows[limit - 1].cumulative_oil_bbl
    assert np.isclose(v.pv10, sum(r.discounted_cash_flow for r in flows[:limit])) and v.pv10 < v.npv
    assert np.isclose(flows[11].discount_factor, 1 / 1.1)
    rich = economics.valuation(f, economics.Terms(0.8, 70.0, 3.0, 0.0)).first()
    assert rich.economic_limit_month is None and np.isclose(rich.eur_oil_bbl, flows[-1].cumulative_oil_bbl)


def test_wells(spark):
    rows = [("a", m, float(1000 * 0.93**m)) for m in range(24)] + [("b", m, 0.0) for m in range(5)]
    df = spark.createDataFrame(rows, "w string, m int, v double")
    got = {r.w: r for r in decline.fit_wells(df, ["w"], "m", "v").collect()}
    assert got["a"].status == "fitted" and got["a"].r_squared > 0.99 and got["b"].qi is None and "3" in got["b"].status
    assert {r.w: r.peak_index for r in decline.peaks(df, ["w"], "m", "v").collect()} == {"a": 0, "b": None}


def test_exponents_around_one(spark):
    """Volumes are continuous in b, also where 1 - b nearly vanishes."""
    cases = spark.createDataFrame([(str(i), "hyperbolic", 1000.0, 0.0, 0.6, 1 + x, 0.0) for i, x in enumerate((0.0, 1e-15, -1e-15, 1e-9, -1e-6, 1e-4, -1e-4, 1.1e-3))], "case_id string, decline_model string, qi_oil double, qi_gas double, di double, b double, d_min double")
    got = {r.case_id: r.cumulative_oil_bbl for r in decline.forecast(cases, 120).filter("month_index = 120").collect()}
    assert max(abs(v / got["0"] - 1) for v in got.values()) < 2e-3 and abs(got["1"] / got["0"] - 1) < 1e-9 and abs(got["2"] / got["0"] - 1) < 1e-9


def test_models(spark):
    rows = [("exponential", 0.7, 0.05, 10.0), ("harmonic", 0.7, 0.05, 0.0), ("hyperbolic", 0.7, 0.05, None)]
    df = spark.createDataFrame(rows, "m string, b double, d double, g double")
    got = {r.m: r.c for r in df.select("m", decline.create_model(F.col("m"), F.lit(3043.75), F.lit(0.4), F.col("b"), F.col("d"), F.col("g")).alias("c")).collect()}
    assert {m: (c.oil.b, c.oil.d_min, c.oil.qi_daily, c.oil.di) for m, c in got.items()} == {"exponential": (0.0, 0.0, 100.0, 0.4), "harmonic": (1.0, 0.05, 100.0, 0.4), "hyperbolic": (0.7, 0.05, 100.0, 0.4)}
    assert got["exponential"].gas.qi == 10.0 and got["exponential"].gas.b == 0.0 and got["harmonic"].gas is None and got["hyperbolic"].gas is None


def test_fits_are_least_squares(spark):
    """The query's fits: no small step of a parameter within its bounds fits better, and the stated errors are those of the curve."""
    from tallgrass.plans import queries

    d = "/root/testdata/sf0.001"
    history = queries.declining(spark, d).select("api_number", "state", "production_date", "total_oil_bbl").toPandas()
    fits = queries.fit_arps(spark, d).toPandas()
    assert (fits.status == "fitted").sum() > 3
    for f in fits[fits.status == "fitted"].itertuples():
        x = history[(history.api_number == f.api_number) & (history.state == f.state)].sort_values("production_date").total_oil_bbl.to_numpy(float)
        at, peak = decline.decline_start(x)
        assert (at, peak) == (f.peak_index, f.peak_value)
        y = x[at:]
        keep = ~decline.outliers(y) & (y > 0)
        t, y = np.arange(1, len(y) + 1)[keep], y[keep]
        error = lambda qi, di, b: float(((decline.rate(t, qi, di, b, f.d_min) - y) ** 2).sum())
        best = error(f.qi, f.di, f.b)
        assert abs(f.rmse - np.sqrt(best / len(y))) < 1e-6 * (1 + f.rmse) and abs(f.r_squared - (1 - best / ((y - y.mean()) ** 2).sum())) < 1e-6
        (_, top), (d_low, d_high), (b_low, b_high) = decline.BOUNDS
        for step in (0.99, 1.01):
            assert error(min(f.qi * step, top * y[0]), f.di, f.b) >= best * (1 - 1e-4)
            assert error(f.qi, min(max(f.di * step, d_low), d_high), f.b) >= best * (1 - 1e-4)
            assert error(f.qi, f.di, min(max(f.b * step, b_low), b_high)) >= best * (1 - 1e-4)


def test_economics_month_by_month(spark):
    """The query's values against a loop over the months of each fitted well."""
    from tallgrass.plans import queries

    out = queries.well_economics(spark, "/root/testdata/sf0.001").toPandas()
    done = out[out.status == "fitted"]
    assert len(done) > 3 and done.pv10.notna().all()
    for r in done.itertuples():
        gas0 = 0.0 if r.qi_gas is None or r.qi_gas != r.qi_gas else r.qi_gas
        pv10 = npv = oil = gas = 0.0
        limit = None
        steps = np.linspace(0, 1, 2001)
        for m in range(1, 361):
            unit = np.trapezoid(decline.rate(m - 1 + steps, 1.0, r.di, r.b, r.d_min), dx=1 / 2000)
            flow = (r.qi * unit * 70 + gas0 * unit * 3) * 0.8 * (1 - 0.046) - 500
            pv10, npv, oil, gas = pv10 + flow * 1.1 ** (-m / 12), npv + flow, oil + r.qi * unit, gas + gas0 * unit
            if flow <= 0:
                limit = m
                break
        assert (limit is None and np.isnan(r.economic_limit_month)) or limit == r.economic_limit_month
        assert np.allclose([r.pv10, r.npv, r.eur_oil_bbl, r.eur_gas_mcf], [pv10, npv, oil, gas], rtol=1e-4)
