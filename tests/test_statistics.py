import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indicata.operators import correlation, describe, distribution, quantiles, regression, residuals, trend


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(11)
    n = 3000
    burden = np.exp(rng.normal(-3, 0.4, n))
    gdp = np.exp(rng.normal(19, 1.5, n))
    idhm = 0.7 - 1.5 * burden + 1e-12 * gdp + rng.normal(0, 0.05, n)
    data = pd.DataFrame({"code": [f"{i:05d}" for i in range(n)], "idhm": idhm, "burden": burden, "gdp": gdp})
    data.loc[::97, "gdp"] = np.nan
    data.loc[5::211, "burden"] = np.inf
    data.loc[7::301, "idhm"] = np.nan
    frame = spark.createDataFrame(data).withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c in ("idhm", "burden", "gdp")}
    )
    path = spark.conf.get("spark.checkpoint.dir") + "/sample"
    frame.write.mode("overwrite").parquet(path)
    return data, spark.read.parquet(path)


def cases(data):
    return data.replace([np.inf, -np.inf], np.nan).dropna()


# --- quantiles --------------------------------------------------------------


def spread_out(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(4)


FRACTIONS = [0.0, 0.25, 0.5, 0.95, 1.0]


@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(1).normal(size=4000),
        np.exp(np.random.default_rng(2).normal(size=4001) * 12),  # spans many magnitudes
        np.concatenate([np.full(3000, 7.0), np.random.default_rng(3).normal(size=1500)]),  # one hot value
        np.repeat([1.0, 2.0], [2500, 2500]),  # the median lies between two hot values
        np.full(2000, 3.5),
        np.array([5.0]),
    ],
    ids=["normal", "wide", "hot", "two", "constant", "single"],
)
def test_narrowing_finds_the_exact_quantiles(spark, values):
    found = quantiles.exact_quantiles(spread_out(spark, [*values, None]), {"v": FRACTIONS}, small=20)["v"]
    assert [found[q] for q in FRACTIONS] == pytest.approx(list(np.quantile(values, FRACTIONS)), rel=1e-14)


def test_narrowing_survives_a_sketch_that_misses(spark, monkeypatch):
    """Brackets from the wrong end still lead to the right rank."""
    monkeypatch.setattr(quantiles, "_sketch", lambda value, q: F.percentile_approx(value, [0.1, 0.2], 100))
    values = np.random.default_rng(5).normal(size=400)
    found = quantiles.exact_quantiles(spread_out(spark, values), {"v": [0.37]}, small=100)["v"]
    assert found[0.37] == pytest.approx(np.quantile(values, 0.37), rel=1e-14)


def test_quantiles_of_small_and_empty_columns(spark):
    assert quantiles.exact_quantiles(spread_out(spark, [1, 2, 4]), {"v": [0.5, 0.75]})["v"] == {0.5: 2.0, 0.75: 3.0}
    assert quantiles.exact_quantiles(spread_out(spark, [None]), {"v": [0.5]})["v"] == {0.5: None}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-30, 30), min_size=1, max_size=300), st.floats(0, 1))
def test_narrowing_agrees_with_numpy(spark, values, fraction):
    found = quantiles.exact_quantiles(spread_out(spark, values), {"v": [fraction]}, small=30)["v"][fraction]
    assert found == pytest.approx(float(np.quantile(values, fraction)), abs=1e-12)


# --- description ------------------------------------------------------------


def test_describe_agrees_with_pandas(spark, sample):
    data, df = sample
    found = {(v, s): x for v, s, x in describe.describe(df, ["idhm", "gdp"]).collect()}
    wanted = data[["idhm", "gdp"]].describe()
    for variable in ("idhm", "gdp"):
        for stat in wanted.index:
            assert found[variable, stat] == pytest.approx(wanted.loc[stat, variable], rel=1e-12)


def test_describe_edges(spark):
    one = {s: x for _, s, x in describe.describe(spark.createDataFrame([(2.0,)], "v double")).collect()}
    assert one["count"] == 1 and one["std"] is None and one["50%"] == 2.0
    flat = {s: x for _, s, x in describe.describe(spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")).collect()}
    assert flat["count"] == 2 and flat["std"] == 0.0
    infinite = spark.createDataFrame([(1.0,), (3.0,), (math.inf,)], "v double")
    left_out = {s: x for _, s, x in describe.moments(infinite).collect()}
    assert (left_out["count"], left_out["mean"], left_out["excluded"]) == (2, 2.0, 1)
    kept = {s: x for _, s, x in describe.moments(infinite, keep_infinite=True).collect()}
    assert kept["count"] == 3 and kept["mean"] == math.inf and math.isnan(kept["std"])


def test_approximate_quartiles_are_near(spark, sample):
    data, df = sample
    found = {s: x for _, s, x in describe.quartiles(df, ["gdp"], approx=True).collect()}
    ranks = data["gdp"].dropna().rank(pct=True)
    assert ranks[(data["gdp"] - found["50%"]).abs().idxmin()] == pytest.approx(0.5, abs=0.01)


# --- correlation ------------------------------------------------------------


def test_matrix_agrees_with_pandas(spark, sample):
    data, df = sample
    names = ["idhm", "burden", "gdp"]
    wanted = data[names].replace([np.inf], np.nan).corr(method="pearson")
    found = {(x, y): r for x, y, r, _ in correlation.correlation_matrix(df, names).collect()}
    assert len(found) == 9
    for x in names:
        for y in names:
            assert found[x, y] == pytest.approx(wanted.loc[x, y], abs=1e-12)
            assert found[x, y] == found[y, x]


def test_correlation_skips_incomplete_and_infinite_pairs(spark):
    given_ = [(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 100.0), (4.0, math.inf)]
    df = spark.createDataFrame(given_, "x double, y double")
    found = {(x, y): (r, n) for x, y, r, n in correlation.correlation_pairs(df, ["x", "y"]).collect()}
    assert found["x", "y"][0] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    assert found["x", "y"][1] == 3
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert {(x, y): r for x, y, r, _ in correlation.correlation_pairs(flat, ["x", "y"]).collect()} == {("x", "x"): None, ("x", "y"): None, ("y", "y"): 1.0}


# --- regression -------------------------------------------------------------


def least_squares(data):
    design = np.column_stack([np.ones(len(data)), data["burden"], data["gdp"]])
    coef, *_ = np.linalg.lstsq(design / design.max(0), data["idhm"], rcond=None)
    return design, coef / design.max(0)


def test_fit_agrees_with_least_squares(sample):
    data, df = sample
    kept = cases(data)
    design, coef = least_squares(kept)
    fit = regression.ols(df, "idhm", ["burden", "gdp"])
    assert fit.n == len(kept)
    assert [fit.intercept, *fit.slopes] == pytest.approx(list(coef), rel=1e-9)
    rss = float(((kept["idhm"] - design @ coef) ** 2).sum())
    assert fit.residual == pytest.approx(rss, rel=1e-10)
    assert fit.condition_number() == pytest.approx(np.linalg.cond(design), rel=1e-6)


def test_fit_agrees_with_the_ml_library(spark, sample):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    _, df = sample
    kept = df.where(regression.complete_case(["idhm", "burden", "gdp"]))
    rows_ = VectorAssembler(inputCols=["burden", "gdp"], outputCol="x").transform(kept)
    model = LinearRegression(featuresCol="x", labelCol="idhm", solver="normal").fit(rows_)
    fit = regression.ols(df, "idhm", ["burden", "gdp"])
    table = {r[0]: r for r in fit.coefficients()}
    # The library lists predictors first and the intercept last.
    for term, coef, error, t, p in zip(
        ["burden", "gdp", "Intercept"],
        [*model.coefficients, model.intercept],
        model.summary.coefficientStandardErrors,
        model.summary.tValues,
        model.summary.pValues,
    ):
        assert table[term][1] == pytest.approx(coef, rel=1e-8)
        assert table[term][2] == pytest.approx(error, rel=1e-8)
        assert table[term][3] == pytest.approx(t, rel=1e-8)
        assert table[term][4] == pytest.approx(p, abs=1e-9)
    assert fit.quality()["r2"] == pytest.approx(model.summary.r2, rel=1e-9)
    assert fit.quality()["adj_r2"] == pytest.approx(model.summary.r2adj, rel=1e-9)


def test_analysis_of_variance_identities(sample):
    _, df = sample
    fit = regression.ols(df, "idhm", ["burden", "gdp"])
    t = {r[0]: r[3] for r in fit.coefficients()}
    table = {r[0]: r for r in fit.anova()}
    for term in ("burden", "gdp"):
        without = regression.ols(df.where(regression.complete_case(["idhm", "burden", "gdp"])), "idhm", [c for c in ("burden", "gdp") if c != term])
        assert table[term][3] == pytest.approx(t[term] ** 2, rel=1e-10)
        assert table[term][1] == pytest.approx(without.residual - fit.residual, rel=1e-6)
        assert table[term][4] == pytest.approx({r[0]: r[4] for r in fit.coefficients()}[term], abs=1e-14)
    assert table["Residual"][1] == fit.residual
    assert fit.explained + fit.residual == pytest.approx(fit.total)


def test_three_predictors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    y = 1 + x @ [2.0, -3.0, 0.5] + rng.normal(0, 0.1, 400)
    df = spark.createDataFrame([tuple(map(float, (*r, v))) for r, v in zip(x, y)], "a double, b double, c double, y double")
    fit = regression.ols(df, "y", ["a", "b", "c"])
    coef, *_ = np.linalg.lstsq(np.column_stack([np.ones(400), x]), y, rcond=None)
    assert [fit.intercept, *fit.slopes] == pytest.approx(list(coef), rel=1e-10)


@pytest.mark.parametrize(
    "rows_",
    [
        [(1.0, 1.0, 2.0), (2.0, 2.5, 4.0), (3.0, 1.0, 3.0)],
        [(1.0, 1.0, 2.0), (2.0, 2.0, 4.0)],
        [(1.0, None, 2.0)],
        [],
    ],
)
def test_too_few_rows_are_refused(spark, rows_):
    df = spark.createDataFrame(rows_, "y double, a double, b double")
    with pytest.raises(regression.NotEstimable, match="complete rows"):
        regression.ols(df, "y", ["a", "b"])


def superfluous(kind, rng):
    a, b = rng.normal(5, 2, 300), rng.normal(-1, 30, 300)
    made = {
        "doubled": [a, b, a],
        "scaled": [a, b, 1000 * a],
        "sum": [a, b, a + b],
        "constant": [a, np.full(300, 3.0), b],
        "zero": [a, np.zeros(300), b],
        "several": [a, a, np.full(300, -2.0), b, a - 2 * b],
        "all constant": [np.full(300, 4.0), np.full(300, 1.0)],
    }[kind]
    return np.column_stack(made), 2 + 3 * a - 0.1 * b + rng.normal(0, 1, 300)


@pytest.mark.parametrize("kind", ["doubled", "scaled", "sum", "constant", "zero", "several", "all constant"])
def test_superfluous_predictors_get_the_shortest_solution(spark, kind):
    x, y = superfluous(kind, np.random.default_rng(8))
    names_ = [f"x{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([tuple(map(float, (*r, v))) for r, v in zip(x, y)], ", ".join(f"{c} double" for c in [*names_, "y"]))
    fit = regression.ols(df, "y", names_)
    design = np.column_stack([np.ones(300), x])
    inverse, rank = np.linalg.pinv(design), np.linalg.matrix_rank(design)
    coef = inverse @ y
    residual = float(((y - design @ coef) ** 2).sum())
    assert fit.rank == rank and fit.df_residual == 300 - rank
    assert [fit.intercept, *fit.slopes] == pytest.approx(list(coef), rel=1e-8, abs=1e-9)
    assert fit.residual == pytest.approx(residual, rel=1e-9)
    errors = np.sqrt(residual / (300 - rank) * np.diag(inverse @ inverse.T))
    assert [r[2] for r in fit.coefficients()] == pytest.approx(list(errors), rel=1e-8, abs=1e-12)
    shown = fit.residual_column()
    assert [r[0] for r in df.select(shown).collect()] == pytest.approx(list(y - design @ coef), abs=1e-8)
    assert (fit.condition_number() == math.inf) and fit.quality()["df_model"] == rank - 1
    assert len(fit.anova()) == x.shape[1] + 1


def test_a_doubled_predictor_gets_half_the_coefficient(spark):
    x, y = superfluous("doubled", np.random.default_rng(8))
    df = spark.createDataFrame([tuple(map(float, (*r, v))) for r, v in zip(x, y)], "a double, b double, again double, y double")
    one, two = regression.ols(df, "y", ["a", "b"]), regression.ols(df, "y", ["a", "b", "again"])
    assert two.slopes[0] == pytest.approx(one.slopes[0] / 2) == pytest.approx(two.slopes[2])
    assert two.quality() == pytest.approx(one.quality())
    sums = {r[0]: r[1] for r in two.anova()}
    assert sums["a"] == pytest.approx(sums["again"]) == pytest.approx({r[0]: r[1] for r in one.anova()}["a"])


def test_a_constant_response_has_no_quality(spark):
    df = spark.createDataFrame([(7.0, float(k)) for k in range(9)], "y double, a double")
    fit = regression.ols(df, "y", ["a"])
    assert (fit.intercept, fit.slopes[0], fit.residual) == (7.0, 0.0, 0.0)
    assert fit.quality()["r2"] is None and fit.quality()["f"] is None
    assert fit.coefficients()[1][3] is None


def residual_vector(data):
    kept = cases(data).sort_values("code")
    design, coef = least_squares(kept)
    return (kept["idhm"] - design @ coef).to_numpy()


def test_diagnostics_agree_with_moments(sample):
    data, df = sample
    e = residual_vector(data)
    m2, m3, m4 = (np.mean((e - e.mean()) ** k) for k in (2, 3, 4))
    found = residuals.diagnostics(df, regression.ols(df, "idhm", ["burden", "gdp"]))
    assert found["skewness"] == pytest.approx(m3 / m2**1.5, rel=1e-6)
    assert found["kurtosis"] == pytest.approx(m4 / m2**2, rel=1e-8)
    assert 0 <= found["omnibus_p"] <= 1 and 0 <= found["jarque_bera_p"] <= 1


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_durbin_watson_across_partition_borders(spark, sample, partitions):
    data, df = sample
    e = residual_vector(data)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fit = regression.ols(df, "idhm", ["burden", "gdp"])
        found = residuals.durbin_watson(df, fit, "code").first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == pytest.approx(float((np.diff(e) ** 2).sum() / (e**2).sum()), rel=1e-9)


# --- charts -----------------------------------------------------------------


def test_histogram_equals_numpy(spark, sample):
    data, df = sample
    for column in ("idhm", "gdp"):
        values = data[column].dropna().to_numpy()
        counts, edges = np.histogram(values, bins=100)
        found = sorted(distribution.histogram(df, [column]).collect(), key=lambda r: r["bin"])
        assert [r["rows"] for r in found] == list(counts)
        assert [r["low"] for r in found] + [found[-1]["high"]] == pytest.approx(list(edges), rel=1e-12)


def test_histogram_of_edge_values_and_constants(spark):
    grid = spark.createDataFrame([(i / 10,) for i in range(11)], "v double")
    counts, _ = np.histogram([i / 10 for i in range(11)], bins=10)
    found = sorted(distribution.histogram(grid, ["v"], bins=10).collect(), key=lambda r: r["bin"])
    assert [r["rows"] for r in found] == list(counts)
    constant = distribution.histogram(spark.createDataFrame([(3.0,)] * 5, "v double"), ["v"])
    assert {(r["bin"], r["rows"]) for r in constant.where("rows > 0").collect()} == {(50, 5)}
    empty = distribution.histogram(spark.createDataFrame([(None,)], "v double"), ["v"]).collect()
    assert len(empty) == 100 and {(r["low"], r["rows"]) for r in empty} == {(None, 0)}


def test_density_agrees_with_the_direct_sum(spark, sample):
    data, df = sample
    v = data["idhm"].dropna().to_numpy()
    found = sorted(distribution.density(df, ["idhm"]).collect(), key=lambda r: r["position"])
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 200)
    z = (x[:, None] - v[None, :]) / h
    direct = np.exp(-0.5 * z * z).sum(1) / (h * math.sqrt(2 * math.pi)) * (v.max() - v.min()) / 100
    assert [r["x"] for r in found] == pytest.approx(list(x))
    assert [r["y"] for r in found] == pytest.approx(list(direct), rel=1e-6)
    area = np.sum((direct[1:] + direct[:-1]) / 2 * np.diff(x))
    assert area == pytest.approx(len(v) * (v.max() - v.min()) / 100, rel=0.03)


def test_density_with_a_far_outlier_touches_few_points(spark):
    """The grid points between the bulk and the outlier get exactly nothing."""
    values = [float(v) for v in np.random.default_rng(8).normal(size=500)] + [1e6]
    found = sorted(distribution.density(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).collect(), key=lambda r: r["position"])
    v = np.array(values)
    h = v.std(ddof=1) * len(v) ** -0.2
    z = (np.linspace(v.min(), v.max(), 200)[:, None] - v[None, :]) / h
    direct = np.exp(-0.5 * z * z).sum(1) / (h * math.sqrt(2 * math.pi)) * (v.max() - v.min()) / 100
    assert [r["y"] for r in found] == pytest.approx(list(direct), rel=1e-6)
    flat = distribution.density(spark.createDataFrame([(1.0,)] * 3, "v double"), ["v"]).collect()
    assert len(flat) == 200 and {r["y"] for r in flat} == {None}


def test_trend_line_and_its_band(spark, sample):
    data, df = sample
    kept = data[["burden", "idhm"]].replace([np.inf], np.nan).dropna()
    slope, intercept = np.polyfit(kept["burden"], kept["idhm"], 1)
    line = sorted(trend.trend_line(df, "burden", "idhm").collect(), key=lambda r: r["position"])
    assert len(line) == 100
    assert [r["y"] for r in line] == pytest.approx([intercept + slope * r["x"] for r in line], rel=1e-9)
    band = sorted(trend.trend_band(df, "burden", "idhm", "code", replicates=400).collect(), key=lambda r: r["position"])
    assert all(b["low"] < r["y"] < b["high"] for b, r in zip(band, line))
    # Against the textbook standard error of the line at the mean and at the right end.
    e = kept["idhm"] - intercept - slope * kept["burden"]
    mean, sxx = kept["burden"].mean(), ((kept["burden"] - kept["burden"].mean()) ** 2).sum()
    sigma = math.sqrt((e**2).sum() / (len(kept) - 2))
    middle = min(range(100), key=lambda i: abs(line[i]["x"] - mean))
    for at in (middle, 99):
        error = sigma * math.sqrt(1 / len(kept) + (line[at]["x"] - mean) ** 2 / sxx)
        assert (band[at]["high"] - band[at]["low"]) / 2 / 1.96 == pytest.approx(error, rel=0.2)


def test_band_does_not_depend_on_partitions(spark, sample):
    _, df = sample
    one = rows(trend.trend_band(df.coalesce(1), "burden", "idhm", "code", replicates=50))
    many = rows(trend.trend_band(df.repartition(7), "burden", "idhm", "code", replicates=50))
    assert [r[0] for r in one] == [r[0] for r in many]
    assert [r[2:] for r in one] == [pytest.approx(r[2:], rel=1e-9) for r in many]


def test_band_covers_like_resampled_rows(spark):
    """The band of the groups against one from plain resampling of rows."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=3000)
    y = 2 * x + rng.normal(size=3000) * (1 + np.abs(x))
    df = spark.createDataFrame([(str(k), float(a), float(b)) for k, (a, b) in enumerate(zip(x, y))], "code string, x double, y double")
    for unit in ("code", None):
        band = sorted(trend.trend_band(df, "x", "y", unit, grid=5).collect(), key=lambda r: r["position"])
        lines = []
        for _ in range(600):
            pick = rng.integers(0, 3000, 3000)
            lines.append(np.polyval(np.polyfit(x[pick], y[pick], 1), [r["x"] for r in band]))
        low, high = np.percentile(lines, [2.5, 97.5], axis=0)
        assert [r["high"] - r["low"] for r in band] == pytest.approx(list(high - low), rel=0.2)


def test_rows_without_key_do_not_gain_weight(spark):
    points = [(None if k == 0 else str(k), float(k % 20), float(k % 20)) for k in range(200)]
    points[0] = (None, 0.0, 2000.0)
    named = [("0", *points[0][1:])] + points[1:]
    bands = [rows(trend.trend_band(spark.createDataFrame(p, "code string, x double, y double"), "x", "y", "code", grid=3)) for p in (points, named)]
    assert [r[3] - r[2] for r in bands[0]] == pytest.approx([r[3] - r[2] for r in bands[1]], rel=0.3)


def test_no_line_has_empty_ends(spark):
    found = trend.trend_band(spark.createDataFrame([("a", 1.0, 2.0)], "code string, x double, y double"), "x", "y", "code").collect()
    assert len(found) == 100 and {r["low"] for r in found} == {None}


def test_bootstrap_weights_are_poisson():
    rng = np.random.default_rng(3)
    n, replicates = 3000, 100
    a, b = rng.integers(1, trend.MODULUS, n), rng.integers(0, trend.MODULUS, n)
    rows_ = pa.RecordBatch.from_arrays([pa.array(np.ones(n)), pa.array(np.zeros(n)), pa.array(a), pa.array(b)], ["u", "v", "a", "b"])
    (found,) = trend._resampled(replicates)(iter([rows_]))
    totals = found.column("s").to_numpy()
    assert totals.mean() == pytest.approx(n, rel=0.01) and totals.std() == pytest.approx(math.sqrt(n), rel=0.3)
    draws = (a[:, None] * np.arange(1, replicates) + b[:, None]) % trend.MODULUS
    weights = np.searchsorted(trend._poisson_thresholds(), draws, side="right")
    assert weights.mean() == pytest.approx(1.0, abs=0.01) and weights.var() == pytest.approx(1.0, abs=0.02)


def test_density_of_a_heavy_tail(spark):
    """Far more bandwidths in the range than a fixed number of cells would tell apart."""
    v = np.exp(np.random.default_rng(21).normal(0, 4, 20_000))
    found = sorted(distribution.density(spark.createDataFrame([(float(x),) for x in v], "v double"), ["v"]).collect(), key=lambda r: r["position"])
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 200)
    direct = np.array([np.exp(-0.5 * ((g - v) / h) ** 2).sum() for g in x]) / (h * math.sqrt(2 * math.pi)) * (v.max() - v.min()) / 100
    assert [r["y"] for r in found] == pytest.approx(list(direct), rel=1e-8, abs=1e-290)


def test_sampled_points_are_the_same_for_any_partitioning(spark):
    rng = np.random.default_rng(5)
    made = [(str(k % 900), float(a), float(b)) for k, (a, b) in enumerate(rng.normal(size=(4000, 2)))] + [(None, 1.0, 2.0), ("x", None, 1.0)]
    df = spark.createDataFrame(made, "code string, x double, y double")
    one, many = (rows(trend.sampled_points(d, "x", "y", "code", 300)) for d in (df.coalesce(1), df.repartition(9)))
    assert one == many and len(one) == 300
    digest = lambda r: hashlib.md5((r[0] if r[0] is not None else f"row {r[1]} {r[2]}").encode()).hexdigest()
    whole = sorted((r for r in made if r[1] is not None), key=lambda r: (digest(r), r[1], r[2]))
    assert sorted(one) == sorted(r[1:] for r in whole[:300])
    assert trend.sampled_points(df, "x", "y", "code", 9999).count() == 4001


def test_moments_of_many_columns_agree_with_the_aggregates(spark):
    rng = np.random.default_rng(31)
    k = 14
    x = rng.normal(size=(3000, k)) * 10.0 ** rng.integers(-2, 6, k) + 10.0 ** rng.integers(-3, 4, k)
    x[:, 3] = 7.0
    x[rng.random(x.shape) < 0.1] = np.nan
    x[0, 1] = np.inf
    names_ = [f"c{j}" for j in range(k)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in names_)).repartition(40)
    wide = {(r["var_x"], r["var_y"]): (r["r"], r["pairs"]) for r in correlation.correlation_pairs(df, names_).collect()}
    plain = {(r["var_x"], r["var_y"]): (r["r"], r["pairs"]) for r in df.agg(correlation.pair_structs(names_).alias("p")).select(F.inline("p")).collect()}
    assert wide.keys() == plain.keys()
    for pair, (r, n) in plain.items():
        assert wide[pair][1] == n and (wide[pair][0] is None) == ("c3" in pair)
        assert "c3" in pair or wide[pair][0] == pytest.approx(r, rel=1e-9, abs=1e-9)


def test_fit_of_two_hundred_columns(spark):
    rng = np.random.default_rng(32)
    x = rng.normal(size=(2000, 200)) * 10.0 ** rng.integers(-3, 4, 200)
    x[:, 7] = x[:, 5]
    y = x[:, :5].sum(1) + rng.normal(size=2000)
    names_ = [f"c{j}" for j in range(200)]
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=[*names_, "y"]))
    fit = regression.ols(df, "y", names_)
    coef = np.linalg.pinv(np.column_stack([np.ones(2000), x])) @ y
    assert fit.rank == 200 and list(fit.slopes) == pytest.approx(list(coef[1:]), rel=1e-6, abs=1e-9)
    empty = regression.cross_moments(df.where("false"), names_[:3])
    assert not empty.rows.any() and np.isnan(empty.correlation()).all()
