import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.distributions import f_upper, normal_two_sided, t_two_sided
from tidemark.operators import inference as inf
from tidemark.operators import regression as reg
from tidemark.operators import reporting as rep
from tidemark.operators.positions import with_position, with_previous
from tidemark.operators.quantiles import exact_quantiles

CARS = [0.01, -0.02, 0.03, 0.0, -0.01]


def column(spark, values, name="car"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"event_id long, {name} double")


def test_summary_and_t_test(spark):
    df = column(spark, [*CARS, None])
    row = inf.summary_stats(df, "car").first()
    assert (row.n, row.median, row.note) == (5, 0.0, None)
    assert row["mean"] == pytest.approx(0.002) and row["std"] == pytest.approx(0.019235384, abs=1e-9)
    t = inf.t_test_one_sample(df, "car").first()
    assert t.t == pytest.approx(0.232495277, abs=1e-9) and t.p == pytest.approx(0.827564720, abs=1e-9)


def test_too_few_observations(spark):
    row = inf.summary_stats(column(spark, [0.5]), "car").first()
    assert row.n == 1 and row["mean"] is None and row.note


def test_patell(spark):
    row = inf.patell_z(column(spark, [0.5, -1.2, 0.3, -0.8]), "car").first()
    assert row.z == pytest.approx(-0.6) and row.p == pytest.approx(0.548506236, abs=1e-9)
    empty = inf.patell_z(column(spark, [None]), "car").first()
    assert empty.z is None and empty.p is None


def test_tail_probabilities():
    assert normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    # with 1 and 2 degrees of freedom the t distribution has closed forms
    assert t_two_sided(2.0, 1) == pytest.approx(1 - 2 * math.atan(2.0) / math.pi, abs=1e-12)
    assert t_two_sided(3.0, 2) == pytest.approx(1 - 3.0 / math.sqrt(2 + 9.0), abs=1e-12)
    assert f_upper(4.0, 1, 7) == pytest.approx(t_two_sided(2.0, 7), abs=1e-12)


@pytest.mark.parametrize("df", [1e4, 9.9e4, 1.1e5, 1e8, 1e12])
def test_tails_at_any_size(df):
    for t in (0.1, 1.0, 2.0, 5.0):
        # the normal tail with its first correction in 1 / df
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        near = normal_two_sided(t) + 2 * density * t * (t * t + 1) / (4 * df)
        assert t_two_sided(t, df) == pytest.approx(near, rel=max(1e-7, 2e4 / df**2))
        assert f_upper(t * t, 1, df) == pytest.approx(t_two_sided(t, df), rel=1e-9)
    assert f_upper(2.0, 2, df) == pytest.approx(math.exp(-df / 2 * math.log1p(4 / df)), rel=1e-7)


def test_rows_without_a_regressor_are_left_out(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 2))
    y = 4.6 + x @ [0.1, 0.2] + rng.normal(size=60)
    rows = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)]
    holes = rows + [(None, 1.0, 2.0), (1.0, float("nan"), 2.0), (1.0, 2.0, None), (1.0, 1.0, float("nan"))]
    schema = "a double, b double, y double"
    want, got = (reg.fit_ols(spark.createDataFrame(r, schema), "y", ["a", "b"]) for r in (rows, holes))
    assert got.n == 60 and got.coef == pytest.approx(want.coef) and got.cov_hc3 == pytest.approx(want.cov_hc3)


def test_welch(spark):
    a, b = [1.0, 2.0, 4.0], [2.0, 3.0, 7.0, 8.0]
    df = spark.createDataFrame([(True, v) for v in a] + [(False, v) for v in b], "g boolean, v double")
    row = inf.welch_t_test(df, "v", F.col("g")).first()
    ea, eb = np.var(a, ddof=1) / 3, np.var(b, ddof=1) / 4
    assert row.t == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(ea + eb))
    assert row.dof == pytest.approx((ea + eb) ** 2 / (ea ** 2 / 2 + eb ** 2 / 3))
    few = inf.welch_t_test(df.where("g or v > 6"), "v", F.col("g")).first()
    assert few.t is None and few.p is None


def test_simple_regression(spark):
    x, y = [0, 1, 2, 3, 4, 5], [1, 3, 2, 5, 4, 7]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    row = inf.simple_regression(df, "x", "y").first()
    slope, intercept = np.polyfit(x, y, 1)
    assert row.slope == pytest.approx(slope) and row.intercept == pytest.approx(intercept)
    assert row.r2 == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2)
    assert inf.simple_regression(df.limit(5), "x", "y").first().slope is None


def test_bootstrap(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(0.3, 1.0, 400)
    df = column(spark, [float(v) for v in values])
    lo, hi = inf.bootstrap_ci(df, "car", "event_id").first()
    assert lo < values.mean() < hi
    assert hi - lo == pytest.approx(2 * 1.96 * values.std(ddof=1) / 20, rel=0.15)
    assert (lo, hi) == pytest.approx(tuple(inf.bootstrap_ci(df.repartition(9), "car", "event_id").first()), abs=1e-12)


def test_bootstrap_weights_are_independent_draws():
    w = inf.poisson_weights(np.arange(3000) * 8 + 1, np.arange(400), 42)
    assert w.mean() == pytest.approx(1, abs=0.005) and w.var() == pytest.approx(1, abs=0.01)
    shares = np.bincount(w.ravel(), minlength=6)[:6] / w.size
    assert shares == pytest.approx([np.exp(-1) / k for k in (1, 1, 2, 6, 24, 120)], abs=0.003)
    # neither neighbouring replicates nor neighbouring rows, at several distances, go together
    for lag in (1, 2, 7, 64):
        for a, b in ((w[:-lag], w[lag:]), (w[:, :-lag], w[:, lag:]), (w[:-lag, lag:], w[lag:, :-lag])):
            assert abs(np.corrcoef(a.ravel(), b.ravel())[0, 1]) < 0.006
    by_replicate, by_row = w.sum(axis=0), w.sum(axis=1)
    assert by_replicate.std() == pytest.approx(3000 ** 0.5, rel=0.12) and by_row.std() == pytest.approx(20, rel=0.06)
    assert not np.array_equal(w, inf.poisson_weights(np.arange(3000) * 8 + 1, np.arange(400), 43))
    odd = inf.poisson_weights(np.array([-5, inf.PRIME - 5, 2 ** 62]), np.arange(10), 42)
    assert np.array_equal(odd[0], odd[1]) and odd.min() >= 0


def test_bootstrap_expands_no_rows(spark):
    plan = inf.bootstrap_means(column(spark, [1.0, 2.0]), "car", "event_id")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert inf.bootstrap_ci(column(spark, [1.0]).where("car > 5"), "car", "event_id").first() == (None, None)


@pytest.mark.parametrize("n", [1, 2, 7, 30_011])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.standard_cauchy(n), 2)  # heavy tails and ties
    df = column(spark, [float(v) for v in values])
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r.p: r["quantile"] for r in exact_quantiles(df, "car", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_exact_quantiles_by_group(spark):
    rng = np.random.default_rng(5)
    big, small = rng.normal(size=25_000), rng.normal(size=9)
    rows = [("a", float(v)) for v in big] + [("b", float(v)) for v in small] + [("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.p): r["quantile"] for r in exact_quantiles(df, "v", [0.25, 0.5], ["g"]).collect()}
    for g, values in (("a", big), ("b", small)):
        for p in (0.25, 0.5):
            assert got[(g, p)] == pytest.approx(np.quantile(values, p))


def test_one_value_holding_most_rows(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).cast("double").alias("v"))
    values = [float(i) if i % 3 == 0 else 7.0 for i in range(50_000)]
    assert exact_quantiles(df, "v", [0.5]).first()["quantile"] == np.median(values)
    assert exact_quantiles(df, "v", [0.9]).first()["quantile"] == pytest.approx(np.quantile(values, 0.9))


def test_positions(spark):
    df = spark.range(5000).withColumn("k", (F.col("id") * 7919) % 5003).repartition(6)
    rows = with_position(df, ["k"]).orderBy("k").collect()
    assert [r.position for r in rows] == list(range(5000))
    previous = with_previous(df, ["k"], "k", "before").orderBy("k").collect()
    assert previous[0].before is None and all(b.before == a.k for a, b in zip(previous, previous[1:]))


def test_neighbours_cross_blocks(spark, monkeypatch):
    from tidemark.operators import positions
    monkeypatch.setattr(positions, "_BLOCK", 4)
    rows = positions.with_previous(spark.range(23), ["id"], "id", "before").orderBy("id").collect()
    assert [r.before for r in rows] == [None, *range(22)]


def test_ols_worked_example(spark):
    df = spark.createDataFrame([(float(i), float(v)) for i, v in enumerate([1, 3, 2, 5, 4])], "x double, y double")
    fit = reg.fit_ols(df, "y", ["x"], min_rows=3)
    table = {r.term: r for r in fit.table().collect()}
    assert table["Intercept"].coef == pytest.approx(1.4) and table["x"].coef == pytest.approx(0.8)
    # residuals -.4 .8 -1 1.2 -.6 over 1 - leverage .4 .7 .8 .7 .4, times the rows of the inverse
    u = [-0.4 / 0.4, 0.8 / 0.7, -1 / 0.8, 1.2 / 0.7, -0.6 / 0.4]
    for term, weights in (("Intercept", [0.6, 0.4, 0.2, 0.0, -0.2]), ("x", [-0.2, -0.1, 0.0, 0.1, 0.2])):
        expected = math.sqrt(sum((a * b) ** 2 for a, b in zip(u, weights)))
        assert table[term].std_err_hc3 == pytest.approx(expected, rel=1e-12)
    assert fit.diagnostics().first().r2 == pytest.approx(0.64)
    assert reg.fit_ols(df, "y", ["x"]) is None  # fewer than thirty rows


def test_ols_with_categories_against_numpy(spark):
    rng = np.random.default_rng(3)
    n = 300
    x1, x2 = rng.normal(size=n), rng.integers(0, 10_000, n).astype(float)
    group = rng.choice(["a", "b", "c"], n)
    y = 0.5 + 0.1 * x1 + 1e-5 * x2 + (group == "b") * 0.3 + rng.normal(size=n) * (1 + np.abs(x1))
    df = spark.createDataFrame([(i, float(a), float(b), str(g), float(c)) for i, (a, b, g, c) in
                                enumerate(zip(x1, x2, group, y))], "i int, x1 double, x2 double, g string, y double")
    fit = reg.fit_ols(df.repartition(5), "y", ["x1", "x2"], ["g"], keep=["i"])
    X = np.column_stack([np.ones(n), group == "b", group == "c", x1, x2]).astype(float)
    inverse = np.linalg.inv(X.T @ X)
    b = inverse @ X.T @ y
    e = y - X @ b
    u = e / (1 - np.einsum("ij,jk,ik->i", X, inverse, X))
    cov = inverse @ (X * (u ** 2)[:, None]).T @ X @ inverse
    assert fit.terms == ["Intercept", "C(g)[T.b]", "C(g)[T.c]", "x1", "x2"]
    assert fit.coef == pytest.approx(b, rel=1e-8)
    assert np.sqrt(np.diag(fit.cov_hc3)) == pytest.approx(np.sqrt(np.diag(cov)), rel=1e-8)
    d = fit.diagnostics(["i"]).first()
    assert d.durbin_watson == pytest.approx(np.sum(np.diff(e) ** 2) / np.sum(e ** 2))
    assert d.condition_number == pytest.approx(np.linalg.cond(X), rel=1e-6)
    assert d.kurtosis == pytest.approx(np.mean(e ** 4) / np.mean(e ** 2) ** 2)
    assert d.adj_r2 == pytest.approx(1 - (e @ e) / ((y - y.mean()) @ (y - y.mean())) * (n - 1) / (n - 5))
    assert d.f_robust == pytest.approx(b[1:] @ np.linalg.solve(cov[1:, 1:], b[1:]) / 4, rel=1e-6)
    assert 0 <= d.f_p <= 1 and 0 <= d.omnibus_p <= 1


def test_singleton_category_has_no_robust_error(spark):
    rows = [(float(i), "only" if i == 7 else "ab"[i % 2], float((i * 13) % 7)) for i in range(40)]
    fit = reg.fit_ols(spark.createDataFrame(rows, "x double, g string, y double"), "y", ["x"], ["g"])
    table = {r.term: r for r in fit.table().collect()}
    assert fit.undefined == 1 and table["C(g)[T.only]"].std_err_hc3 is None
    assert all(table[t].std_err_hc3 > 0 for t in ("Intercept", "C(g)[T.b]", "x"))


def test_histogram_keeps_empty_bins(spark):
    rows = rep.histogram(column(spark, [0.0, 0.1, 10.0]), "car", bins=4).orderBy("bin").collect()
    assert [r.n for r in rows] == [2, 0, 0, 1] and rows[-1].hi == 10.0
    same = rep.histogram(column(spark, [3.0, 3.0]), "car", bins=2).collect()
    assert sum(r.n for r in same) == 2


def test_density_integrates_to_one(spark):
    values = np.random.default_rng(2).normal(size=300)
    rows = rep.kernel_density(column(spark, [float(v) for v in values]), "car").orderBy("i").collect()
    x, density = np.array([r.x for r in rows]), np.array([r.density for r in rows])
    assert np.trapezoid(density, x) == pytest.approx(1.0, abs=0.03)
    h = values.std(ddof=1) * len(values) ** -0.2
    expected = np.exp(-0.5 * ((x[50] - values) / h) ** 2).sum() / (len(values) * h * math.sqrt(2 * math.pi))
    assert density[50] == pytest.approx(expected)


def test_density_agrees_with_mllib(spark):
    from pyspark.mllib.stat import KernelDensity
    values = [float(v) for v in np.random.default_rng(4).normal(size=100)]
    rows = rep.kernel_density(column(spark, values), "car", points=5).orderBy("i").collect()
    kd = KernelDensity()
    kd.setSample(spark.sparkContext.parallelize(values))
    kd.setBandwidth(float(np.std(values, ddof=1) * 100 ** -0.2))
    assert [r.density for r in rows] == pytest.approx(list(kd.estimate([r.x for r in rows])))


def test_box_stats(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 5.0)]
    got = {r.g: r for r in rep.box_stats(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()}
    a = got["a"]
    assert (a.q1, a["median"], a.q3, a.whisker_lo, a.whisker_hi, a.outliers) == (2, 3, 4, 1, 4, 1)
    assert got["b"].whisker_hi == 5.0


@pytest.mark.parametrize("few", [1, 4096])
def test_quantiles_of_odd_values(spark, monkeypatch, few):
    """All passes, or the first ones: ties, both infinities, NaN, both zeros, the smallest doubles, one row, no group name."""
    from tidemark.operators import quantiles as qt

    monkeypatch.setattr(qt, "_FEW", few)
    rng = np.random.default_rng(3)
    groups = {"tied": [2.5] * 6000 + [1.0, 9.0], "one": [-7.25], None: list(rng.normal(size=501) * 10.0 ** rng.integers(-300, 300, 501)),
              "edges": [float("-inf"), -1e308, -5e-324, -0.0, 0.0, 5e-324, 1e308, float("inf")], "close": list(1 + np.arange(40) * 2.0 ** -52)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("nan", 1.0), ("nan", float("nan")), ("nan", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {(r.g, r.p): r["quantile"] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert {g for g, _ in got} == {*groups, "nan"}
    for g, vs in groups.items():
        ordered = sorted(vs)
        for p in probs:
            at = p * (len(vs) - 1)
            low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            want = low if low == high else low + (at - np.floor(at)) * (high - low)
            assert np.array_equal(got[g, p], want, equal_nan=True), (g, p)
    assert got["nan", 0.0] == 1.0 and np.isnan(got["nan", 1.0])


def test_quantiles_sort_no_column(spark):
    """Rows of a group are counted, and only the rows of small buckets are ever put side by side."""
    df = spark.range(20000).selectExpr("double(id % 7) as v", "id % 2 as g")
    got = {(r.g, r.p): r["quantile"] for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {(0, 0.5): 3.0, (1, 0.5): 3.0}
    plan = exact_quantiles(df, "v", [0.5], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "raise_error" not in plan
