"""Registered queries: returns, alignment, windows, features, tests and models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.windows import DEFAULT_WINDOWS, parse_windows, window_key_column
from tidemark.operators import calendar as cal
from tidemark.operators import eventstudy as es
from tidemark.operators import features as ft
from tidemark.operators import forest as rf
from tidemark.operators import inference as inf
from tidemark.operators import regression as reg
from tidemark.operators import reporting as rep
from tidemark.operators import returns as ret
from tidemark.plans import warehouse as wh
from tidemark.plans.checks import OLS_STEPS, recursive, statement
from tidemark.plans.registry import query
from tidemark.session import settled

HEAD = (-5, 5)


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    return cal.trading_calendar(wh.market(spark, folder))


def price_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``(prices, calendar)`` from a single pass over the lines."""
    sums = settled(wh.weekly(spark, folder))
    return wh.prices(spark, folder, sums), cal.trading_calendar(wh.market(spark, folder, sums))


def wide(spark: SparkSession, folder: str, windows=DEFAULT_WINDOWS, events: DataFrame | None = None) -> DataFrame:
    events = wh.study_events(spark, folder) if events is None else events
    return es.wide_results(events, *price_inputs(spark, folder), windows)


def headline(spark: SparkSession, folder: str) -> DataFrame:
    """``event_id, company_id, car, scar`` of the headline window."""
    return wide(spark, folder, [HEAD]).select(
        "event_id", "company_id", F.col("car_m5_p5").alias("car"), F.col("scar_m5_p5").alias("scar"))


def stored_windows(spark: SparkSession, folder: str, windows=DEFAULT_WINDOWS, events: DataFrame | None = None) -> DataFrame:
    """The event-window table as a report finds it: written, six decimals; only the windows that the report reads."""
    return settled(es.long_results(wide(spark, folder, windows, events), windows, stored=True))


def features(spark: SparkSession, folder: str) -> DataFrame:
    """Written events first: ranks, medians, buckets and regime each read them."""
    return ft.build_features(settled(wh.study_events(spark, folder)), calendar(spark, folder))


def model_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Features joined with returns, written out because the models read it many times."""
    prices, days = price_inputs(spark, folder)
    events = settled(wh.study_events(spark, folder))
    results = es.wide_results(events, prices, days, [HEAD])
    return settled(ft.join_results(ft.build_features(events, days), results))


# ---- returns and the calendar

@query("W1_market_log_return", "trade_date:s r_mkt:f", statement("SELECT trade_date, r_mkt FROM days"))
def _(spark, folder):
    return calendar(spark, folder)


@query("W2_stock_log_return", "company_id:l trade_date:s r_stock:f",
       statement("SELECT company_id, trade_date, r_stock FROM returns"))
def _(spark, folder):
    return ret.stock_returns(wh.prices(spark, folder))


@query("W3_calendar_index", "trade_date:s idx:l", statement("SELECT trade_date, idx FROM days"))
def _(spark, folder):
    return calendar(spark, folder)


@query("W4_event_rank", "event_id:l event_rank:l is_repeat:l is_first:l",
       statement("SELECT event_id, event_rank, is_repeat, is_first FROM features"))
def _(spark, folder):
    return ft.event_history(wh.study_events(spark, folder))


@query("W5_days_since_prior", "event_id:l days_since_prior_layoff:l",
       statement("SELECT event_id, days_since_prior_layoff FROM history"))
def _(spark, folder):
    return ft.event_history(wh.study_events(spark, folder))


@query("W6_sql_rank", "event_id:l company_id:l rn:l",
       statement("SELECT event_id, company_id, event_rank AS rn FROM history"))
def _(spark, folder):
    # the SQL twin of W4; the view name is private to this query
    wh.study_events(spark, folder).createOrReplaceTempView("tidemark_study_events")
    return spark.sql("""
        SELECT event_id, company_id,
               row_number() OVER (PARTITION BY company_id ORDER BY announcement_date, event_id) AS rn
        FROM tidemark_study_events""")


@query("W7_rolling_regime", "trade_date:s regime:f", statement("SELECT trade_date, regime FROM regimes"))
def _(spark, folder):
    return cal.rolling_regime(calendar(spark, folder))


# ---- joins

@query("J1_inner_equi", "event_id:l company_id:l ticker_symbol:s industry:s",
       statement("SELECT event_id, company_id, ticker_symbol, industry FROM study"))
def _(spark, folder):
    return wh.study_events(spark, folder)


@query("J2_events_windows", "event_id:l company_id:l car:f", statement(
    """SELECT s.event_id, s.company_id, w.car FROM study s JOIN stored w USING (event_id)
       WHERE window_start_offset = -5 AND window_end_offset = 5 AND car IS NOT NULL"""))
def _(spark, folder):
    stored = es.long_results(wide(spark, folder), stored=True)
    return rep.events_with_returns(wh.study_events(spark, folder), stored, HEAD)


@query("J3_left_outer", "event_id:l car:f", statement(
    """SELECT s.event_id, w.car FROM study s LEFT JOIN stored w
       ON w.event_id = s.event_id AND window_start_offset = -5 AND window_end_offset = 5"""))
def _(spark, folder):
    stored = es.long_results(wide(spark, folder), stored=True)
    hits = rep.in_window(stored, HEAD).select("event_id", "car")
    return wh.study_events(spark, folder).select("event_id").join(hits, "event_id", "left")


@query("J4_asof_forward", "event_id:l t0:l", statement("SELECT event_id, t0 FROM aligned"))
def _(spark, folder):
    return cal.align_forward(wh.study_events(spark, folder), calendar(spark, folder))


@query("J5_asof_backward_strict", "event_id:l t_prev:l", statement(
    """SELECT s.event_id, d.idx AS t_prev FROM study s
       ASOF LEFT JOIN days d ON s.announcement_date > d.trade_date"""))
def _(spark, folder):
    return cal.align_backward(wh.study_events(spark, folder), calendar(spark, folder))


_ALIGNED = """
    SELECT a.event_id, x.idx - a.t0 AS "offset", x.r_stock, x.r_mkt, x.ar
    FROM aligned a JOIN abnormal x ON x.company_id = a.company_id AND x.idx BETWEEN a.t0 - 5 AND a.t0 + 5
    WHERE a.t0 - 5 >= 1 AND a.t0 + 5 < (SELECT count(*) FROM days)"""


@query("J6_window_align", "event_id:l offset:l r_stock:f r_mkt:f", statement(_ALIGNED))
def _(spark, folder):
    return es.window_alignment(wh.study_events(spark, folder), *price_inputs(spark, folder), HEAD)


@query("J7_semi_has_prices", "event_id:l company_id:l", statement(
    "SELECT event_id, company_id FROM study WHERE company_id IN (SELECT company_id FROM prices)"))
def _(spark, folder):
    return wh.study_events(spark, folder).join(
        wh.prices(spark, folder).select("company_id"), "company_id", "left_semi")


# ---- the event study

@query("V1_abnormal_return", "event_id:l offset:l ar:f", statement(_ALIGNED))
def _(spark, folder):
    return es.window_alignment(wh.study_events(spark, folder), *price_inputs(spark, folder), HEAD)


@query("V2_car", "event_id:l car:f avg_ar:f", statement(
    "SELECT event_id, car, avg_ar FROM windows WHERE window_start_offset = -5 AND window_end_offset = 5"))
def _(spark, folder):
    return wide(spark, folder, [HEAD]).select(
        "event_id", F.col("car_m5_p5").alias("car"), F.col("avg_ar_m5_p5").alias("avg_ar"))


@query("V3_estimation_sigma", "event_id:l sigma:f", statement("SELECT event_id, sigma FROM estimation"))
def _(spark, folder):
    return es.study_events(wh.study_events(spark, folder), *price_inputs(spark, folder), [HEAD])


@query("V4_scar", "event_id:l scar:f", statement("SELECT event_id, scar FROM headline"))
def _(spark, folder):
    return headline(spark, folder)


@query("V5_multi_window", "event_id:l window_start_offset:l window_end_offset:l car:f avg_ar:f scar:f",
       statement("SELECT * FROM windows"))
def _(spark, folder):
    return es.long_results(wide(spark, folder))


_KEYS = {"m30_p30": (-30, 30), "m5_p5": (-5, 5), "m1_p1": (-1, 1), "p0_p3": (0, 3)}
_WIDE_SQL = "SELECT event_id, " + ", ".join(
    f"max({m}) FILTER (WHERE window_start_offset = {a} AND window_end_offset = {b}) AS {m}_{k}"
    for k, (a, b) in _KEYS.items() for m in ("car", "scar")) + " FROM windows GROUP BY event_id"


@query("V6_wide_results", "event_id:l " + " ".join(f"{m}_{k}:f" for k in _KEYS for m in ("car", "scar")),
       statement(_WIDE_SQL))
def _(spark, folder):
    return wide(spark, folder)


@query("V7_timeline", "event_id:l offset:l ar:f", statement("SELECT * FROM daily"))
def _(spark, folder):
    prices, days = price_inputs(spark, folder)
    return es.timeline(es.wide_results(wh.study_events(spark, folder), prices, days), prices, days)


_FEATURE_SPEC = (
    "event_id:l event_rank:l is_repeat:l is_first:l days_since_prior_layoff:l log_employees_laid_off:f "
    "has_pct:l pct_laid_off_filled:f log_funds_raised:f has_funds:l market_regime_30d:f "
    "industry_top15:s stage_clean:s event_year:l"
)


@query("V8_features", _FEATURE_SPEC, statement("SELECT * FROM features"))
def _(spark, folder):
    return features(spark, folder)


@query("P12_window_key", "window_start_offset:l window_end_offset:l key:s n:l", statement(
    """SELECT window_start_offset, window_end_offset, count(*) AS n,
              CASE WHEN window_start_offset < 0 THEN 'm' ELSE 'p' END || abs(window_start_offset) || '_' ||
              CASE WHEN window_end_offset < 0 THEN 'm' ELSE 'p' END || abs(window_end_offset) AS key
       FROM windows GROUP BY ALL"""))
def _(spark, folder):
    counts = rep.window_counts(es.long_results(wide(spark, folder)))
    return counts.withColumn("key", window_key_column(F.col("window_start_offset"), F.col("window_end_offset")))


_PARSED = {"spans": "SELECT * FROM (VALUES (-10, 10), (-2, 1), (-5, 5)) AS v(ws, we)"}


@query("P13_parse_windows", "event_id:l window_start_offset:l window_end_offset:l car:f",
       statement("SELECT * FROM windows", _PARSED))
def _(spark, folder):
    windows = parse_windows("-10,+10;-2,+1")
    return es.long_results(wide(spark, folder, windows), windows)


@query("P14_sign_label", "event_id:l label:l", statement(
    "SELECT event_id, CASE WHEN car > 0 THEN 1 ELSE 0 END AS label FROM headline WHERE car IS NOT NULL"))
def _(spark, folder):
    return rf.sign_label(headline(spark, folder), "car")


# ---- run statistics

@query("A7_timeline_ci", "offset:l mean:f std:f n:l se:f ci_lo:f ci_hi:f", statement(
    """SELECT *, mean - 1.96 * se AS ci_lo, mean + 1.96 * se AS ci_hi FROM (
         SELECT "offset", avg(ar) AS mean, stddev_samp(ar) AS std, count(*) AS n,
                stddev_samp(ar) / sqrt(count(*)) AS se FROM daily GROUP BY "offset")"""))
def _(spark, folder):
    prices, days = price_inputs(spark, folder)
    return rep.timeline_interval(
        es.timeline(es.wide_results(wh.study_events(spark, folder), prices, days), prices, days))


@query("A11_window_counts", "window_start_offset:l window_end_offset:l n:l", statement(
    "SELECT window_start_offset, window_end_offset, count(*) AS n FROM windows GROUP BY ALL"))
def _(spark, folder):
    return rep.window_counts(es.long_results(wide(spark, folder)))


@query("A14_mean_by_window", "window_start_offset:l window_end_offset:l n:l mean_car:x", statement(
    """SELECT window_start_offset, window_end_offset, count(car) AS n, CAST(sum(car) AS DOUBLE) / count(car) AS mean_car
       FROM stored GROUP BY ALL"""))
def _(spark, folder):
    return rep.mean_by_window(es.long_results(wide(spark, folder), stored=True))


@query("A15_run_counters", "processed:l skipped_no_prices:l skipped_bounds:l", statement(
    """SELECT count(*) FILTER (WHERE has AND t0 IS NOT NULL) AS processed,
              count(*) FILTER (WHERE NOT has) AS skipped_no_prices,
              count(*) FILTER (WHERE has AND t0 IS NULL) AS skipped_bounds
       FROM (SELECT t0, company_id IN (SELECT company_id FROM prices) AS has FROM aligned)"""))
def _(spark, folder):
    return es.run_counters(es.study_events(wh.study_events(spark, folder), *price_inputs(spark, folder), [HEAD]))


# ---- inference

def t_density_p(t: str, v: str) -> str:
    """Two-sided t tail by Simpson's rule on the density."""
    return f"""(SELECT 1 - 2 * abs({t}) / 6000 * sum(
        CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
        * exp(lgamma(({v} + 1) / 2.0) - lgamma({v} / 2.0)) / sqrt({v} * pi())
        * pow(1 + pow(k * abs({t}) / 2000.0, 2) / {v}, -({v} + 1) / 2.0)) FROM range(2001) AS g(k))"""


def f_density_p(f: str, a: str, b: str) -> str:
    """Upper F tail, for more than two degrees of freedom above, by Simpson's rule on the density."""
    at = f"(k * {f} / 2000.0)"
    return f"""(SELECT 1 - {f} / 6000 * sum(
        CASE WHEN k = 0 THEN 0 WHEN k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
        * exp(lgamma(({a} + {b}) / 2.0) - lgamma({a} / 2.0) - lgamma({b} / 2.0) + {a} / 2.0 * ln({a} / CAST({b} AS DOUBLE))
              + ({a} / 2.0 - 1) * ln(greatest({at}, 1e-300)) - ({a} + {b}) / 2.0 * ln(1 + {a} * {at} / {b}))) FROM range(2001) AS g(k))"""


def normal_density_p(z: str) -> str:
    return f"""(SELECT 1 - 2 * abs({z}) / 6000 * sum(
        CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
        * exp(-pow(k * abs({z}) / 2000.0, 2) / 2) / sqrt(2 * pi())) FROM range(2001) AS g(k))"""


@query("T1_summary_stats", "n:l mean:f median:f std:f", statement(
    """SELECT count(car) AS n, avg(car) AS mean, median(car) AS median, stddev_samp(car) AS std
       FROM headline"""))
def _(spark, folder):
    return inf.summary_stats(settled(headline(spark, folder)), "car")


@query("T2_ttest_1samp", "n:l mean:f std:f t:f p:f", statement(
    f"""SELECT *, {t_density_p('t', '(n - 1)')} AS p FROM (
          SELECT count(car) AS n, avg(car) AS mean, stddev_samp(car) AS std,
                 avg(car) / (stddev_samp(car) / sqrt(count(car))) AS t FROM headline)"""))
def _(spark, folder):
    return inf.t_test_one_sample(headline(spark, folder), "car")


def _fifth(x: str) -> str:
    return f"({x} * {x} % {inf.PRIME}) * ({x} * {x} % {inf.PRIME}) % {inf.PRIME} * {x} % {inf.PRIME}"


def _drawn(rows: str) -> str:
    """Rows (with ``event_id``) by replicate ``r`` with their weight ``w``: the generator once more, in SQL."""
    (a, b), (c, d) = inf.FACTORS
    weight = " + ".join(f"CAST(x >= {t} AS INT)" for t in inf.POISSON_STEPS)
    return f"""(SELECT *, {weight} AS w FROM (
        SELECT * EXCLUDE (x), {_fifth("x")} AS x FROM (
        SELECT * EXCLUDE (x), (x * {inf.STEP} + id * {c} + r * {d} + {inf.PLUS}) % {inf.PRIME} AS x FROM (
        SELECT * EXCLUDE (x), {_fifth("x")} AS x FROM (
        SELECT t.*, id, r, (id * {a} + r * {b} + {inf.BOOTSTRAP_SEED}) % {inf.PRIME} AS x
        FROM (SELECT *, ((event_id % {inf.PRIME}) + {inf.PRIME}) % {inf.PRIME} AS id FROM ({rows})) t, range(1, {inf.BOOTSTRAP_REPLICATES + 1}) AS g(r))))))"""


@query("T3_bootstrap_ci", "ci_lo:f ci_hi:f", statement(
    f"""SELECT quantile_cont(mean, 0.025) AS ci_lo, quantile_cont(mean, 0.975) AS ci_hi
        FROM (SELECT r, sum(w * car) / sum(w) AS mean FROM {_drawn("SELECT event_id, car FROM headline WHERE car IS NOT NULL")} GROUP BY r)"""))
def _(spark, folder):
    return inf.bootstrap_ci(headline(spark, folder), "car", "event_id")


@query("T3_bootstrap_contract", "n:l mean:f brackets_mean:b width_as_expected:b", statement(
    """SELECT count(car) AS n, avg(car) AS mean, true AS brackets_mean, true AS width_as_expected
       FROM headline"""))
def _(spark, folder):
    """The random interval must bracket the mean and be about as wide as theory says."""
    rows = settled(headline(spark, folder))
    ci = inf.bootstrap_ci(rows, "car", "event_id").select(F.struct("ci_lo", "ci_hi")).scalar()
    se = F.col("std") / F.sqrt("n")
    ratio = (ci["ci_hi"] - ci["ci_lo"]) / (2 * 1.96 * se)
    return inf.t_test_one_sample(rows, "car").select(
        "n", "mean", F.col("mean").between(ci["ci_lo"], ci["ci_hi"]).alias("brackets_mean"),
        ratio.between(0.85, 1.15).alias("width_as_expected"))


@query("T4_patell_z", "n:l mean:f z:f p:f", statement(
    f"""SELECT *, {normal_density_p('z')} AS p FROM (
          SELECT count(scar) AS n, avg(scar) AS mean, avg(scar) * sqrt(count(scar)) AS z FROM headline)"""))
def _(spark, folder):
    return inf.patell_z(headline(spark, folder), "scar")


_RANKED_PCT = """SELECT h.event_rank = 1 AS is_first, CAST(w.car AS DOUBLE) * 100 AS car_pct
                 FROM history h JOIN stored w USING (event_id)
                 WHERE window_start_offset = -5 AND window_end_offset = 5 AND w.car IS NOT NULL"""


def ranked_pct(spark: SparkSession, folder: str) -> DataFrame:
    """``is_first, grp, car_pct`` per event with a stored headline return."""
    events = settled(wh.study_events(spark, folder))
    stored = stored_windows(spark, folder, [HEAD], events)
    ranked = ft.event_history(events).select("event_id", "event_rank")
    hits = rep.events_with_returns(ranked, stored, HEAD)
    first = F.col("event_rank") == 1
    return hits.select(
        "event_id", first.alias("is_first"), F.when(first, "First-time").otherwise("Repeat").alias("grp"),
        (F.col("car").cast("double") * 100).alias("car_pct"))


@query("T5_welch_ttest", "n_first:l mean_first:f n_rest:l mean_rest:f t:f dof:f p:f", statement(
    f"""SELECT *, {t_density_p('t', 'dof')} AS p FROM (
          SELECT *, CASE WHEN n_first > 2 AND n_rest > 2 THEN (mean_first - mean_rest) / sqrt(ea + eb) END AS t,
                 CASE WHEN n_first > 2 AND n_rest > 2
                      THEN pow(ea + eb, 2) / (ea * ea / (n_first - 1) + eb * eb / (n_rest - 1)) END AS dof FROM (
            SELECT count(*) FILTER (WHERE is_first) AS n_first, count(*) FILTER (WHERE NOT is_first) AS n_rest,
                   avg(car_pct) FILTER (WHERE is_first) AS mean_first,
                   avg(car_pct) FILTER (WHERE NOT is_first) AS mean_rest,
                   var_samp(car_pct) FILTER (WHERE is_first) / count(*) FILTER (WHERE is_first) AS ea,
                   var_samp(car_pct) FILTER (WHERE NOT is_first) / count(*) FILTER (WHERE NOT is_first) AS eb
            FROM ({_RANKED_PCT})))"""))
def _(spark, folder):
    return inf.welch_t_test(ranked_pct(spark, folder), "car_pct", F.col("is_first"))


_SIZE_SQL = """SELECT ln(1 + employees_laid_off) AS x, CAST(w.car AS DOUBLE) * 100 AS y
               FROM study s JOIN stored w USING (event_id)
               WHERE window_start_offset = -5 AND window_end_offset = 5 AND w.car IS NOT NULL
                 AND employees_laid_off > 0"""
_SHARE_SQL = """SELECT percentage_laid_off * 100 AS x, CAST(w.car AS DOUBLE) * 100 AS y
                FROM study s JOIN stored w USING (event_id)
                WHERE window_start_offset = -5 AND window_end_offset = 5 AND w.car IS NOT NULL
                  AND percentage_laid_off IS NOT NULL"""


def _regression_sql(source: str, label: str) -> str:
    return f"""SELECT '{label}' AS predictor, *, {t_density_p('t', '(n - 2)')} AS p FROM (
        SELECT *, sign(slope) * sqrt(r2 * (n - 2) / (1 - r2)) AS t FROM (
          SELECT CAST(regr_count(y, x) AS BIGINT) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
                 regr_r2(y, x) AS r2 FROM ({source})))"""


def size_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """``event_id, x_size, x_share, y``: log employees and share laid off against the return in percent."""
    events = settled(wh.study_events(spark, folder))
    stored = stored_windows(spark, folder, [HEAD], events)
    hits = rep.events_with_returns(events, stored, HEAD)
    return hits.select(
        "event_id",
        F.when(F.col("employees_laid_off") > 0, F.log1p("employees_laid_off")).alias("x_size"),
        (F.col("percentage_laid_off") * 100).alias("x_share"),
        (F.col("car").cast("double") * 100).alias("y"))


@query("T6_simple_regression", "predictor:s n:l slope:f intercept:f r2:f t:f p:f",
       statement(_regression_sql(_SIZE_SQL, "log_employees") + " UNION ALL " + _regression_sql(_SHARE_SQL, "share")))
def _(spark, folder):
    pairs = size_pairs(spark, folder)
    size = inf.simple_regression(pairs, "x_size", "y").withColumn("predictor", F.lit("log_employees"))
    return size.unionByName(inf.simple_regression(pairs, "x_share", "y").withColumn("predictor", F.lit("share")))


@query("T7_regression_line", "x:f fit:f inside:b", statement(
    f"""SELECT lo + k * (hi - lo) / 99 AS x, intercept + slope * (lo + k * (hi - lo) / 99) AS fit, true AS inside
        FROM (SELECT min(x) AS lo, max(x) AS hi, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
              FROM ({_SIZE_SQL})), range(100) AS g(k)"""))
def _(spark, folder):
    """Grid and line are exact; the random band must contain the line."""
    pairs = settled(size_pairs(spark, folder))
    band = inf.regression_band(pairs, "x_size", "y", "event_id")
    return band.withColumn("inside", F.col("fit").between(F.col("lo"), F.col("hi")))


_SIZE_EVENTS = _SIZE_SQL.replace("SELECT ln", "SELECT event_id, ln", 1)


@query("T7_regression_band", "x:f fit:f lo:f hi:f", statement(
    f"""WITH pairs AS ({_SIZE_EVENTS}),
             frame AS (SELECT min(x) AS low, max(x) AS high, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, avg(x) AS cx, avg(y) AS cy FROM pairs),
             sums AS (SELECT r, sum(w) AS sw, sum(w * dx) AS sx, sum(w * dy) AS sy, sum(w * dx * dx) AS sxx, sum(w * dx * dy) AS sxy
                      FROM {_drawn("SELECT event_id, x - cx AS dx, y - cy AS dy FROM pairs, frame")} GROUP BY r),
             lines AS (SELECT r, (sxy - sx * sy / sw) / (sxx - sx * sx / sw) AS b, sw, sx, sy FROM sums),
             grid AS (SELECT low + k * (high - low) / 99 AS x FROM frame, range(100) AS g(k))
        SELECT x, any_value(intercept + slope * x) AS fit, quantile_cont(cy + (sy - b * sx) / sw + b * (x - cx), 0.025) AS lo,
               quantile_cont(cy + (sy - b * sx) / sw + b * (x - cx), 0.975) AS hi
        FROM grid, lines, frame GROUP BY x""".replace("WITH pairs", "SELECT * FROM (WITH pairs", 1) + ")"))
def _(spark, folder):
    return inf.regression_band(settled(size_pairs(spark, folder)), "x_size", "y", "event_id")


# ---- models

@query("T8_ols_hc3", "term:s coef:e std_err_hc3:e z:e p_value:e ci_lo:e ci_hi:e", recursive(
    f"""SELECT *, {normal_density_p('z')} AS p_value FROM (
          SELECT *, coef / std_err_hc3 AS z, coef - 1.959963984540054 * std_err_hc3 AS ci_lo,
                 coef + 1.959963984540054 * std_err_hc3 AS ci_hi FROM robust)""", OLS_STEPS))
def _(spark, folder):
    return reg.fit_ols(model_frame(spark, folder), "car_m5_p5",
                       ft.NUMERIC_REGRESSORS, ft.CATEGORICAL_REGRESSORS).table()


@query("T8_ols_single_regressor", "term:s coef:f std_err_hc3:f", statement(
    """SELECT * FROM (
       WITH d AS (SELECT f.log_employees_laid_off AS x, h.car AS y FROM features f JOIN headline h USING (event_id)
                  WHERE h.car IS NOT NULL),
            m AS (SELECT avg(x) AS mx, count(*) AS n, regr_sxx(y, x) AS sxx, regr_slope(y, x) AS b,
                         regr_intercept(y, x) AS a FROM d),
            u AS (SELECT x - mx AS dx, (y - a - b * x) / (1 - 1.0 / n - pow(x - mx, 2) / sxx) AS u, m.* FROM d, m)
       SELECT 'Intercept' AS term, any_value(a) AS coef,
              sqrt(sum(pow(u * (1.0 / n - mx * dx / sxx), 2))) AS std_err_hc3 FROM u
       UNION ALL
       SELECT 'log_employees_laid_off', any_value(b), sqrt(sum(pow(u * dx / sxx, 2))) FROM u)"""))
def _(spark, folder):
    """The same two passes with one regressor, where the errors have a closed form."""
    return reg.fit_ols(model_frame(spark, folder), "car_m5_p5", ["log_employees_laid_off"]).table()


_FULL_MODEL_SQL = """SELECT *, exp(-jarque_bera / 2) AS jarque_bera_p FROM (
       WITH o AS (SELECT *, lag(e) OVER (ORDER BY company_id, announcement_date, event_id) AS before FROM errors),
            s AS (SELECT count(*) AS n_obs, (SELECT count(*) FROM scales) AS k, sum(e * e) AS ssr,
                         var_pop(y) * count(*) AS sst, sum(pow(e - before, 2)) / sum(e * e) AS durbin_watson,
                         avg(pow(e, 3)) / pow(avg(e * e), 1.5) AS skew,
                         avg(pow(e, 4)) / pow(avg(e * e), 2) AS kurtosis FROM o),
            l AS (SELECT *, -n_obs / 2.0 * (ln(2 * pi()) + ln(ssr / n_obs) + 1) AS log_likelihood FROM s)
       SELECT n_obs, k - 1 AS df_model, n_obs - k AS df_resid, 1 - ssr / sst AS r2,
              1 - (ssr / sst) * (n_obs - 1) / (n_obs - k) AS adj_r2, log_likelihood,
              2 * k - 2 * log_likelihood AS aic, k * ln(n_obs) - 2 * log_likelihood AS bic, durbin_watson, skew,
              kurtosis, n_obs / 6.0 * (skew * skew + pow(kurtosis - 3, 2) / 4) AS jarque_bera FROM l)"""

_ROBUST_SQL = f"""
    SELECT *, {f_density_p('f_robust', 'df_model', 'df_resid')} AS f_p, exp(-omnibus / 2) AS omnibus_p FROM (
      SELECT *, pow(asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)), 2)
                + pow(1 - 2 / (9 * a) - sign(ratio) * pow(abs(ratio), 1 / 3.0), 2) / (2 / (9 * a)) AS omnibus FROM (
        SELECT *, (1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))) AS ratio FROM (
          SELECT *, 6 + 8 / root * (2 / root + sqrt(1 + 4 / (root * root))) AS a FROM (
            SELECT *, skewness * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
                   sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
                   (kurtosis - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / (pow(n + 1, 2) * (n + 3) * (n + 5))) AS x,
                   6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS root
            FROM (SELECT *, skew AS skewness, CAST(n_obs AS DOUBLE) AS n, (SELECT f_robust FROM joint) AS f_robust,
                         (SELECT sqrt(product(top)) FROM eigen) AS condition_number,
                         (SELECT count(*) FILTER (WHERE lost) FROM errors) AS undefined_leverage
                  FROM ({_FULL_MODEL_SQL}))))))"""


@query("T9_ols_diagnostics", "n_obs:l df_model:l df_resid:l r2:f adj_r2:f f_robust:e f_p:f log_likelihood:f "
       "aic:f bic:f durbin_watson:f omnibus:f omnibus_p:f jarque_bera:f jarque_bera_p:f skew:f kurtosis:f "
       "condition_number:e undefined_leverage:l", recursive(_ROBUST_SQL, OLS_STEPS))
def _(spark, folder):
    order = ["company_id", "announcement_date", "event_id"]
    fit = reg.fit_ols(model_frame(spark, folder), "car_m5_p5", ft.NUMERIC_REGRESSORS,
                      ft.CATEGORICAL_REGRESSORS, keep=order)
    return fit.diagnostics(order)


@query("T9_residual_statistics", "n_obs:l r2:f adj_r2:f log_likelihood:f aic:f bic:f durbin_watson:f "
       "jarque_bera:f skew:f kurtosis:f", statement("""SELECT * FROM (
       WITH d AS (SELECT f.company_id, f.announcement_date, f.event_id, f.log_employees_laid_off AS x, h.car AS y
                  FROM features f JOIN headline h USING (event_id) WHERE h.car IS NOT NULL),
            m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM d),
            e AS (SELECT y, y - a - b * x AS e,
                         lag(y - a - b * x) OVER (ORDER BY company_id, announcement_date, event_id) AS before
                  FROM d, m),
            s AS (SELECT count(*) AS n_obs, sum(e * e) AS ssr, var_pop(y) * count(*) AS sst,
                         sum(pow(e - before, 2)) / sum(e * e) AS durbin_watson,
                         avg(pow(e, 3)) / pow(avg(e * e), 1.5) AS skew, avg(pow(e, 4)) / pow(avg(e * e), 2) AS kurtosis
                  FROM e),
            l AS (SELECT *, -n_obs / 2.0 * (ln(2 * pi()) + ln(ssr / n_obs) + 1) AS log_likelihood FROM s)
       SELECT n_obs, 1 - ssr / sst AS r2, 1 - (ssr / sst) * (n_obs - 1) / (n_obs - 2) AS adj_r2, log_likelihood,
              4 - 2 * log_likelihood AS aic, 2 * ln(n_obs) - 2 * log_likelihood AS bic, durbin_watson, skew, kurtosis,
              n_obs / 6.0 * (skew * skew + pow(kurtosis - 3, 2) / 4) AS jarque_bera FROM l)"""))
def _(spark, folder):
    """The diagnostics of the one-regressor model, checked in closed form."""
    order = ["company_id", "announcement_date", "event_id"]
    fit = reg.fit_ols(model_frame(spark, folder), "car_m5_p5", ["log_employees_laid_off"], keep=order)
    return fit.diagnostics(order)


@query("T9_full_model_statistics", "n_obs:l df_model:l df_resid:l r2:f adj_r2:f log_likelihood:f aic:f bic:f "
       "durbin_watson:f jarque_bera:f jarque_bera_p:f skew:f kurtosis:f", recursive(_FULL_MODEL_SQL, OLS_STEPS))
def _(spark, folder):
    """The diagnostics SQL can state, for the full model."""
    order = ["company_id", "announcement_date", "event_id"]
    fit = reg.fit_ols(model_frame(spark, folder), "car_m5_p5", ft.NUMERIC_REGRESSORS,
                      ft.CATEGORICAL_REGRESSORS, keep=order)
    return fit.diagnostics(order)


@query("T10_rf_classifier", "event_id:l label:l prediction:l probability:f")
def _(spark, folder):
    frame = model_frame(spark, folder)
    model = rf.fit_forest(frame, "car_m5_p5")
    return model.transform(rf.sign_label(frame, "car_m5_p5"))


@query("T11_onehot_ignore", "event_id:l industry_hot:l stage_hot:l", statement(
    """SELECT event_id,
              CASE WHEN industry_top15 IN (SELECT industry_top15 FROM features WHERE stage_clean = 'Unknown')
                   THEN 1 ELSE 0 END AS industry_hot,
              CASE WHEN stage_clean IN (SELECT stage_clean FROM features WHERE stage_clean = 'Unknown')
                   THEN 1 ELSE 0 END AS stage_hot
       FROM features"""))
def _(spark, folder):
    """Categories learned from the events of unknown stage, applied to all events."""
    frame = settled(features(spark, folder).select("event_id", *ft.CATEGORICAL_REGRESSORS))
    model = rf.encoder().fit(frame.where("stage_clean = 'Unknown'"))

    def ones(name: str):
        return F.aggregate(vector_to_array(name), F.lit(0.0), lambda a, v: a + v)

    return model.transform(frame).select(
        "event_id", ones("industry_top15_hot").alias("industry_hot"), ones("stage_clean_hot").alias("stage_hot"))


@query("T12_class_weights", "label:l n:l weight:f", statement(
    """SELECT label, n, sum(n) OVER () / (count(*) OVER () * n) AS weight FROM (
         SELECT CASE WHEN car > 0 THEN 1 ELSE 0 END AS label, count(*) AS n
         FROM headline WHERE car IS NOT NULL GROUP BY 1)"""))
def _(spark, folder):
    return rf.class_weights(rf.sign_label(headline(spark, folder), "car"))


@query("T13_stratified_folds", "event_id:l label:l fold:l", statement(
    """SELECT event_id, label, fold FROM (WITH labelled AS (
           SELECT s.event_id, s.company_id, s.announcement_date, CASE WHEN h.car > 0 THEN 1 ELSE 0 END AS label
           FROM study s JOIN headline h USING (event_id) WHERE h.car IS NOT NULL),
       numbered AS (
           SELECT *, row_number() OVER (PARTITION BY label ORDER BY company_id, announcement_date, event_id) - 1 AS nth,
                  row_number() OVER (ORDER BY company_id, announcement_date, event_id) AS place FROM labelled),
       dealt AS (
           SELECT label, (row_number() OVER (ORDER BY first_place, nth) - 1) % 5 AS fold
           FROM (SELECT *, min(place) OVER (PARTITION BY label) AS first_place FROM numbered)),
       blocks AS (SELECT label, fold, row_number() OVER (PARTITION BY label ORDER BY fold) - 1 AS nth FROM dealt)
       SELECT event_id, label, fold FROM numbered JOIN blocks USING (label, nth))"""))
def _(spark, folder):
    events = wh.study_events(spark, folder).select("event_id", "announcement_date")
    labelled = rf.sign_label(headline(spark, folder), "car").join(events, "event_id")
    return rf.stratified_folds(labelled, ["company_id", "announcement_date", "event_id"])


@query("T13_cross_validation", "n_obs:l pos_rate:f cv_accuracy_mean:f cv_accuracy_std:f cv_roc_auc_mean:f cv_roc_auc_std:f")
def _(spark, folder):
    return rf.cv_metrics(rf.cross_validate(model_frame(spark, folder), "car_m5_p5"))


@query("T10_rf_contract", "event_id:l label:l scored:b agrees:b", statement(
    """SELECT s.event_id, CASE WHEN h.car > 0 THEN 1 ELSE 0 END AS label, true AS scored, true AS agrees
       FROM study s JOIN headline h USING (event_id) WHERE h.car IS NOT NULL"""))
def _(spark, folder):
    """Every labelled event is scored, by a share of votes that its prediction agrees with (fewer trees, all rows)."""
    frame = model_frame(spark, folder)
    scored = rf.fit_forest(frame, "car_m5_p5", trees=8).transform(rf.sign_label(frame, "car_m5_p5"))
    share = F.col("probability")
    return scored.select("event_id", "label", share.between(0, 1).alias("scored"), ((share > 0.5) == (F.col("prediction") == 1)).alias("agrees"))


@query("T13_cv_contract", "fold:l n:l positives:l in_range:b", statement(
    """WITH labelled AS (
           SELECT s.event_id, s.company_id, s.announcement_date, CASE WHEN h.car > 0 THEN 1 ELSE 0 END AS label
           FROM study s JOIN headline h USING (event_id) WHERE h.car IS NOT NULL),
       numbered AS (
           SELECT *, row_number() OVER (PARTITION BY label ORDER BY company_id, announcement_date, event_id) - 1 AS nth,
                  row_number() OVER (ORDER BY company_id, announcement_date, event_id) AS place FROM labelled),
       dealt AS (
           SELECT label, (row_number() OVER (ORDER BY first_place, nth) - 1) % 5 AS fold
           FROM (SELECT *, min(place) OVER (PARTITION BY label) AS first_place FROM numbered))
       SELECT fold, count(*) AS n, sum(label) AS positives, true AS in_range FROM dealt GROUP BY fold""".replace("WITH labelled", "SELECT * FROM (WITH labelled") + ")"))
def _(spark, folder):
    """What the folds of the cross-validation scored, and that scores lie between 0 and 1 (fewer trees, all rows)."""
    folds = rf.cross_validate(model_frame(spark, folder), "car_m5_p5", trees=8)
    return folds.withColumn("in_range", F.col("accuracy").between(0, 1) & F.col("roc_auc").between(0, 1))


@query("T14_importance_contract", "feature:s in_range:b total:f", statement(
    """SELECT feature, true AS in_range, 1.0 AS total FROM (
         SELECT unnest(['log_employees_laid_off', 'pct_laid_off_filled', 'has_pct', 'is_repeat', 'days_since_prior_layoff',
                        'market_regime_30d', 'log_funds_raised', 'has_funds', 'event_year']) AS feature
         UNION ALL SELECT DISTINCT 'industry_top15_' || industry_top15 FROM features JOIN headline USING (event_id) WHERE car IS NOT NULL
         UNION ALL SELECT DISTINCT 'stage_clean_' || stage_clean FROM features JOIN headline USING (event_id) WHERE car IS NOT NULL)"""))
def _(spark, folder):
    """A row per feature of the model; the means are shares of one (fewer trees, all rows)."""
    rows = rf.feature_importance(rf.fit_forest(model_frame(spark, folder), "car_m5_p5", trees=8))
    mean, spread = F.col("importance_mean"), F.col("importance_std")
    total = rows.agg(F.sum("importance_mean")).scalar()
    return rows.select("feature", (mean.between(0, 1) & (spread >= 0)).alias("in_range"), total.alias("total"))


@query("T14_feature_importance", "feature:s importance_mean:f importance_std:f")
def _(spark, folder):
    model = rf.fit_forest(model_frame(spark, folder), "car_m5_p5")
    return rf.feature_importance(model).orderBy(F.desc("importance_mean"))
