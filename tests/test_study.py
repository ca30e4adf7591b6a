"""Worked values for the calendar, the returns and the windows."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.windows import check_windows, parse_windows, window_key, window_key_column
from tidemark.operators import calendar as cal
from tidemark.operators import eventstudy as es
from tidemark.operators import features as ft
from tidemark.operators import reporting as rep
from tidemark.operators import returns as ret

MONDAY = dt.date(2024, 1, 1)


def weekdays(n):
    out, day = [], MONDAY
    while len(out) < n:
        if day.weekday() < 5:
            out.append(day)
        day += dt.timedelta(days=1)
    return out


def market_of(spark, days, price=lambda i: 100.0 + i):
    return spark.createDataFrame([(d, price(i)) for i, d in enumerate(days)], "trade_date date, adj_close double")


def wiggle(i):
    return 50.0 * math.exp(0.01 * ((i * 37) % 11 - 5))


def prices_of(spark, rows):
    return spark.createDataFrame(rows, "company_id long, trade_date date, adj_close double")


def events_of(spark, rows):
    return spark.createDataFrame(rows, "event_id long, company_id long, announcement_date date")


def test_window_names_and_parsing(spark):
    assert [window_key(w) for w in ((-5, 5), (0, 3), (-30, 30))] == ["m5_p5", "p0_p3", "m30_p30"]
    assert parse_windows("-30,+30; -1,+1") == [(-30, 30), (-1, 1), (-5, 5)]
    assert parse_windows("-5,5") == [(-5, 5)]
    assert parse_windows(None) == [(-30, 30), (-5, 5), (-1, 1), (0, 3)]
    with pytest.raises(ValueError):
        check_windows([(3, 3)])
    row = spark.range(1).select(window_key_column(F.lit(-5), F.lit(0)).alias("k")).first()
    assert row.k == "m5_p0"


def test_alignment_forward_and_backward(spark):
    days = weekdays(10)  # Mon 1 .. Fri 12 January
    calendar = cal.trading_calendar(market_of(spark, days))
    asked = {
        1: dt.date(2024, 1, 6),    # Saturday
        2: dt.date(2024, 1, 5),    # Friday
        3: dt.date(2024, 1, 13),   # after the last day
        4: dt.date(2023, 12, 20),  # before the first day
        5: dt.date(2024, 1, 8),    # Monday
        6: dt.date(2024, 1, 1),    # first day
    }
    events = spark.createDataFrame(list(asked.items()), "event_id long, announcement_date date")
    t0 = {r.event_id: r.t0 for r in cal.align_forward(events, calendar).collect()}
    assert t0 == {1: 5, 2: 4, 3: None, 4: 0, 5: 5, 6: 0}
    prev = {r.event_id: r.t_prev for r in cal.align_backward(events, calendar).collect()}
    assert prev == {1: 4, 2: 3, 3: 9, 4: None, 5: 4, 6: None}
    regime = {r.event_id: r.market_regime_30d for r in cal.attach_regime(events, calendar).collect()}
    assert set(regime.values()) == {0.0}  # fewer than 20 returns


def test_regime_needs_twenty_returns(spark):
    rows = cal.rolling_regime(cal.trading_calendar(market_of(spark, weekdays(40)))).orderBy("idx").collect()
    assert rows[19].regime is None and rows[20].regime is not None  # day 0 has no return
    assert rows[20].regime == pytest.approx(math.log(120 / 100))
    assert rows[39].regime == pytest.approx(math.log(139 / 109))  # thirty returns


def test_stock_returns_span_gaps(spark):
    days = weekdays(5)
    prices = prices_of(spark, [(1, days[0], 10.0), (1, days[3], 20.0), (2, days[1], 5.0)])
    got = {(r.company_id, r.trade_date): r.r_stock for r in ret.stock_returns(prices).collect()}
    assert got[(1, days[3])] == pytest.approx(math.log(2)) and got[(1, days[0])] is None
    assert got[(2, days[1])] is None


def brute_force(days, market, series, t0, ws, we):
    """Window sum by walking the days, the slow and obvious way."""
    r_mkt = {d: math.log(market[d] / market[days[i - 1]]) for i, d in enumerate(days) if i}
    own = sorted(series)
    r_stock = {d: math.log(series[d] / series[own[i - 1]]) for i, d in enumerate(own) if i}
    lo, hi = t0 + ws, t0 + we
    if lo < 1 or hi >= len(days):
        return None, []
    ars = [r_stock[d] - r_mkt[d] for d in days[lo:hi + 1] if d in r_stock and d in r_mkt]
    return (sum(ars) if len(ars) >= (we - ws + 1) * 0.9 else None), ars


def test_windows_against_brute_force(spark):
    days = weekdays(400)
    market = {d: 100.0 + (i * 7) % 13 for i, d in enumerate(days)}
    full = {d: wiggle(i) for i, d in enumerate(days)}
    # company 2 misses every ninth day and trades on days the market does not
    holey = {d: wiggle(i + 3) for i, d in enumerate(days) if i % 9}
    holey[dt.date(2024, 6, 1)] = 77.0  # a Saturday
    short = {d: wiggle(i) for i, d in enumerate(days) if i >= 120}
    series = {1: full, 2: holey, 3: short}
    prices = prices_of(spark, [(c, d, p) for c, s in series.items() for d, p in s.items()])
    picks = [0, 1, 4, 5, 6, 30, 31, 249, 250, 251, 260, 300, 369, 370, 394, 395, 399]
    events = [(c * 1000 + t, c, days[t]) for c in series for t in picks]
    events += [(9001, 4, days[300]), (9002, 1, days[-1] + dt.timedelta(days=30))]
    calendar = cal.trading_calendar(market_of(spark, days, lambda i: market[days[i]]))
    windows = [(-30, 30), (-5, 5), (-1, 1), (0, 3)]
    results = es.study_events(events_of(spark, events), prices, calendar, windows)
    got = {r.event_id: r for r in results.collect()}
    assert len(got) == len(events)
    for company, s in series.items():
        for t in picks:
            row = got[company * 1000 + t]
            _, est = brute_force(days, market, s, t, -250, -31)
            sigma = None
            if len(est) >= 150:
                mean = sum(est) / len(est)
                sigma = math.sqrt(sum((x - mean) ** 2 for x in est) / (len(est) - 1))
            assert (row.sigma is None) == (sigma is None)
            for ws, we in windows:
                car, ars = brute_force(days, market, s, t, ws, we)
                key = window_key((ws, we))
                assert (row[f"car_{key}"] is None) == (car is None), (company, t, key)
                if car is not None:
                    assert row[f"car_{key}"] == pytest.approx(car, abs=1e-10)
                    assert row[f"avg_ar_{key}"] == pytest.approx(car / len(ars), abs=1e-10)
                    if sigma:
                        assert row[f"scar_{key}"] == pytest.approx(car / (sigma * math.sqrt(we - ws + 1)), abs=1e-8)
                    else:
                        assert row[f"scar_{key}"] is None
    counters = es.run_counters(results).first()
    assert counters.asDict() == {"processed": len(events) - 2, "skipped_no_prices": 1, "skipped_bounds": 1}
    wide = es.studied(results)
    assert wide.count() == len(events) - 2
    long = es.long_results(wide, windows)
    assert long.count() == 4 * (len(events) - 2)  # rows with a null return are kept
    line = es.timeline(wide, prices, calendar).where("event_id = 1031").collect()
    assert sorted(r.offset for r in line) == list(range(-30, 31))


def test_prefix_totals_hold_until_the_next_return(spark):
    days = weekdays(30)
    calendar = cal.trading_calendar(market_of(spark, days))
    kept = [4, 5, 9, 10, 17]  # the series starts late, has gaps and ends early
    rows = [(1, days[i], wiggle(i)) for i in kept] + [(2, days[3], 10.0), (3, dt.date(2024, 1, 6), 5.0)]
    got = {r.company_id: r for r in es.prefix_totals(prices_of(spark, rows), calendar).collect()}
    assert (got[2].n_prices, got[2].cells, got[3].n_prices, got[3].first) == (1, [], 1, None)
    one = got[1]
    assert (one.n_prices, one.first, one.last, len(one.cells)) == (5, 5, 17, 13)
    ar = {b: math.log(wiggle(b) / wiggle(a)) - math.log((100 + b) / (99 + b)) for a, b in zip(kept, kept[1:])}
    for p, cell in enumerate(one.cells, start=5):
        upto = [v for i, v in ar.items() if i <= p]
        assert cell.n == len(upto)
        assert cell.s == pytest.approx(sum(upto), abs=1e-12) and cell.q == pytest.approx(sum(v * v for v in upto), abs=1e-12)
    events = events_of(spark, [(1, 1, days[25]), (2, 1, days[2]), (3, 2, days[3]), (4, 7, days[3])])
    out = {r.event_id: r for r in es.study_events(events, prices_of(spark, rows), calendar, [(-1, 1)], estimation=(-2, 1)).collect()}
    assert [out[e].n_m1_p1 for e in (1, 2, 3, 4)] == [0, 0, 0, 0]  # after the end, before the start, without returns, unknown
    assert [out[e].n_prices for e in (1, 2, 3, 4)] == [5, 5, 1, 0]


def coverage_case(spark, missing, bounds_days=60, t0=30):
    days = weekdays(bounds_days)
    kept = [(1, d, wiggle(i)) for i, d in enumerate(days) if i not in missing]
    calendar = cal.trading_calendar(market_of(spark, days))
    out = es.study_events(events_of(spark, [(1, 1, days[t0])]), prices_of(spark, kept), calendar, [(-5, 5)])
    return out.first()


def test_ten_of_eleven_days_are_enough(spark):
    assert coverage_case(spark, {27}).car_m5_p5 is not None
    assert coverage_case(spark, {27, 29}).car_m5_p5 is None


def test_window_must_lie_inside_the_calendar(spark):
    assert coverage_case(spark, set(), t0=5).car_m5_p5 is None      # starts on day 0
    assert coverage_case(spark, set(), t0=6).car_m5_p5 is not None
    assert coverage_case(spark, set(), t0=55).car_m5_p5 is None     # ends behind the last day
    assert coverage_case(spark, set(), t0=54).car_m5_p5 is not None


@pytest.mark.parametrize("valid, defined", [(150, True), (149, False)])
def test_sigma_needs_150_days(spark, valid, defined):
    # estimation window of an event at 251 is [1, 220]; drop its first days
    row = coverage_case(spark, set(range(0, 220 - valid)), bounds_days=300, t0=251)
    assert row.n_est == valid and (row.sigma is not None) is defined


def test_market_against_itself_is_zero(spark):
    days = weekdays(300)
    calendar = cal.trading_calendar(market_of(spark, days, wiggle))
    prices = prices_of(spark, [(1, d, wiggle(i)) for i, d in enumerate(days)])
    row = es.study_events(events_of(spark, [(1, 1, days[260])]), prices, calendar, [(-5, 5)]).first()
    assert row.car_m5_p5 == 0.0 and row.sigma is None and row.scar_m5_p5 is None


def test_repartitioning_changes_nothing(spark):
    days = weekdays(320)
    calendar = cal.trading_calendar(market_of(spark, days))
    prices = prices_of(spark, [(c, d, wiggle(i * c)) for c in (1, 2) for i, d in enumerate(days)])
    events = events_of(spark, [(c * 100 + t, c, days[t]) for c in (1, 2) for t in range(255, 300, 5)])

    def run(p, e):
        return sorted(tuple(r) for r in es.wide_results(e, p, calendar).collect())

    assert run(prices, events) == run(prices.repartition(7), events.repartition(5))


def test_event_history(spark):
    events = events_of(spark, [(1, 1, dt.date(2024, 1, 1)), (2, 1, dt.date(2024, 1, 11)), (3, 2, dt.date(2024, 1, 5))])
    got = {r.event_id: (r.event_rank, r.is_repeat, r.is_first, r.days_since_prior_layoff)
           for r in ft.event_history(events).collect()}
    assert got == {1: (1, 0, 1, 9999), 2: (2, 1, 0, 10), 3: (1, 0, 1, 9999)}


def test_top_categories_tie_by_name(spark):
    rows = [(c,) for c in ["b", "b", "a", "a", "c", None, None, None]]
    df = spark.createDataFrame(rows, "industry string")
    got = sorted(r.top for r in ft.bucket_categories(df, "industry", "top", k=1).collect())
    assert got == ["Other"] * 6 + ["a"] * 2


def test_unusable_prices_cost_two_returns_and_no_more(spark):
    days = weekdays(400)
    series = [wiggle(i) for i in range(400)]
    broken = {3: float("nan"), 60: 0.0, 120: -1.0, 301: float("inf")}
    usable = {i: broken.get(i, p) for i, p in enumerate(series)}
    calendar = cal.trading_calendar(market_of(spark, days, lambda i: {40: 0.0, 41: float("nan")}.get(i, 100.0 + (i * 7) % 13)))
    market = [{40: 0.0, 41: float("nan")}.get(i, 100.0 + (i * 7) % 13) for i in range(400)]
    good = lambda a: 0 < a < math.inf  # noqa: E731  false for NaN
    back = lambda p, i: math.log(p[i] / p[i - 1]) if i and good(p[i]) and good(p[i - 1]) else None
    ar = {i: back(usable, i) - back(market, i) for i in range(400) if back(usable, i) is not None and back(market, i) is not None}
    assert len(ar) == 399 - 8 - 3
    prices = prices_of(spark, [(1, d, usable[i]) for i, d in enumerate(days)] + [(2, d, None) for d in days])
    events = [(t, 1, days[t]) for t in (280, 299, 300, 310, 350)] + [(9000, 2, days[300])]
    got = {r.event_id: r for r in es.study_events(events_of(spark, events), prices, calendar, [(-5, 5), (-30, 30)]).collect()}
    for t in (280, 299, 300, 310, 350):
        est = [ar[i] for i in range(t - 250, t - 30) if i in ar]
        mean = sum(est) / len(est)
        assert got[t].sigma == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in est) / (len(est) - 1)), rel=1e-9)
        for low, high in ((-5, 5), (-30, 30)):
            own = [ar[i] for i in range(t + low, t + high + 1) if i in ar]
            car = sum(own) if len(own) >= 0.9 * (high - low + 1) else None
            assert got[t][f"car_{window_key((low, high))}"] == (None if car is None else pytest.approx(car, abs=1e-10))
    assert got[9000].sigma is None and got[9000].car_m5_p5 is None


def test_long_history_keeps_its_digits(spark):
    days = [dt.date(1930, 1, 1) + dt.timedelta(days=i) for i in range(25_000)]
    # a wild century before a calm end
    series = [50.0 * math.exp((0.5 if i < 24_000 else 0.001) * ((i * 37) % 11 - 5)) for i in range(25_000)]
    calendar = cal.trading_calendar(market_of(spark, days, lambda i: 100.0))
    row = es.study_events(events_of(spark, [(1, 1, days[24_900])]), prices_of(spark, [(1, d, p) for d, p in zip(days, series)]), calendar, [(-5, 5)]).first()
    est = [math.log(series[i] / series[i - 1]) for i in range(24_650, 24_870)]
    mean = sum(est) / len(est)
    assert row.sigma == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in est) / (len(est) - 1)), rel=1e-4)
    assert row.car_m5_p5 == pytest.approx(math.log(series[24_905] / series[24_894]), abs=1e-8)


def test_two_indexes_need_a_name(spark):
    days = weekdays(5)
    both = market_of(spark, days).withColumn("index_symbol", F.lit("A")).unionByName(
        market_of(spark, days, lambda i: 7.0 + i).withColumn("index_symbol", F.lit("B")))
    with pytest.raises(Exception, match="one row per date"):
        cal.trading_calendar(both)
    assert [r.adj_close for r in cal.trading_calendar(both, symbol="B").orderBy("idx").collect()] == [7.0, 8.0, 9.0, 10.0, 11.0]


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(1).normal(size=3000)), list(np.random.default_rng(2).standard_t(1.1, size=800)), [0.0] * 500 + [1000.0], [3.0, 4.0]])
def test_density_equals_the_sum_of_kernels(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
    got = sorted((r.i, r.x, r.density) for r in rep.kernel_density(df, "v", 50).collect())
    v = np.array(values)
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 50)
    want = np.exp(-0.5 * ((x[:, None] - v[None, :]) / h) ** 2).mean(axis=1) / (h * np.sqrt(2 * np.pi))
    assert [i for i, _, _ in got] == list(range(50)) and [g[1] for g in got] == pytest.approx(list(x))
    assert np.abs(np.array([g[2] for g in got]) - want).max() * h < 1e-11


def test_density_without_spread_or_rows(spark):
    df = spark.createDataFrame([(2.0,)] * 3, "v double")
    assert [r.density for r in rep.kernel_density(df, "v", 4).collect()] == [None] * 4
    assert rep.kernel_density(df.where("v > 5"), "v", 4).count() == 0
