"""Windowed abnormal returns around events.

Every window statistic is a difference of running totals: with S(p) the total
of abnormal returns up to calendar position p, a window [lo, hi] sums to
S(hi) - S(lo-1). The totals are taken once, on the price rows, and laid out as
one array a company with a cell for every position between its first and last
return. An event meets its company's array once and reads the edges of its
windows by position: nothing is expanded to one row per event and day, or per
event and edge. Prices are shuffled and sorted once, on ``company_id``. A company
has at most one price and one event per date, so an array is bounded by the
calendar, however many rows there are (about 1 MB for a century of days).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.windows import (
    DEFAULT_WINDOWS, ESTIMATION_WINDOW, MIN_COVERAGE, MIN_ESTIMATION_DAYS, TIMELINE_WINDOW, Window,
    check_windows, window_key,
)
from tidemark.operators.calendar import align_forward
from tidemark.operators.returns import abnormal_returns, stock_returns

def _probe_offsets(windows: Sequence[Window], estimation: Window) -> list[int]:
    edges = {o for start, end in [*windows, estimation] for o in (start - 1, end)}
    return sorted(edges)


def prefix_totals(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """``(company_id, n_prices, first, last, cells)``: running totals of abnormal returns by calendar position.

    ``cells[p - first]`` holds the sum ``s``, the sum of squares ``q`` and the number ``n`` of the company's returns up to
    position p. Companies without a return have no cells.
    """
    days = calendar.select("trade_date", "idx", "r_mkt")
    so_far = W.partitionBy("company_id").orderBy("trade_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = (
        stock_returns(prices).join(F.broadcast(days), "trade_date", "left")
        .withColumn("ar", F.col("r_stock") - F.col("r_mkt"))
        .select("company_id", "adj_close", F.when(F.col("ar").isNotNull(), F.struct(
            "idx", F.sum("ar").over(so_far).alias("s"), F.sum(F.col("ar") * F.col("ar")).over(so_far).alias("q"),
            F.count("ar").over(so_far).alias("n"))).alias("total"))
        .groupBy("company_id")
        .agg(F.count("adj_close").alias("n_prices"), F.sort_array(F.collect_list("total")).alias("known"))
    )

    def filled(known: Column) -> Column:
        """A total holds until the next one."""
        until = lambda total, i: F.coalesce(F.get(known, i + 1)["idx"], total["idx"] + 1)
        cells = F.flatten(F.transform(known, lambda total, i: F.array_repeat(total, until(total, i) - total["idx"])))
        return F.struct(F.get(known, F.lit(0))["idx"].alias("first"),
                        F.get(known, F.size(known) - 1)["idx"].alias("last"), cells.alias("cells"))

    # bound as a lambda's argument, so that the sorted list is made once a company
    bound = F.transform(F.array("known"), filled)
    return totals.select("company_id", "n_prices", F.inline(bound))


def _running_totals(events: DataFrame, prices: DataFrame, calendar: DataFrame,
                    offsets: Sequence[int]) -> DataFrame:
    """One row per event with the running totals at each probe offset; null where that lies outside the calendar."""
    aligned = align_forward(events.select("event_id", "company_id", "announcement_date"), calendar)
    aligned = aligned.withColumn("size", calendar.agg(F.count("*").alias("n")).scalar())
    met = aligned.join(prefix_totals(prices, calendar), "company_id", "left")
    none = F.struct(F.lit(None).cast("int").alias("idx"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0).cast("long").alias("n"))

    def cell(o: Column) -> Column:
        at = F.col("t0") + o  # no cell before the first return; the last one holds to the end
        return F.when((at >= 0) & (at < F.col("size")), F.coalesce(F.get("cells", F.least(at, F.col("last")) - F.col("first")), none))

    edges = met.select("company_id", "event_id", "t0", F.coalesce("n_prices", F.lit(0)).alias("n_prices"),
                       F.transform(F.array(*[F.lit(o) for o in offsets]), cell).alias("edges"))
    return edges.select("company_id", "event_id", "t0", "n_prices", *[
        F.col("edges")[i][m].alias(f"{m}@{o}") for i, o in enumerate(offsets) for m in ("s", "q", "n")])


def _between(measure: str, window: Window) -> Column:
    """Total over a window; null when either edge lies outside the calendar."""
    return F.col(f"{measure}@{window[1]}") - F.col(f"{measure}@{window[0] - 1}")


def study_events(events: DataFrame, prices: DataFrame, calendar: DataFrame,
                 windows: Sequence[Window] = DEFAULT_WINDOWS, estimation: Window = ESTIMATION_WINDOW,
                 min_estimation_days: int = MIN_ESTIMATION_DAYS,
                 coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per event: position, price count, sigma and all window statistics.

    ``events(event_id, company_id, announcement_date)``,
    ``prices(company_id, trade_date, adj_close)``, ``calendar`` from ``trading_calendar``.
    Keeps every event; ``wide_results`` drops those that cannot be studied.
    """
    windows = check_windows(windows)
    totals = _running_totals(events, prices, calendar, _probe_offsets(windows, estimation))

    n_est, s_est = _between("n", estimation), _between("s", estimation)
    variance = F.try_divide(_between("q", estimation) - F.try_divide(s_est * s_est, n_est), n_est - 1)
    enough = (n_est >= min_estimation_days) & (n_est > 1)
    out = totals.withColumn("n_est", n_est.cast("int")).withColumn(
        "sigma", F.when(enough & (variance > 0), F.sqrt(variance))
    )
    columns: list[Column] = []
    for window in windows:
        key, length = window_key(window), window[1] - window[0] + 1
        days = _between("n", window)
        car = F.when(days >= F.lit(length * coverage), _between("s", window))
        columns += [
            days.cast("int").alias(f"n_{key}"),
            car.alias(f"car_{key}"),
            F.try_divide(car, days).alias(f"avg_ar_{key}"),
            (car / (F.col("sigma") * F.sqrt(F.lit(float(length))))).alias(f"scar_{key}"),
        ]
    return out.select("company_id", "event_id", "t0", "n_prices", "n_est", "sigma", *columns)


def studied(results: DataFrame) -> DataFrame:
    """Events with a price series and a position in the calendar."""
    return results.where("n_prices > 0 and t0 is not null")


def wide_results(events: DataFrame, prices: DataFrame, calendar: DataFrame,
                 windows: Sequence[Window] = DEFAULT_WINDOWS, **options) -> DataFrame:
    """``event_id, company_id, car_<key>, scar_<key>, ...`` for every studied event."""
    results = studied(study_events(events, prices, calendar, windows, **options))
    keys = [window_key(w) for w in check_windows(windows)]
    return results.select("event_id", "company_id", "t0", "sigma",
                          *[f"{m}_{k}" for k in keys for m in ("car", "avg_ar", "scar")])


def long_results(wide: DataFrame, windows: Sequence[Window] = DEFAULT_WINDOWS,
                 stored: bool = False) -> DataFrame:
    """One row per event and window, kept even if the return is null.

    ``stored=True`` rounds to the table's DECIMAL(10,6).
    """
    rows = [
        F.struct(F.lit(w[0]).alias("window_start_offset"), F.lit(w[1]).alias("window_end_offset"),
                 *[F.col(f"{m}_{window_key(w)}").alias(m) for m in ("car", "avg_ar", "scar")])
        for w in check_windows(windows)
    ]
    out = wide.select("event_id", F.inline(F.array(*rows)))
    if stored:
        out = out.withColumns({m: F.col(m).cast("decimal(10,6)") for m in ("car", "avg_ar", "scar")})
    return out


def run_counters(results: DataFrame) -> DataFrame:
    """How many events were processed and why the others were not."""
    no_prices = F.col("n_prices") == 0
    return results.agg(
        F.count_if(~no_prices & F.col("t0").isNotNull()).alias("processed"),
        F.count_if(no_prices).alias("skipped_no_prices"),
        F.count_if(~no_prices & F.col("t0").isNull()).alias("skipped_bounds"),
    )


def window_alignment(events: DataFrame, prices: DataFrame, calendar: DataFrame, window: Window) -> DataFrame:
    """``(event_id, company_id, offset, idx, r_stock, r_mkt, ar)``: one row per valid day of the window."""
    size = calendar.agg(F.count("*").alias("n")).scalar()
    start, end = window
    days = (
        align_forward(events.select("event_id", "company_id", "announcement_date"), calendar)
        .where((F.col("t0") + start >= 1) & (F.col("t0") + end < size))
        .select("event_id", "company_id", "t0",
                F.explode(F.sequence(F.lit(start), F.lit(end))).alias("offset"))
        .withColumn("idx", F.col("t0") + F.col("offset"))
    )
    return days.join(abnormal_returns(prices, calendar), ["company_id", "idx"]).select(
        "event_id", "company_id", "offset", "idx", "r_stock", "r_mkt", "ar"
    )


def timeline(wide: DataFrame, prices: DataFrame, calendar: DataFrame,
             window: Window = TIMELINE_WINDOW) -> DataFrame:
    """Daily ``(event_id, offset, ar)`` of the events whose window has a return."""
    start, end = window
    days = (
        wide.where(F.col(f"car_{window_key(window)}").isNotNull())
        .select("event_id", "company_id", "t0",
                F.explode(F.sequence(F.lit(start), F.lit(end))).alias("offset"))
        .withColumn("idx", F.col("t0") + F.col("offset"))
    )
    returns = abnormal_returns(prices, calendar).select("company_id", "idx", "ar")
    return days.join(returns, ["company_id", "idx"]).select("event_id", "offset", "ar")
