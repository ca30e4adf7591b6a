"""The tables behind the study's reports."""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.quantiles import exact_quantiles

# Fixed values of the report design.
HISTOGRAM_BINS = 40
KDE_POINTS = 200
NORMAL_95 = 1.96
WHISKER = 1.5
LOW_COVERAGE_DAYS = 200


def in_window(windows: DataFrame, window: tuple[int, int]) -> DataFrame:
    """Stored rows of one window."""
    return windows.where((F.col("window_start_offset") == window[0]) & (F.col("window_end_offset") == window[1]))


def events_with_returns(events: DataFrame, windows: DataFrame, window: tuple[int, int]) -> DataFrame:
    """Events that have a return in the window."""
    hits = in_window(windows, window).where(F.col("car").isNotNull()).select("event_id", "car")
    return events.join(hits, "event_id")


def stored_mean(column: str) -> Column:
    """Mean of a stored decimal: the sum is exact, so the mean does not depend on the order of rows."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def monthly_activity(events: DataFrame, windows: DataFrame, window: tuple[int, int]) -> DataFrame:
    """``month, n_events, mean_car``; events without a return still count."""
    hits = in_window(windows, window).select("event_id", "car")
    return (
        events.select("event_id", F.trunc("announcement_date", "month").alias("month"))
        .join(hits, "event_id", "left")
        .groupBy("month")
        .agg(F.count("*").alias("n_events"), stored_mean("car").alias("mean_car"))
    )


def year_month_matrix(monthly: DataFrame, value: Column, empty: float | int | None = None) -> DataFrame:
    """One row per year, one column per month ``m1``..``m12``."""
    cells = monthly.select(F.year("month").alias("year"), F.month("month").alias("m"), value.alias("v"))
    wide = cells.groupBy("year").pivot("m", list(range(1, 13))).agg(F.first("v"))
    wide = wide.withColumnsRenamed({str(m): f"m{m}" for m in range(1, 13)})
    return wide if empty is None else wide.fillna(empty)


def symmetric_limit(df: DataFrame, value: str) -> DataFrame:
    """The largest absolute value, for a colour scale centred on zero."""
    return df.agg(F.greatest(F.abs(F.min(value)), F.abs(F.max(value))).alias("vmax"))


def timeline_interval(timeline: DataFrame) -> DataFrame:
    """Mean abnormal return per day offset with its 95 % interval."""
    stats = timeline.groupBy("offset").agg(
        F.avg("ar").alias("mean"), F.stddev_samp("ar").alias("std"), F.count("ar").alias("n"))
    se = F.col("std") / F.sqrt("n")
    return stats.withColumn("se", se).withColumns({
        "ci_lo": F.col("mean") - NORMAL_95 * F.col("se"),
        "ci_hi": F.col("mean") + NORMAL_95 * F.col("se"),
    })


def histogram(df: DataFrame, value: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``bin, lo, hi, n`` over equal widths from minimum to maximum; empty bins are kept."""
    number = df.select(F.col(value).cast("double").alias("__v")).where("__v is not null")
    span = number.agg(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi")).alias("s")).scalar()
    width = (span["hi"] - span["lo"]) / F.lit(float(bins))
    # the maximum belongs to the last bin
    place = F.least(F.floor(F.try_divide(F.col("__v") - span["lo"], width)), F.lit(bins - 1))
    place = F.when(width > 0, place).otherwise(0).cast("int")
    counts = number.groupBy(place.alias("bin")).agg(F.count("*").alias("k"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", (span["lo"] + F.col("bin") * width).alias("lo"),
        (span["lo"] + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("k", F.lit(0)).cast("long").alias("n"))


_MOMENTS = 12
_REACH = 9  # bandwidths: a kernel is below 3e-18 beyond


def _hermite(terms: int) -> list[list[float]]:
    """Coefficients by power of the Hermite polynomials, each divided by its factorial."""
    rows = [[1.0], [0.0, 1.0]]
    for k in range(1, terms - 1):
        up, down = [0.0, *rows[k]], [*rows[k - 1], 0.0, 0.0]
        rows.append([a - k * b for a, b in zip(up, down)])
    return [[c / math.factorial(k) for c in row] for k, row in enumerate(rows[:terms])]


def kernel_density(df: DataFrame, value: str, points: int = KDE_POINTS) -> DataFrame:
    """``i, x, density``: Gaussian kernel, Scott bandwidth h, even grid from minimum to maximum.

    Rows go to boxes half a bandwidth wide, of which twelve moments are kept: with d the distance of a row from the middle
    and z that of a grid point, in bandwidths, the kernel exp(-(z - d)^2 / 2) is exp(-z^2 / 2) times the sum of He_k(z) d^k / k!,
    so a box adds a polynomial of z to the grid points within nine bandwidths. What is left out of a row's kernel is at
    most 1.09 (1/4)^12 / sqrt(12!) < 3.1e-12 of its height, by the bound on Hermite functions. Work grows with the rows plus
    the boxes, of which there are at most 2 (maximum - minimum) / h.
    """
    number = df.select(F.col(value).cast("double").alias("__v")).where("__v is not null")
    frame = number.agg(F.struct(
        F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.count("*").alias("n"),
        (F.stddev_samp("__v") * F.pow(F.count("*"), F.lit(-0.2))).alias("h"),
    ).alias("f")).scalar()
    step = (frame["hi"] - frame["lo"]) / F.lit(float(points - 1))
    place = F.try_divide(F.col("__v") - frame["lo"], frame["h"]) * 2
    rows = number.select(F.floor(place).alias("box"), ((place - F.floor(place) - 0.5) / 2).alias("d"))
    power = F.lit(1.0)
    for k in range(_MOMENTS):
        rows = rows.withColumn(f"d{k}", power)
        power = F.col(f"d{k}") * F.col("d")
    boxes = rows.where("box is not null").groupBy("box").agg(*[F.sum(f"d{k}").alias(f"d{k}") for k in range(_MOMENTS)])
    hermite = _hermite(_MOMENTS)
    by_power = [F.array(*[F.lit(row[j] if j < len(row) else 0.0) * F.col(f"d{k}") for k, row in enumerate(hermite)]) for j in range(_MOMENTS)]
    boxes = boxes.select(((F.col("box") + 0.5) / 2).alias("middle"), *[
        F.aggregate(terms, F.lit(0.0), lambda a, t: a + t).alias(f"a{j}") for j, terms in enumerate(by_power)])
    # grid points near a box; distances in bandwidths from the minimum
    pace = F.try_divide(step, frame["h"])
    first = F.greatest(F.ceil(F.try_divide(F.col("middle") - _REACH, pace)), F.lit(0))
    last = F.least(F.floor(F.try_divide(F.col("middle") + _REACH, pace)), F.lit(points - 1))
    near = boxes.withColumn("i", F.explode(F.when(first <= last, F.sequence(first, last)))).withColumn("z", F.col("i") * pace - F.col("middle"))
    total = F.lit(0.0)
    for j in reversed(range(_MOMENTS)):
        total = total * F.col("z") + F.col(f"a{j}")
    sums = near.groupBy("i").agg(F.sum(total * F.exp(F.col("z") * F.col("z") * -0.5)).alias("k"))
    grid = df.sparkSession.range(points).withColumnRenamed("id", "i").where(frame["n"] > 0)
    return grid.join(sums, "i", "left").select(
        F.col("i").cast("int").alias("i"), (frame["lo"] + F.col("i") * step).alias("x"),
        F.try_divide(F.coalesce("k", F.lit(0.0)), frame["n"] * frame["h"] * F.sqrt(F.lit(2.0) * F.pi())).alias("density"))


def clip_range(df: DataFrame, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """``p, quantile`` of the outer percentiles used to clip an axis."""
    return exact_quantiles(df, value, [low, high])


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Per group: quartiles, whiskers at 1.5 interquartile ranges, and the outlier count."""
    rows = df.select(F.col(group), F.col(value).cast("double").alias("__v")).where("__v is not null")
    quartiles = (
        exact_quantiles(rows, "__v", [0.25, 0.5, 0.75], [group])
        .groupBy(group)
        .agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(n)
               for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    )
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("__v").between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.join(quartiles, group).groupBy(group, "q1", "median", "q3").agg(
        F.count("*").alias("n"),
        F.min(F.when(inside, F.col("__v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"),
    )


def window_counts(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_start_offset", "window_end_offset").agg(F.count("*").alias("n"))


def mean_by_window(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_start_offset", "window_end_offset").agg(
        F.count("car").alias("n"), stored_mean("car").alias("mean_car"))


def price_coverage(companies: DataFrame, feed: DataFrame, low: int = LOW_COVERAGE_DAYS) -> DataFrame:
    """What a raw feed (``ticker``, ``adj_close``) holds for each listed company.

    ``days`` are all days that were delivered, ``attempted`` those with a usable price and ``skipped_invalid`` the others;
    status and low-coverage flag go by the delivered days.
    """
    usable = F.coalesce((F.col("adj_close") > 0) & ~F.isnan("adj_close"), F.lit(False))
    days = feed.groupBy(F.col("ticker").alias("ticker_symbol")).agg(
        F.count("*").alias("days"), F.count_if(usable).alias("attempted"), F.count_if(~usable).alias("skipped_invalid"))
    n = F.coalesce("days", F.lit(0))
    return (
        companies.where("ticker_symbol is not null")
        .join(days, "ticker_symbol", "left")
        .select("company_id", "ticker_symbol", n.cast("long").alias("days"),
                *[F.coalesce(c, F.lit(0)).alias(c) for c in ("attempted", "skipped_invalid")],
                F.when(n > 0, "ok").otherwise("empty").alias("status"),
                F.when((n > 0) & (n < low), "LOW-COVERAGE").alias("flag"))
    )


def coverage_totals(coverage: DataFrame) -> DataFrame:
    """One row over ``price_coverage``: companies with and without data, with little of it, and rows by their fate."""
    return coverage.agg(
        F.count_if(F.col("status") == "ok").alias("with_data"), F.count_if(F.col("status") == "empty").alias("empty"),
        F.count_if(F.col("flag").isNotNull()).alias("low_coverage"), F.coalesce(F.sum("attempted"), F.lit(0)).alias("attempted"),
        F.coalesce(F.sum("skipped_invalid"), F.lit(0)).alias("skipped_invalid"))


def match_by_method(companies: DataFrame) -> DataFrame:
    return companies.groupBy("match_method").agg(F.count("*").alias("n"))


def impact_coverage(companies: DataFrame, events: DataFrame) -> DataFrame:
    """Matched against missed companies and the employees affected."""
    # one row per company first: the event side is reduced before the join
    impact = events.groupBy("company_id").agg(F.sum("employees_laid_off").alias("employees"))
    status = F.when(F.col("ticker_symbol").isNotNull(), "matched").otherwise("missed")
    return (
        companies.select("company_id", "ticker_symbol").join(impact, "company_id", "left")
        .groupBy(status.alias("status"))
        .agg(F.countDistinct("company_id").alias("companies"),
             F.sum("employees").cast("long").alias("total_laid_off"))
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
