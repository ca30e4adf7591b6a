"""The trading calendar and lookups by date.

A calendar has one row per distinct date. The date type itself has about 3.7
million values (years 1 to 9999), so a calendar stays below some 100 MB whatever
the size of the price tables; a century of daily data has some 25,000 rows.
That bound is why calendars, and only calendars, are broadcast unconditionally
here, and why their running windows may run in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.operators.returns import log_return
from tidemark.session import settled

REGIME_DAYS = 30
REGIME_MIN_DAYS = 20


def trading_calendar(market: DataFrame, settle: bool = True, symbol: str | None = None) -> DataFrame:
    """``market(trade_date, adj_close)`` -> ``(trade_date, idx, adj_close, r_mkt)``, of the index ``symbol`` if it is given.

    A date that comes twice, as with two indexes in one table, is an error.

    ``idx`` is the 0-based position; ``r_mkt`` the log return, null on day 0.
    A study looks the calendar up several times, so by default it is written
    once to the shared folder and its source is read only once.
    """
    if symbol is not None:
        market = market.where(F.col("index_symbol") == symbol)
    order = W.orderBy("trade_date")
    twice = F.lag("trade_date").over(order) == F.col("trade_date")
    close = F.col("adj_close").cast("double")
    calendar = (
        market.select("trade_date", close.alias("adj_close"))
        .withColumn("idx", (F.row_number().over(order) - 1).cast("int"))
        .withColumn("r_mkt", log_return(F.col("adj_close"), F.lag("adj_close").over(order)))
        .withColumn("r_mkt", F.when(twice, F.raise_error(F.lit("a calendar has one row per date; name the index"))).otherwise(F.col("r_mkt")))
    )
    return settled(calendar) if settle else calendar


def date_lookup(calendar: DataFrame) -> DataFrame:
    """One row per calendar date from the first to the last trading day.

    ``(date, t0)`` with ``t0`` the position of the first trading day on or after
    ``date``. Turns the ordered search into an equi-join.
    """
    order = W.orderBy("trade_date")
    gap = calendar.select("trade_date", "idx").withColumn(
        "after", F.coalesce(F.date_add(F.lag("trade_date").over(order), 1), F.col("trade_date"))
    )
    return gap.select(
        F.explode(F.sequence("after", "trade_date")).alias("date"), F.col("idx").alias("t0")
    )


def align_forward(events: DataFrame, calendar: DataFrame, date_col: str = "announcement_date",
                  name: str = "t0") -> DataFrame:
    """Position of the first trading day on or after the date; null past the end."""
    first = calendar.agg(F.min("trade_date").alias("d")).scalar()
    lookup = date_lookup(calendar).withColumnsRenamed({"date": "__date", "t0": "__t0"})
    return (
        events.join(F.broadcast(lookup), F.col(date_col) == F.col("__date"), "left")
        .withColumn(name, F.coalesce("__t0", F.when(F.col(date_col) < first, 0)))
        .drop("__date", "__t0")
    )


def align_backward(events: DataFrame, calendar: DataFrame, date_col: str = "announcement_date",
                   name: str = "t_prev") -> DataFrame:
    """Position of the last trading day strictly before the date; null if there is none."""
    last = calendar.agg(F.max(F.struct("trade_date", "idx")).alias("last")).scalar()
    forward = align_forward(events, calendar, date_col, "__t")
    position = F.when(F.col("__t").isNotNull(), F.col("__t") - 1).when(
        F.col(date_col) > last["trade_date"], last["idx"]
    )
    return forward.withColumn(name, F.when(position >= 0, position).cast("int")).drop("__t")


def rolling_regime(calendar: DataFrame, days: int = REGIME_DAYS,
                   min_days: int = REGIME_MIN_DAYS) -> DataFrame:
    """Rolling sum of market returns, null until ``min_days`` returns are in the frame."""
    frame = W.orderBy("idx").rowsBetween(-(days - 1), 0)
    return calendar.select(
        "trade_date", "idx", "r_mkt",
        F.when(F.count("r_mkt").over(frame) >= min_days, F.sum("r_mkt").over(frame)).alias("regime"),
    )


def attach_regime(events: DataFrame, calendar: DataFrame, date_col: str = "announcement_date",
                  name: str = "market_regime_30d") -> DataFrame:
    """Market regime on the day before the event; 0.0 where unknown."""
    regime = rolling_regime(calendar).select(F.col("idx").alias("__idx"), F.col("regime").alias("__regime"))
    return (
        align_backward(events, calendar, date_col, "__prev")
        .join(F.broadcast(regime), F.col("__prev") == F.col("__idx"), "left")
        .withColumn(name, F.coalesce("__regime", F.lit(0.0)))
        .drop("__prev", "__idx", "__regime")
    )
