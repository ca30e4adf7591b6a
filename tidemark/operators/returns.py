"""Stock and abnormal returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def log_return(now: Column, before: Column) -> Column:
    """Log return of two prices; null where either is missing, not a finite number or not above zero."""
    usable = lambda p: (p > 0) & (p < F.lit(float("inf")))  # noqa: E731  NaN is above every number
    return F.when(usable(now) & usable(before), F.log(F.try_divide(now, before)))


def stock_returns(prices: DataFrame) -> DataFrame:
    """Log return against the company's previous row, so returns span gaps.

    One shuffle on ``company_id``. A company has at most one row per date, so no
    partition of the window outgrows the calendar.
    """
    order = W.partitionBy("company_id").orderBy("trade_date")
    close = F.col("adj_close").cast("double")
    return prices.select("company_id", "trade_date", close.alias("adj_close")).withColumn(
        "r_stock", log_return(F.col("adj_close"), F.lag("adj_close").over(order))
    )


def abnormal_returns(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """``(company_id, idx, trade_date, r_stock, r_mkt, ar)`` on days where both returns exist."""
    days = calendar.where("r_mkt is not null").select("trade_date", "idx", "r_mkt")
    return (
        stock_returns(prices)
        .where("r_stock is not null")
        .join(F.broadcast(days), "trade_date")
        .select("company_id", "idx", "trade_date", "r_stock", "r_mkt",
                (F.col("r_stock") - F.col("r_mkt")).alias("ar"))
    )
