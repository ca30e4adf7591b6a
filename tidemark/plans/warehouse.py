"""The study's inputs expressed over the order warehouse tables.

A company is a supplier, a trading day is a week with shipments, a price is the
volume-weighted unit price of the supplier's shipments in that week, the market
is the same over all suppliers, and an announcement is an order, credited to
the supplier of its first line. All tables are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.dedupe import keep_most_complete

_SHIFT = 1 << 40


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _unit_price(cents: Column, quantity: Column) -> Column:
    """Whole cents over whole units, rounded to 4 decimals of a dollar.

    Integer sums are exact in any order, so the price does not depend on how
    the lines were partitioned.
    """
    return F.floor(cents / quantity * 100 + 0.5) / F.lit(10000.0)


def _shipments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("company_id"),
        F.date_trunc("week", "l_shipdate").cast("date").alias("trade_date"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        F.col("l_quantity").cast("long").alias("quantity"),
    )


def weekly(spark: SparkSession, folder: str) -> DataFrame:
    """``company_id, trade_date, cents, volume``: the one pass over the lines that prices and market share."""
    return _shipments(spark, folder).groupBy("company_id", "trade_date").agg(
        F.sum("cents").alias("cents"), F.sum("quantity").alias("volume"))


def prices(spark: SparkSession, folder: str, sums: DataFrame | None = None) -> DataFrame:
    """``company_id, trade_date, adj_close, volume``"""
    sums = weekly(spark, folder) if sums is None else sums
    return sums.select("company_id", "trade_date",
                       _unit_price(F.col("cents"), F.col("volume")).alias("adj_close"), "volume")


def market(spark: SparkSession, folder: str, sums: DataFrame | None = None) -> DataFrame:
    """``index_symbol, trade_date, adj_close, volume``"""
    if sums is None:
        sums = _shipments(spark, folder).withColumnRenamed("quantity", "volume")
    sums = sums.groupBy("trade_date").agg(F.sum("cents").alias("cents"), F.sum("volume").alias("volume"))
    return sums.select(F.lit("^GSPC").alias("index_symbol"), "trade_date",
                       _unit_price(F.col("cents"), F.col("volume")).alias("adj_close"), "volume")


def companies(spark: SparkSession, folder: str) -> DataFrame:
    """``company_id, company_name, ticker_symbol, industry``; an overdrawn supplier is private."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("company_id"),
            F.col("s_name").alias("company_name"),
            F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("S"), F.col("s_suppkey"))).alias("ticker_symbol"),
            F.when(F.col("s_acctbal") < 9000, F.col("n_name")).alias("industry"),
        )
    )


def announcements(spark: SparkSession, folder: str) -> DataFrame:
    """Raw announcements, one per order, before de-duplication."""
    lead = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("event_id"))
        # line number and supplier packed into one long: the smallest is the first line
        .agg(F.min(F.col("l_linenumber") * F.lit(_SHIFT) + F.col("l_suppkey")).alias("first_line"))
        .select("event_id", (F.col("first_line") % _SHIFT).alias("company_id"))
    )
    price = F.col("o_totalprice")
    return (
        table(spark, folder, "orders")
        .select(
            F.col("o_orderkey").alias("event_id"),
            F.col("o_orderdate").cast("date").alias("announcement_date"),
            F.when(F.col("o_orderstatus") != "P", F.floor(price / 100).cast("int")).alias("employees_laid_off"),
            F.when(F.col("o_orderstatus") != "O", (F.floor(price) % 100 / 100.0)).alias("percentage_laid_off"),
            F.when(price >= 100000, (F.floor(price) * 3).cast("double")).alias("funds_raised_usd"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("stage"),
        )
        .join(lead, "event_id")
    )


MEASURES = ("employees_laid_off", "percentage_laid_off", "funds_raised_usd", "stage")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Announcements, one per company and date."""
    return keep_most_complete(announcements(spark, folder), ["company_id", "announcement_date"],
                              MEASURES, ["event_id"])


def study_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of listed companies with the company's attributes."""
    listed = companies(spark, folder).where("ticker_symbol is not null")
    return events(spark, folder).join(listed, "company_id")
