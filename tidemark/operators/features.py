"""The feature frame behind the regression and the classifier.

Ranks, medians and the category buckets are taken over all matched events,
before any event without a return is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.functions.cleaning import log1p_filled, missing_flag
from tidemark.operators.calendar import attach_regime
from tidemark.operators.quantiles import exact_median

# Fixed values of the study design.
NO_PRIOR_DAYS = 9999
TOP_CATEGORIES = 15
OTHER, UNKNOWN = "Other", "Unknown"

NUMERIC_REGRESSORS = (
    "log_employees_laid_off", "pct_laid_off_filled", "has_pct", "is_repeat",
    "days_since_prior_layoff", "market_regime_30d", "log_funds_raised", "has_funds",
)
CATEGORICAL_REGRESSORS = ("industry_top15", "stage_clean")
FOREST_NUMERICS = (*NUMERIC_REGRESSORS, "event_year")


def event_history(events: DataFrame) -> DataFrame:
    """Order of each event within its company and the days since the one before."""
    order = W.partitionBy("company_id").orderBy("announcement_date", "event_id")
    prior = F.lag("announcement_date").over(order)
    return (
        events.withColumn("event_rank", F.row_number().over(order))
        .withColumn("days_since_prior_layoff",
                    F.coalesce(F.datediff("announcement_date", prior), F.lit(NO_PRIOR_DAYS)))
        .withColumn("is_repeat", (F.col("event_rank") > 1).cast("int"))
        .withColumn("is_first", (F.col("event_rank") == 1).cast("int"))
    )


def top_categories(df: DataFrame, column: str, k: int = TOP_CATEGORIES) -> DataFrame:
    """The ``k`` most frequent non-null values; ties by name."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc(column)).limit(k)
    )


def bucket_categories(df: DataFrame, column: str, name: str, k: int = TOP_CATEGORIES) -> DataFrame:
    """Keep the ``k`` most frequent values, everything else and null becomes ``Other``."""
    # k rows: the bound is the operator's own parameter
    kept = top_categories(df, column, k).select(F.col(column).alias("__kept"))
    return (
        df.join(F.broadcast(kept), F.col(column) == F.col("__kept"), "left")
        .withColumn(name, F.coalesce("__kept", F.lit(OTHER)))
        .drop("__kept")
    )


def fill_median(df: DataFrame, column: str, name: str) -> DataFrame:
    """Nulls replaced by the median of the whole column."""
    return df.withColumn(name, F.coalesce(F.col(column).cast("double"), exact_median(df, column)))


def size_features(events: DataFrame) -> DataFrame:
    """Log size, log funds, filled share and the presence flags."""
    filled = fill_median(events, "percentage_laid_off", "pct_laid_off_filled")
    return filled.withColumns({
        "log_employees_laid_off": log1p_filled(
            F.col("employees_laid_off"), exact_median(events, "employees_laid_off")),
        "has_pct": missing_flag(F.col("percentage_laid_off")),
        "log_funds_raised": log1p_filled(F.col("funds_raised_usd"), F.lit(0.0)),
        "has_funds": missing_flag(F.col("funds_raised_usd")),
    })


def build_features(events: DataFrame, calendar: DataFrame) -> DataFrame:
    """All features for ``events`` (matched events with company attributes)."""
    return (
        events.transform(size_features)
        .transform(bucket_categories, "industry", "industry_top15")
        .transform(attach_regime, calendar)
        .transform(event_history)
        .withColumn("stage_clean", F.coalesce("stage", F.lit(UNKNOWN)))
        .withColumn("event_year", F.year("announcement_date"))
    )


def join_results(features: DataFrame, wide: DataFrame) -> DataFrame:
    """Features with the event's returns, null where the event was not studied."""
    return features.join(wide.drop("company_id", "t0"), "event_id", "left")
