"""The whole study, from stored tables to result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.windows import (
    DEFAULT_WINDOWS, HEADLINE_WINDOW, TIMELINE_WINDOW, Window, check_windows, window_key,
)
from tidemark.operators import eventstudy, features, forest, inference, regression
from tidemark.operators.calendar import trading_calendar
from tidemark.operators.forest import Forest
from tidemark.session import settled


@dataclass
class StudyInputs:
    events: DataFrame
    prices: DataFrame
    market: DataFrame


def study_inputs(events: DataFrame, companies: DataFrame, prices: DataFrame, market: DataFrame) -> StudyInputs:
    """The pruned reads of a study: events of listed companies, and three price columns as doubles."""
    listed = companies.where(F.col("ticker_symbol").isNotNull()).select(
        "company_id", "company_name", "ticker_symbol", "industry")
    close = F.col("adj_close").cast("double").alias("adj_close")
    return StudyInputs(
        events.select("event_id", "company_id", "announcement_date", "employees_laid_off",
                      "percentage_laid_off", "funds_raised_usd", "stage").join(listed, "company_id"),
        prices.select("company_id", "trade_date", close),
        market.select("trade_date", close),
    )


@dataclass
class Study:
    per_event: DataFrame
    windows: DataFrame
    counters: DataFrame
    timeline: DataFrame | None
    summary: DataFrame
    features: DataFrame
    ols: regression.OlsFit | None
    forest: Forest | None
    forest_folds: DataFrame | None


def run_study(inputs: StudyInputs, windows: Sequence[Window] = DEFAULT_WINDOWS,
              headline: Window = HEADLINE_WINDOW, with_forest: bool = True, **forest_options) -> Study:
    """Events, per-event results and the model frame are written out once and reused by all that follows."""
    windows = check_windows([*windows, headline])
    calendar = trading_calendar(inputs.market)
    events = settled(inputs.events)
    results = settled(eventstudy.study_events(events, inputs.prices, calendar, windows))
    per_event = eventstudy.studied(results)
    key = window_key(headline)
    frame = settled(features.join_results(features.build_features(events, calendar), per_event))
    model = folds = None
    if with_forest:
        model = forest.fit_forest(frame, f"car_{key}", **forest_options)
        folds = forest.cross_validate(frame, f"car_{key}", **forest_options) if model else None
    return Study(
        per_event=per_event,
        windows=eventstudy.long_results(per_event, windows, stored=True),
        counters=eventstudy.run_counters(results),
        timeline=eventstudy.timeline(per_event, inputs.prices, calendar) if TIMELINE_WINDOW in windows else None,
        summary=inference.hypothesis_summary(per_event, key),
        features=frame,
        ols=regression.fit_ols(frame, f"car_{key}", features.NUMERIC_REGRESSORS, features.CATEGORICAL_REGRESSORS,
                               keep=["company_id", "announcement_date", "event_id"]),
        forest=model,
        forest_folds=folds,
    )
