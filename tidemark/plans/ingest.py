"""Raw announcements into the company and event tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.constraints import event_checks, flag_violations, split_valid
from tidemark.operators.dedupe import completeness, first_non_null
from tidemark.operators.merge import lookup_key, new_rows, upsert_fill_nulls
from tidemark.operators.positions import with_position
from tidemark.session import settled
from tidemark.sources.readers import event_columns

COMPANY_ATTRIBUTES = ("company", "industry", "location", "country")
EVENT_KEY = ("company_id", "announcement_date")
EVENT_ATTRIBUTES = ("employees_laid_off", "percentage_laid_off", "funds_raised_usd", "stage", "source_url")


def unique_companies(clean: DataFrame) -> DataFrame:
    """One row per normalised name with the first non-null value of each attribute."""
    present = [c for c in COMPANY_ATTRIBUTES if c in clean.columns]
    order = [-completeness([c for c in clean.columns if c != "company_normalized"]), F.col("date"), F.col("company")]
    folded = first_non_null(clean, ["company_normalized"], present, order)
    missing = {c: F.lit(None).cast("string") for c in COMPANY_ATTRIBUTES if c not in present}
    return folded.withColumns(missing) if missing else folded


def load_companies(companies: DataFrame, clean: DataFrame) -> DataFrame:
    """The company table with the batch's new names; stored rows and ids stay."""
    batch = unique_companies(clean).select(
        F.col("company").alias("company_name"), "industry", F.col("location").alias("headquarters"), "country",
        F.lit(False).alias("is_public"))
    new = new_rows(companies, batch, ["company_name"])
    top = companies.agg(F.coalesce(F.max("company_id"), F.lit(0)).alias("top")).scalar()
    numbered = with_position(new, ["company_name"], "__pos").withColumn(
        "company_id", (top + 1 + F.col("__pos")).cast("long")).drop("__pos")
    return companies.unionByName(numbered, allowMissingColumns=True)


class EventLoad(NamedTuple):
    """The event table after a batch, what was left out of it, and one row of counters.

    ``counters``: ``inserted`` rows written, new or known; ``created`` events that were not stored before; ``skipped`` rows of
    unknown companies; ``failed`` rows that break a rule.
    """

    events: DataFrame
    rejected: DataFrame
    unknown: DataFrame
    counters: DataFrame


def load_events(events: DataFrame, companies: DataFrame, clean: DataFrame) -> EventLoad:
    """The event table after the batch. Known events only gain values they lacked.

    The batch is read and judged once, and written; rows, rejects and counters all come from that table.
    """
    rows = lookup_key(event_columns(clean), "company", companies, "company_name", "company_id")
    judged = settled(flag_violations(rows, {"company_known": F.col("company_id").isNotNull()} | event_checks()))
    is_unknown = F.array_contains("violations", "company_known")
    unknown = judged.where(is_unknown).drop("violations")
    valid, rejected = split_valid(judged.where(~is_unknown).select(*EVENT_KEY, *EVENT_ATTRIBUTES, "violations"))
    merged = settled(upsert_fill_nulls(events, valid, EVENT_KEY, EVENT_ATTRIBUTES))
    # stored rows keep their ids; only the new ones are numbered
    top = events.agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("top")).scalar()
    created = merged.where("event_id is null")
    new = with_position(created, EVENT_KEY, "__pos").withColumn(
        "event_id", (top + 1 + F.col("__pos")).cast("long")).drop("__pos")
    counters = judged.agg(F.count_if(F.size("violations") == 0).alias("inserted"), F.count_if(is_unknown).alias("skipped"),
                          F.count_if(~is_unknown & (F.size("violations") > 0)).alias("failed"))
    counters = counters.select("inserted", created.agg(F.count("*")).scalar().alias("created"), "skipped", "failed")
    return EventLoad(merged.where("event_id is not null").unionByName(new), rejected, unknown, counters)
