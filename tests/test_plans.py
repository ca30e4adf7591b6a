"""The physical plans the design promises."""

import re

import pytest

from tidemark.operators import dedupe as dd
from tidemark.operators import eventstudy as es
from tidemark.operators import merge as mg
from tidemark.plans import all_queries
from tidemark.plans import queries_ingest as qi
from tidemark.plans import queries_study as qs
from tidemark.plans import warehouse as wh
from tidemark.session import settled
from tidemark.sources import readers as rd

FOLDER = "/root/testdata/sf0.001"
MODELS = {"T8_ols_hc3", "T8_ols_single_regressor", "T9_ols_diagnostics", "T9_residual_statistics",
          "T9_full_model_statistics",
          "T10_rf_classifier", "T13_cross_validation", "T14_feature_importance", "T10_rf_contract", "T13_cv_contract",
          "T14_importance_contract"}  # results of finished jobs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_study_shuffles_prices_once(spark):
    """Prices and events are each shuffled once on the company; prices are sorted once; edges are read, not joined."""
    events, (prices, days) = settled(wh.study_events(spark, FOLDER)), qs.price_inputs(spark, FOLDER)
    text = plan(es.wide_results(events, settled(prices), days))
    on_company = [e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if e.startswith("company_id")]
    assert len(on_company) == 2 and len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert len(re.findall(r"Sort \[company_id#\d+L ASC NULLS FIRST, trade_date", text)) == 1
    assert len(re.findall(r"ReadSchema: struct<company_id:bigint,trade_date:date,adj_close:double>", text)) == 1
    assert "Union" not in text and "Expand" not in text and text.count("Generate explode") == 1  # the dates of the calendar


def test_best_row_per_key_is_cut_before_the_shuffle(spark):
    text = plan(dd.keep_most_complete(wh.announcements(spark, FOLDER), ["company_id"], wh.MEASURES, ["event_id"]))
    before = text[text.index("WindowGroupLimit"):]
    assert "Final" in before and "Partial" in before
    assert before.index("Exchange hashpartitioning(company_id") < before.index("Partial")


def test_small_batch_is_broadcast_not_the_table(spark):
    table = settled(wh.prices(spark, FOLDER))
    batch = settled(wh.prices(spark, FOLDER).where("company_id = 1"))
    text = plan(mg.new_rows(table, batch, ["company_id", "trade_date"]))
    assert "SortMergeJoin" not in text and "LeftSemi, BuildRight" in text


def test_scans_read_only_what_they_need(spark):
    text = plan(wh.prices(spark, FOLDER))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"}


@pytest.mark.parametrize("name", sorted(set(all_queries()) - MODELS))
def test_no_cross_joins(spark, name):
    text = plan(all_queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_a_raw_row_is_cleaned_and_parsed_once(spark):
    text = plan(rd.clean_events(qi.raw_events(spark, FOLDER)))
    dates = text.count("regexp_replace(") - text.count("(?U)")
    assert dates == 1 and "Generate inline" in text
    # a strip for each text column, and one more for each number
    assert text.count("(?U)") == len(qi._HEADER) + 3 + 1
