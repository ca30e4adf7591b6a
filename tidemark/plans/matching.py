"""Matching the pending companies and writing the outcome back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.entity import claim_tickers, resolve, unmatched


def match_companies(companies: DataFrame, overrides: DataFrame, quotes: DataFrame,
                    securities: DataFrame) -> DataFrame:
    """The company table with every pending company resolved; earlier matches stay as they are."""
    outcome = claim_tickers(resolve(unmatched(companies), overrides, quotes, securities), companies)
    done = outcome.select(
        "company_id", F.struct("ticker_symbol", "match_method", "match_confidence", "is_public").alias("__new"))
    joined = companies.join(done, "company_id", "left")
    pending = F.col("__new").isNotNull()
    return joined.withColumns({
        **{c: F.when(pending, F.col(f"__new.{c}")).otherwise(F.col(c))
           for c in ("ticker_symbol", "match_method", "match_confidence", "is_public")},
        "match_attempted_at": F.when(pending, F.current_timestamp()).otherwise(F.col("match_attempted_at")),
    }).select(*companies.columns)
