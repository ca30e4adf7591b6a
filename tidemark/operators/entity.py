"""Company names to securities, in tiers.

Candidates always meet names through an equi-join on a key (the normalised
name, the searched name, or a guessed symbol), never by comparing all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.cleaning import normalise_key
from tidemark.functions.similarity import with_token_set_ratio
from tidemark.session import settled

# The admissible listings, thresholds and confidences.
US_EXCHANGES = ("NMS", "NYQ", "NGM", "NCM", "ASE", "PCX", "BTS")
EQUITY = "EQUITY"
SEARCH_MIN_RATIO = 85.0
DIRECT_MIN_RATIO = 70.0
MANUAL_CONFIDENCE, DIRECT_CONFIDENCE, NO_CONFIDENCE = 100.0, 85.0, 0.0
MAX_SEARCH_RESULTS = 10


def unmatched(companies: DataFrame) -> DataFrame:
    """Companies no run has looked at yet."""
    return companies.where("match_method is null").select(
        "company_id", "company_name", normalise_key(F.col("company_name")).alias("normalized"))


def override_match(names: DataFrame, overrides: DataFrame) -> DataFrame:
    """``company_id, ticker`` for curated names; a null ticker is a hit meaning "not listed"."""
    curated = overrides.groupBy(F.col("normalized_name").alias("normalized")).agg(
        F.max("ticker").alias("ticker"))
    return names.join(curated, "normalized").select("company_id", "ticker")


def _listed_name() -> Column:
    blank = F.lit("")
    name = F.when(F.coalesce("longname", blank) != "", F.col("longname")).otherwise(F.col("shortname"))
    return F.coalesce(name, blank)


def search_match(quotes: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``company_name, ticker, confidence``: best-ranked admissible search hit per name.

    Works on the search results alone (they carry the searched name), reduced to
    one row per name before anything is joined. With ``names``, only the results of
    those names are looked at, so a run costs what its pending names cost.
    """
    if names is not None:
        quotes = quotes.join(names.select("company_name"), "company_name", "left_semi")
    usable = (
        quotes.withColumn("__listed", _listed_name())
        .where((F.col("rank") <= MAX_SEARCH_RESULTS) & (F.col("quote_type") == EQUITY)
               & F.col("exchange").isin(*US_EXCHANGES)
               & (F.coalesce("symbol", F.lit("")) != "") & (F.col("__listed") != ""))
        .select("company_name", "rank", "symbol", "__listed")
    )
    scored = with_token_set_ratio(usable, F.lower("__listed"), F.lower("company_name"), "ratio")
    best = scored.where(F.col("ratio") >= SEARCH_MIN_RATIO).groupBy("company_name").agg(
        F.min(F.struct("rank", "symbol", "ratio")).alias("best"))
    return best.select("company_name", F.col("best.symbol").alias("ticker"),
                       F.col("best.ratio").alias("confidence"))


def ticker_guesses(names: DataFrame) -> DataFrame:
    """``company_id, company_name, pos, symbol``: up to four guesses per name, in order, no repeats."""
    words = F.filter(F.split(F.trim("company_name"), r"(?U)\s+"), lambda w: w != "")
    letters = F.upper(F.regexp_replace(F.coalesce(F.get(words, F.lit(0)), F.lit("")), r"\P{L}", ""))
    initials = F.filter(F.transform(words, lambda w: F.substring(w, 1, 1)), lambda c: c.rlike(r"^\p{Lu}$"))
    acronym = F.array_join(initials, "")
    size = F.length("__letters")
    guesses = F.array(
        F.when(size.between(1, 5), F.col("__letters")),
        F.when(size >= 4, F.substring("__letters", 1, 4)),
        F.when(size >= 3, F.substring("__letters", 1, 3)),
        F.when(F.length("__acronym").between(2, 5), F.col("__acronym")),
    )
    return (
        names.select("company_id", "company_name", letters.alias("__letters"), acronym.alias("__acronym"))
        .select("company_id", "company_name",
                F.posexplode(F.array_distinct(F.array_compact(guesses))).alias("pos", "symbol"))
    )


def direct_match(names: DataFrame, securities: DataFrame) -> DataFrame:
    """``company_id, ticker``: first guess that is a listed symbol with a similar enough name."""
    listed = securities.select("symbol", _listed_name().alias("__listed")).where(F.col("__listed") != "")
    met = ticker_guesses(names).join(listed, "symbol")
    scored = with_token_set_ratio(met, F.lower("__listed"), F.lower("company_name"), "ratio")
    best = scored.where(F.col("ratio") >= DIRECT_MIN_RATIO).groupBy("company_id").agg(
        F.min(F.struct("pos", "symbol")).alias("best"))
    return best.select("company_id", F.col("best.symbol").alias("ticker"))


def resolve(names: DataFrame, overrides: DataFrame, quotes: DataFrame, securities: DataFrame) -> DataFrame:
    """``company_id, company_name, ticker, match_method, match_confidence``: first tier that hits wins."""
    manual = override_match(names, overrides).select(
        "company_id", F.struct("ticker", F.lit("manual").alias("method"),
                               F.lit(MANUAL_CONFIDENCE).alias("confidence")).alias("manual"))
    curated = settled(names.join(manual, "company_id", "left"))
    search = search_match(quotes, curated.where("manual is null")).select(
        "company_name", F.struct("ticker", F.lit("yf_search").alias("method"), "confidence").alias("search"))
    # names with the curated hit stay without a search hit, as that tier comes first
    left = settled(curated.join(search, "company_name", "left"))
    pending = left.where("manual is null and search is null").select("company_id", "company_name")
    direct = direct_match(pending, securities).select(
        "company_id", F.struct("ticker", F.lit("yf_direct").alias("method"),
                               F.lit(DIRECT_CONFIDENCE).alias("confidence")).alias("direct"))
    nothing = F.struct(F.lit(None).cast("string").alias("ticker"), F.lit("unresolved").alias("method"),
                       F.lit(NO_CONFIDENCE).alias("confidence"))
    hit = F.coalesce("manual", "search", "direct", nothing)
    return left.join(direct, "company_id", "left").select(
        "company_id", "company_name", hit["ticker"].alias("ticker"),
        hit["method"].alias("match_method"), hit["confidence"].alias("match_confidence"))


def claim_tickers(resolved: DataFrame, held: DataFrame) -> DataFrame:
    """One owner per ticker: holders first, then the first claimant by name.

    Losers become unresolved. Owners are matched back on the company id, so a
    ticker claimed by many names is never gathered in one task.
    """
    claims = resolved.where("ticker is not null").groupBy("ticker").agg(
        F.min(F.struct("company_name", "company_id")).alias("first"))
    free = claims.join(held.where("ticker_symbol is not null").select(
        F.col("ticker_symbol").alias("ticker")), "ticker", "left_anti")
    owners = free.select(F.col("first.company_id").alias("company_id"), F.lit(True).alias("__owner"))
    lost = F.col("ticker").isNotNull() & F.col("__owner").isNull()
    return resolved.join(owners, "company_id", "left").select(
        "company_id", "company_name",
        F.when(~lost, F.col("ticker")).alias("ticker_symbol"),
        F.when(lost, "unresolved").otherwise(F.col("match_method")).alias("match_method"),
        F.when(lost, NO_CONFIDENCE).otherwise(F.col("match_confidence")).cast("decimal(5,2)").alias("match_confidence"),
        (F.col("ticker").isNotNull() & ~lost).alias("is_public"),
    )
