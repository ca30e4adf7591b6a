"""Stored tables."""

from __future__ import annotations

COMPANIES = (
    "company_id bigint, company_name string, ticker_symbol string, industry string, headquarters string, "
    "country string, is_public boolean, match_method string, match_confidence decimal(5,2), "
    "match_attempted_at timestamp"
)
EVENTS = (
    "event_id bigint, company_id bigint, announcement_date date, employees_laid_off int, "
    "percentage_laid_off decimal(5,2), funds_raised_usd decimal(15,2), stage string, source_url string"
)
DAILY_PRICES = (
    "company_id bigint, trade_date date, open_price decimal(12,4), close_price decimal(12,4), "
    "adj_close decimal(12,4), volume bigint"
)
MARKET_INDEX = "trade_date date, index_symbol string, adj_close decimal(12,4), volume bigint"
EVENT_WINDOWS = (
    "event_id bigint, window_start_offset int, window_end_offset int, car decimal(10,6), "
    "avg_ar decimal(10,6), scar decimal(10,6)"
)
OVERRIDES = "normalized_name string, ticker string"
SEARCH_QUOTES = (
    "company_name string, rank int, symbol string, quote_type string, exchange string, "
    "longname string, shortname string"
)
SECURITIES = "symbol string, longname string, shortname string"
RAW_PRICES = (
    "ticker string, ts timestamp, open double, close double, adj_close double, volume bigint"
)
RAW_INDEX = "ts timestamp, adj_close double, volume bigint"

MARKET_SYMBOL = "^GSPC"
