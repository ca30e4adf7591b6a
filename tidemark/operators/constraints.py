"""Declared integrity rules as a split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import settled

# Keys that tables promise to be unique: rule -> columns.
COMPANY_KEYS = {"name_unique": ["company_name"], "ticker_unique": ["ticker_symbol"]}
PRICE_KEYS = {"price_day_unique": ["company_id", "trade_date"]}
WINDOW_KEYS = {"window_unique": ["event_id", "window_start_offset", "window_end_offset"]}


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Rows numbered for ``flag_violations`` where a table has no id of its own; written, so that the numbers stay."""
    return settled(df.withColumn(name, F.monotonically_increasing_id()))


def flag_violations(df: DataFrame, checks: Mapping[str, Column], id_col: str | None = None,
                    unique: Mapping[str, Sequence[str]] | None = None,
                    references: Mapping[str, tuple[str, DataFrame, str]] | None = None) -> DataFrame:
    """Add ``violations``, the sorted names of the broken rules.

    ``checks``: rule -> condition that must not be false (null passes, as in SQL).
    ``unique``: rule -> key columns; the smallest ``id_col`` keeps the key, and a
    null in the key never collides; needs a unique ``id_col``. ``references``: rule -> (column, parent, parent column).
    Winners are found by partial aggregation and matched back on the row id, so
    a key shared by many rows is never gathered in one task.
    """
    broken = [F.when(~condition, F.lit(name)) for name, condition in checks.items()]
    flags: list[str] = []
    for name, keys in (unique or {}).items():
        flag = f"__{name}"
        first = (
            df.dropna(subset=list(keys)).groupBy(*keys).agg(F.min(id_col).alias(id_col))
            .select(id_col, F.lit(True).alias(flag))
        )
        df = df.join(first, id_col, "left")
        collides = F.col(flag).isNull()
        for key in keys:
            collides = collides & F.col(key).isNotNull()
        broken.append(F.when(collides, F.lit(name)))
        flags.append(flag)
    for name, (column, parent, parent_col) in (references or {}).items():
        flag = f"__{name}"
        known = parent.select(F.col(parent_col).alias(column)).distinct().withColumn(flag, F.lit(True))
        df = df.join(known, column, "left")
        broken.append(F.when(F.col(column).isNotNull() & F.col(flag).isNull(), F.lit(name)))
        flags.append(flag)
    found = F.array_sort(F.array_compact(F.array(*broken)))
    return df.withColumn("violations", found).drop(*flags)


def split_valid(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid rows, rejected rows with their violations)``"""
    ok = F.size("violations") == 0
    return flagged.where(ok).drop("violations"), flagged.where(~ok)


def event_checks() -> dict[str, Column]:
    pct = F.col("percentage_laid_off")
    return {
        "company_present": F.col("company_id").isNotNull(),
        "date_present": F.col("announcement_date").isNotNull(),
        "employees_not_negative": F.col("employees_laid_off") >= 0,
        "percentage_range": (pct >= 0) & (pct <= 100),
    }


def price_checks() -> dict[str, Column]:
    return {"price_positive": F.coalesce(F.col("adj_close") > 0, F.lit(False))}


def market_checks() -> dict[str, Column]:
    return {"market_price_positive": F.coalesce(F.col("adj_close") > 0, F.lit(False))}


def window_checks() -> dict[str, Column]:
    return {"window_order": F.col("window_start_offset") < F.col("window_end_offset")}


def match_checks() -> dict[str, Column]:
    # The admissible match methods.
    methods = ("manual", "yf_search", "yf_direct", "fuzzy", "unresolved")
    return {
        "match_complete": F.col("match_method").isNull() == F.col("match_confidence").isNull(),
        "match_method_known": F.col("match_method").isin(*methods),
    }
