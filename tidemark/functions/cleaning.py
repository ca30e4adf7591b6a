"""Column expressions that turn raw text into typed, nullable values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The text markers a CSV reader of the pandas family treats as missing.
READER_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# The markers treated as missing after trimming.
TRIMMED_NA_TOKENS = ("", "N/A", "nan")

# The names of the months, of which three letters are enough.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
          "december")

_BLANKS = r"[\s\x1c-\x1f]+"
_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?inf(inity)?$"
_TIME = r"(?:[T ]\s*\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:[AaPp][Mm])?\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})?)?\s*"
_NAME = "(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + "|sept)"
_LETTERS = f"(?={_NAME}\\b)[a-z]{{3}}"
_DAY = r"\d{1,2}"
# The shapes of a date in one pattern, each with groups of its own; behind it the numbers of its year, month and day group.
_SHAPES = (
    (rf"(\d{{4}})[-/.]({_DAY})[-/.]({_DAY})", (1, 2, 3)),
    (rf"({_DAY})[-/.]({_DAY})[-/.](\d{{4}}|\d{{2}})", (6, 4, 5)),
    (r"(\d{4})(\d{2})(\d{2})", (7, 8, 9)),
    (rf"({_LETTERS})[a-z]*\.?\s+({_DAY})(?:st|nd|rd|th)?,?\s+(\d{{4}})", (12, 10, 11)),
    (rf"({_DAY})(?:st|nd|rd|th)?[\s-]+({_LETTERS})[a-z]*\.?,?[\s-]+(\d{{4}})", (15, 14, 13)),
)
_MARK = "\x01"
_DATE = r"(?i)^\s*(?:" + "|".join(shape for shape, _ in _SHAPES) + ")" + _TIME + "$"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used and the result is filtered and selected."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(col: Column) -> Column:
    """Without the white space, of any alphabet, at both ends."""
    return F.regexp_replace(col, f"(?U)^{_BLANKS}|{_BLANKS}\\z", "")


def clean_text(col: Column) -> Column:
    """Strip white space, and map the usual missing-value markers to null."""
    return once(strip(F.when(~col.isin(*READER_NA_TOKENS), col)), lambda text: F.when(~text.isin(*TRIMMED_NA_TOKENS), text))


def parse_date(col: Column) -> Column:
    """The date that a text states, whatever follows as its time; null where it states none.

    Years first, or month, day and year; one or two digits; slashes, dashes or dots; names of months before or after the
    day. Two-digit years are those from 1969 to 2068.

    One match tells the shape and its parts: they come out as one text, year, month and day between bars, in which the
    groups of the other shapes are empty. A mark in front, which no date has, tells that there was a match.
    """
    groups = "|".join("".join(f"${g[k]}" for _, g in _SHAPES) for k in range(3))
    months = F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS) for x in (m[:3], k + 1)])

    def of(parts: Column) -> Column:
        year, month, day = (F.element_at(parts, k) for k in (1, 2, 3))
        short = year.cast("int")
        full = F.when(F.char_length(year) > 2, short).otherwise(short + F.when(short < 69, 2000).otherwise(1900))
        number = F.coalesce(F.try_element_at(months, F.lower(month)), month.try_cast("int"))
        # the last check leaves out days that a month does not have, without an error a row
        first = F.when(number.between(1, 12) & (full > 0), F.make_date(full, number, F.lit(1)))
        date = F.date_add(first, F.least(day.cast("int"), F.lit(31)) - 1)
        return F.when((F.month(date) == number) & (day.cast("int") > 0), date)

    parts = once(F.regexp_replace(col, _DATE, _MARK + groups),
                 lambda m: F.when(m.startswith(_MARK) & ~col.startswith(_MARK), F.split(F.substr(m, F.lit(2)), r"\|")))
    return once(parts, lambda p: F.when(p.isNotNull(), of(p)))


def to_number(col: Column) -> Column:
    """Numeric value or null; a textual NaN counts as missing, as does a number with a type letter behind it."""
    return once(strip(col.cast("string")), lambda text: F.when(text.rlike(_NUMBER), text.try_cast("double")))


def to_percent(col: Column, scale: float = 1.0) -> Column:
    """Drop percent signs, then as ``to_number``. ``12%`` stays 12.0 unless ``scale`` says otherwise."""
    number = to_number(F.replace(col.cast("string"), F.lit("%"), F.lit("")))
    return number if scale == 1.0 else number * F.lit(scale)


def to_int(col: Column) -> Column:
    """Truncates toward zero; out-of-range or non-numeric input becomes null."""
    return to_number(col).try_cast("int")


def normalise_key(col: Column) -> Column:
    return F.lower(strip(col))


def missing_flag(col: Column) -> Column:
    return col.isNotNull().cast("int")


def log1p_filled(col: Column, fill: Column) -> Column:
    return F.log1p(F.coalesce(col.cast("double"), fill))


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def snake_case(name: str) -> str:
    """Header text to a column name."""
    name = name.strip().lower()
    # The spelled-out symbols.
    for symbol, word in ((" ", "_"), ("#", "num"), ("%", "pct")):
        name = name.replace(symbol, word)
    return name
