"""Raw feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql import types as T

from tidemark.functions.cleaning import (
    clean_text, normalise_key, parse_date, snake_case, to_int, to_number, to_percent,
)
from tidemark.operators.dedupe import keep_most_complete
from tidemark.session import settled
from tidemark.sources.schemas import MARKET_SYMBOL


_QUOTES = {"header": True, "quote": '"', "escape": '"'}


def csv_header(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    """Column names of a headered CSV file or folder; reads no data rows."""
    return spark.read.options(**_QUOTES, multiLine=multi_line, samplingRatio=1e-9).csv(path).columns


def read_events_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A headered CSV, every column as text; a missing path is an error.

    Quoted cells may hold doubled quotes and line breaks. A file with line breaks inside cells can't be split, so a task
    reads a file; ``multi_line=False`` splits files that are known to have none.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in csv_header(spark, path, multi_line)])
    return spark.read.options(**_QUOTES, multiLine=multi_line, ignoreLeadingWhiteSpace=False,
                              ignoreTrailingWhiteSpace=False).schema(schema).csv(path)


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_events_csv``, for files of any size with line breaks inside cells: many tasks read one file.

    Byte ranges are read as lines. Whether a line starts a record depends on how many quotes come before it in its file: each range
    counts its own, and a running sum over the ranges (a row each) says in which state a range begins. Lines between two
    starts are one record, which also holds across ranges; only records of several lines are put together, all others are
    parsed where they were read. Quotes must be paired, as RFC 4180 has it; a lone quote inside a bare cell is for
    ``read_events_csv``. A path with several files may give them in any order; each has a header.
    """
    columns = csv_header(spark, path)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    lines = settled(lines.withColumn("quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))))
    before = F.coalesce(F.sum("quotes").over(W.partitionBy("file", "range").orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("inner", before % 2)
    # one row per range: its quotes, and the last line that starts a record in either state
    ranges = lines.groupBy("file", "range").agg(F.sum("quotes").alias("quotes"), F.min(F.struct("range", "at")).alias("low"), *[
        F.max(F.when(F.col("inner") == k, F.struct("range", "at"))).alias(f"last{k}") for k in (0, 1)])
    so_far = W.partitionBy("file").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("state", F.coalesce(F.sum("quotes").over(so_far), F.lit(0)) % 2)
    open_record = F.last(F.when(F.col("state") == 0, F.col("last0")).otherwise(F.col("last1")), ignorenulls=True).over(so_far)
    header = F.min("low").over(W.partitionBy("file"))
    ranges = settled(ranges.select("file", "range", "state", open_record.alias("open"), header.alias("header")))
    placed = lines.join(ranges, ["file", "range"])
    starts = F.col("inner") == F.col("state")
    own = W.partitionBy("file", "range").orderBy("at")
    record = F.coalesce(F.last(F.when(starts, F.struct("range", "at")), ignorenulls=True).over(own), F.col("open"))
    # a record ends with its first line unless that leaves a quote open
    whole = starts & (F.col("quotes") % 2 == 0)
    placed = settled(placed.select("file", "range", "at", "line", whole.alias("whole"), record.alias("record"), "header").where("record <> header"))
    joined = placed.where("not whole").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("range", "at", "line"))).alias("parts"))
    joined = joined.select(F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("text"))
    rows = placed.where("whole").select(F.col("line").alias("text")).unionAll(joined)
    rows = rows.select(F.regexp_replace("text", "\r$", "").alias("text")).where("text <> ''")
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))])
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return rows.select(F.from_csv("text", schema.simpleString()[7:-1].replace(":", " "), options).alias("cells")).select(
        *[F.col(f"cells.c{i}").alias(c) for i, c in enumerate(columns)])


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every text column; missing-value markers become null."""
    return df.withColumns({
        f.name: clean_text(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    })


_TYPED = {"total_laid_off": to_number, "percentage_laid_off": to_percent, "funds_raised": to_number}


def _dated(raw: DataFrame) -> DataFrame:
    return raw.transform(normalise_columns).transform(clean_strings).withColumn("date", parse_date(F.col("date")))


def clean_events(raw: DataFrame) -> DataFrame:
    """Raw announcements to typed rows with a date and a company, one per company and date.

    A row is cleaned and parsed once: it is one value until it has been judged. A plain filter would move below the columns
    it looks at, and take copies of their expressions along.
    """
    df = _dated(raw)
    typed = [(_TYPED[c](F.col(c)) if c in _TYPED else F.col(c)).alias(c) for c in df.columns]
    usable = F.filter(F.array(F.struct(*typed)), lambda row: row["date"].isNotNull() & row["company"].isNotNull())
    df = df.select(F.inline(usable))
    ties = [c for c in df.columns if c not in ("company", "date")]
    df = keep_most_complete(df, ["company", "date"], df.columns, ties)
    return df.withColumn("company_normalized", normalise_key(F.col("company")))


def cleaning_counters(raw: DataFrame) -> DataFrame:
    """One row: raw rows, rows without a readable date, rows that have one and a company, and what folding leaves of them.

    One pass: rows are counted by company and date first, and the groups are summed up.
    """
    df = _dated(raw).select("company", "date")
    usable = F.col("date").isNotNull() & F.col("company").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return df.groupBy("company", "date").agg(F.count("*").alias("n")).agg(
        total("n").alias("raw_rows"), total(F.when(F.col("date").isNull(), F.col("n"))).alias("bad_dates"),
        total(F.when(usable, F.col("n"))).alias("before_folding"), F.count_if(usable).alias("after_folding"))


def event_columns(clean: DataFrame) -> DataFrame:
    """Cleaned rows under the names of the stored event table."""
    def optional(name: str) -> Column:
        return F.col(name) if name in clean.columns else F.lit(None).cast("string")

    return clean.select(
        "company", "company_normalized", F.col("date").alias("announcement_date"),
        to_int(optional("total_laid_off")).alias("employees_laid_off"),
        to_number(optional("percentage_laid_off")).try_cast("decimal(5,2)").alias("percentage_laid_off"),
        to_number(optional("funds_raised")).try_cast("decimal(15,2)").alias("funds_raised_usd"),
        optional("stage").alias("stage"), optional("source").alias("source_url"),
    )


def _positive() -> Column:
    return F.col("adj_close").isNotNull() & ~F.isnan("adj_close") & (F.col("adj_close") > 0)


def _price(name: str) -> Column:
    number = F.col(name).try_cast("double")
    return F.when(~F.isnan(number), number).try_cast("decimal(12,4)")


def normalise_prices(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Feed rows with a usable adjusted close, keyed by company and trading date."""
    listed = companies.where("ticker_symbol is not null").select("company_id", F.col("ticker_symbol").alias("ticker"))
    return raw.where(_positive()).join(listed, "ticker").select(
        "company_id", F.to_date("ts").alias("trade_date"), _price("open").alias("open_price"),
        _price("close").alias("close_price"), _price("adj_close").alias("adj_close"),
        F.col("volume").try_cast("bigint").alias("volume"))


def price_feed_counts(raw: DataFrame) -> DataFrame:
    """``attempted, skipped_invalid`` of a feed."""
    ok = F.coalesce(_positive(), F.lit(False))
    return raw.agg(F.count_if(ok).alias("attempted"), F.count_if(~ok).alias("skipped_invalid"))


def normalise_index(raw: DataFrame, symbol: str = MARKET_SYMBOL) -> DataFrame:
    """The benchmark feed stamped with its symbol."""
    return raw.where(_positive()).select(
        F.to_date("ts").alias("trade_date"), F.lit(symbol).alias("index_symbol"), _price("adj_close").alias("adj_close"),
        F.col("volume").try_cast("bigint").alias("volume"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Abort early when a feed that everything depends on is empty."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
