"""Registered queries: sources, cleaning, merging, integrity and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import cleaning as cl
from tidemark.operators import constraints as con
from tidemark.operators import dedupe as dd
from tidemark.operators import eventstudy as es
from tidemark.operators import features as ft
from tidemark.operators import merge as mg
from tidemark.operators import reporting as rep
from tidemark.operators.positions import with_position
from tidemark.plans import ingest as ing
from tidemark.plans import study as st
from tidemark.plans import warehouse as wh
from tidemark.plans.checks import statement
from tidemark.plans.queries_study import ranked_pct, stored_windows, wide
from tidemark.plans.registry import query
from tidemark.session import scratch_path, settled
from tidemark.sources import readers as rd
from tidemark.sources import schemas
from tidemark.sources import writers as wr


# ---- raw announcements as text, derived from the warehouse tables

_HEADER = {"company": "Company", "date": " Date ", "total_laid_off": "Total Laid Off",
           "percentage_laid_off": "Percentage Laid Off", "funds_raised": "Funds Raised", "industry": "Industry",
           "location": "Location", "country": "Country", "stage": "Stage", "source": "Source"}


# How the text of a date is spelled, by the remainder of the order's key: a pattern here and in SQL.
_SPELLINGS = (
    ("M/d/yyyy", "%-m/%-d/%Y"), ("yyyy-M-d", "%Y-%-m-%-d"), ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT00:00:00"),
    ("yyyy-MM-dd HH:mm:ss.SSS", "%Y-%m-%d 00:00:00.000"), ("yyyy-MM-dd HH:mm", "%Y-%m-%d 00:00"), ("MMM d, yyyy", "%b %-d, %Y"),
    ("d MMMM yyyy", "%-d %B %Y"), ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT00:00:00Z"), ("yyyy/MM/dd", "%Y/%m/%d"), ("MM/dd/yyyy", "%m/%d/%Y"),
    ("yyyy-MM-dd", "%Y-%m-%d"),
)
# Spaces, a tab and a no-break space.
_SQL_PAD = "' ' || chr(9) || chr(160)"


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Untidy text rows: padded and upper-cased names, dates in many spellings, N/A, percent signs, quotes, line breaks."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    whole = F.floor("o_totalprice")
    spelled = F.date_format("o_orderdate", "yyyy-MM-dd")
    for k, (pattern, _) in enumerate(_SPELLINGS):
        spelled = F.when(F.col("o_orderkey") % len(_SPELLINGS) == k, F.date_format("o_orderdate", pattern)).otherwise(spelled)
    year = F.year("o_orderdate").cast("string")
    orders = wh.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority",
                                                      "o_orderdate", "o_totalprice")
    listed = wh.announcements(spark, folder).select("event_id", "company_id").join(
        wh.companies(spark, folder).select("company_id", "company_name", "industry"), "company_id")
    # rows are few bytes for the work that spelling and parsing them is: put together by size, all would be in one task
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return orders.join(listed, F.col("o_orderkey") == F.col("event_id")).repartition(tasks, "o_orderkey").select(
        F.when(status == "F", F.concat(F.lit(" \t"), "company_name", F.lit("\u00a0 ")))
        .when(status == "O", F.upper("company_name")).otherwise(F.col("company_name")).alias(_HEADER["company"]),
        F.when((status == "P") & (priority == "5-LOW"), "to be announced")
        .otherwise(spelled).alias(_HEADER["date"]),
        F.when(status == "P", "N/A\t").otherwise(F.floor(F.col("o_totalprice") / 100).cast("string"))
        .alias(_HEADER["total_laid_off"]),
        F.when(priority == "2-HIGH", " nan ").when(status == "F", F.concat((whole % 100).cast("string"), F.lit("%")))
        .otherwise((whole % 100 / 100.0).cast("string")).alias(_HEADER["percentage_laid_off"]),
        F.when(priority == "3-MEDIUM", "undisclosed").when(status == "P", F.concat((whole * 3).cast("string"), F.lit("d")))
        .otherwise((whole * 3).cast("string"))
        .alias(_HEADER["funds_raised"]),
        F.coalesce("industry", F.lit(" ")).alias(_HEADER["industry"]),
        F.when(status == "O", "N/A").when(priority == "2-HIGH", F.concat(F.lit('Old "City", '), year))
        .when(priority == "5-LOW", F.concat(F.lit("City\n"), year)).otherwise(F.concat(F.lit(" City "), year))
        .alias(_HEADER["location"]),
        F.when(status == "P", "nan").otherwise("Somewhere").alias(_HEADER["country"]),
        F.when(priority == "4-NOT SPECIFIED", "").otherwise(F.concat(F.lit(" "), priority)).alias(_HEADER["stage"]),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias(_HEADER["source"]),
    )


RAW = {
    "raw_text": f"""
        SELECT CASE o_orderstatus WHEN 'F' THEN ' ' || chr(9) || company_name || chr(160) || ' ' WHEN 'O' THEN upper(company_name)
                    ELSE company_name END AS company,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'to be announced'
                    {" ".join(f"WHEN o_orderkey % {len(_SPELLINGS)} = {k} THEN strftime(o_orderdate, '{f}')" for k, (_, f) in enumerate(_SPELLINGS))}
                    END AS date,
               CASE WHEN o_orderstatus = 'P' THEN 'N/A' || chr(9)
                    ELSE CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) END AS total_laid_off,
               CASE WHEN o_orderpriority = '2-HIGH' THEN ' nan '
                    WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) % 100 || '%'
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 / 1e2 AS VARCHAR) END AS percentage_laid_off,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'undisclosed'
                    WHEN o_orderstatus = 'P' THEN CAST(floor(o_totalprice) AS BIGINT) * 3 || 'd'
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) * 3 AS VARCHAR) END AS funds_raised,
               coalesce(industry, ' ') AS industry,
               CASE WHEN o_orderstatus = 'O' THEN 'N/A' WHEN o_orderpriority = '2-HIGH' THEN 'Old "City", ' || year(o_orderdate)
                    WHEN o_orderpriority = '5-LOW' THEN 'City' || chr(10) || year(o_orderdate)
                    ELSE ' City ' || year(o_orderdate) END AS location,
               CASE WHEN o_orderstatus = 'P' THEN 'nan' ELSE 'Somewhere' END AS country,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE ' ' || o_orderpriority END AS stage,
               'order ' || o_orderkey AS source
        FROM orders JOIN lead_line ON o_orderkey = event_id JOIN companies USING (company_id)""",
    "trimmed": "SELECT " + ", ".join(
        f"CASE WHEN trim({c}, {_SQL_PAD}) NOT IN ('', 'N/A', 'nan') THEN trim({c}, {_SQL_PAD}) END AS {c}" for c in _HEADER)
        + " FROM raw_text",
    "typed": """
        SELECT company,
               CAST(try_strptime(date, ['%Y-%m-%d', '%m/%d/%Y', '%Y/%m/%d', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%d %H:%M:%S.%g',
                    '%Y-%m-%d %H:%M', '%b %d, %Y', '%d %B %Y']) AS DATE) AS date,
               try_cast(total_laid_off AS DOUBLE) AS total_laid_off,
               try_cast(replace(percentage_laid_off, '%', '') AS DOUBLE) AS percentage_laid_off,
               try_cast(funds_raised AS DOUBLE) AS funds_raised, industry, location, country, stage, source
        FROM trimmed""",
    "clean": "SELECT *, lower(company) AS company_normalized FROM typed"
        " WHERE date IS NOT NULL AND company IS NOT NULL"
        " QUALIFY row_number() OVER (PARTITION BY company, date ORDER BY " + " + ".join(
            f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in _HEADER) + " DESC, " + ", ".join(
            f"{c} NULLS FIRST" for c in _HEADER if c not in ("company", "date")) + ") = 1",
    "firsts": "SELECT company_normalized, " + ", ".join(
        f"first({c} ORDER BY filled DESC, date, company) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in ("company", "industry", "location", "country"))
        + " FROM (SELECT *, " + " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in _HEADER)
        + " AS filled FROM clean) GROUP BY company_normalized",
}
_TEXT_SPEC = " ".join(f"{c}:s" for c in _HEADER)


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return rd.clean_events(raw_events(spark, folder))


_READ_SQL = statement("SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in _HEADER) + " FROM raw_text", RAW)


FILE_ROWS = 1 << 19  # of a written CSV, some 70 MB: a task writes a file


def _written_csv(spark: SparkSession, folder: str, file_rows: int | None = None) -> str:
    """Written as Spark has it, or else as two files at least, and as many as keep each at about ``file_rows`` rows."""
    path, raw = scratch_path(spark, "raw-events"), raw_events(spark, folder)
    if file_rows is not None:
        raw = raw.repartition(max(2, -(-wh.table(spark, folder, "orders").count() // file_rows)))
    raw.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query("S1_read_events_csv", _TEXT_SPEC, _READ_SQL)
def _(spark, folder):
    """Written as CSV and read back; padding, quotes and line breaks survive, empty cells are null."""
    return rd.normalise_columns(rd.read_events_csv(spark, _written_csv(spark, folder)))


@query("S1_read_split_csv", _TEXT_SPEC, _READ_SQL)
def _(spark, folder):
    """Written as few CSV files, each of which many tasks read, with line breaks in cells."""
    return rd.normalise_columns(rd.read_split_csv(spark, _written_csv(spark, folder, FILE_ROWS)))


@query("P1_normalise_columns", "company:s num_laid_off:s pct_laid_off:s funds_raised:s", statement(
    "SELECT company, total_laid_off AS num_laid_off, percentage_laid_off AS pct_laid_off, funds_raised FROM raw_text",
    RAW))
def _(spark, folder):
    raw = raw_events(spark, folder).withColumnsRenamed(
        {"Total Laid Off": " # Laid Off", "Percentage Laid Off": "% Laid Off "})
    return rd.normalise_columns(raw)


@query("P2_clean_strings", _TEXT_SPEC, statement("SELECT * FROM trimmed", RAW))
def _(spark, folder):
    return raw_events(spark, folder).transform(rd.normalise_columns).transform(rd.clean_strings)


def _trimmed(spark: SparkSession, folder: str) -> DataFrame:
    return raw_events(spark, folder).transform(rd.normalise_columns).transform(rd.clean_strings)


@query("P3_parse_dates", "source:s date:s bad_dates:l", statement(
    "SELECT source, date, (SELECT count(*) FROM typed WHERE date IS NULL) AS bad_dates FROM typed"
    " WHERE date IS NOT NULL AND company IS NOT NULL", RAW))
def _(spark, folder):
    rows = _trimmed(spark, folder).withColumn("date", cl.parse_date(F.col("date")))
    bad = rows.agg(F.count_if(F.col("date").isNull())).scalar()
    return rows.where("date is not null and company is not null").withColumn("bad_dates", bad)


@query("P4_coerce_numeric", "source:s total_laid_off:f funds_raised:f", statement(
    "SELECT source, total_laid_off, funds_raised FROM typed", RAW))
def _(spark, folder):
    return _trimmed(spark, folder).withColumns(
        {c: cl.to_number(F.col(c)) for c in ("total_laid_off", "funds_raised")})


@query("P5_parse_percent", "source:s percentage_laid_off:f", statement(
    "SELECT source, percentage_laid_off FROM typed", RAW))
def _(spark, folder):
    return _trimmed(spark, folder).withColumn("percentage_laid_off", cl.to_percent(F.col("percentage_laid_off")))


@query("P6_safe_int_float", "source:s as_int:l as_float:f", statement(
    "SELECT source, CAST(trunc(percentage_laid_off) AS BIGINT) AS as_int, funds_raised AS as_float FROM typed", RAW))
def _(spark, folder):
    rows = _trimmed(spark, folder)
    return rows.select(
        "source", cl.to_int(F.replace("percentage_laid_off", F.lit("%"), F.lit(""))).alias("as_int"),
        cl.to_number(F.col("funds_raised")).alias("as_float"))


@query("P7_normalise_key", "company_normalized:s n:l", statement(
    f"SELECT lower(trim(company, {_SQL_PAD})) AS company_normalized, count(*) AS n FROM raw_text GROUP BY 1", RAW))
def _(spark, folder):
    key = cl.normalise_key(F.col("Company")).alias("company_normalized")
    return raw_events(spark, folder).groupBy(key).agg(F.count("*").alias("n"))


@query("P8_year_month", "event_id:l month:s year:l m:l", statement(
    """SELECT event_id, CAST(date_trunc('month', announcement_date) AS DATE) AS month,
              year(announcement_date) AS year, month(announcement_date) AS m FROM study"""))
def _(spark, folder):
    date = F.col("announcement_date")
    return wh.study_events(spark, folder).select(
        "event_id", cl.month_start(date).alias("month"), F.year(date).alias("year"), F.month(date).alias("m"))


@query("P9_log_features", "event_id:l log_employees_laid_off:f log_funds_raised:f", statement(
    "SELECT event_id, log_employees_laid_off, log_funds_raised FROM features"))
def _(spark, folder):
    return ft.size_features(settled(wh.study_events(spark, folder)))


@query("P10_missing_flags", "event_id:l has_pct:l has_funds:l", statement(
    "SELECT event_id, has_pct, has_funds FROM features"))
def _(spark, folder):
    return wh.study_events(spark, folder).select(
        "event_id", cl.missing_flag(F.col("percentage_laid_off")).alias("has_pct"),
        cl.missing_flag(F.col("funds_raised_usd")).alias("has_funds"))


@query("P11_null_default", "event_id:l stage_clean:s", statement("SELECT event_id, stage_clean FROM features"))
def _(spark, folder):
    return wh.study_events(spark, folder).select(
        "event_id", F.coalesce("stage", F.lit(ft.UNKNOWN)).alias("stage_clean"))


# ---- de-duplication and aggregates over raw rows

@query("A1_dedupe_most_complete", "source:s company:s date:s company_normalized:s total_laid_off:f "
       "percentage_laid_off:f funds_raised:f stage:s", statement("SELECT * FROM clean", RAW))
def _(spark, folder):
    return clean(spark, folder)


@query("A2_first_non_null", "company_normalized:s company:s industry:s location:s country:s",
       statement("SELECT * FROM firsts", RAW))
def _(spark, folder):
    return ing.unique_companies(clean(spark, folder))


@query("A3_median_fill", "event_id:l employees:f pct:f", statement(
    """SELECT event_id, coalesce(employees_laid_off, (SELECT median(employees_laid_off) FROM study)) AS employees,
              coalesce(percentage_laid_off, (SELECT median(percentage_laid_off) FROM study)) AS pct FROM study"""))
def _(spark, folder):
    events = settled(wh.study_events(spark, folder))
    return events.transform(ft.fill_median, "employees_laid_off", "employees").transform(
        ft.fill_median, "percentage_laid_off", "pct")


@query("A4_topk_bucket", "event_id:l industry_top15:s", statement(
    "SELECT event_id, industry_top15 FROM features"))
def _(spark, folder):
    return ft.bucket_categories(wh.study_events(spark, folder), "industry", "industry_top15")


# ---- merges

PRICE_MERGE = {
    "stored_prices": "SELECT company_id, trade_date, adj_close FROM prices WHERE year(trade_date) < 1998",
    "batch_prices": """
        SELECT company_id, trade_date, max(cents) / 1e2 AS adj_close FROM shipments GROUP BY company_id, trade_date""",
}


def _batch_prices(spark: SparkSession, folder: str) -> DataFrame:
    """A second feed of the same keys with other values: the dearest line of each week."""
    return wh.table(spark, folder, "lineitem").groupBy(
        F.col("l_suppkey").alias("company_id"), F.date_trunc("week", "l_shipdate").cast("date").alias("trade_date")
    ).agg((F.max(F.round(F.col("l_extendedprice") * 100).cast("long")) / 100.0).alias("adj_close"))


def _stored_prices(spark: SparkSession, folder: str) -> DataFrame:
    return wh.prices(spark, folder).where(F.year("trade_date") < 1998).drop("volume")


@query("S2_insert_only", "company_id:l trade_date:s adj_close:f", statement(
    """SELECT * FROM stored_prices UNION ALL
       SELECT b.* FROM batch_prices b LEFT JOIN stored_prices s USING (company_id, trade_date)
       WHERE s.adj_close IS NULL""", PRICE_MERGE))
def _(spark, folder):
    return mg.insert_only(_stored_prices(spark, folder), _batch_prices(spark, folder), ["company_id", "trade_date"])


@query("O3_union_new", "company_id:l trade_date:s", statement(
    """SELECT company_id, trade_date FROM stored_prices UNION
       SELECT company_id, trade_date FROM batch_prices""", PRICE_MERGE))
def _(spark, folder):
    return mg.insert_only(_stored_prices(spark, folder), _batch_prices(spark, folder), ["company_id", "trade_date"])


EVENT_MERGE = {
    "batch_events": """
        SELECT a.event_id, a.company_id,
               CAST(CASE WHEN o_orderstatus = 'O' THEN announcement_date + 1 ELSE announcement_date END AS DATE)
                   AS announcement_date,
               CAST(floor(o_totalprice / 50) AS INT) AS employees_laid_off,
               CASE WHEN o_orderstatus <> 'F' THEN 0.5 END AS percentage_laid_off,
               'batch ' || o_orderstatus AS stage
        FROM announcements a JOIN orders ON o_orderkey = a.event_id""",
    "folded_events": """
        SELECT company_id, announcement_date,
               first(employees_laid_off ORDER BY event_id) FILTER (WHERE employees_laid_off IS NOT NULL)
                   AS employees_laid_off,
               first(percentage_laid_off ORDER BY event_id) FILTER (WHERE percentage_laid_off IS NOT NULL)
                   AS percentage_laid_off,
               first(stage ORDER BY event_id) FILTER (WHERE stage IS NOT NULL) AS stage
        FROM batch_events GROUP BY company_id, announcement_date""",
}


_UPSERT_SPEC = "company_id:l announcement_date:s employees_laid_off:l percentage_laid_off:f stage:s"
_UPSERT_SQL = statement("""SELECT company_id, announcement_date,
                           coalesce(e.employees_laid_off, i.employees_laid_off) AS employees_laid_off,
                           coalesce(e.percentage_laid_off, i.percentage_laid_off) AS percentage_laid_off,
                           coalesce(e.stage, i.stage) AS stage
                    FROM all_events e FULL OUTER JOIN folded_events i USING (company_id, announcement_date)""",
                        EVENT_MERGE)
_UPSERT_KEYS, _UPSERT_COLUMNS = ["company_id", "announcement_date"], ["employees_laid_off", "percentage_laid_off", "stage"]


def _event_batch(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored events, and a later batch of which some rows are a day off."""
    keys, columns = _UPSERT_KEYS, _UPSERT_COLUMNS
    orders = wh.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"), "o_orderstatus", "o_totalprice")
    status = F.col("o_orderstatus")
    batch = wh.announcements(spark, folder).select("event_id", *keys).join(orders, "event_id").select(
        "event_id", "company_id",
        F.when(status == "O", F.date_add("announcement_date", 1)).otherwise(F.col("announcement_date"))
        .alias("announcement_date"),
        F.floor(F.col("o_totalprice") / 50).cast("int").alias("employees_laid_off"),
        F.when(status != "F", 0.5).alias("percentage_laid_off"),
        F.concat(F.lit("batch "), status).alias("stage"))
    stored = wh.events(spark, folder).select(*keys, *columns)
    return stored, batch


@query("S3_upsert_fill_nulls", _UPSERT_SPEC, _UPSERT_SQL)
def _(spark, folder):
    return mg.upsert_fill_nulls(*_event_batch(spark, folder), _UPSERT_KEYS, _UPSERT_COLUMNS, [F.col("event_id")])


@query("S3_upsert_parts", _UPSERT_SPEC, _UPSERT_SQL)
def _(spark, folder):
    """The same load into a table laid out by year: once for each half of the batch, which touch different years."""
    path, schema = scratch_path(spark, "events-by-year"), "company_id long, announcement_date date, employees_laid_off int, percentage_laid_off double, stage string, year int"
    stored, batch = (df.withColumn("year", F.year("announcement_date")) for df in _event_batch(spark, folder))
    wr.replace_table(stored, path, ["year"])
    batch = settled(batch)
    for odd in (0, 1):
        wr.upsert_parts(spark, path, schema, batch.where(F.col("year") % 2 == odd), _UPSERT_KEYS, _UPSERT_COLUMNS, "year", [F.col("event_id")])
    return wr.read_table(spark, path, schema)


@query("S4_surrogate_key", "company_id:l company_name:s", statement(
    """SELECT company_id + 1 AS company_id, company_name FROM companies
       WHERE ticker_symbol IS NOT NULL UNION ALL
       SELECT (SELECT max(company_id) + 1 FROM companies WHERE ticker_symbol IS NOT NULL)
              + row_number() OVER (ORDER BY company_name), company_name
       FROM (SELECT DISTINCT upper(company_name) AS company_name FROM companies)"""))
def _(spark, folder):
    """Listed companies keep their ids; the upper-cased names are new keys."""
    companies = wh.companies(spark, folder)
    stored = companies.where("ticker_symbol is not null").select(
        (F.col("company_id") + 1).alias("company_id"), "company_name")
    incoming = stored.select("company_name").unionByName(
        companies.select(F.upper("company_name").alias("company_name")))
    return mg.assign_ids(stored, incoming, ["company_name"], "company_id")


@query("S5_key_lookup", "source:s company_id:l", statement(
    f"""SELECT r.source, c.company_id FROM raw_text r
       LEFT JOIN (SELECT * FROM companies WHERE ticker_symbol IS NOT NULL) c
         ON lower(trim(r.company, {_SQL_PAD})) = lower(trim(c.company_name, {_SQL_PAD}))""", RAW))
def _(spark, folder):
    raw = raw_events(spark, folder).transform(rd.normalise_columns)
    return mg.lookup_key(raw, "company", wh.companies(spark, folder).where("ticker_symbol is not null"),
                         "company_name", "company_id")


FEED = {
    "feed": """
        SELECT l_suppkey AS company_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS trade_date,
               CASE WHEN max(l_tax) = 0 THEN 0
                    ELSE floor(CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS DOUBLE)
                         / CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END) AS DOUBLE)
                         * 100 + 0.5) / 1e4 END AS adj_close,
               CASE WHEN sum(l_quantity) >= 10 THEN max(CAST(round(l_extendedprice * 100) AS BIGINT)) / 1e2 END AS "open",
               CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM lineitem GROUP BY ALL""",
}


def price_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A raw feed: returned shipments carry no price, untaxed weeks report zero."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    kept = F.col("l_returnflag") != "R"
    sums = wh.table(spark, folder, "lineitem").groupBy(
        F.col("l_suppkey"), F.date_trunc("week", "l_shipdate").cast("date").alias("day")
    ).agg(F.max("l_tax").alias("tax"), F.sum(F.when(kept, cents)).alias("cents"),
          F.sum(F.when(kept, F.col("l_quantity").cast("long"))).alias("units"), F.max(cents).alias("top"),
          F.sum(F.col("l_quantity").cast("long")).alias("volume"))
    return sums.select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("ticker"),
        (F.col("day").cast("timestamp") + F.expr("interval 16 hours")).alias("ts"),
        F.when(F.col("volume") >= 10, F.col("top") / 100.0).alias("open"),
        F.lit(None).cast("double").alias("close"),
        F.when(F.col("tax") == 0, 0.0).otherwise(
            F.floor(F.try_divide("cents", "units") * 100 + 0.5) / F.lit(10000.0)).alias("adj_close"),
        "volume")


@query("S6_ingest_prices", "company_id:l trade_date:s open_price:f close_price:f adj_close:f volume:l", statement(
    """SELECT company_id, trade_date, "open" AS open_price, NULL AS close_price, adj_close, volume
       FROM feed JOIN companies USING (company_id) WHERE ticker_symbol IS NOT NULL AND adj_close > 0""", FEED))
def _(spark, folder):
    return rd.normalise_prices(price_feed(spark, folder), wh.companies(spark, folder))


@query("S6_feed_counts", "attempted:l skipped_invalid:l", statement(
    """SELECT count(*) FILTER (WHERE adj_close > 0) AS attempted,
              count(*) FILTER (WHERE adj_close IS NULL OR adj_close <= 0) AS skipped_invalid FROM feed""", FEED))
def _(spark, folder):
    return rd.price_feed_counts(price_feed(spark, folder))


@query("S7_ingest_market_index", "trade_date:s index_symbol:s adj_close:f volume:l", statement(
    "SELECT trade_date, '^GSPC' AS index_symbol, adj_close, volume FROM market"))
def _(spark, folder):
    feed = wh.market(spark, folder).select(F.col("trade_date").cast("timestamp").alias("ts"), "adj_close", "volume")
    return rd.normalise_index(rd.require_rows(feed, "the benchmark feed"))


_COVERAGE = """SELECT c.company_id, c.ticker_symbol, count(f.company_id) AS days, count(*) FILTER (WHERE f.adj_close > 0) AS attempted,
              count(f.company_id) - count(*) FILTER (WHERE f.adj_close > 0) AS skipped_invalid,
              CASE WHEN count(f.company_id) > 0 THEN 'ok' ELSE 'empty' END AS status,
              CASE WHEN count(f.company_id) BETWEEN 1 AND 199 THEN 'LOW-COVERAGE' END AS flag
       FROM companies c LEFT JOIN feed f USING (company_id)
       WHERE c.ticker_symbol IS NOT NULL GROUP BY ALL"""


@query("S8_price_coverage", "company_id:l ticker_symbol:s days:l attempted:l skipped_invalid:l status:s flag:s", statement(_COVERAGE, FEED))
def _(spark, folder):
    return rep.price_coverage(wh.companies(spark, folder), price_feed(spark, folder))


@query("S8_coverage_totals", "with_data:l empty:l low_coverage:l attempted:l skipped_invalid:l", statement(
    f"""SELECT count(*) FILTER (WHERE status = 'ok') AS with_data, count(*) FILTER (WHERE status = 'empty') AS empty,
              count(flag) AS low_coverage, sum(attempted) AS attempted, sum(skipped_invalid) AS skipped_invalid
       FROM ({_COVERAGE})""", FEED))
def _(spark, folder):
    return rep.coverage_totals(rep.price_coverage(wh.companies(spark, folder), price_feed(spark, folder)))


@query("A15_cleaning_counters", "raw_rows:l bad_dates:l before_folding:l after_folding:l", statement(
    """SELECT count(*) AS raw_rows, count(*) FILTER (WHERE date IS NULL) AS bad_dates,
              count(*) FILTER (WHERE date IS NOT NULL AND company IS NOT NULL) AS before_folding,
              (SELECT count(*) FROM clean) AS after_folding FROM typed""", RAW))
def _(spark, folder):
    return rd.cleaning_counters(raw_events(spark, folder))


_LOAD = {
    **RAW,
    "landed": """SELECT company, date, percentage_laid_off * 1.5 AS pct, c.company_id FROM clean r
        LEFT JOIN (SELECT lower(company_name) AS name, min(company_id) AS company_id FROM companies
                   WHERE ticker_symbol IS NOT NULL GROUP BY 1) c ON c.name = lower(r.company)""",
}


@query("A15_load_counters", "inserted:l created:l skipped:l failed:l", statement(
    """SELECT count(*) FILTER (WHERE company_id IS NOT NULL AND NOT coalesce(pct > 100, false)) AS inserted,
              (SELECT count(*) FROM (
                   SELECT DISTINCT company_id, date FROM landed WHERE company_id IS NOT NULL AND NOT coalesce(pct > 100, false)
                   EXCEPT SELECT company_id, announcement_date FROM all_events WHERE announcement_date < DATE '1995-01-01')) AS created,
              count(*) FILTER (WHERE company_id IS NULL) AS skipped,
              count(*) FILTER (WHERE company_id IS NOT NULL AND pct > 100) AS failed FROM landed""", _LOAD))
def _(spark, folder):
    """A load of all announcements, some with shares beyond 100 %, into the events before 1995."""
    listed = wh.companies(spark, folder).where("ticker_symbol is not null")
    batch = clean(spark, folder).withColumn("percentage_laid_off", F.col("percentage_laid_off") * 1.5)
    # a table, as a load finds it: it is read for the rows to fill, for their keys and for the largest id
    stored = settled(wh.events(spark, folder).where("announcement_date < date'1995-01-01'").withColumn("source_url", F.lit(None).cast("string")))
    return ing.load_events(stored, listed, batch).counters


@query("S9_load_study_inputs", "kind:s company_id:l date:s value:f", statement(
    """SELECT 'event' AS kind, company_id, announcement_date AS date, event_id AS value FROM study UNION ALL
       SELECT 'price', company_id, trade_date, adj_close FROM prices UNION ALL
       SELECT 'market', NULL, trade_date, adj_close FROM market"""))
def _(spark, folder):
    loaded = st.study_inputs(wh.events(spark, folder), wh.companies(spark, folder),
                             wh.prices(spark, folder), wh.market(spark, folder))
    events = loaded.events.select(F.lit("event").alias("kind"), "company_id",
                                  F.col("announcement_date").alias("date"), F.col("event_id").cast("double").alias("value"))
    prices = loaded.prices.select(F.lit("price"), "company_id", "trade_date", "adj_close")
    market = loaded.market.select(F.lit("market"), F.lit(None).cast("long"), "trade_date", "adj_close")
    return events.union(prices).union(market)


@query("S10_constraint_check", "event_id:l violations:s", statement(
    """SELECT event_id, array_to_string(list_sort(list_filter([
              CASE WHEN employees < 0 THEN 'employees_not_negative' END,
              CASE WHEN pct > 100 OR pct < 0 THEN 'percentage_range' END,
              CASE WHEN rn > 1 THEN 'one_per_day' END,
              CASE WHEN listed IS NULL THEN 'company_known' END], lambda v: v IS NOT NULL)), ',') AS violations
       FROM (SELECT a.event_id, a.employees_laid_off - 1000 AS employees, a.percentage_laid_off * 150 AS pct,
                    row_number() OVER (PARTITION BY a.company_id, a.announcement_date ORDER BY a.event_id) AS rn,
                    c.company_id AS listed
             FROM announcements a LEFT JOIN (SELECT company_id FROM companies WHERE ticker_symbol IS NOT NULL) c
               ON c.company_id = a.company_id)"""))
def _(spark, folder):
    rows = wh.announcements(spark, folder).withColumns({
        "employees_laid_off": F.col("employees_laid_off") - 1000,
        "percentage_laid_off": F.col("percentage_laid_off") * 150})
    listed = wh.companies(spark, folder).where("ticker_symbol is not null")
    flagged = con.flag_violations(
        rows, con.event_checks(), "event_id", {"one_per_day": ["company_id", "announcement_date"]},
        {"company_known": ("company_id", listed, "company_id")})
    return flagged.withColumn("violations", F.array_join("violations", ","))


@query("S10_other_rules", "kind:s rule:s n:l", statement(
    """SELECT * FROM (SELECT 'price' AS kind, 'price_positive' AS rule, count(*) AS n FROM feed WHERE NOT coalesce(adj_close > 0, false) UNION ALL
       SELECT 'price', 'price_company_known', count(*) FROM feed f
       WHERE NOT EXISTS (SELECT 1 FROM companies c WHERE c.company_id = f.company_id AND ticker_symbol IS NOT NULL) UNION ALL
       SELECT 'window', 'window_order', count(*) FROM lineitem WHERE l_linenumber - 4 >= CAST(l_quantity AS INT) % 5 - 2 UNION ALL
       SELECT 'match', 'match_complete', count(*) FROM supplier WHERE (s_suppkey % 5 = 0) <> (s_suppkey % 7 = 0) UNION ALL
       SELECT 'match', 'match_method_known', count(*) FROM supplier WHERE s_suppkey % 5 = 1 UNION ALL
       SELECT 'match', 'name_unique', count(*) - count(DISTINCT s_nationkey) FROM supplier UNION ALL
       SELECT 'match', 'ticker_unique', count(t) - count(DISTINCT t) FROM (SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey // 2 END AS t FROM supplier) UNION ALL
       SELECT 'price_day', 'price_day_unique', count(*) - count(DISTINCT (l_suppkey, CAST(l_shipdate AS DATE))) FROM lineitem UNION ALL
       SELECT 'stored_window', 'window_unique', count(*) - count(DISTINCT (l_orderkey, l_linenumber % 3, l_quantity)) FROM lineitem UNION ALL
       SELECT 'market', 'market_price_positive', count(*) FROM market WHERE NOT coalesce(adj_close - 1350 > 0, false)) WHERE n > 0""", FEED))
def _(spark, folder):
    """The rules of prices, windows, matches and the index, each over rows that break some of them."""
    def broken(kind: str, flagged: DataFrame) -> DataFrame:
        return flagged.select(F.lit(kind).alias("kind"), F.explode("violations").alias("rule"))

    companies = wh.companies(spark, folder).where("ticker_symbol is not null")
    feed = price_feed(spark, folder).withColumn("company_id", F.substring("ticker", 2, 20).cast("long"))
    windows = wh.table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") - 4).alias("window_start_offset"), (F.col("l_quantity").cast("int") % 5 - 2).alias("window_end_offset"))
    key = F.col("s_suppkey")
    matches = wh.table(spark, folder, "supplier").select(
        key.alias("company_id"), F.col("s_nationkey").alias("company_name"),
        F.when(key % 5 == 0, F.lit(None).cast("string")).when(key % 5 == 1, "guess").otherwise("manual").alias("match_method"),
        F.when(key % 7 != 0, 100.0).alias("match_confidence"),
        F.when(F.col("s_acctbal") >= 0, F.floor(key / 2)).alias("ticker_symbol"))
    lines = wh.table(spark, folder, "lineitem")
    days = con.with_row_id(lines.select(F.col("l_suppkey").alias("company_id"), F.col("l_shipdate").cast("date").alias("trade_date")))
    stored = con.with_row_id(lines.select(F.col("l_orderkey").alias("event_id"), (F.col("l_linenumber") % 3).alias("window_start_offset"),
                                          F.col("l_quantity").alias("window_end_offset")))
    index = wh.market(spark, folder).withColumn("adj_close", F.col("adj_close") - 1350)
    found = (
        broken("price", con.flag_violations(feed, con.price_checks(), references={"price_company_known": ("company_id", companies, "company_id")}))
        .unionByName(broken("window", con.flag_violations(windows, con.window_checks())))
        .unionByName(broken("match", con.flag_violations(matches, con.match_checks(), "company_id", con.COMPANY_KEYS)))
        .unionByName(broken("price_day", con.flag_violations(days, {}, "row_id", con.PRICE_KEYS)))
        .unionByName(broken("stored_window", con.flag_violations(stored, {}, "row_id", con.WINDOW_KEYS)))
        .unionByName(broken("market", con.flag_violations(index, con.market_checks()))))
    return found.groupBy("kind", "rule").agg(F.count("*").alias("n"))


@query("S11_cascade_delete", "kind:s company_id:l n:l", statement(
    """SELECT 'company' AS kind, company_id, count(*) AS n FROM companies
       WHERE ticker_symbol IS NOT NULL GROUP BY company_id UNION ALL
       SELECT 'event', company_id, count(*) FROM study GROUP BY company_id UNION ALL
       SELECT 'window', company_id, 2 * count(*) FROM study GROUP BY company_id UNION ALL
       SELECT 'price', company_id, count(*) FROM prices JOIN companies USING (company_id)
       WHERE ticker_symbol IS NOT NULL GROUP BY company_id"""))
def _(spark, folder):
    companies, events = wh.companies(spark, folder), wh.events(spark, folder)
    windows = events.select("event_id", "company_id", F.explode(F.array(F.lit(-1), F.lit(0))).alias("window_start_offset"))
    kept, children = mg.cascade_delete(
        companies, companies.where("ticker_symbol is null"), "company_id", {"event": events, "price": wh.prices(spark, folder)},
        {"window": ("event", "event_id", windows)})

    def sizes(kind: str, df: DataFrame) -> DataFrame:
        return df.groupBy("company_id").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))

    out = sizes("company", kept)
    for kind, df in children.items():
        out = out.unionByName(sizes(kind, df))
    return out


@query("S12_recompute_replace", "event_id:l window_start_offset:l window_end_offset:l car:f scar:f", statement(
    "SELECT * FROM stored"))
def _(spark, folder):
    """Results of another window set are stored first; the recompute leaves none of them behind."""
    path = scratch_path(spark, "event-windows")
    first = [(-2, 2)]
    wr.replace_table(es.long_results(wide(spark, folder, first), first, stored=True), path)
    wr.replace_table(es.long_results(wide(spark, folder), stored=True), path)
    return wr.read_table(spark, path, schemas.EVENT_WINDOWS)


@query("S13_write_results", "event_id:l car_m5_p5:f scar_m5_p5:f", statement(
    "SELECT event_id, car AS car_m5_p5, scar AS scar_m5_p5 FROM headline"))
def _(spark, folder):
    path = scratch_path(spark, "study")
    wr.write_study(path, per_event=wide(spark, folder).drop("company_id", "t0", "sigma"))
    return rd.read_events_csv(spark, f"{path}/per_event_cars")


# ---- reports over the stored windows

def _stored_pct(spark: SparkSession, folder: str) -> DataFrame:
    stored = rep.in_window(stored_windows(spark, folder, [(-5, 5)]), (-5, 5))
    return stored.select("event_id", (F.col("car").cast("double") * 100).alias("v")).where("v is not null")


_PCT = {"pct": """SELECT event_id, CAST(car AS DOUBLE) * 100 AS v FROM stored
                  WHERE window_start_offset = -5 AND window_end_offset = 5 AND car IS NOT NULL"""}


def monthly(spark: SparkSession, folder: str) -> DataFrame:
    stored = es.long_results(wide(spark, folder), stored=True)
    return rep.monthly_activity(wh.study_events(spark, folder), stored, (-5, 5))


@query("A5_monthly_agg", "month:s n_events:l mean_car:x", statement("SELECT * FROM monthly"))
def _(spark, folder):
    return monthly(spark, folder)


def _matrix_sql(value: str, empty: str) -> str:
    cells = ", ".join(f"coalesce(max({value}) FILTER (WHERE month(month) = {m}), {empty}) AS m{m}"
                      for m in range(1, 13))
    return f"SELECT year(month) AS year, {cells} FROM monthly GROUP BY 1"


@query("A6_pivot_counts", "year:l " + " ".join(f"m{m}:l" for m in range(1, 13)),
       statement(_matrix_sql("n_events", "0")))
def _(spark, folder):
    return rep.year_month_matrix(monthly(spark, folder), F.col("n_events"), 0)


@query("A6_pivot_year_month", "year:l vmax:x " + " ".join(f"m{m}:x" for m in range(1, 13)), statement(
    "SELECT *, (SELECT max(abs(mean_car * 100)) FROM monthly) AS vmax FROM ("
    + _matrix_sql("mean_car * 100", "NULL") + ")"))
def _(spark, folder):
    pct = settled(monthly(spark, folder)).withColumn("pct", F.col("mean_car") * 100)
    return rep.year_month_matrix(pct, F.col("pct")).withColumn("vmax", rep.symmetric_limit(pct, "pct").scalar())


@query("A8_histogram", "bin:l lo:f hi:f n:l", statement(
    """SELECT g.bin, lo + g.bin * w AS lo, lo + (g.bin + 1) * w AS hi, count(v) AS n
       FROM range(40) AS g(bin) CROSS JOIN (SELECT min(v) AS lo, (max(v) - min(v)) / 40 AS w FROM pct) s
       LEFT JOIN pct ON least(floor((v - lo) / w), 39) = g.bin GROUP BY ALL""", _PCT))
def _(spark, folder):
    return rep.histogram(_stored_pct(spark, folder), "v")


@query("A8_clip_range", "p:f quantile:f", statement(
    "SELECT p, quantile FROM (SELECT unnest([0.01, 0.99]) AS p, unnest(quantile_cont(v, [0.01, 0.99])) AS quantile FROM pct)",
    _PCT))
def _(spark, folder):
    return rep.clip_range(_stored_pct(spark, folder), "v")


@query("A9_kde", "i:l x:f density:f", statement(
    """SELECT i, x, sum(exp(-0.5 * pow((x - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
       FROM (SELECT g.i, lo + g.i * (hi - lo) / 199 AS x, h, n FROM range(200) AS g(i),
             (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h FROM pct)),
            pct GROUP BY i, x""", _PCT))
def _(spark, folder):
    return rep.kernel_density(_stored_pct(spark, folder), "v")


_BOX_SQL = """
    SELECT grp, q1, median, q3, count(*) AS n, min(v) FILTER (WHERE v BETWEEN lo AND hi) AS whisker_lo,
           max(v) FILTER (WHERE v BETWEEN lo AND hi) AS whisker_hi,
           count(*) FILTER (WHERE NOT v BETWEEN lo AND hi) AS outliers
    FROM (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
          FROM ranked JOIN (SELECT grp, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                                   quantile_cont(v, 0.75) AS q3 FROM ranked GROUP BY grp) USING (grp))
    GROUP BY ALL"""


@query("A10_box_stats", "grp:s q1:f median:f q3:f n:l whisker_lo:f whisker_hi:f outliers:l", statement(
    _BOX_SQL, {**_PCT, "ranked": """SELECT CASE WHEN h.event_rank = 1 THEN 'First-time' ELSE 'Repeat' END AS grp, v
                                    FROM pct JOIN history h USING (event_id)"""}))
def _(spark, folder):
    return rep.box_stats(settled(ranked_pct(spark, folder)), "car_pct", "grp")


@query("A13_impact_coverage", "status:s companies:l total_laid_off:l", statement(
    """SELECT CASE WHEN ticker_symbol IS NOT NULL THEN 'matched' ELSE 'missed' END AS status,
              count(DISTINCT c.company_id) AS companies, sum(e.employees_laid_off) AS total_laid_off
       FROM companies c LEFT JOIN all_events e USING (company_id) GROUP BY 1"""))
def _(spark, folder):
    return rep.impact_coverage(wh.companies(spark, folder), wh.events(spark, folder))


@query("O1_order_by", "position:l event_id:l company_id:l announcement_date:s", statement(
    """SELECT row_number() OVER (ORDER BY company_id, announcement_date, event_id) - 1 AS position,
              event_id, company_id, announcement_date FROM study"""))
def _(spark, folder):
    """The order itself is what is checked, so each row carries its place."""
    return with_position(wh.study_events(spark, folder), ["company_id", "announcement_date", "event_id"])


@query("O2_top_k", "industry:s n:l", statement("SELECT * FROM top_industries"))
def _(spark, folder):
    return ft.top_categories(wh.study_events(spark, folder), "industry")
