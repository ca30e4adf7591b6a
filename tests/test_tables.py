"""Cleaning, merging, integrity, sinks and matching."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cleaning as cl
from tidemark.functions.similarity import with_token_set_ratio
from tidemark.operators import constraints as con
from tidemark.operators import entity as en
from tidemark.operators import merge as mg
from tidemark.operators import reporting as rep
from tidemark.plans import ingest as ing
from tidemark.plans import matching
from tidemark.sources import readers as rd
from tidemark.sources import schemas
from tidemark.sources import writers as wr
from tidemark.streaming.ingest import stream_prices

D = dt.date


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("text, number", [("N/A", None), ("12", 12.0), (" 1e3 ", 1000.0), ("NaN", None), ("x", None)])
def test_numbers(spark, text, number):
    assert one(spark, text, cl.to_number) == number


@pytest.mark.parametrize("text, number", [("12%", 12.0), ("0.13", 0.13), ("%", None)])
def test_percent(spark, text, number):
    assert one(spark, text, cl.to_percent) == number
    if number is not None:
        assert one(spark, text, lambda c: cl.to_percent(c, 0.01)) == pytest.approx(number / 100)


@pytest.mark.parametrize("text, number", [("3.9", 3), ("-3.9", -3), ("1e12", None), ("N/A", None)])
def test_int(spark, text, number):
    assert one(spark, text, cl.to_int) == number


@pytest.mark.parametrize("text, number", [("12", 12.0), (" 1e3\t", 1000.0), ("+.5", 0.5), ("5.", 5.0), ("12d", None), ("12f", None), ("1,000", None),
                                          ("NaN", None), ("-inf", float("-inf")), ("0x10", None), ("", None), ("1_0", None)])
def test_number(spark, text, number):
    assert one(spark, text, cl.to_number) == number


def test_quoted_cells_survive(spark, tmp_path):
    from tidemark.sources.readers import read_events_csv

    (tmp_path / "a.csv").write_text('Company,Date,Note\n"Acme ""X"", Inc.",2023-03-06,B\n"two\nlines",2023-03-07," pad "\nlast,2023-03-08,\n')
    rows = read_events_csv(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [('Acme "X", Inc.', "2023-03-06", "B"), ("two\nlines", "2023-03-07", " pad "), ("last", "2023-03-08", None)]


@pytest.mark.parametrize("text, clean", [("  a ", "a"), ("Meta\t", "Meta"), ("\u00a0N/A\t", None), ("\u2003a b\n", "a b"), ("", None), ("  ", None), ("N/A", None), (" nan ", None),
                                         ("null", None), (" null ", "null")])
def test_text(spark, text, clean):
    assert one(spark, text, cl.clean_text) == clean


@pytest.mark.parametrize("text, day", [
    *[(t, D(2022, 11, 9)) for t in (
        "2022-11-09", "11/09/2022", "2022-11-09 00:00:00", "11/9/2022", "2022/11/9", "2022-11-9", "2022-11-09T00:00:00", "2022-11-09T10:00:00Z",
        "2022-11-09 00:00:00.000", "2022-11-09 10:00", "2022-11-09T10:00:00.5+02:00", "Nov 9, 2022", "9 November 2022", "november 9 2022",
        "Nov. 9th, 2022", "09-Nov-2022", "20221109", "11/9/22", "11-09-2022", "11/9/2022 3:45 PM", " 2022-11-09\t")],
    ("9/1/1999", D(1999, 9, 1)), ("9/1/99", D(1999, 9, 1)), ("Sept 1, 2020", D(2020, 9, 1)), ("May 5, 2021", D(2021, 5, 5)),
    ("soon", None), ("2022-13-01", None), ("2022-02-30", None), ("Novel 9, 2022", None), ("2022-11-09 later", None), ("13/40/2022", None), ("", None)])
def test_dates(spark, text, day):
    assert one(spark, text, cl.parse_date) == day


def test_header_names():
    assert [cl.snake_case(c) for c in (" Total Laid Off", "# Laid Off", "%")] == ["total_laid_off", "num_laid_off", "pct"]


RAW = [
    # company, date, total, pct, funds, industry, stage
    (" Meta ", "2022-11-09", "11000", "13%", "26000", "Social", "Post-IPO"),
    ("Meta", "2022-11-09", "N/A", "", "", None, "Post-IPO"),       # the same day, less complete
    ("META", "2023-03-14", "10000", None, None, None, None),       # another spelling
    ("Beta", "unknown", "5", None, None, None, None),              # no date
    (None, "2023-01-01", "5", None, None, None, None),             # no company
    ("Gamma", "2023-01-01", "-5", "0.2", "1", None, "Seed"),       # violates a rule
]
RAW_SCHEMA = ("Company string, Date string, `Total Laid Off` string, `Percentage Laid Off` string, "
              "`Funds Raised` string, Industry string, Stage string")


@pytest.fixture()
def clean(spark):
    return rd.clean_events(spark.createDataFrame(RAW, RAW_SCHEMA)).cache()


def test_clean_keeps_the_most_complete_row(clean):
    rows = {(r.company, r.date): r for r in clean.collect()}
    assert set(rows) == {("Meta", D(2022, 11, 9)), ("META", D(2023, 3, 14)), ("Gamma", D(2023, 1, 1))}
    best = rows[("Meta", D(2022, 11, 9))]
    assert (best.total_laid_off, best.percentage_laid_off, best.company_normalized) == (11000.0, 13.0, "meta")


def test_ingest_twice_changes_nothing(spark, clean):
    companies = spark.createDataFrame([(7, "Old")], "company_id long, company_name string").select(
        *[F.col(c) if c in ("company_id", "company_name") else F.lit(None).cast(t).alias(c)
          for c, t in (x.strip().split(" ") for x in schemas.COMPANIES.split(", "))])
    events = spark.createDataFrame([], schemas.EVENTS)
    for created in (2, 0):
        companies = ing.load_companies(companies, clean).cache()
        events, rejected, unknown, counters = ing.load_events(events, companies, clean)
        events = events.cache()
        assert {(r.company_id, r.company_name) for r in companies.collect()} == {(7, "Old"), (8, "Gamma"), (9, "Meta")}
        got = {(r.event_id, r.company_id, r.announcement_date, r.employees_laid_off) for r in events.collect()}
        assert got == {(1, 9, D(2022, 11, 9), 11000), (2, 9, D(2023, 3, 14), 10000)}
        assert [r.violations for r in rejected.collect()] == [["employees_not_negative"]]
        assert unknown.count() == 0
        assert counters.first().asDict() == {"inserted": 2, "created": created, "skipped": 0, "failed": 1}


def test_upsert_fills_but_never_overwrites(spark):
    schema = "k int, pct double, stage string"
    stored = spark.createDataFrame([(1, None, "A"), (2, 0.5, None)], schema)
    batch = spark.createDataFrame([(1, 0.1, "B"), (1, 0.9, "C"), (2, 0.7, "D"), (3, None, "E"), (3, 0.3, None)], schema)
    got = mg.upsert_fill_nulls(stored, batch, ["k"], ["pct", "stage"], [F.col("pct")])
    expected = [(1, 0.1, "A"), (2, 0.5, "D"), (3, 0.3, "E")]
    assert sorted(tuple(r) for r in got.collect()) == expected
    again = mg.upsert_fill_nulls(got, batch, ["k"], ["pct", "stage"], [F.col("pct")])
    assert sorted(tuple(r) for r in again.collect()) == expected


def test_insert_only_keeps_existing(spark):
    stored = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    once = mg.insert_only(stored, batch, ["k"])
    assert sorted(tuple(r) for r in once.collect()) == [(1, "old"), (2, "a")]
    assert mg.new_rows(once, batch, ["k"]).count() == 0


def test_ids_survive(spark):
    stored = spark.createDataFrame([(5, "m"), (9, "c")], "id long, name string")
    got = mg.assign_ids(stored, spark.createDataFrame([("z",), ("a",), ("m",), ("a",)], "name string"), ["name"], "id")
    assert sorted(tuple(r) for r in got.collect()) == [(5, "m"), (9, "c"), (10, "a"), (11, "z")]


def test_lookup_and_cascade(spark):
    dim = spark.createDataFrame([(1, " Meta ")], "company_id long, company_name string")
    rows = spark.createDataFrame([("META",), ("nobody",)], "company string")
    got = {r.company: r.company_id for r in mg.lookup_key(rows, "company", dim, "company_name", "company_id").collect()}
    assert got == {"META": 1, "nobody": None}
    child = spark.createDataFrame([(1,), (1,), (2,)], "company_id long")
    left, children = mg.cascade_delete(dim, dim, "company_id", {"events": child})
    assert left.count() == 0 and children["events"].count() == 1
    events = spark.createDataFrame([(10, 1), (11, 2)], "event_id long, company_id long")
    windows = spark.createDataFrame([(10, -1), (10, 0), (11, -1)], "event_id long, low int")
    _, children = mg.cascade_delete(dim, dim, "company_id", {"events": events}, {"windows": ("events", "event_id", windows)})
    assert [tuple(r) for r in children["windows"].collect()] == [(11, -1)]


def test_constraints(spark):
    rows = [(1, 1, D(2024, 1, 1), 5, 50.0), (2, 1, D(2024, 1, 1), None, None), (3, 2, D(2024, 1, 1), -1, 101.0),
            (4, 9, None, 0, 0.0)]
    df = spark.createDataFrame(rows, "event_id long, company_id long, announcement_date date, "
                                     "employees_laid_off int, percentage_laid_off double")
    parents = spark.createDataFrame([(1,), (2,)], "company_id long")
    flagged = con.flag_violations(df, con.event_checks(), "event_id", {"one_per_day": ["company_id", "announcement_date"]},
                                  {"company_known": ("company_id", parents, "company_id")})
    valid, rejected = con.split_valid(flagged)
    assert [r.event_id for r in valid.collect()] == [1]
    assert {r.event_id: r.violations for r in rejected.collect()} == {
        2: ["one_per_day"], 3: ["employees_not_negative", "percentage_range"], 4: ["company_known", "date_present"]}


def test_other_rules(spark):
    def broken(schema, rows, checks):
        df = spark.createDataFrame(rows, "id long, " + schema)
        return {r.id: r.violations for r in con.flag_violations(df, checks, "id").collect()}

    assert broken("adj_close double", [(1, 1.0), (2, 0.0), (3, None)], con.price_checks()) == {
        1: [], 2: ["price_positive"], 3: ["price_positive"]}
    assert broken("window_start_offset int, window_end_offset int", [(1, -1, 1), (2, 3, 3)], con.window_checks()) == {
        1: [], 2: ["window_order"]}
    assert broken("match_method string, match_confidence double",
                  [(1, None, None), (2, "manual", None), (3, "guess", 1.0), (4, "fuzzy", 1.0)], con.match_checks()) == {
        1: [], 2: ["match_complete"], 3: ["match_method_known"], 4: []}


def test_price_feeds(spark):
    ts = dt.datetime(2024, 1, 2, 16)
    feed = spark.createDataFrame(
        [("A", ts, 1.0, None, 10.00005, 5), ("A", ts, 1.0, 1.0, None, 5), ("A", ts, 1.0, 1.0, -1.0, 5),
         ("A", ts, 1.0, 1.0, float("nan"), 5), ("Z", ts, 1.0, 1.0, 2.0, None)], schemas.RAW_PRICES)
    companies = spark.createDataFrame([(1, "A"), (2, None)], "company_id long, ticker_symbol string")
    rows = rd.normalise_prices(feed, companies).collect()
    assert [tuple(r) for r in rows] == [(1, D(2024, 1, 2), Decimal("1.0000"), None, Decimal("10.0001"), 5)]
    assert tuple(rd.price_feed_counts(feed).first()) == (2, 3)
    index = rd.normalise_index(feed.select("ts", "adj_close", "volume"))
    assert {r.index_symbol for r in index.collect()} == {"^GSPC"} and index.count() == 2
    with pytest.raises(ValueError):
        rd.require_rows(feed.limit(0), "feed")


def test_coverage_counts_every_delivered_day(spark):
    companies = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, None), (5, "E")], "company_id long, ticker_symbol string")
    days = [("A", 1.0)] * 199 + [("A", float("nan"))] + [("B", 2.0)] * 99 + [("B", None)] + [("E", 0.0)] * 250 + [("Z", 1.0)]
    coverage = rep.price_coverage(companies, spark.createDataFrame(days, "ticker string, adj_close double"))
    got = {r.company_id: tuple(r)[2:] for r in coverage.collect()}
    assert got == {1: (200, 199, 1, "ok", None), 2: (100, 99, 1, "ok", "LOW-COVERAGE"), 3: (0, 0, 0, "empty", None), 5: (250, 0, 250, "ok", None)}
    assert tuple(rep.coverage_totals(coverage).first()) == (3, 1, 1, 298, 252)


def test_missing_csv_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        rd.read_events_csv(spark, str(tmp_path / "nowhere.csv"))


def test_csv_columns_stay_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Company,# Laid Off\nMeta,007\n")
    df = rd.normalise_columns(rd.read_events_csv(spark, str(tmp_path / "a.csv")))
    assert df.columns == ["company", "num_laid_off"] and df.first().num_laid_off == "007"


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "market")
    rows = [(D(2024, 1, 1), "^GSPC", Decimal("1.0000"), 1), (D(2024, 1, 2), "^GSPC", Decimal("2.0000"), 1)]
    df = spark.createDataFrame(rows, schemas.MARKET_INDEX)
    wr.replace_table(df.limit(1), path)
    for _ in range(2):
        wr.append_new(spark, path, schemas.MARKET_INDEX, df, ["trade_date"])
        assert wr.read_table(spark, path, schemas.MARKET_INDEX).count() == 2
    wr.replace_table(df.where("adj_close > 1"), path)
    assert wr.read_table(spark, path, schemas.MARKET_INDEX).count() == 1


def test_streamed_prices_load_once(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "prices", "state"))
    companies = spark.createDataFrame([(1, "A")], "company_id long, ticker_symbol string")
    spark.createDataFrame([], schemas.DAILY_PRICES).write.parquet(table)

    def land(day):
        feed = spark.createDataFrame([("A", dt.datetime(2024, 1, d), 1.0, 1.0, float(d), 1) for d in day],
                                     schemas.RAW_PRICES)
        feed.write.mode("append").parquet(landing)
        stream_prices(spark, landing, companies, table, state).awaitTermination()
        return wr.read_table(spark, table, schemas.DAILY_PRICES).count()

    assert land([1, 2]) == 2
    assert land([2, 3]) == 3  # the overlapping day is not loaded again


# ---- matching

@pytest.mark.parametrize("listed, name, score", [
    ("Meta Platforms, Inc.", "Meta", 100), ("Apple Hospitality REIT, Inc.", "Apple", 100),
    ("Advance Auto Parts", "Apple", 17.3913), ("SolarEdge Technologies, Inc.", "Solar Edge", 36.8421),
    ("Micron Technology", "Mikron Technology", 94.1176), ("Getty Images Holdings", "Getty Photos", 58.8235),
    ("", "x", 0), ("a" * 200 + "b", "a" * 200 + "c", 99.5025),
])
def test_similarity(spark, listed, name, score):
    df = spark.createDataFrame([(listed, name)], "a string, b string")
    got = with_token_set_ratio(df, F.lower("a"), F.lower("b"), "r").first().r
    assert got == pytest.approx(score, abs=1e-4)


@pytest.mark.parametrize("name, symbols", [
    ("International Business Machines", ["INTE", "INT", "IBM"]), ("Meta", ["META", "MET"]), ("hi", ["HI"]),
    ("3M Co", ["M"]), ("  Éa b C ", ["ÉA", "ÉC"]),
])
def test_ticker_guesses(spark, name, symbols):
    df = spark.createDataFrame([(1, name)], "company_id long, company_name string")
    assert [r.symbol for r in en.ticker_guesses(df).orderBy("pos").collect()] == symbols


def test_chain_and_claims(spark):
    names = ["Acme Robots", "Aurora Innovation", "Aurora Solar", "Initech", "Kodak", "Nobody Knows", "Twitter"]
    companies = spark.createDataFrame(
        [(i, n, None, None, None, False, None) for i, n in enumerate(names, 1)]
        + [(50, "Earlier", "KODK", "manual", Decimal("100.00"), True, None)],
        "company_id long, company_name string, ticker_symbol string, match_method string, "
        "match_confidence decimal(5,2), is_public boolean, match_attempted_at timestamp")
    overrides = spark.createDataFrame([("twitter", None), ("kodak", "KODK")], schemas.OVERRIDES)
    quotes = spark.createDataFrame([
        ("Acme Robots", 1, "ACMF", "ETF", "NMS", "Acme Robots", None),        # not an equity
        ("Acme Robots", 2, "ACM.L", "EQUITY", "LSE", "Acme Robots", None),    # not a US listing
        ("Acme Robots", 3, "ACMR", "EQUITY", "NMS", "", "Acme Robots Inc"),   # short name used
        ("Acme Robots", 4, "ZZZ", "EQUITY", "NMS", "Acme Robots", None),      # a later rank
        ("Initech", 11, "INTC", "EQUITY", "NMS", "Initech", None),            # beyond the first ten results
        ("Twitter", 1, "TWTR", "EQUITY", "NYQ", "Twitter", None),             # the override comes first
    ], schemas.SEARCH_QUOTES)
    securities = spark.createDataFrame([("AUR", "Aurora", None), ("NOBO", "Something Else", None)], schemas.SECURITIES)
    out = matching.match_companies(companies, overrides, quotes, securities)
    got = {r.company_name: (r.ticker_symbol, r.match_method, float(r.match_confidence), r.is_public) for r in out.collect()}
    assert got == {
        "Acme Robots": ("ACMR", "yf_search", 100.0, True),
        "Aurora Innovation": ("AUR", "yf_direct", 85.0, True),
        "Aurora Solar": (None, "unresolved", 0.0, False),      # lost the ticker to the earlier name
        "Initech": (None, "unresolved", 0.0, False),
        "Kodak": (None, "unresolved", 0.0, False),             # held by an earlier match
        "Nobody Knows": (None, "unresolved", 0.0, False),
        "Twitter": (None, "manual", 100.0, False),             # known to be private
        "Earlier": ("KODK", "manual", 100.0, True),
    }
    assert out.where("ticker_symbol is not null").groupBy("ticker_symbol").count().where("count > 1").isEmpty()
    assert en.unmatched(out).isEmpty()


def test_scratch_is_released(spark):
    import os

    from tidemark.session import release_paths, scratch_mark, scratch_path, scratch_since, settled

    mark = scratch_mark()
    frame = settled(spark.range(5))
    scratch_path(spark, "never-written")
    made = scratch_since(mark)
    assert frame.count() == 5 and len(made) == 2 and os.path.isdir(made[0].removeprefix("file:"))
    release_paths(spark, made)
    assert made == [] and scratch_mark() == mark


def test_upsert_reads_and_writes_only_the_parts_of_its_batch(spark, tmp_path):
    import os

    path, schema = str(tmp_path / "t"), "k int, v string, year int"
    rows = [(y * 10 + i, None if i % 2 else f"old{i}", y) for y in (2020, 2021, 2022) for i in range(4)]
    wr.replace_table(spark.createDataFrame(rows, schema), path, ["year"])
    files = lambda: {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part")}
    before = files()
    batch = spark.createDataFrame([(20210, "no", 2021), (20211, "b", 2021), (20211, "a", 2021), (20219, "new", 2021), (20300, "next", 2030)], schema)
    for _ in range(2):
        assert wr.upsert_parts(spark, path, schema, batch, ["k"], ["v"], "year") == [2021, 2030]
        got = {r.k: r.v for r in wr.read_table(spark, path, schema).collect()}
        assert got == {k: v for k, v, _ in rows} | {20211: "a", 20219: "new", 20300: "next"}
    after = files()
    assert all(after.get(f) == t for f, t in before.items() if "year=2021" not in f)
    assert not any(f in after for f in before if "year=2021" in f)
    # files of other parts are not listed for the scan
    text = wr.read_table(spark, path, schema).where(F.col("year").isin([2021, 2030]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [year" in text
    assert wr.upsert_parts(spark, path, schema, batch.where("k < 0"), ["k"], ["v"], "year") == [] and files() == after


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path):
    """Records with doubled quotes, commas and up to many line breaks in cells, cut anywhere by byte ranges."""
    import csv
    import random

    rng = random.Random(4)
    cells = ["plain", "", " padded ", 'say ""', '"', "a,b", "x\ny", "\n\n", 'q"\n"q', "long\n" * 40, "é 漢", "tail\r\nmore"]
    rows = [[str(i), *(rng.choice(cells) for _ in range(3))] for i in range(1500)]
    folder = tmp_path / "csv"
    folder.mkdir()
    for name, part, end in (("a.csv", rows[:1200], "\n"), ("b.csv", rows[1200:], "\r\n")):
        with open(folder / name, "w", newline="", encoding="utf-8") as f:
            csv.writer(f, lineterminator=end).writerows([["id", "One", " Two", "three"], *part])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096"), spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = rd.read_split_csv(spark, str(folder))
        lines = spark.read.text(str(folder)).rdd.getNumPartitions()
        result = sorted((tuple(r) for r in got.collect()), key=lambda r: int(r[0]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0]), spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert lines > 10 and got.columns == ["id", "One", " Two", "three"]
    want = [tuple(c or None for c in r) for r in rows]
    assert [tuple(c or None for c in r) for r in result] == want


def test_split_csv_equals_the_plain_reader(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    with open(path, "w") as f:
        f.write('a,b\n1,"x\ny"\n\n2,\n3,"q""q"\n4,"",5\n')
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(rd.read_split_csv(spark, path)) == rows(rd.read_events_csv(spark, path))


def test_csv_files_grow_in_number_not_in_size(spark):
    """A task writes a file, so a fixed number of files would be a share of the whole input each."""
    from pathlib import Path

    from tidemark.plans import queries_ingest as qi

    folder = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{folder}/orders.parquet").count()
    files = lambda rows: sorted(Path(qi._written_csv(spark, folder, rows)).glob("*.csv"))
    assert len(files(qi.FILE_ROWS)) == 2
    many = files(100)
    assert len(many) == -(-orders // 100) > 2 and max(f.read_text().count("order ") for f in many) < 150


def test_raw_rows_are_parsed_by_many_tasks(spark):
    """One small file of orders is one scan task; the text work on its rows is spread all the same."""
    from tidemark.plans import queries_ingest as qi

    raw = qi.raw_events(spark, "/root/testdata/sf0.001")
    assert raw.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
