"""Registered queries: matching names to securities.

Names, search results and listings are all derived from the part table: a
company is a distinct part name and brand, every part is one search result for
its company, and the curated overrides cover two brands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.similarity import with_token_set_ratio
from tidemark.operators import entity as en
from tidemark.operators import reporting as rep
from tidemark.plans import matching
from tidemark.plans import warehouse as wh
from tidemark.plans.checks import recursive
from tidemark.plans.registry import query


def _title() -> Column:
    return F.initcap("p_name")


def names(spark: SparkSession, folder: str) -> DataFrame:
    """The company table before matching; one brand was matched in an earlier run."""
    parts = wh.table(spark, folder, "part")
    done = F.col("p_brand") == "Brand#11"
    return (
        parts.groupBy(F.concat_ws(" ", _title(), "p_brand").alias("company_name"), "p_brand")
        .agg(F.min("p_partkey").alias("company_id"))
        .select(
            "company_id", "company_name", "p_brand",
            F.when(done, F.concat(F.lit("H"), F.col("company_id"))).alias("ticker_symbol"),
            F.when(done, "manual").alias("match_method"),
            F.when(done, 100.0).cast("decimal(5,2)").alias("match_confidence"),
            done.alias("is_public"), F.lit(None).cast("timestamp").alias("match_attempted_at"))
    )


def overrides(spark: SparkSession, folder: str) -> DataFrame:
    """Two curated brands: one listed, one known to be private."""
    curated = names(spark, folder).where(F.col("p_brand").isin("Brand#3", "Brand#7"))
    return curated.select(
        F.lower(F.trim("company_name")).alias("normalized_name"),
        F.when(F.col("p_brand") == "Brand#3", F.concat(F.lit("BR"), F.col("company_id"))).alias("ticker"))


def quotes(spark: SparkSession, folder: str) -> DataFrame:
    """One search result per part, for the company of its name and brand."""
    kind = F.col("p_type")
    return wh.table(spark, folder, "part").select(
        F.concat_ws(" ", _title(), "p_brand").alias("company_name"),
        F.col("p_size").alias("rank"),
        F.concat(F.upper(F.substring("p_name", 1, 2)), F.col("p_size")).alias("symbol"),
        F.when(kind == "PROMO", "ETF").otherwise("EQUITY").alias("quote_type"),
        F.when(kind == "LARGE", "LSE").when(kind == "MEDIUM", "NYQ").otherwise("NMS").alias("exchange"),
        F.when(kind == "STANDARD", F.concat(_title(), F.lit(" "), F.col("p_brand"), F.lit(" Corp")))
        .when(kind == "MEDIUM", F.concat(_title(), F.lit(" Holdings Inc")))
        .when(kind == "ECONOMY", F.concat(F.lit("Standard "), _title())).alias("longname"),
        _title().alias("shortname"))


def securities(spark: SparkSession, folder: str) -> DataFrame:
    """Listings under the first letters of a word of the part name."""
    words = F.split("p_name", " ")
    symbols = F.array(F.upper(F.substring(words[0], 1, 4)), F.upper(F.substring(words[1], 1, 3)),
                      F.upper(F.concat(F.substring(words[0], 1, 1), F.substring(words[1], 1, 1), F.lit("b"))))
    return (
        wh.table(spark, folder, "part").select(F.explode(symbols).alias("symbol"), _title().alias("title"))
        .groupBy("symbol").agg(F.concat(F.min("title"), F.lit(" Inc")).alias("longname"))
        .withColumn("shortname", F.lit(None).cast("string"))
    )


_TITLED = """upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' ||
             upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2)"""


def _set(column: str) -> str:
    return f"list_sort(list_distinct(string_split(lower({column}), ' ')))"


NAMES = {
    "titled": f"SELECT *, {_TITLED} AS title FROM part",
    "roster": """
        SELECT min(p_partkey) AS company_id, title || ' ' || p_brand AS company_name, p_brand,
               CASE WHEN p_brand = 'Brand#11' THEN 'H' || min(p_partkey) END AS held,
               p_brand <> 'Brand#11' AS pending
        FROM titled GROUP BY title, p_brand""",
    "curated": """
        SELECT lower(trim(company_name)) AS normalized,
               CASE WHEN p_brand = 'Brand#3' THEN 'BR' || company_id END AS ticker
        FROM roster WHERE p_brand IN ('Brand#3', 'Brand#7')""",
    "results": """
        SELECT title || ' ' || p_brand AS company_name, p_size AS rank,
               upper(left(p_name, 2)) || p_size AS symbol, p_type AS kind,
               coalesce(CASE p_type WHEN 'STANDARD' THEN title || ' ' || p_brand || ' Corp'
                             WHEN 'MEDIUM' THEN title || ' Holdings Inc'
                             WHEN 'ECONOMY' THEN 'Standard ' || title END, title) AS listed
        FROM titled""",
    "listings": """
        SELECT symbol, min(title) || ' Inc' AS listed
        FROM (SELECT title, unnest([upper(left(split_part(p_name, ' ', 1), 4)), upper(left(split_part(p_name, ' ', 2), 3)),
                     upper(left(p_name, 1) || left(split_part(p_name, ' ', 2), 1) || 'b')]) AS symbol FROM titled)
        GROUP BY symbol""",
    # all guesses of a two-word name followed by a brand word
    "guesses": """
        SELECT company_id, company_name, symbol, min(pos) AS pos
        FROM (SELECT company_id, company_name, unnest([0, 1, 2, 3]) AS pos, unnest([
                CASE WHEN length(w) BETWEEN 1 AND 5 THEN w END, CASE WHEN length(w) >= 4 THEN left(w, 4) END,
                CASE WHEN length(w) >= 3 THEN left(w, 3) END, initials]) AS symbol
              FROM (SELECT *, upper(split_part(company_name, ' ', 1)) AS w,
                           left(split_part(company_name, ' ', 1), 1) || left(split_part(company_name, ' ', 2), 1) || 'B'
                               AS initials
                    FROM roster WHERE pending))
        WHERE symbol IS NOT NULL GROUP BY ALL""",
    "couples": """
        SELECT listed, company_name FROM results UNION
        SELECT l.listed, g.company_name FROM guesses g JOIN listings l USING (symbol)""",
    "couple_sets": f"""
        SELECT *, list_intersect(a, b) AS i, list_sort(list_filter(a, lambda t: NOT list_contains(b, t))) AS xs,
               list_sort(list_filter(b, lambda t: NOT list_contains(a, t))) AS ys
        FROM (SELECT *, {_set('listed')} AS a, {_set('company_name')} AS b FROM couples)""",
    "rests": """
        SELECT *, array_to_string(list_sort(i), ' ') AS s, array_to_string(xs, ' ') AS x,
               array_to_string(ys, ' ') AS y
        FROM couple_sets""",
    # longest common subsequence by dynamic programming, one matrix row at a time
    "lcs_rows": """
        SELECT x, y, 0 AS step, list_transform(range(length(y) + 1), lambda k: 0) AS line
        FROM (SELECT DISTINCT x, y FROM rests WHERE x <> '' AND y <> '')
        UNION ALL
        SELECT x, y, step + 1,
               list_reduce(list_transform(range(1, length(y) + 1), lambda j: [
                               CASE WHEN substr(x, step + 1, 1) = substr(y, j, 1) THEN line[j] + 1 ELSE line[j + 1] END]),
                           lambda done, cell: list_append(done, greatest(done[length(done)], cell[1])), [0])
        FROM lcs_rows WHERE step < length(x)""",
    "ratios": """
        SELECT r.listed, r.company_name,
               CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0
                    WHEN s <> '' AND (r.x = '' OR r.y = '') THEN 100.0
                    WHEN s = '' THEN 100 - 100.0 * (length(r.x) + length(r.y) - 2 * lcs) / (length(r.x) + length(r.y))
                    ELSE greatest(
                      100 - 100.0 * (length(r.x) + length(r.y) - 2 * lcs)
                            / (2 * length(s) + 2 + length(r.x) + length(r.y)),
                      100 - 100.0 * (1 + length(r.x)) / (2 * length(s) + 1 + length(r.x)),
                      100 - 100.0 * (1 + length(r.y)) / (2 * length(s) + 1 + length(r.y))) END AS ratio
        FROM rests r LEFT JOIN (SELECT x, y, line[length(y) + 1] AS lcs FROM lcs_rows WHERE step = length(x)) l
          ON l.x = r.x AND l.y = r.y""",
    "found": """
        SELECT company_name, symbol AS ticker, ratio AS confidence
        FROM results JOIN ratios USING (listed, company_name)
        WHERE rank <= 10 AND kind NOT IN ('PROMO', 'LARGE') AND ratio >= 85
        QUALIFY row_number() OVER (PARTITION BY company_name ORDER BY rank, symbol, ratio) = 1""",
    "guessed": """
        SELECT g.company_id, g.symbol AS ticker
        FROM guesses g JOIN listings l USING (symbol) JOIN ratios r USING (listed, company_name)
        WHERE r.ratio >= 70
        QUALIFY row_number() OVER (PARTITION BY g.company_id ORDER BY g.pos) = 1""",
    "chain": """
        SELECT n.company_id, n.company_name,
               CASE WHEN c.normalized IS NOT NULL THEN c.ticker WHEN f.ticker IS NOT NULL THEN f.ticker
                    ELSE g.ticker END AS ticker,
               CASE WHEN c.normalized IS NOT NULL THEN 'manual' WHEN f.ticker IS NOT NULL THEN 'yf_search'
                    WHEN g.ticker IS NOT NULL THEN 'yf_direct' ELSE 'unresolved' END AS match_method,
               CASE WHEN c.normalized IS NOT NULL THEN 100 WHEN f.ticker IS NOT NULL THEN f.confidence
                    WHEN g.ticker IS NOT NULL THEN 85 ELSE 0 END AS match_confidence
        FROM roster n LEFT JOIN curated c ON c.normalized = lower(trim(n.company_name))
        LEFT JOIN found f ON f.company_name = n.company_name
        LEFT JOIN guessed g ON g.company_id = n.company_id
        WHERE n.pending""",
    "claimed": """
        SELECT company_id, company_name, CASE WHEN keeps THEN ticker END AS ticker_symbol,
               CASE WHEN ticker IS NOT NULL AND NOT keeps THEN 'unresolved' ELSE match_method END AS match_method,
               CASE WHEN ticker IS NOT NULL AND NOT keeps THEN 0 ELSE match_confidence END AS match_confidence,
               ticker IS NOT NULL AND keeps AS is_public
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY company_name, company_id) = 1
                        AND ticker NOT IN (SELECT held FROM roster WHERE held IS NOT NULL) AS keeps FROM chain)""",
    "matched": """
        SELECT company_id, company_name, ticker_symbol, match_method FROM claimed UNION ALL
        SELECT company_id, company_name, held, 'manual' FROM roster WHERE NOT pending""",
}


def named(body: str) -> str:
    return recursive(body, NAMES)


def pending(spark: SparkSession, folder: str) -> DataFrame:
    return en.unmatched(names(spark, folder))


def resolved(spark: SparkSession, folder: str) -> DataFrame:
    return en.resolve(pending(spark, folder), overrides(spark, folder), quotes(spark, folder),
                      securities(spark, folder))


def matched(spark: SparkSession, folder: str) -> DataFrame:
    return matching.match_companies(names(spark, folder), overrides(spark, folder), quotes(spark, folder),
                                    securities(spark, folder))


@query("E1_unmatched_scan", "company_id:l company_name:s normalized:s", named(
    "SELECT company_id, company_name, lower(trim(company_name)) AS normalized FROM roster WHERE pending"))
def _(spark, folder):
    return pending(spark, folder).orderBy("company_name")


@query("J8_override_lookup", "company_id:l ticker:s", named(
    """SELECT n.company_id, c.ticker FROM roster n JOIN curated c ON c.normalized = lower(trim(n.company_name))
       WHERE n.pending"""))
def _(spark, folder):
    return en.override_match(pending(spark, folder), overrides(spark, folder))


@query("E2_token_set_ratio", "company_name:s listed:s ratio:f", named(
    "SELECT company_name, listed, ratio FROM results JOIN ratios USING (listed, company_name)"))
def _(spark, folder):
    rows = quotes(spark, folder).withColumn("listed", F.coalesce("longname", "shortname"))
    return with_token_set_ratio(rows, F.lower("listed"), F.lower("company_name"), "ratio")


@query("E3_search_match", "company_name:s ticker:s confidence:f", named("SELECT * FROM found"))
def _(spark, folder):
    return en.search_match(quotes(spark, folder))


@query("E4_ticker_candidates", "company_id:l place:l symbol:s", named(
    """SELECT company_id, row_number() OVER (PARTITION BY company_id ORDER BY pos) - 1 AS place, symbol
       FROM guesses"""))
def _(spark, folder):
    return en.ticker_guesses(pending(spark, folder)).withColumnRenamed("pos", "place")


@query("E5_direct_match", "company_id:l ticker:s", named("SELECT company_id, ticker FROM guessed"))
def _(spark, folder):
    return en.direct_match(pending(spark, folder), securities(spark, folder))


@query("E6_resolve_chain", "company_id:l ticker:s match_method:s match_confidence:f",
       named("SELECT * FROM chain"))
def _(spark, folder):
    return resolved(spark, folder)


@query("E7_ticker_claim", "company_id:l company_name:s ticker_symbol:s match_method:s match_confidence:f is_public:b",
       named("SELECT company_id, company_name, ticker_symbol, match_method,"
             " CAST(match_confidence AS DECIMAL(5,2)) AS match_confidence, is_public FROM claimed"))
def _(spark, folder):
    return en.claim_tickers(resolved(spark, folder), names(spark, folder))


@query("A12_match_by_method", "match_method:s n:l", named(
    "SELECT match_method, count(*) AS n FROM matched GROUP BY 1"))
def _(spark, folder):
    return rep.match_by_method(matched(spark, folder))


@query("P15_filter_by_method", "company_name:s ticker_symbol:s", named(
    "SELECT company_name, ticker_symbol FROM matched WHERE match_method = 'manual'"))
def _(spark, folder):
    return matched(spark, folder).where("match_method = 'manual'").select(
        "company_name", "ticker_symbol").orderBy("company_name")
