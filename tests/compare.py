"""Runs registered queries against their SQL on the same tables."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def sql_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def difference(spark, con, folder, build, sql) -> str | None:
    columns, got = spark_rows(build(spark, folder))
    expected_columns, expected = sql_rows(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if got != expected:
        extra, missing = list((got - expected).items())[:3], list((expected - got).items())[:3]
        return f"{sum(got.values())} rows against {sum(expected.values())}; only here {extra}; only there {missing}"
    return None if sum(got.values()) else "no rows"


def main(folder: str, names: list[str]) -> None:
    from tidemark.plans import all_checks, all_queries
    from tidemark.session import local_session, release_scratch

    spark = local_session(cpus=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, checks = connect(folder), all_checks()
    for name, build in all_queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in checks:
                verdict = difference(spark, con, folder, build, checks[name]) or "ok"
            else:
                verdict = f"rows {len(build(spark, folder).collect())}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {str(error)[:600]}"
        release_scratch(spark)
        print(f"{name:28s} {time.time() - start:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
