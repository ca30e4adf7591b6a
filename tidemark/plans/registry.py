"""Registered queries: a Spark callable, its result columns and, where SQL can say it, its check.

The column specification ``name:kind`` shapes both sides alike. Kinds: ``l``
bigint, ``f`` double rounded to 6 places, ``x`` double as it is (for values both
sides compute exactly), ``e`` double to 4 significant digits (for solutions of
nearly collinear systems, which amplify the last bits of their inputs), ``s`` text (dates as ISO text), ``b`` boolean.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

Build = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    build: Build
    spec: str
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, spec: str, sql: str | None = None):
    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(build, spec, sql)
        return build

    return add


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) for item in spec.split()]


def shaped(df: DataFrame, spec: str) -> DataFrame:
    def cell(name: str, kind: str):
        c = F.col(f"`{name}`")
        return {"l": lambda: c.cast("bigint"), "f": lambda: F.round(c.cast("double"), 6),
                "e": lambda: F.when(c.isNotNull(), F.format_string("%.3e", c.cast("double")).cast("double") + 0.0),
                "x": lambda: c.cast("double"), "s": lambda: c.cast("string"), "b": lambda: c.cast("boolean")}[kind]().alias(name)

    return df.select(*[cell(n, k) for n, k in _columns(spec)])


def shaped_sql(sql: str, spec: str) -> str:
    def cell(name: str, kind: str) -> str:
        return {"l": f'CAST("{name}" AS BIGINT)', "f": f'round(CAST("{name}" AS DOUBLE), 6) + 0.0',
                "e": f'CAST(printf(\'%.3e\', CAST("{name}" AS DOUBLE)) AS DOUBLE) + 0.0',
                "x": f'CAST("{name}" AS DOUBLE)', "s": f'CAST("{name}" AS VARCHAR)', "b": f'CAST("{name}" AS BOOLEAN)'}[kind] + f' AS "{name}"'

    return f"SELECT {', '.join(cell(n, k) for n, k in _columns(spec))} FROM (\n{sql}\n) AS q"


def all_queries() -> dict[str, Build]:
    def runner(q: Query) -> Build:
        return lambda spark, folder: shaped(q.build(spark, folder), q.spec)

    return {name: runner(q) for name, q in REGISTRY.items()}


def all_checks() -> dict[str, str]:
    return {name: shaped_sql(q.sql, q.spec) for name, q in REGISTRY.items() if q.sql}
