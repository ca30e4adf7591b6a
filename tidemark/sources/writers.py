"""Sinks. Tables are Parquet folders; a rewrite goes to a fresh folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.dedupe import first_non_null
from tidemark.operators.forest import Forest
from tidemark.operators.merge import new_rows, upsert_fill_nulls
from tidemark.session import settled


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table with its declared schema."""
    return spark.read.schema(schema).parquet(path)


def append_new(spark: SparkSession, path: str, schema: str, incoming: DataFrame, keys: Sequence[str], within: str | None = None) -> None:
    """Insert-only load: append the rows whose key is not stored; the stored files stay as they are.

    ``within``: a column of the key by which the table grows, such as a date. Only stored rows between the batch's smallest
    and largest value are compared, which files and row groups outside that range are skipped for.
    """
    stored = read_table(spark, path, schema)
    if within is not None:
        low, high = incoming.agg(F.min(within), F.max(within)).first()
        stored = stored.where(F.col(within).between(F.lit(low), F.lit(high)))
    new_rows(stored, incoming, keys).write.mode("append").parquet(path)


def upsert_parts(spark: SparkSession, path: str, schema: str, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 part: str, order: Sequence[Column] | None = None) -> list:
    """Fill nulls of stored rows and add new ones in a table laid out by ``part``; returns the parts that were written.

    ``part`` is a column of the table and the batch that follows from the key, such as the year of a date. Only parts
    that the batch has rows for are read and written again; every other file stays as it is. The new rows of the touched parts are
    written beside the table first, and then put in place part by part, so the same load run again gives the same table.
    """
    batch = settled(first_non_null(incoming, [*keys, part], columns, order or [F.col(c) for c in columns]))
    touched = sorted(r[0] for r in batch.select(part).distinct().collect())  # as many as the table has folders
    stored = read_table(spark, path, schema).where(F.col(part).isin(touched))
    merged = settled(upsert_fill_nulls(stored, batch, [*keys, part], columns))
    # files by part; a part with many rows is split, small ones share a task
    merged.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    return touched


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Recompute: drop every stored row and write the new ones. ``df`` must not read from ``path``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_model(model: Forest, path: str) -> None:
    model.save(path)


def write_study(folder: str, *, summary: DataFrame | None = None, coefficients: DataFrame | None = None,
                diagnostics: DataFrame | None = None, importance: DataFrame | None = None,
                metrics: DataFrame | None = None, per_event: DataFrame | None = None,
                timeline: DataFrame | None = None, model: Forest | None = None) -> None:
    """Everything a study produced, each result under its own name; absent results are skipped."""
    for name, df in (("analysis_summary", summary), ("regression_diagnostics", diagnostics),
                     ("rf_metrics", metrics)):
        if df is not None:
            write_json(df, f"{folder}/{name}")
    for name, df in (("regression_coefficients", coefficients), ("rf_feature_importance", importance),
                     ("per_event_cars", per_event), ("timeline_ars", timeline)):
        if df is not None:
            write_csv(df, f"{folder}/{name}")
    if model is not None:
        write_model(model, f"{folder}/rf_model")
