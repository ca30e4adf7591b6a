"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def completeness(columns: Sequence[str]) -> Column:
    """Number of non-null cells."""
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])


def keep_most_complete(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                       tiebreak: Sequence[str]) -> DataFrame:
    """Per key, the row with the most non-null cells; ties go to the smallest ``tiebreak``.

    ``row_number = 1`` lets Spark cut every key to one row per map task before
    the shuffle, so a key holding a third of all rows costs no more than others.
    """
    order = W.partitionBy(*keys).orderBy(F.desc("__filled"), *[F.asc_nulls_first(c) for c in tiebreak])
    return (
        df.withColumn("__filled", completeness(measures))
        .withColumn("__rank", F.row_number().over(order))
        .where("__rank = 1")
        .drop("__filled", "__rank")
    )


def first_non_null(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   order: Sequence[Column]) -> DataFrame:
    """Per key and column, the first non-null value in the given order.

    Partial aggregation keeps one candidate per key, column and map task.
    """
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    picks = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*picks)
