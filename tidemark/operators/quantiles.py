"""Exact quantiles with linear interpolation by radix selection: counting passes, no sort of a column.

A double becomes a whole number of 64 bits in the same order. Each pass counts the rows of a bucket by their next twelve
bits and steps into the bucket that holds the wanted rank, for all groups and ranks at once; counts combine before the shuffle
and are at most 4,096 a bucket, however many rows it has. Passes end when every bucket that is left holds few rows, which are
then put in order, or one value; that is after six passes at the latest.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tidemark.session import settled

_SHIFTS = (52, 40, 28, 16, 4, 0)
_FEW = 4096  # rows of a bucket that are put in order instead of counted again


@F.arrow_udf(T.LongType())
def _ordered_bits(values: pa.Array) -> pa.Array:
    """Whole numbers in the order of the doubles, NaN above all."""
    bits = values.to_numpy(zero_copy_only=False).astype(np.float64).view(np.int64)
    return pa.array(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


def _match(left: Sequence[str], right: Sequence[str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]


def _select(rows: DataFrame, groups: list[str], wanted: DataFrame) -> DataFrame:
    """``wanted`` (groups, ``rank``: whole, from 0) with ``value``, the row of that rank. ``rows``: groups, ``v``, ``s`` in order."""
    held = [f"{g}_of" for g in groups]
    at = wanted.select(*[F.col(g).alias(h) for g, h in zip(groups, held)], "rank", F.col("rank").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    before = None
    for shift in _SHIFTS:
        inside = rows.withColumn("in", F.lit(0).cast("long") if before is None else F.shiftright("s", before))
        if before is not None:
            buckets = at.select(*held, "prefix").distinct()
            inside = inside.join(buckets, [*_match(groups, held), F.col("in") == F.col("prefix")], "left_semi")
        counts = inside.groupBy(*groups, "in", F.shiftright("s", shift).alias("digit")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(W.partitionBy(*groups, "in").orderBy("digit").rowsBetween(W.unboundedPreceding, 0))
        counts = counts.withColumn("upto", upto)
        found = at.join(counts, [*_match(held, groups), F.col("prefix") == F.col("in"),
                                 F.col("rest") < F.col("upto"), F.col("rest") >= F.col("upto") - F.col("n")])
        at = settled(found.select(*held, "rank", (F.col("rest") - F.col("upto") + F.col("n")).alias("rest"), F.col("digit").alias("prefix"), F.col("n").alias("size")))
        before = shift
        largest = at.agg(F.max("size")).first()[0] or 0
        at = at.drop("size")
        if largest <= _FEW:
            break
    inside = rows.withColumn("in", F.shiftright("s", before))
    inside = inside.join(at.select(*held, "prefix").distinct(), [*_match(groups, held), F.col("in") == F.col("prefix")], "left_semi")
    # with all bits looked at, the rows of a bucket are equal
    values = F.sort_array(F.collect_list("v")) if before else F.array(F.min("v"))
    last = inside.groupBy(*groups, "in").agg(values.alias("values"))
    place = F.col("rest") + 1 if before else F.lit(1)
    return at.join(last, [*_match(held, groups), F.col("prefix") == F.col("in")]).select(
        *[F.col(h).alias(g) for g, h in zip(groups, held)], "rank", F.element_at("values", place.cast("int")).alias("value"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, p, quantile)``, one row per group and probability; nulls are ignored, NaN is above all numbers."""
    groups = [f"__g{i}" for i in range(max(len(by), 1))]
    names = [F.col(c).alias(g) for c, g in zip(by, groups)] or [F.lit(0).alias(groups[0])]
    rows = df.select(*names, (F.col(value).cast("double") + 0.0).alias("v")).where("v is not null")
    rows = settled(rows.withColumn("s", _ordered_bits("v")))
    ranks = rows.groupBy(*groups).agg(F.count("*").alias("n")).select(
        *groups, F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"), "n").withColumn("exact", F.col("p") * (F.col("n") - 1))
    ends = ranks.select(*groups, "p", F.explode(F.array(F.floor("exact"), F.ceil("exact"))).alias("rank"), "exact").distinct()
    found = _select(rows, groups, ends.select(*groups, "rank").distinct())
    out = ends.join(found.withColumnsRenamed({g: f"{g}_at" for g in groups} | {"rank": "rank_at"}),
                    [*_match(groups, [f"{g}_at" for g in groups]), F.col("rank") == F.col("rank_at")])
    # one row where the rank is whole, two where it lies between rows
    out = out.groupBy(*groups, "p").agg(*[f("value", "rank").alias(n) for f, n in ((F.min_by, "low"), (F.max_by, "high"))],
                                        F.max("exact").alias("exact"))
    part = F.col("exact") - F.floor("exact")
    # equal ends are the value itself, also where it is infinite
    blend = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + part * (F.col("high") - F.col("low")))
    return out.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], "p", blend.alias("quantile"))


def exact_median(df: DataFrame, value: str):
    """The median of a column as a scalar expression, null if there are no values."""
    return exact_quantiles(df, value, [0.5]).select("quantile").scalar()
