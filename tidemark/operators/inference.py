"""Tests and intervals on the cross-section of event returns."""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.distributions import normal_p_value, t_p_value
from tidemark.operators.quantiles import exact_quantiles

BOOTSTRAP_REPLICATES = 1000
BOOTSTRAP_SEED = 42


def summary_stats(df: DataFrame, value: str) -> DataFrame:
    """``n, mean, median, std`` in one row; fewer than two values give only ``n``."""
    present = df.where(F.col(value).isNotNull())
    median = exact_quantiles(present, value, [0.5]).select("quantile").scalar()
    many = F.col("n") >= 2
    return present.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
    ).select(
        "n", F.when(many, F.col("mean")).alias("mean"), F.when(many, median).alias("median"),
        F.when(many, F.col("std")).alias("std"),
        F.when(~many, "insufficient observations").alias("note"),
    )


def t_test_one_sample(df: DataFrame, value: str, mu: float = 0.0) -> DataFrame:
    """``n, mean, std, t, p``: two-sided test of the mean against ``mu``."""
    moments = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                     F.stddev_samp(value).alias("std"))
    t = F.when((F.col("n") >= 2) & (F.col("std") > 0),
               (F.col("mean") - mu) / (F.col("std") / F.sqrt("n")))
    return moments.withColumn("t", t).withColumn("p", t_p_value("t", F.col("n") - 1.0))


def patell_z(df: DataFrame, scar: str) -> DataFrame:
    """``n, mean, z, p``: mean standardised return times root n, against the normal."""
    moments = df.agg(F.count(scar).alias("n"), F.avg(scar).alias("mean"))
    return moments.withColumn("z", F.col("mean") * F.sqrt("n")).withColumn("p", normal_p_value("z"))


def welch_t_test(df: DataFrame, value: str, first_group: Column, min_n: int = 3) -> DataFrame:
    """One row comparing the rows where ``first_group`` holds with the rest, unequal variances."""
    a = F.when(first_group, F.col(value))
    b = F.when(~first_group, F.col(value))
    moments = df.agg(
        F.count(a).alias("n_first"), F.avg(a).alias("mean_first"), F.var_samp(a).alias("var_first"),
        F.count(b).alias("n_rest"), F.avg(b).alias("mean_rest"), F.var_samp(b).alias("var_rest"),
    )
    ea, eb = F.col("var_first") / F.col("n_first"), F.col("var_rest") / F.col("n_rest")
    enough = (F.col("n_first") >= min_n) & (F.col("n_rest") >= min_n) & (ea + eb > 0)
    t = F.when(enough, (F.col("mean_first") - F.col("mean_rest")) / F.sqrt(ea + eb))
    dof = F.when(enough, (ea + eb) * (ea + eb) / (
        ea * ea / (F.col("n_first") - 1) + eb * eb / (F.col("n_rest") - 1)))
    return moments.withColumn("t", t).withColumn("dof", dof).withColumn("p", t_p_value("t", "dof"))


def simple_regression(df: DataFrame, x: str, y: str, min_n: int = 6) -> DataFrame:
    """``n, slope, intercept, r2, t, p`` in one row, null below ``min_n`` pairs."""
    fit = df.agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
    )
    enough = F.col("n") >= min_n
    fit = fit.withColumns({c: F.when(enough, F.col(c)) for c in ("slope", "intercept", "r2")})
    t = F.signum("slope") * F.sqrt(F.try_divide(F.col("r2") * (F.col("n") - 2), 1 - F.col("r2")))
    return fit.withColumn("t", t).withColumn("p", t_p_value("t", F.col("n") - 2.0))


# A generator in whole numbers below 2**31, which any engine with 64-bit integers repeats exactly: powers of five are
# a permutation modulo the prime, and the two sums of row and replicate tell every pair apart.
PRIME = 2147483647
FACTORS = (48271, 69621), (39373, 1234567)
STEP, PLUS = 16807, 1013904223
POISSON_STEPS = tuple(int(PRIME * sum(math.exp(-1.0) / math.factorial(j) for j in range(k + 1))) for k in range(10))
_ROWS = 256  # rows whose weights in all replicates are held at once


def poisson_weights(ids: np.ndarray, replicates: np.ndarray, seed: int) -> np.ndarray:
    """Poisson(1) weights of rows (first axis) in replicates, from nothing but their numbers."""
    fifth = lambda x: x * x % PRIME * (x * x % PRIME) % PRIME * x % PRIME
    row, rep = (ids.astype(np.int64) % PRIME)[:, None], replicates.astype(np.int64)[None, :] + 1
    x = fifth((row * FACTORS[0][0] + rep * FACTORS[0][1] + seed) % PRIME)
    x = fifth((x * STEP + row * FACTORS[1][0] + rep * FACTORS[1][1] + PLUS) % PRIME)
    return np.searchsorted(np.array(POISSON_STEPS), x, side="right")


def bootstrap_sums(df: DataFrame, row_id: str, columns: Mapping[str, Column], replicates: int = BOOTSTRAP_REPLICATES,
                   seed: int = BOOTSTRAP_SEED) -> DataFrame:
    """``rep, w`` (sum of weights) and each column's weighted sum, one row per replicate.

    Weights are independent Poisson(1) draws, the distributed form of resampling with replacement. They follow from the
    row's number and the replicate's, so the result does not depend on partitioning and a lost task draws the same.
    A task adds up one array of all replicates and passes that on: nothing is expanded to a row per row and replicate.
    """
    names = list(columns)

    def add_up(batches):
        reps = np.arange(replicates)
        sums, any_row = np.zeros((replicates, len(names) + 1)), False
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.column_stack([np.ones(len(ids)), *[c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]])
            any_row |= len(ids) > 0
            for at in range(0, len(ids), _ROWS):
                sums += poisson_weights(ids[at:at + _ROWS], reps, seed).T @ values[at:at + _ROWS]
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array(reps), *[pa.array(sums[:, k].copy()) for k in range(sums.shape[1])]], ["rep", "w", *names])

    rows = df.select(F.coalesce(F.col(row_id).cast("long"), F.lit(0)).alias(row_id), *[c.cast("double").alias(n) for n, c in columns.items()])
    fields = ", ".join(f"{n} double" for n in ("w", *names))
    return rows.mapInArrow(add_up, f"rep long, {fields}").groupBy("rep").agg(*[F.sum(n).alias(n) for n in ("w", *names)])


def bootstrap_means(df: DataFrame, value: str, row_id: str, replicates: int = BOOTSTRAP_REPLICATES,
                    seed: int = BOOTSTRAP_SEED) -> DataFrame:
    """``(rep, mean)``; a replicate that draws no row has none."""
    present = df.where(F.col(value).isNotNull())
    return bootstrap_sums(present, row_id, {"total": F.col(value)}, replicates, seed).select(
        "rep", F.try_divide("total", "w").alias("mean"))


def bootstrap_ci(df: DataFrame, value: str, row_id: str, level: float = 0.95,
                 replicates: int = BOOTSTRAP_REPLICATES, seed: int = BOOTSTRAP_SEED) -> DataFrame:
    """``ci_lo, ci_hi``: percentile interval of the mean over the replicates."""
    tail = (1.0 - level) / 2.0
    # as many values as replicates, a fixed parameter
    return bootstrap_means(df, value, row_id, replicates, seed).agg(
        F.percentile("mean", F.array(F.lit(tail), F.lit(1.0 - tail))).alias("ci")
    ).select(F.col("ci")[0].alias("ci_lo"), F.col("ci")[1].alias("ci_hi"))


def regression_band(df: DataFrame, x: str, y: str, row_id: str, points: int = 100,
                    replicates: int = BOOTSTRAP_REPLICATES, seed: int = BOOTSTRAP_SEED,
                    level: float = 0.95) -> DataFrame:
    """``(x, fit, lo, hi)``: fitted line on an even grid with its bootstrap band."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        row_id, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"))
    frame = pairs.agg(F.struct(
        F.min("__x").alias("lo"), F.max("__x").alias("hi"),
        F.regr_slope("__y", "__x").alias("slope"), F.regr_intercept("__y", "__x").alias("intercept"),
        F.avg("__x").alias("cx"), F.avg("__y").alias("cy"),
    ).alias("f")).scalar()
    # centred sums keep the weighted normal equations well conditioned
    centred = pairs.select(row_id, (F.col("__x") - frame["cx"]).alias("dx"), (F.col("__y") - frame["cy"]).alias("dy"))
    dx, dy = F.col("dx"), F.col("dy")
    sums = bootstrap_sums(centred, row_id, {"sx": dx, "sy": dy, "sxx": dx * dx, "sxy": dx * dy}, replicates, seed).withColumnRenamed("w", "sw")
    spread = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), F.col("sw"))
    slope = F.when(spread > 0, (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("sw")) / spread)
    lines = sums.withColumn("b", slope).where("b is not null").select(
        "b", ((F.col("sy") - F.col("b") * F.col("sx")) / F.col("sw")).alias("a"))
    step = (frame["hi"] - frame["lo"]) / F.lit(float(points - 1))
    tail = (1.0 - level) / 2.0
    return (
        lines.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", frame["lo"] + F.col("i") * step)
        .groupBy("i", "x")
        .agg(F.percentile(frame["cy"] + F.col("a") + F.col("b") * (F.col("x") - frame["cx"]),
                          F.array(F.lit(tail), F.lit(1.0 - tail))).alias("ci"))
        .select("x", (frame["intercept"] + frame["slope"] * F.col("x")).alias("fit"),
                F.col("ci")[0].alias("lo"), F.col("ci")[1].alias("hi"))
    )


def hypothesis_summary(wide: DataFrame, window_key: str) -> DataFrame:
    """The headline summary row: moments, t-test, bootstrap interval and Patell Z."""
    car, scar = f"car_{window_key}", f"scar_{window_key}"
    stats = summary_stats(wide, car)
    t = t_test_one_sample(wide, car).select(F.struct("t", "p")).scalar()
    ci = bootstrap_ci(wide, car, "event_id").select(F.struct("ci_lo", "ci_hi")).scalar()
    z = patell_z(wide, scar).select(F.struct("n", "mean", "z", "p")).scalar()
    return stats.select(
        F.lit(window_key).alias("window"), "n", F.col("mean").alias("mean_car"),
        F.col("median").alias("median_car"), F.col("std").alias("std_car"),
        t["t"].alias("t_statistic"), t["p"].alias("p_value"),
        ci["ci_lo"].alias("bootstrap_ci_lo"), ci["ci_hi"].alias("bootstrap_ci_hi"),
        z["n"].alias("scar_n"), z["mean"].alias("scar_mean"),
        z["z"].alias("scar_z"), z["p"].alias("scar_p_value"), "note",
    )
