"""Least squares with heteroscedasticity-robust (HC3) errors.

Two passes over the rows. Each task reduces its rows to a k x k cross-product
with numpy; those are summed by Spark, so only k x k numbers (k = number of
regressors) reach the driver, where the small system is solved. The second pass
needs the coefficients and the inverse, k x k numbers again, in every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.distributions import f_upper, normal_two_sided
from tidemark.operators.positions import with_previous

MIN_ROWS = 30
MAX_TERMS = 1000
MIN_SLACK = 1e-10  # 1 - leverage below this leaves the robust error undefined


@dataclass
class Design:
    """Names and expressions of the model terms, intercept first."""

    terms: list[str]
    columns: list[Column] = field(repr=False)

    def frame(self, df: DataFrame, y: str, keep: Sequence[str] = ()) -> DataFrame:
        """The rows in which the outcome and every term have a number."""
        x = F.array(*[c.cast("double") for c in self.columns])
        number = lambda v: v.isNotNull() & ~F.isnan(v)
        rows = df.select(F.col(y).cast("double").alias("y"), x.alias("x"), *keep)
        return rows.where(number(F.col("y")) & F.forall("x", number))


def design(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> Design:
    """Intercept, treatment-coded categories (first level is the base), then the numbers."""
    terms, columns = ["Intercept"], [F.lit(1.0)]
    for name in categorical:
        found = df.select(name).where(F.col(name).isNotNull()).distinct().limit(MAX_TERMS + 1)
        levels = sorted(r[0] for r in found.collect())
        if len(levels) > MAX_TERMS:
            raise ValueError(f"{name} has more than {MAX_TERMS} levels; bucket it first")
        for level in levels[1:]:
            terms.append(f"C({name})[T.{level}]")
            columns.append((F.col(name) == level).cast("int"))
    for name in numeric:
        terms.append(name)
        columns.append(F.col(name))
    if len(terms) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} model terms")
    return Design(terms, columns)


def _summed(frame: DataFrame, reduce_batch, size: int) -> np.ndarray:
    """Sum a fixed-size vector over all rows; ``reduce_batch(x, y)`` gives one batch's part."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += reduce_batch(np.vstack(pdf["x"].to_numpy()), pdf["y"].to_numpy())
        yield pd.DataFrame({"i": np.arange(size), "v": total})

    sums = frame.select("x", "y").mapInPandas(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(size)
    for row in sums.collect():  # `size` rows, fixed by the number of terms
        out[row["i"]] = row["v"]
    return out


def _symmetric_inverse(gram: np.ndarray) -> tuple[np.ndarray, int]:
    """Inverse by scaled eigenvalues; minimum-norm pseudo-inverse if rank-deficient."""
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    values, vectors = np.linalg.eigh(gram / np.outer(scale, scale))
    good = values > values.max() * len(gram) * 1e-14
    rank = int(good.sum())
    if rank == len(gram):
        return (vectors / values) @ vectors.T / np.outer(scale, scale), rank
    return np.linalg.pinv(gram, rcond=1e-13, hermitian=True), rank


@dataclass
class OlsFit:
    spark: SparkSession
    terms: list[str]
    coef: np.ndarray
    cov_hc3: np.ndarray
    n: int
    rank: int
    undefined: int
    residual_sums: dict[str, float]
    condition_number: float
    frame: DataFrame = field(repr=False)

    def residuals(self) -> DataFrame:
        """The model rows with ``fitted`` and ``residual``."""
        b = F.array(*[F.lit(float(v)) for v in self.coef])
        fitted = F.aggregate(F.zip_with("x", b, lambda u, v: u * v), F.lit(0.0), lambda a, v: a + v)
        return self.frame.withColumn("fitted", fitted).withColumn("residual", F.col("y") - F.col("fitted"))

    def table(self) -> DataFrame:
        """``term, coef, std_err_hc3, z, p_value, ci_lo, ci_hi``; one row per term."""
        reach = 1.959963984540054
        rows = []
        for i, term in enumerate(self.terms):
            b, variance = float(self.coef[i]), float(self.cov_hc3[i, i])
            se = math.sqrt(variance) if variance > 0 else None
            z = b / se if se else None
            rows.append((term, b, se, z, normal_two_sided(z) if se else None,
                         b - reach * se if se else None, b + reach * se if se else None))
        return self.spark.createDataFrame(
            rows, "term string, coef double, std_err_hc3 double, z double, p_value double, "
                  "ci_lo double, ci_hi double")

    def diagnostics(self, order: Sequence[str] = ()) -> DataFrame:
        """Fit statistics, one row; Durbin-Watson needs the row order (columns kept in the frame)."""
        n, k, s = self.n, self.rank, self.residual_sums
        ssr, sst = s["e2"], s["sst"]
        r2 = 1.0 - ssr / sst
        loglik = -n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / n) + 1.0)
        skew, kurt = _shape(s, n)
        jb = n / 6.0 * (skew ** 2 + (kurt - 3.0) ** 2 / 4.0)
        omnibus = _omnibus(skew, kurt, n)
        f, f_p = self._robust_f()
        values = {
            "n_obs": float(n), "df_model": float(k - 1), "df_resid": float(n - k), "r2": r2,
            "adj_r2": 1.0 - (1.0 - r2) * (n - 1) / (n - k), "f_robust": f, "f_p": f_p,
            "log_likelihood": loglik, "aic": 2.0 * k - 2.0 * loglik, "bic": k * math.log(n) - 2.0 * loglik,
            "skew": skew, "kurtosis": kurt, "jarque_bera": jb, "jarque_bera_p": math.exp(-jb / 2.0),
            "omnibus": omnibus, "omnibus_p": None if omnibus is None else math.exp(-omnibus / 2.0),
            "condition_number": self.condition_number, "undefined_leverage": float(self.undefined),
            "durbin_watson": self._durbin_watson(order) if order else None,
        }
        return self.spark.createDataFrame([tuple(None if v is None else float(v) for v in values.values())],
                                          ", ".join(f"{c} double" for c in values))

    def _durbin_watson(self, order: Sequence[str]) -> float:
        steps = with_previous(self.residuals().select("residual", *order), order, "residual", "before")
        step = F.col("residual") - F.col("before")
        row = steps.agg((F.sum(step * step) / F.sum(F.col("residual") * F.col("residual"))).alias("dw")).first()
        return row["dw"]

    def _robust_f(self) -> tuple[float | None, float | None]:
        b, v = self.coef[1:], self.cov_hc3[1:, 1:]
        if not len(b) or not np.isfinite(v).all():
            return None, None
        q, scale = self.rank - 1, np.sqrt(np.where(np.diag(v) > 0, np.diag(v), 1.0))
        b = b / scale  # slopes differ in size by many powers of ten
        f = float(b @ np.linalg.pinv(v / np.outer(scale, scale), hermitian=True) @ b) / q
        return f, f_upper(f, q, self.n - self.rank)


def _shape(s: dict[str, float], n: int) -> tuple[float, float]:
    m = s["e1"] / n
    m2 = s["e2"] / n - m * m
    m3 = s["e3"] / n - 3 * m * s["e2"] / n + 2 * m ** 3
    m4 = s["e4"] / n - 4 * m * s["e3"] / n + 6 * m * m * s["e2"] / n - 3 * m ** 4
    return m3 / m2 ** 1.5, m4 / m2 ** 2


def _omnibus(skew: float, kurt: float, n: int) -> float | None:
    """D'Agostino-Pearson K2 from sample skewness and kurtosis."""
    if n < 8:
        return None
    y = skew * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2 * (beta2 - 1)) - 1
    z_skew = math.asinh(y / math.sqrt(2.0 / (w2 - 1))) / math.sqrt(0.5 * math.log(w2))

    mean = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (kurt - mean) / math.sqrt(var)
    root = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(
        6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / root * (2.0 / root + math.sqrt(1 + 4.0 / root ** 2))
    ratio = (1 - 2.0 / a) / (1 + x * math.sqrt(2.0 / (a - 4)))
    z_kurt = (1 - 2.0 / (9 * a) - math.copysign(abs(ratio) ** (1 / 3), ratio)) / math.sqrt(2.0 / (9 * a))
    return z_skew ** 2 + z_kurt ** 2


def fit_ols(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str] = (),
            keep: Sequence[str] = (), min_rows: int = MIN_ROWS) -> OlsFit | None:
    """Fit on the rows with a non-null ``y``; ``None`` below ``min_rows``."""
    model = design(df.where(F.col(y).isNotNull()), numeric, categorical)
    frame = model.frame(df, y, keep)
    k = len(model.terms)

    def cross_products(x: np.ndarray, t: np.ndarray) -> np.ndarray:
        return np.concatenate([(x.T @ x).ravel(), x.T @ t, [len(t), t.sum()]])

    sums = _summed(frame, cross_products, k * k + k + 2)
    gram, xty, n = sums[: k * k].reshape(k, k), sums[k * k: k * k + k], int(sums[-2])
    if n < min_rows:
        return None
    inverse, rank = _symmetric_inverse(gram)
    coef, mean_y, scale = inverse @ xty, sums[-1] / n, np.sqrt(np.diag(gram))

    def second_pass(x: np.ndarray, t: np.ndarray) -> np.ndarray:
        e = t - x @ coef
        slack = 1.0 - np.einsum("ij,jk,ik->i", x, inverse, x)
        lost = slack < MIN_SLACK
        u = e / np.where(lost, np.nan, slack)
        weighted = x * np.nan_to_num(u)[:, None]
        # a row with full leverage is fitted exactly by these terms alone
        tainted = (np.abs(x[lost] @ inverse) * scale > 1e-6).any(axis=0)
        return np.concatenate([
            (weighted.T @ weighted).ravel(), x.T @ e, tainted.astype(float),
            [e.sum(), (e ** 2).sum(), (e ** 3).sum(), (e ** 4).sum(), ((t - mean_y) ** 2).sum(), lost.sum()],
        ])

    more = _summed(frame, second_pass, k * k + 2 * k + 6)
    coef = coef + inverse @ more[k * k: k * k + k]  # one step of iterative refinement
    cov = inverse @ more[: k * k].reshape(k, k) @ inverse
    tainted = more[k * k + k: k * k + 2 * k] > 0
    cov[tainted, tainted] = np.nan
    e1, e2, e3, e4, sst, undefined = more[-6:]
    eigen = np.linalg.eigvalsh(gram)
    return OlsFit(
        spark=df.sparkSession, terms=model.terms, coef=coef, cov_hc3=cov, n=n, rank=rank,
        undefined=int(undefined), frame=frame,
        residual_sums={"e1": e1, "e2": e2, "e3": e3, "e4": e4, "sst": sst},
        condition_number=float(math.sqrt(eigen[-1] / eigen[0])) if eigen[0] > 0 else math.inf,
    )
