"""Token-set similarity of two names, 0..100.

Tokenising, set algebra and the final arithmetic are built-in expressions.
Only the longest common subsequence of the two leftovers needs Python: Spark's
``levenshtein`` allows substitutions, which this score does not. It travels in
Arrow batches, and only pairs whose score depends on it are sent.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T


def _common_subsequence(a: str, b: str) -> int:
    """Bit-parallel LCS length; Python integers put no limit on the text length."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & where.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


@F.pandas_udf(T.IntegerType())
def _lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [None if x is None or y is None else _common_subsequence(x, y) for x, y in zip(a, b)],
        dtype="Int32",
    )


# A filter on the score would otherwise be pushed below it and evaluate the function a second time.
lcs_length = _lcs_length.asNondeterministic()


def _tokens(col: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(col, r"(?U)\s+"), lambda t: t != "")))


def with_token_set_ratio(df: DataFrame, left: Column, right: Column, name: str) -> DataFrame:
    """Add the similarity of ``left`` and ``right`` as column ``name``; null input gives 0."""
    spare = [f"__{name}_{part}" for part in ("a", "b", "both", "x", "y", "lcs")]
    a, b, both, x, y, lcs = spare
    staged = (
        df.withColumn(a, _tokens(F.coalesce(left, F.lit(""))))
        .withColumn(b, _tokens(F.coalesce(right, F.lit(""))))
        .withColumn(both, F.array_join(F.array_sort(F.array_intersect(a, b)), " "))
        .withColumn(x, F.array_join(F.array_sort(F.array_except(a, b)), " "))
        .withColumn(y, F.array_join(F.array_sort(F.array_except(b, a)), " "))
    )
    s, lx, ly = F.length(both), F.length(x), F.length(y)
    empty = (F.size(a) == 0) | (F.size(b) == 0)
    contained = (s > 0) & ((lx == 0) | (ly == 0))
    open_pair = ~empty & ~contained
    staged = staged.withColumn(lcs, lcs_length(F.when(open_pair, F.col(x)), F.when(open_pair, F.col(y))))

    gap = F.when(s > 0, 1).otherwise(0)
    sx, sy = s + gap + lx, s + gap + ly

    def score(distance: Column, total: Column) -> Column:
        return F.lit(100.0) - F.lit(100.0) * distance / total

    whole = score(lx + ly - 2 * F.col(lcs), sx + sy)
    best = F.when(
        s > 0, F.greatest(whole, score(gap + lx, s + sx), score(gap + ly, s + sy))
    ).otherwise(whole)
    ratio = F.when(empty, 0.0).when(contained, 100.0).otherwise(best)
    return staged.withColumn(name, ratio).drop(*spare)
