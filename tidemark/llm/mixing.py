"""Mixing sources to target weights by fitting the remaining budget exactly.

Every source gets a target number of words by weight, at most ``max_repeats`` times what it has; what a capped source
leaves over goes to the others by weight (a water level: target = min(cap, level x weight)). Whole passes over a source
are taken first. For the rest, documents are counted by exact length; most of the budget is filled in proportion to the
counts, and a bounded knapsack over the lengths hits what remains to the word where any subset does. While it falls short,
filled documents are given back and the knapsack gets twice the words, up to the whole budget, at any size; its memory
grows with those words, or with the number of subsets where there are few documents. Within a length,
documents are picked in the order of a seeded hash of their id, so reruns agree.

Nulls: a null text has length 0, a null source is a source of its own (the last), a null id is hashed like a value.
Empty texts are kept with nothing taken. Repeated rows are separate documents. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.text import WORD
from tidemark.session import settled

_CELLS = 1024  # parts of a length's documents, by hash: only the part at the cut is ranked
_RESERVE = 1 << 16  # words left to the knapsack
_SUBSETS = 1 << 20  # up to so many subsets are summed one by one


def word_count(text: str | Column = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeats: int) -> DataFrame:
    """One row per source (``key``): ``source_size``, ``target``. ``sizes``: key, source, size."""
    per = sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    everything = W.partitionBy()  # one row per source
    place = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    per = per.withColumn("cap", (max_repeats * F.col("source_size")).cast("double"))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "key")
    full = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_cap.rowsBetween(0, W.unboundedFollowing))
    total = share * F.sum("source_size").over(everything)
    # the level if all sources before this one are at their caps; the first level that its source can bear holds
    level = (total - full) / open_weight
    per = per.withColumn("level", level)
    holds = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "key", "level")))
    held = holds.over(everything)["level"]
    return per.select("key", "source_size", F.coalesce(F.least("cap", held * F.col("weight")), F.col("cap")).alias("target"))


def fit_subset(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the lengths sum to the budget, or to the most below it that the
    knapsack reaches. ``lengths`` are distinct and positive; at most ``counts`` of each are taken."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    budget = max(0, min(int(budget), total))
    if budget == total:
        return counts.copy()
    unit = int(np.gcd.reduce(lengths[counts > 0]))
    lengths, budget = lengths // unit, budget // unit
    if np.log2(counts + 1.0).sum() <= np.log2(_SUBSETS):
        return _all_subsets(lengths, counts, budget)
    reserve, best, least = _RESERVE, None, budget + 1
    while True:
        taken, left = _filled(lengths, counts, budget, reserve if best is not None else 0, reserve)
        short = left - _knapsack(lengths, counts, taken, left)
        if short < least:
            best, least = taken, short
        if not least or left == budget:  # met, or the whole budget was the knapsack's
            return best
        reserve *= 2


def _filled(lengths: np.ndarray, counts: np.ndarray, budget: int, back: int, reserve: int) -> tuple[np.ndarray, int]:
    """Documents for ``budget`` less ``back`` in proportion to the counts, then long ones first, and what is left of the
    budget for the knapsack."""
    taken = (counts * (max(0, budget - back) / int((lengths * counts).sum()))).astype(np.int64)
    left = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths) if back < budget else ():
        if left <= reserve:
            break
        more = min(int(counts[i] - taken[i]), max(0, (left - reserve // 2) // int(lengths[i])))
        taken[i] += more
        left -= more * int(lengths[i])
    return taken, left


def _all_subsets(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """The best subset of few documents, whatever their lengths: all sums up to the budget, length by length."""
    sums = [np.zeros(1, np.int64)]
    for step, n in zip(lengths, counts):
        more = np.unique(sums[-1][:, None] + step * np.arange(n + 1))
        sums.append(more[more <= budget])
    taken, r = np.zeros_like(counts), int(sums[-1][-1])
    for i in range(len(lengths) - 1, -1, -1):
        before = r - lengths[i] * np.arange(counts[i] + 1)
        taken[i] = int(np.flatnonzero(np.isin(before, sums[i]))[0])
        r = int(before[taken[i]])
    return taken


def _knapsack(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, budget: int) -> int:
    """Add documents to ``taken``, up to ``counts``, for the largest sum of lengths up to the budget; returns that sum."""
    # which[r]: the length that first reached the sum r; its predecessor was reached by other lengths
    which = np.full(budget + 1, -1, np.int32)
    used = np.zeros(budget + 1, np.int32)
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    for i in np.argsort(-lengths):
        step, room = int(lengths[i]), int(counts[i] - taken[i])
        if step > budget or not room:
            continue
        front = reached.copy()
        for n in range(1, min(room, budget // step) + 1):
            moved = np.zeros_like(reached)
            moved[step:] = front[:-step]
            front = moved & ~reached
            if not front.any():
                break
            which[front], used[front] = i, n
            reached |= front
        if reached[budget]:
            break
    r = best = int(np.flatnonzero(reached)[-1])
    while r:
        i, n = which[r], used[r]
        taken[i] += n
        r -= int(n * lengths[i])
    return best


def _fit(hist: pd.DataFrame) -> pd.DataFrame:
    hist = hist.sort_values("size")
    size, budget = int(hist["source_size"].iloc[0]), int(round(hist["target"].iloc[0]))
    passes = min(budget // size, budget)
    taken = fit_subset(hist["size"].to_numpy(), hist["n"].to_numpy(), budget - passes * size)
    return pd.DataFrame({"key": hist["key"], "size": hist["size"], "passes": passes, "more": taken})


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0, max_repeats: int = 3,
        seed: int = 17) -> DataFrame:
    """One row per document: ``doc_id, tkey`` (a hash of the text), ``source, size, source_size, target, repeats, taken``
    (words taken, repeats counted).

    Sources in code point order, null last, take the weights in turn; together they are to hold ``share`` of all words.
    No document is taken more than ``max_repeats`` times.
    """
    sizes = settled(docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
        word_count().alias("size"), F.xxhash64(F.lit(seed), "doc_id").alias("draw"), F.xxhash64("text").alias("tkey"),
    ).withColumn("cell", F.pmod("draw", F.lit(_CELLS)).cast("int")))
    targets = settled(source_targets(sizes, weights, share, max_repeats))
    cells = settled(sizes.where("size > 0").groupBy("key", "size", "cell").agg(F.count("*").alias("n")))
    hist = cells.groupBy("key", "size").agg(F.sum("n").alias("n")).join(targets, "key")
    plan = hist.groupBy("key").applyInPandas(_fit, "key string, size long, passes long, more long")
    before = F.coalesce(F.sum("n").over(
        W.partitionBy("key", "size").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = cells.join(plan, ["key", "size"]).select(
        "key", "size", "cell", "passes", "n", (F.col("more") - before).alias("room"))
    placed = sizes.join(cut, ["key", "size", "cell"], "left")
    at_cut = (F.col("room") > 0) & (F.col("room") < F.col("n"))
    rank = F.row_number().over(W.partitionBy("key", "size", "cell", "at_cut").orderBy("draw", "doc_id"))
    inside = placed.withColumn("at_cut", F.coalesce(at_cut, F.lit(False)))
    ranked = inside.where("at_cut").withColumn("more", (rank <= F.col("room")).cast("long"))
    whole = inside.where("not at_cut").withColumn("more", F.coalesce((F.col("room") >= F.col("n")).cast("long"), F.lit(0)))
    repeats = F.coalesce(F.col("passes"), F.lit(0)) + F.col("more")
    return ranked.unionByName(whole).join(targets, "key").select(
        "doc_id", "tkey", "source", "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents with all their columns, as often as the mix takes them."""
    key = ["doc_id", "source", "tkey"]
    taken = mix(docs, **how).groupBy(*key).agg(F.sum("repeats").alias("__times"), F.count("*").alias("__rows"))
    taken = settled(taken.where("__times > 0").select(*[F.col(c).alias(f"__{c}") for c in key], "__times", "__rows"))
    own = docs.withColumn("__text", F.xxhash64("text"))
    found = own.join(taken, own["doc_id"].eqNullSafe(taken["__doc_id"]) & own["source"].eqNullSafe(taken["__source"])
                     & (own["__text"] == taken["__tkey"]))
    # equal rows share their copies; only they are ranked
    nth = F.row_number().over(W.partitionBy("__doc_id", "__source", "__tkey").orderBy("__tkey"))
    several = found.where("__rows > 1").withColumn("__nth", nth)
    each = F.floor(F.col("__times") / F.col("__rows")) + (F.col("__nth") <= F.col("__times") % F.col("__rows")).cast("long")
    copies = found.where("__rows = 1").select(*docs.columns, F.col("__times").alias("__copies")).unionAll(
        several.select(*docs.columns, each.alias("__copies")))
    return copies.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
