"""Exact duplicates, with frequent texts told apart before anything is shuffled.

Texts are equal when they are identical after lower-casing A-Z only; they are compared by the SHA-256 digest of the result
in UTF-8. Digests and ids are written once, 40 bytes a row, and all that follows reads them.

1. Every task keeps a Misra-Gries summary of its digests: at most ``counters`` of them, each counted low by no more than
   1 / counters of the task's rows. Summed by digest, and the ``counters`` largest sums kept, they hold every digest that
   makes up more than 2 / counters of all rows.
2. These candidates are counted exactly, behind a map-side combine. The verified winners, with the row that stays and the
   size of the group, are at most ``counters`` rows whatever the corpus: they are broadcast, and their rows are settled where
   they were read.
3. What remains has no digest with more than 2 / counters of the rows, and is shuffled by digest in the ordinary way.

Nulls: a null text is an empty one; a null id is smaller than any other. Of rows with equal text and equal largest id, just
one is kept (which one is not told by the columns, as they are the same). Empty texts are equal to one another, very long ones
are digested whole. Extra columns are not looked at, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import settled

COUNTERS = 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str | Column = "text") -> Column:
    """A text with A-Z, and no other letter, in lower case; empty for null."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def digest(text: str | Column = "text") -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def merged(summary: Counter, more: Counter, counters: int) -> Counter:
    """A Misra-Gries summary of both: counts add up, and the first that has no place is taken off all that have one."""
    summary = summary + more
    if len(summary) <= counters:
        return summary
    least = sorted(summary.values(), reverse=True)[counters]
    return Counter({k: n - least for k, n in summary.items() if n > least})


def frequent_candidates(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests (column ``digest``), every one with more than 2 / counters of all rows among them."""

    def summaries(batches):
        summary = Counter()
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            more = Counter(dict(zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist())))
            summary = merged(summary, more, counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(summary), pa.binary()), pa.array(list(summary.values()), pa.int64())], ["digest", "n"])

    return (digests.select("digest").mapInArrow(summaries, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "digest").limit(counters).select("digest"))


def _rank() -> Column:
    return F.struct(F.col("doc_id").isNotNull(), "doc_id", "row")


def winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``digest, top (the row that stays), group_size`` of every frequent digest, counted exactly; at most ``counters`` rows."""
    candidates = F.broadcast(frequent_candidates(rows, counters))
    return settled(rows.join(candidates, "digest").groupBy("digest").agg(F.max(_rank()).alias("top"), F.count("*").alias("group_size")))


def _numbered(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, row``: written once, so that row numbers stay."""
    return settled(docs.select("doc_id", digest().alias("digest"), F.monotonically_increasing_id().alias("row")))


def exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` of every row of ``docs``; of equal texts the largest id stays."""
    rows = _numbered(docs)
    heavy = F.broadcast(winners(rows, counters))
    split = rows.join(heavy, "digest", "left")
    frequent = split.where("group_size is not null").select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("top.row")).alias("kept"), "digest")
    group = W.partitionBy("digest")
    order = group.orderBy(F.col("doc_id").desc_nulls_last(), F.col("row").desc())
    rest = split.where("group_size is null").select(
        "doc_id", F.first("doc_id").over(order).alias("keep_id"), F.count("*").over(group).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"), "digest")
    return frequent.unionAll(rest)


def keep_one(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs``, with all their columns, less the copies.

    Copies of frequent texts are left out where they are read; of other texts, each task keeps its best row of a digest
    before the shuffle.
    """
    heavy = winners(_numbered(docs), counters).select("digest", F.col("top.doc_id").alias("top"))
    alias = F.broadcast(heavy.select(F.col("digest").alias("__digest"), F.struct(F.col("top").alias("id")).alias("__top")))
    marked = docs.withColumn("__digest", digest()).join(alias, "__digest", "left")
    left = marked.where(F.col("__top").isNull() | F.col("doc_id").eqNullSafe(F.col("__top.id")))
    first = F.row_number().over(W.partitionBy("__digest").orderBy(F.col("doc_id").desc_nulls_last()))
    return left.withColumn("__place", first).where("__place = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
