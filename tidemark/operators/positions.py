"""Global row positions and neighbours without a single-task window.

The rows are range-sorted and written to the shared folder; partitions of the
written copy are ordered and stable, so position = rows in earlier partitions +
place within the partition. The per-partition counts, one row per partition,
are the only thing every task needs to know.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.session import checkpointed

_BLOCK = 1 << 16


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the global order (which must be total)."""
    settled = checkpointed(df.orderBy(*order)).withColumn("__mid", F.monotonically_increasing_id())
    settled = settled.withColumn("__part", F.shiftright("__mid", 33))
    counts = settled.groupBy("__part").agg(F.count("*").alias("__n"))
    # one row per partition of the sorted copy
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (
        settled.join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__mid", "__part", "__start")
    )


def with_previous(df: DataFrame, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Add the value of the globally preceding row.

    Positions are cut into fixed blocks; the last row of a block is also sent to
    the next one, so a plain ``lag`` inside blocks sees every neighbour.
    """
    placed = with_position(df, order, "__pos").withColumn("__block", F.floor(F.col("__pos") / _BLOCK))
    last_of_block = (F.col("__pos") % _BLOCK) == _BLOCK - 1
    blocks = F.when(last_of_block, F.array(F.col("__block"), F.col("__block") + 1)).otherwise(
        F.array("__block"))
    copies = placed.withColumn("__in", F.explode(blocks))
    neighbour = F.lag(value).over(W.partitionBy("__in").orderBy("__pos"))
    return (
        copies.withColumn(name, neighbour)
        .where("__in = __block")
        .drop("__pos", "__block", "__in")
    )
