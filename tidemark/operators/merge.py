"""Idempotent loads into keyed tables.

Each function returns the rows to write; Parquet has no in-place merge, so the
caller writes them to a fresh folder or appends them. Incoming batches are
usually far smaller than the table: the table's keys are first narrowed to the
batch with a semi join, which lets Spark broadcast the batch when it is small
and shuffle both sides on the key when it is not. The table is never shuffled
for the sake of a small batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.cleaning import normalise_key
from tidemark.operators.dedupe import first_non_null
from tidemark.operators.positions import with_position
from tidemark.session import settled


def new_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
             order: Sequence[str] = ()) -> DataFrame:
    """Incoming rows whose key is not stored yet, one per key (first by ``order``)."""
    keys = list(keys)
    rank = [F.asc_nulls_first(c) for c in (order or [c for c in incoming.columns if c not in keys] or keys)]
    # the batch is read once; the stored table is only narrowed to its keys
    one_each = settled(
        incoming.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*rank)))
        .where("__rank = 1").drop("__rank")
    )
    stored = existing.select(*keys).join(one_each.select(*keys), keys, "left_semi").distinct()
    return one_each.join(stored, keys, "left_anti")


def insert_only(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                order: Sequence[str] = ()) -> DataFrame:
    """The table after an insert that leaves existing keys untouched."""
    return existing.unionByName(new_rows(existing, incoming, keys, order), allowMissingColumns=True)


def upsert_fill_nulls(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                      columns: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The table after a load that fills nulls but never overwrites a value.

    Several incoming rows for one key are first folded to the first non-null
    value per column, in ``order``.
    """
    keys, columns = list(keys), list(columns)
    folded = settled(first_non_null(incoming, keys, columns, order or [F.col(c) for c in columns]))
    update = folded.withColumnsRenamed({c: f"__{c}" for c in columns})
    kept = (
        existing.join(update, keys, "left")
        .withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in columns})
        .drop(*[f"__{c}" for c in columns])
    )
    stored = existing.select(*keys).join(folded.select(*keys), keys, "left_semi")
    added = folded.join(stored, keys, "left_anti")
    return kept.unionByName(added, allowMissingColumns=True)


def assign_ids(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """``(id, *keys)`` for all keys: stored ids survive, new keys follow in key order."""
    keys = list(keys)
    new = new_rows(existing.select(*keys), incoming.select(*keys).distinct(), keys)
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).scalar()
    numbered = with_position(new, keys, "__pos").select(
        (top + 1 + F.col("__pos")).cast("long").alias(id_col), *keys)
    return existing.select(F.col(id_col).cast("long").alias(id_col), *keys).unionByName(numbered)


def lookup_key(rows: DataFrame, name_col: str, dimension: DataFrame, dimension_name: str,
               id_col: str) -> DataFrame:
    """Resolve a name to the dimension's id by its normalised form; null if unknown."""
    names = dimension.select(
        normalise_key(F.col(dimension_name)).alias("__key"), F.col(id_col).alias("__id")
    ).groupBy("__key").agg(F.min("__id").alias(id_col))
    keyed = rows.withColumn("__key", normalise_key(F.col(name_col)))
    return keyed.join(names, "__key", "left").drop("__key")


def cascade_delete(parent: DataFrame, doomed: DataFrame, key: str, children: dict[str, DataFrame],
                   below: dict[str, tuple[str, str, DataFrame]] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Remove ``doomed`` keys from the parent, from every child that refers to them, and from what refers to those.

    ``below``: name -> (name of the table it refers to, the key of that, rows); a table may refer to one named before it.
    """
    gone = doomed.select(key).distinct()
    removed = {name: child.join(gone, key, "left_semi") for name, child in children.items()}
    left = {name: child.join(gone, key, "left_anti") for name, child in children.items()}
    for name, (above, by, rows) in (below or {}).items():
        lost = removed[above].select(by).distinct()
        removed[name], left[name] = rows.join(lost, by, "left_semi"), rows.join(lost, by, "left_anti")
    return parent.join(gone, key, "left_anti"), left
