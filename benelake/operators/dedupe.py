"""Deduplication on a key.

All variants aggregate rather than window: a hash/sort aggregate combines
duplicates map-side before the shuffle, so a key holding a third of the rows
sends one row per map task, where a ``row_number`` window would pull every
copy of it into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, arbitrary survivor (``dropDuplicates``)."""
    return df.dropDuplicates(keys)


def dedupe_first(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key, deterministic survivor: the row that sorts first by
    ``order_by`` (default: all non-key columns, in order; nulls first).

    Implemented as ``min(struct(order_by..., rest...))`` per key - an
    aggregate with map-side combine - then unpacked.
    """
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by else rest
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in tail])
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    cols = [F.col(k) for k in keys]
    cols += [F.col(f"_best._o{order.index(c)}").alias(c) if c in order else F.col(f"_best.{c}") for c in rest]
    return best.select(*cols).select(*df.columns)


def surplus_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key (null keys form one group), as one row
    ``(rows, distinct_keys, surplus_rows)``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("long").alias("rows"),
        F.count(F.lit(1)).cast("long").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
    )
