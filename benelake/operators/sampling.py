"""Reproducible samples without randomness: rows are ranked by an md5 of
``id || ':' || seed`` (ties by id), so the same input always gives the same
sample on any cluster layout, and an SQL engine can reproduce it.

``stratified`` keeps up to n rows per group with ``row_number() <= n``.
Catalyst turns that filter into a WindowGroupLimit that runs *before* the
shuffle as well as after, so each map task sends at most n rows per group:
a group holding a third of all rows costs n rows per task, not a third of
the table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SEED = 42


def sample_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def stratified(df: DataFrame, group: str, id_col: str, n: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """Up to ``n`` rows per non-null ``group``."""
    w = Window.partitionBy(group).orderBy(sample_key(id_col, seed), F.col(id_col))
    ranked = df.filter(F.col(group).isNotNull()).withColumn("_rn", F.row_number().over(w))
    return ranked.filter(F.col("_rn") <= n).drop("_rn")


def fixed_size(df: DataFrame, id_col: str, n: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """``n`` rows of ``df`` (all if fewer): a top-k, partial per task."""
    return df.orderBy(sample_key(id_col, seed), F.col(id_col)).limit(n)


def combine(parts: list[DataFrame], id_col: str, seed: int = DEFAULT_SEED + 1) -> DataFrame:
    """Union the parts, keep the first occurrence of each id (earlier part
    wins), and order rows by an md5 of the id with a second seed."""
    tagged = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    w = Window.partitionBy(id_col).orderBy("_part")
    first = union.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_part")
    return first.orderBy(sample_key(id_col, seed), F.col(id_col))
