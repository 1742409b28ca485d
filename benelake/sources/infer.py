"""Types of text columns, found by one aggregate over all rows of all files.

The types form a chain: nothing but nulls, whole numbers, numbers, text. Each
value has the least type that reads it, a column the greatest of its values', so
parts of the rows, or files, are merged by taking the greater of two. Columns
whose type must not hang on the data are pinned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The chain, and what a column without values is read as.
CHAIN = ("void", "bigint", "double", "string")
NO_VALUES = "bigint"


def type_ranks(raw: DataFrame, columns: list[str]) -> DataFrame:
    """One row: for each column the place of its type in ``CHAIN``."""
    ranks = []
    for c in columns:
        x = F.col(f"`{c}`")
        rank = F.when(x.isNull(), 0).when(x.try_cast("bigint").isNotNull(), 1).when(x.try_cast("double").isNotNull(), 2).otherwise(3)
        ranks.append(F.coalesce(F.max(rank), F.lit(0)).alias(c))
    return raw.agg(*ranks)


def infer_types(raw: DataFrame, columns: list[str], pinned: dict[str, str] | None = None) -> dict[str, str]:
    """The type of each of the text ``columns``; ``pinned`` ones as they say."""
    pinned = pinned or {}
    open_ = [c for c in columns if c not in pinned]
    found = type_ranks(raw, open_).first().asDict() if open_ else {}
    return {c: pinned.get(c) or (CHAIN[found[c]] if found[c] else NO_VALUES) for c in columns}
