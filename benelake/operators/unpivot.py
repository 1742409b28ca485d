"""Wide boolean flags -> long (label, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_flags(
    df: DataFrame,
    ids: list[str],
    labels: dict[str, str],
    name_col: str = "condition",
    value_col: str = "has_condition",
    drop_nulls: bool = True,
) -> DataFrame:
    """Unpivot ``labels`` (column -> label) into ``(name_col, value_col)``.

    SQL ``UNPIVOT`` drops null values, ``DataFrame.unpivot`` keeps them; the
    default here follows SQL, so a denominator counts only known flags.
    """
    renamed = df.select(*ids, *[F.col(c).alias(label) for c, label in labels.items()])
    long = renamed.unpivot(ids, list(labels.values()), name_col, value_col)
    return long.filter(F.col(value_col).isNotNull()) if drop_nulls else long


def wide_to_long(df: DataFrame, columns: list[str], name_col: str, value_col: str, ids: list[str] | None = None) -> DataFrame:
    """Turn a (typically one-row) wide aggregate into long rows."""
    return df.unpivot(ids or [], columns, name_col, value_col)
