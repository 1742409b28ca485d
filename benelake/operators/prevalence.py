"""Prevalence of conditions by group, without expanding the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money


def prevalence_by_group(df: DataFrame, keys: list[str], labels: dict[str, str], cost: str) -> DataFrame:
    """``condition``, the keys, and per condition and group: rows with a known
    flag, rows that have it, their rate (4 dp) and mean cost (2 dp).

    ``labels`` maps flag columns to condition names. All flags are counted in
    one aggregate per group; its few rows are then turned into one row per
    condition. Groups without a known flag have no row, as unpivoting the
    flags and dropping nulls would give."""
    columns = []
    df = df.withColumn("_paid", money.as_money(cost))
    for flag in labels:
        paid = F.when(F.col(flag), F.col("_paid"))
        columns += [
            F.count(flag).alias(f"known_{flag}"),
            F.count_if(F.col(flag)).alias(f"with_{flag}"),
            F.sum(paid).alias(f"paid_{flag}"),
            F.count(paid).alias(f"payers_{flag}"),
        ]
    each = [
        F.struct(F.lit(label).alias("condition"), *[F.col(f"{k}_{flag}").alias(k) for k in ("known", "with", "paid", "payers")])
        for flag, label in labels.items()
    ]
    grouped = df.groupBy(*keys).agg(*columns)
    long = grouped.select(*keys, F.inline(F.array(*each))).where("known > 0")
    return long.select(
        "condition",
        *keys,
        F.col("known").alias("total_beneficiaries_in_state"),
        F.col("with").alias("beneficiaries_with_condition"),
        money.ratio(F.col("with"), F.col("known"), 4).alias("prevalence_rate"),
        F.round(F.try_divide("paid", F.col("payers").cast("decimal(20,0)")), 2).cast("double").alias("avg_total_cost_with_condition"),
    )
