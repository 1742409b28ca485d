"""Cohort filtering and the explorer's aggregate views.

Filters are plain predicates merged by Catalyst and pushed into the scan
where the source allows; every view is a small aggregate, so nothing
beneficiary-grain leaves the cluster.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, money
from .unpivot import wide_to_long
from ..schemas import FLAG_COLUMNS

STATUSES = ("All", "Alive", "Deceased")


def cohort_filter(
    df: DataFrame,
    states: list[str] | None = None,
    age_bands: list[str] | None = None,
    conditions: list[str] | None = None,
    status: str = "All",
) -> DataFrame:
    """Conjunction of optional filters; an empty list means no filter.
    ``conditions`` keeps rows with any of the chosen flags true (a null flag
    counts as false)."""
    if status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}, got {status!r}")
    out = df
    if states:
        out = out.filter(F.col("state_abbr").isin(list(states)))
    if age_bands:
        out = out.filter(F.col("age_band").isin(list(age_bands)))
    if conditions:
        unknown = sorted(set(conditions) - set(FLAG_COLUMNS))
        if unknown:
            raise ValueError(f"unknown condition columns: {unknown}")
        out = out.filter(functools.reduce(operator.or_, [F.coalesce(F.col(c), F.lit(False)) for c in conditions]))
    if status == "Alive":
        out = out.filter(~F.col("is_deceased"))
    elif status == "Deceased":
        out = out.filter(F.col("is_deceased"))
    return out


def kpis(cohort: DataFrame, cost: str = "total_medicare_reimbursement") -> DataFrame:
    """One row: beneficiaries, total cost, mean cost. An empty cohort gives
    0 / 0.0 / 0.0 (Spark's empty sum and mean are null)."""
    n = F.count(F.lit(1))
    return cohort.agg(
        n.alias("beneficiaries"),
        F.coalesce(money.money_sum(cost), F.lit(0.0)).alias("total_cost"),
        F.when(n == 0, F.lit(0.0)).otherwise(money.money_avg(cost)).alias("avg_cost"),
    )


def state_table(cohort: DataFrame, cost: str = "total_medicare_reimbursement") -> DataFrame:
    """By-state summary; rows with a null state key are dropped (as the
    explorer's group-by does), largest states first."""
    keyed = cohort.filter(F.col("state_abbr").isNotNull() & F.col("state_name").isNotNull())
    return (
        keyed.groupBy("state_abbr", "state_name")
        .agg(
            F.count("desynpuf_id").alias("beneficiary_count"),
            F.coalesce(money.money_sum(cost), F.lit(0.0)).alias("total_cost"),
            money.money_avg(cost).alias("avg_cost"),
        )
        .orderBy(F.desc("beneficiary_count"), F.asc("state_abbr"))
    )


def prevalence(cohort: DataFrame, labelled: bool = False) -> DataFrame:
    """Mean of each flag over the cohort (nulls skipped), as 11 long rows:
    one wide aggregate, then unpivot of the single row."""
    wide = cohort.agg(
        *[money.ratio(F.sum(F.col(c).cast("int")), F.count(F.col(c)), 4).alias(c) for c in FLAG_COLUMNS]
    )
    long = wide_to_long(wide, FLAG_COLUMNS, "condition", "prevalence")
    if labelled:
        long = long.select(codes.display_label("condition").alias("condition"), "prevalence")
    return long


def condition_ranking(cohort: DataFrame) -> DataFrame:
    """Display-labelled prevalence, highest first (chart order)."""
    return prevalence(cohort, labelled=True).orderBy(F.desc("prevalence"), F.asc("condition"))


def state_options(df: DataFrame) -> DataFrame:
    """Sorted distinct non-null state abbreviations (filter choices)."""
    return df.select("state_abbr").filter(F.col("state_abbr").isNotNull()).distinct().orderBy("state_abbr")


def kpi_display(kpi_row: DataFrame) -> DataFrame:
    """KPI card text: thousands separators, whole dollars (the numeric
    columns stay numeric in ``kpis``; this is presentation only)."""
    return kpi_row.select(
        F.format_number("beneficiaries", 0).alias("beneficiaries"),
        F.concat(F.lit("$"), F.format_number("total_cost", 0)).alias("total_cost"),
        F.concat(F.lit("$"), F.format_number("avg_cost", 0)).alias("avg_cost"),
    )
