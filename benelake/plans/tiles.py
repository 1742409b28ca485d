"""Fixed dashboard tiles over the marts. Every tile is a small aggregate of a
mart (<= 583 rows in) or of the beneficiary-grain dim/fct with partial
aggregation before its one shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, money
from ..operators.unpivot import wide_to_long
from ..schemas import ALL_STATES_LABEL


def scorecards(state_summary: DataFrame) -> DataFrame:
    """Total beneficiaries, total Medicare-paid cost, and the ratio of sums
    (not a mean of state means)."""
    n = F.sum("beneficiary_count")
    total = F.sum(money.as_money("total_medicare_reimbursement"))
    return state_summary.agg(
        n.cast("long").alias("total_beneficiaries"),
        total.cast("double").alias("total_medicare_reimbursement"),
        F.round(F.try_divide(total, n.cast("decimal(20,0)")), 2).cast("double").alias("avg_cost_per_beneficiary"),
    )


def geo(state_summary: DataFrame) -> DataFrame:
    """Beneficiaries by state name (map tile)."""
    return state_summary.groupBy("state_name").agg(F.sum("beneficiary_count").cast("long").alias("beneficiary_count"))


def _overall(prevalence: DataFrame) -> DataFrame:
    return prevalence.filter(F.col("state_name") == ALL_STATES_LABEL)


def prevalence_rank(prevalence: DataFrame) -> DataFrame:
    return _overall(prevalence).select("condition", "prevalence_rate").orderBy(
        F.desc("prevalence_rate"), F.asc("condition")
    )


def avg_cost_rank(prevalence: DataFrame) -> DataFrame:
    return _overall(prevalence).select("condition", "avg_total_cost_with_condition").orderBy(
        F.desc_nulls_last("avg_total_cost_with_condition"), F.asc("condition")
    )


def condition_count_distribution(dim: DataFrame) -> DataFrame:
    return dim.groupBy("chronic_condition_count").agg(F.count(F.lit(1)).alias("beneficiaries")).orderBy(
        "chronic_condition_count"
    )


def cost_mix_source(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """fct x dim on the beneficiary id (the cost-mix data source)."""
    return fct.select("desynpuf_id", "medreimb_ip", "medreimb_op", "medreimb_car", "total_medicare_reimbursement").join(
        dim.select("desynpuf_id", "age_band"), "desynpuf_id", "inner"
    )


def cost_mix(source: DataFrame) -> DataFrame:
    """IP / OP / carrier split as ``(component, amount)`` rows."""
    parts = {"inpatient": "medreimb_ip", "outpatient": "medreimb_op", "carrier": "medreimb_car"}
    wide = source.agg(*[money.money_sum(c).alias(k) for k, c in parts.items()])
    return wide_to_long(wide, list(parts), "component", "amount")


def cost_by_band(source: DataFrame) -> DataFrame:
    """Medicare-paid total by age band, in band order (not alphabetical)."""
    agg = source.groupBy("age_band").agg(money.money_sum("total_medicare_reimbursement").alias("total_medicare_reimbursement"))
    return agg.withColumn("band_order", codes.age_band_sort_key("age_band")).orderBy("band_order")
