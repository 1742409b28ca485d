"""The cohort cube: the explorer's rows folded into cells that every cohort
figure can be read from.

A cell is a state, an age band, alive or deceased, and two masks over the
conditions: which are present, and which are known at all. It holds the number
of beneficiaries, of those with a cost, and the exact sum of their costs. Any
choice of states, bands, status and conditions selects whole cells, so a view of
a cohort is a filter and a sum over cells, with no row of a beneficiary and no
join. Cells add up: cubes of parts of the rows union into a cube of all.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, money
from ..schemas import FLAG_COLUMNS
from .cohort import STATUSES
from .unpivot import wide_to_long

KEYS = ["state_abbr", "state_name", "age_band", "is_deceased", "present", "known"]


def _mask(bits: list[Column]) -> Column:
    return functools.reduce(operator.add, [F.when(b, F.lit(1 << i)).otherwise(F.lit(0)) for i, b in enumerate(bits)])


def build(explorer: DataFrame, cost: str = "total_medicare_reimbursement") -> DataFrame:
    """The cells of an explorer frame: one aggregate, combined map-side."""
    present = _mask([F.coalesce(F.col(c), F.lit(False)) for c in FLAG_COLUMNS]).alias("present")
    known = _mask([F.col(c).isNotNull() for c in FLAG_COLUMNS]).alias("known")
    rows = explorer.select(*KEYS[:4], present, known, "desynpuf_id", money.as_money(cost).alias("paid"))
    return rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("beneficiaries"),
        F.count("desynpuf_id").alias("ids"),
        F.count("paid").alias("payers"),
        F.sum("paid").alias("paid"),
    )


def cells(cube: DataFrame, states: list[str] | None = None, age_bands: list[str] | None = None,
          conditions: list[str] | None = None, status: str = "All") -> DataFrame:
    """The cells of a cohort; the filters of ``cohort.cohort_filter``."""
    if status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}, got {status!r}")
    if unknown := sorted(set(conditions or []) - set(FLAG_COLUMNS)):
        raise ValueError(f"unknown condition columns: {unknown}")
    out = cube
    if states:
        out = out.filter(F.col("state_abbr").isin(list(states)))
    if age_bands:
        out = out.filter(F.col("age_band").isin(list(age_bands)))
    if conditions:
        chosen = sum(1 << FLAG_COLUMNS.index(c) for c in set(conditions))
        out = out.filter(F.col("present").bitwiseAND(F.lit(chosen)) != 0)
    if status != "All":
        out = out.filter(F.col("is_deceased") if status == "Deceased" else ~F.col("is_deceased"))
    return out


def _mean(scale: int = 2) -> Column:
    return F.round(F.try_divide(F.sum("paid"), F.sum("payers").cast("decimal(20,0)")), scale).cast("double")


def _total() -> Column:
    return F.coalesce(F.sum("paid").cast("double"), F.lit(0.0))


def kpis(cohort: DataFrame) -> DataFrame:
    """One row: beneficiaries, total cost, mean cost; 0 / 0.0 / 0.0 of none."""
    n = F.coalesce(F.sum("beneficiaries"), F.lit(0))
    return cohort.agg(n.alias("beneficiaries"), _total().alias("total_cost"), F.when(n == 0, F.lit(0.0)).otherwise(_mean()).alias("avg_cost"))


def state_table(cohort: DataFrame) -> DataFrame:
    """By-state summary, largest states first; without a state no row."""
    keyed = cohort.filter(F.col("state_abbr").isNotNull() & F.col("state_name").isNotNull())
    found = keyed.groupBy("state_abbr", "state_name").agg(F.sum("ids").alias("beneficiary_count"), _total().alias("total_cost"), _mean().alias("avg_cost"))
    return found.orderBy(F.desc("beneficiary_count"), F.asc("state_abbr"))


def prevalence(cohort: DataFrame, labelled: bool = False) -> DataFrame:
    """Share of each condition among those of whom it is known, 11 rows."""
    within = lambda mask, i: F.coalesce(F.sum(F.when(F.col(mask).bitwiseAND(F.lit(1 << i)) != 0, F.col("beneficiaries"))), F.lit(0))
    wide = cohort.agg(*[money.ratio(within("present", i), within("known", i), 4).alias(c) for i, c in enumerate(FLAG_COLUMNS)])
    long = wide_to_long(wide, FLAG_COLUMNS, "condition", "prevalence")
    return long.select(codes.display_label("condition").alias("condition"), "prevalence") if labelled else long


def condition_ranking(cohort: DataFrame) -> DataFrame:
    """Display-labelled prevalence, highest first."""
    return prevalence(cohort, labelled=True).orderBy(F.desc("prevalence"), F.asc("condition"))


def state_options(cube: DataFrame) -> DataFrame:
    """Sorted distinct non-null state abbreviations (filter choices)."""
    return cube.select("state_abbr").filter(F.col("state_abbr").isNotNull()).distinct().orderBy("state_abbr")
