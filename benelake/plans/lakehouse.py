"""Lakehouse path: raw -> bronze -> silver -> gold, in the DataFrame API.

Each step is a pure ``DataFrame -> DataFrame`` function; I/O lives in
``plans.pipeline``. Column derivations are batched into single
``withColumns``/``select`` projections so analysis stays linear and the whole
row pipeline sits in one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates, money
from ..operators.dedupe import dedupe_any, dedupe_first
from ..operators.prevalence import prevalence_by_group
from ..schemas import (
    BENEFICIARY_PAID,
    CONDITION_FLAGS,
    CONDITION_LABELS,
    DATE_COLUMNS,
    FLAG_COLUMNS,
    ID_COLUMN,
    MEDICARE_PAID,
    MONEY_COLUMNS,
    MONTH_COLUMNS,
)


def to_bronze(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Type the raw text: 2 dates, 4 ints, 9 doubles, plus ``_ingested_at``.
    Strict (ANSI) casts by default: a malformed value fails the job."""
    typed = {c: dates.parse_date(c, strict) for c in DATE_COLUMNS}
    cast = (lambda c, t: F.col(c).cast(t)) if strict else (lambda c, t: F.col(c).try_cast(t))
    typed.update({c: cast(c, "int") for c in MONTH_COLUMNS})
    typed.update({c: cast(c, "double") for c in MONEY_COLUMNS})
    typed["_ingested_at"] = F.current_timestamp()
    return raw.withColumns(typed)


def enrich(df: DataFrame) -> DataFrame:
    """Silver columns on a bronze-typed frame (no dedupe)."""
    birth = F.col("BENE_BIRTH_DT")
    age = dates.age_exact(birth)
    derived = {
        "birth_date": birth,
        "death_date": F.col("BENE_DEATH_DT"),
        "age_2008": age,
        "age_band": codes.age_band(age),
        "is_deceased": F.col("BENE_DEATH_DT").isNotNull(),
        "state_abbr": codes.state_lookup("SP_STATE_CODE", "abbr"),
        "state_name": codes.state_lookup("SP_STATE_CODE", "name"),
    }
    derived.update({flag: codes.flag_from_text(raw) for raw, flag in CONDITION_FLAGS.items()})
    derived["chronic_condition_count"] = codes.count_true(
        [codes.flag_from_text(raw) for raw in CONDITION_FLAGS]
    )
    return df.withColumns(derived)


def to_silver(bronze: DataFrame, stable: bool = True) -> DataFrame:
    """Dedupe on the beneficiary id (before the projections: fewer columns in
    the aggregate), then decode and enrich. Of a duplicated id the copy that
    sorts first over all columns survives, the same on every run and layout;
    ``stable=False`` keeps any copy."""
    if stable:
        # Order copies by their data columns; the ingest instant is carried.
        order = [c for c in bronze.columns if c not in (ID_COLUMN, "_ingested_at")]
        return enrich(dedupe_first(bronze, [ID_COLUMN], order))
    return enrich(dedupe_any(bronze, [ID_COLUMN]))


def gold_cost_summary(silver: DataFrame) -> DataFrame:
    """One row per beneficiary; Medicare-paid and beneficiary-paid totals
    kept apart."""
    return silver.select(
        F.col(ID_COLUMN).alias("desynpuf_id"),
        "state_abbr",
        "state_name",
        "age_band",
        "chronic_condition_count",
        "is_deceased",
        F.col("MEDREIMB_IP").alias("medreimb_ip"),
        F.col("MEDREIMB_OP").alias("medreimb_op"),
        F.col("MEDREIMB_CAR").alias("medreimb_car"),
        money.total(*MEDICARE_PAID).alias("total_medicare_reimbursement"),
        F.col("BENRES_IP").alias("benres_ip"),
        F.col("BENRES_OP").alias("benres_op"),
        F.col("BENRES_CAR").alias("benres_car"),
        money.total(*BENEFICIARY_PAID).alias("total_beneficiary_responsibility"),
    )


def gold_prevalence(silver: DataFrame) -> DataFrame:
    """Condition x state prevalence: one aggregate per state, then one row per
    condition; only state-grain partial rows are shuffled."""
    base = silver.select("state_abbr", "state_name", money.total(*MEDICARE_PAID).alias("total_medicare_reimbursement"), *FLAG_COLUMNS)
    return prevalence_by_group(base, ["state_abbr", "state_name"], CONDITION_LABELS, "total_medicare_reimbursement")


def ordered_prevalence(prevalence: DataFrame) -> DataFrame:
    """The prevalence table in report order (a saved table keeps no order,
    so order on read)."""
    return prevalence.orderBy(F.asc("condition"), F.asc_nulls_first("state_abbr"))
