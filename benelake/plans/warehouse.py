"""Warehouse path: raw load -> staging -> intermediate -> marts, as Spark SQL.

Written independently of ``plans.lakehouse`` (own decode, own state seed as a
joined table, own age rule) so that reconciling the two paths means
something. A model's SQL names its inputs by placeholders that are bound to
frames, never to names of the session; ``plans.pipeline`` saves the marts as
tables and keeps the other models as views of a namespace.

Plan notes for scale:
* the marts' joins are equi-joins on the unique beneficiary id (uniqueness is
  a checked test), so no join key is skewed; in the pipeline the typed raw
  table they all derive from is bucketed by the id, so the joins need no
  exchange at all (``plans.pipeline.run_warehouse``).
* the state seed is 52 rows, fixed by definition - the only broadcast.
* the prevalence mart joins at beneficiary grain and aggregates per state
  before it unpivots some 53 rows: no row of a beneficiary is expanded.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (
    AGE_BANDS,
    ALL_STATES_LABEL,
    CONDITION_FLAGS,
    CONDITION_LABELS,
    FLAG_COLUMNS,
    MONEY_COLUMNS,
    RAW_COLUMNS,
    REFERENCE_YEAR,
    SSA_STATES,
    STATE_SEED_SCHEMA,
)
from ..sinks.writers import replace_table

# Column types the warehouse's type-inferring load gives the raw file: codes,
# dates and counts become integers (dropping the zero of "05"), amounts
# floats, the id and the Y/0 indicator text.
_TEXT_AFTER_LOAD = {"DESYNPUF_ID", "BENE_ESRD_IND"}
# Text whatever the data holds: a file without a "Y" still has an indicator.
PINNED_TYPES = dict.fromkeys(_TEXT_AFTER_LOAD, "string")


def load_types() -> dict[str, str]:
    return {
        c: ("string" if c in _TEXT_AFTER_LOAD else "double" if c in MONEY_COLUMNS else "bigint")
        for c in RAW_COLUMNS
    }


def inferred_load(raw: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Raw text -> the typed table of an inferring load (strict casts).
    ``types`` are those found in the data (``sources.infer``); by default the
    ones that the annual file has."""
    types = types or load_types()
    return raw.select(*[F.col(c).cast(types[c]).alias(c) for c in RAW_COLUMNS])


def state_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SSA_STATES, STATE_SEED_SCHEMA)


_FLAG_SQL = ",\n    ".join(f"({raw} = 1) AS {flag}" for raw, flag in CONDITION_FLAGS.items())
_MONEY_SQL = ",\n    ".join(f"CAST({c} AS DOUBLE) AS {c.lower()}" for c in MONEY_COLUMNS)

STAGING_SQL = f"""
SELECT
    DESYNPUF_ID AS desynpuf_id,
    to_date(CAST(BENE_BIRTH_DT AS STRING), 'yyyyMMdd') AS birth_date,
    to_date(CAST(BENE_DEATH_DT AS STRING), 'yyyyMMdd') AS death_date,
    CAST(BENE_SEX_IDENT_CD AS BIGINT) AS sex_cd,
    CAST(BENE_RACE_CD AS BIGINT) AS race_cd,
    BENE_ESRD_IND AS esrd_ind,
    lpad(CAST(SP_STATE_CODE AS STRING), 2, '0') AS state_code,
    CAST(BENE_COUNTY_CD AS BIGINT) AS county_cd,
    CAST(BENE_HI_CVRAGE_TOT_MONS AS BIGINT) AS hi_coverage_months,
    CAST(BENE_SMI_CVRAGE_TOT_MONS AS BIGINT) AS smi_coverage_months,
    CAST(BENE_HMO_CVRAGE_TOT_MONS AS BIGINT) AS hmo_coverage_months,
    CAST(PLAN_CVRG_MOS_NUM AS BIGINT) AS plan_coverage_months,
    {_FLAG_SQL},
    {_MONEY_SQL}
FROM {{raw}}
"""

_UNPIVOT_IN = ",\n        ".join(f"{flag} AS {label}" for flag, label in CONDITION_LABELS.items())

INT_CONDITIONS_SQL = f"""
SELECT desynpuf_id, state_code, condition, has_condition
FROM (SELECT desynpuf_id, state_code, {", ".join(FLAG_COLUMNS)} FROM {{stg}})
UNPIVOT EXCLUDE NULLS (
    has_condition FOR condition IN (
        {_UNPIVOT_IN}
    )
)
"""

INT_ANNUAL_COST_SQL = """
SELECT
    desynpuf_id,
    medreimb_ip,
    medreimb_op,
    medreimb_car,
    medreimb_ip + medreimb_op + medreimb_car AS total_cost_2008,
    benres_ip,
    benres_op,
    benres_car,
    benres_ip + benres_op + benres_car AS total_beneficiary_responsibility_2008
FROM {stg}
"""

_COUNT_SQL = " + ".join(f"CAST({flag} AS BIGINT)" for flag in FLAG_COLUMNS)

_AGE = f"{REFERENCE_YEAR} - year(b.birth_date)"
_BAND = "CASE " + " ".join(f"WHEN {_AGE} < {upper} THEN '{label}'" for upper, label in AGE_BANDS[:-1]) + f" ELSE '{AGE_BANDS[-1][1]}' END"

# One row per beneficiary: staging with its state's names, age and band.
DIM_SQL = f"""
SELECT /*+ BROADCAST(s) */
    b.desynpuf_id,
    b.birth_date,
    b.death_date,
    isnotnull(b.death_date) AS is_deceased,
    CAST(b.sex_cd AS BIGINT) AS sex_cd,
    CAST(b.race_cd AS BIGINT) AS race_cd,
    b.esrd_ind,
    b.state_code,
    s.state_abbr,
    s.state_name,
    CAST({_AGE} AS BIGINT) AS age_2008,
    {_BAND} AS age_band,
    {_COUNT_SQL} AS chronic_condition_count
FROM {{stg}} AS b
LEFT JOIN {{ssa}} AS s USING (state_code)
"""

FCT_SQL = """
SELECT
    desynpuf_id,
    CAST(2008 AS BIGINT) AS year,
    medreimb_ip,
    medreimb_op,
    medreimb_car,
    total_cost_2008 AS total_medicare_reimbursement,
    benres_ip,
    benres_op,
    benres_car,
    total_beneficiary_responsibility_2008 AS total_beneficiary_responsibility
FROM {cost}
"""

# The decimal of 15 digits that an amount stands for, exact to add up.
_PAID = "CASE WHEN total_cost_2008 IS NOT NULL THEN CAST(format_string('%.14e', total_cost_2008) AS DECIMAL(38,18)) END AS paid"

MART_STATE_SUMMARY_SQL = f"""
SELECT
    b.state_code,
    b.state_abbr,
    b.state_name,
    COUNT(*) AS beneficiary_count,
    CAST(SUM(cost.paid) AS DOUBLE) AS total_medicare_reimbursement,
    CAST(ROUND(try_divide(SUM(cost.paid), CAST(COUNT(cost.paid) AS DECIMAL(20,0))), 2) AS DOUBLE)
        AS avg_medicare_reimbursement_per_beneficiary
FROM {{dim}} AS b
LEFT JOIN (SELECT desynpuf_id, {_PAID} FROM {{cost}}) AS cost ON b.desynpuf_id = cost.desynpuf_id
GROUP BY b.state_code, b.state_abbr, b.state_name
"""

_KNOWN = ",\n        ".join(
    f"COUNT(s.{flag}) AS known_{flag}, COUNT_IF(s.{flag}) AS with_{flag}, "
    f"SUM(CASE WHEN s.{flag} THEN c.paid END) AS paid_{flag}, "
    f"COUNT(CASE WHEN s.{flag} THEN c.paid END) AS payers_{flag}"
    for flag in FLAG_COLUMNS
)
_STACK = ", ".join(f"'{label}', known_{flag}, with_{flag}, paid_{flag}, payers_{flag}" for flag, label in CONDITION_LABELS.items())

# One aggregate per state over the beneficiaries, without expanding them; the
# conditions and the total over all states come from its few rows.
MART_PREVALENCE_SQL = f"""
WITH by_state AS (
    SELECT
        d.state_abbr,
        d.state_name,
        {_KNOWN}
    FROM {{stg}} AS s
    LEFT JOIN {{dim}} AS d ON s.desynpuf_id = d.desynpuf_id
    LEFT JOIN (SELECT desynpuf_id, {_PAID} FROM {{cost}}) AS c ON s.desynpuf_id = c.desynpuf_id
    GROUP BY d.state_abbr, d.state_name
),
by_condition AS (
    SELECT state_abbr, state_name, t.*
    FROM by_state
    LATERAL VIEW stack({len(FLAG_COLUMNS)}, {_STACK}) t AS condition, known, positive, paid, payers
    WHERE t.known > 0
)
SELECT
    condition,
    CASE WHEN grouping(state_abbr) = 0 THEN state_abbr END AS state_abbr,
    CASE WHEN grouping(state_name) = 1 THEN '{ALL_STATES_LABEL}' ELSE state_name END AS state_name,
    SUM(known) AS total_beneficiaries_in_state,
    SUM(positive) AS beneficiaries_with_condition,
    CAST(ROUND(try_divide(CAST(SUM(positive) AS DECIMAL(30,4)), CAST(SUM(known) AS DECIMAL(20,0))), 4) AS DOUBLE)
        AS prevalence_rate,
    CAST(ROUND(try_divide(SUM(paid), CAST(SUM(payers) AS DECIMAL(20,0))), 2) AS DOUBLE)
        AS avg_total_cost_with_condition
FROM by_condition
GROUP BY GROUPING SETS ((condition, state_abbr, state_name), (condition))
"""

# Each model's SQL and the models that its placeholders stand for.
MODELS: dict[str, tuple[str, dict[str, str]]] = {
    "stg_beneficiary_summary": (STAGING_SQL, {"raw": "raw"}),
    "int_beneficiary_chronic_conditions": (INT_CONDITIONS_SQL, {"stg": "stg_beneficiary_summary"}),
    "int_beneficiary_annual_cost": (INT_ANNUAL_COST_SQL, {"stg": "stg_beneficiary_summary"}),
    "dim_beneficiary": (DIM_SQL, {"stg": "stg_beneficiary_summary", "ssa": "ssa_state_codes"}),
    "fct_beneficiary_annual_cost": (FCT_SQL, {"cost": "int_beneficiary_annual_cost"}),
    "mart_state_cost_summary": (MART_STATE_SUMMARY_SQL, {"dim": "dim_beneficiary", "cost": "int_beneficiary_annual_cost"}),
    "mart_chronic_condition_prevalence": (
        MART_PREVALENCE_SQL,
        {"stg": "stg_beneficiary_summary", "dim": "dim_beneficiary", "cost": "int_beneficiary_annual_cost"},
    ),
}
VIEW_NAMES = ["stg_beneficiary_summary", "int_beneficiary_chronic_conditions", "int_beneficiary_annual_cost"]
MART_NAMES = ["dim_beneficiary", "fct_beneficiary_annual_cost", "mart_state_cost_summary", "mart_chronic_condition_prevalence"]
MODEL_NAMES = ["ssa_state_codes", *MODELS]


class Models(Mapping):
    """Model name -> DataFrame, each bound to the frames that it reads: two
    builds in one session do not see each other. A model is analysed on first
    access. ``given`` frames (a raw table, written marts) take the place of
    their model."""

    def __init__(self, spark: SparkSession, **given: DataFrame):
        self._spark = spark
        self._built = dict(given)
        self._published: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name == "ssa_state_codes":
                self._built[name] = state_seed(self._spark)
            else:
                text, reads = MODELS[name]
                self._built[name] = self._spark.sql(text, **{k: self[m] for k, m in reads.items()})
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(MODEL_NAMES)

    def __len__(self) -> int:
        return len(MODEL_NAMES)

    def having(self, **given: DataFrame) -> Models:
        """The same inputs with ``given`` marts in place of their models."""
        fixed = ("raw", "ssa_state_codes", *VIEW_NAMES)
        kept = {k: v for k, v in self._built.items() if k in fixed or k in self._published}
        out = Models(self._spark, **{**kept, **given})
        out._published = self._published | set(given)
        return out


def register_models(spark: SparkSession, loaded_raw: DataFrame, seed: DataFrame | None = None) -> Models:
    """The models over ``loaded_raw``, the typed raw table (``inferred_load``),
    and the states of ``seed`` (by default the built-in ones)."""
    return Models(spark, raw=loaded_raw, **({"ssa_state_codes": seed} if seed is not None else {}))


def build_from_raw(spark: SparkSession, raw_text: DataFrame) -> Models:
    """Convenience: raw text -> inferred load -> all models."""
    return register_models(spark, inferred_load(raw_text))


def create_views(spark: SparkSession, namespace: str, raw_table: str, seed: DataFrame | None = None) -> None:
    """Keep the seed as a table, and staging and the intermediate models as
    views of ``namespace`` over ``raw_table``, for other sessions to read."""
    replace_table((seed if seed is not None else state_seed(spark)).coalesce(1), f"{namespace}.ssa_state_codes")
    for name in VIEW_NAMES:
        text, reads = MODELS[name]
        tables = {k: raw_table if m == "raw" else f"{namespace}.{m}" for k, m in reads.items()}
        spark.sql(f"CREATE OR REPLACE VIEW {namespace}.{name} AS {text.format(**tables)}")


def catalog_models(spark: SparkSession, namespace: str) -> Models:
    """The models as an earlier session left them in ``namespace``."""
    return Models(spark, **{name: spark.table(f"{namespace}.{name}") for name in MODEL_NAMES})
