"""Model fixtures: a few raw rows with what each model must make of them.

They run before a build, as ``jobs fixtures``; rows name only the columns that a
case is about, all others have the plain values of ``PLAIN``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import quality
from ..schemas import CONDITION_FLAGS, FLAG_COLUMNS, ID_COLUMN, MONEY_COLUMNS, MONTH_COLUMNS, RAW_SCHEMA
from . import warehouse

PLAIN = dict.fromkeys(MONEY_COLUMNS, "0.00") | dict.fromkeys(MONTH_COLUMNS, "12") | dict.fromkeys(CONDITION_FLAGS, "2")
PLAIN |= {"BENE_BIRTH_DT": "19350304", "SP_STATE_CODE": "33", "BENE_COUNTY_CD": "100", "BENE_SEX_IDENT_CD": "1", "BENE_RACE_CD": "1", "BENE_ESRD_IND": "0"}

FIRST, LAST = list(CONDITION_FLAGS)[0], list(CONDITION_FLAGS)[-1]

# model -> (raw rows, expected rows)
CASES: dict[str, tuple[list[dict], list[dict]]] = {
    "stg_beneficiary_summary": (
        [{ID_COLUMN: "p", "SP_STATE_CODE": "7", FIRST: "1"}, {ID_COLUMN: "q", "SP_STATE_CODE": "49", LAST: "1"}],
        [
            {"desynpuf_id": "p", "state_code": "07", FLAG_COLUMNS[0]: True, FLAG_COLUMNS[-1]: False},
            {"desynpuf_id": "q", "state_code": "49", FLAG_COLUMNS[0]: False, FLAG_COLUMNS[-1]: True},
        ],
    ),
    "int_beneficiary_annual_cost": (
        [{ID_COLUMN: "p", "MEDREIMB_IP": "12.5", "MEDREIMB_OP": "-2.25", "BENRES_CAR": "7"}, {ID_COLUMN: "q", "MEDREIMB_CAR": None}],
        [
            {"desynpuf_id": "p", "total_cost_2008": 10.25, "total_beneficiary_responsibility_2008": 7.0},
            {"desynpuf_id": "q", "total_cost_2008": None, "total_beneficiary_responsibility_2008": 0.0},
        ],
    ),
    "dim_beneficiary": (
        [{ID_COLUMN: "p", FIRST: "1", LAST: "1", "BENE_DEATH_DT": "20080229"}, {ID_COLUMN: "q", "BENE_BIRTH_DT": "19431231", "SP_STATE_CODE": "40"}],
        [
            {"desynpuf_id": "p", "chronic_condition_count": 2, "is_deceased": True, "age_band": "65-74", "state_abbr": "NY"},
            {"desynpuf_id": "q", "chronic_condition_count": 0, "is_deceased": False, "age_band": "65-74", "state_abbr": None},
        ],
    ),
}


def run_fixtures(spark: SparkSession) -> list[str]:
    """The models checked; raises with every difference there is."""
    wrong = []
    for name, (rows, expected) in CASES.items():
        raw = quality.fixture_frame(spark, [{**PLAIN, **r} for r in rows], RAW_SCHEMA)
        model = warehouse.build_from_raw(spark, raw)[name]
        wrong += [f"{name}: {x}" for x in quality.compare_rows(model, expected, "desynpuf_id")]
    if wrong:
        raise quality.DataQualityError("model fixtures differ:\n" + "\n".join(wrong))
    return list(CASES)
