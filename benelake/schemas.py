"""Column sets, fixed lookup values and output contracts.

Everything here is data, not logic: the raw record layout, the decoded flag
names, the SSA state table, the age bands, and the StructTypes the marts must
match before they are written.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# ---------------------------------------------------------------------------

# Raw record: 32 text columns in file order.
ID_COLUMN = "DESYNPUF_ID"

RAW_COLUMNS: list[str] = [
    "DESYNPUF_ID",
    "BENE_BIRTH_DT",
    "BENE_DEATH_DT",
    "BENE_SEX_IDENT_CD",
    "BENE_RACE_CD",
    "BENE_ESRD_IND",
    "SP_STATE_CODE",
    "BENE_COUNTY_CD",
    "BENE_HI_CVRAGE_TOT_MONS",
    "BENE_SMI_CVRAGE_TOT_MONS",
    "BENE_HMO_CVRAGE_TOT_MONS",
    "PLAN_CVRG_MOS_NUM",
    "SP_ALZHDMTA",
    "SP_CHF",
    "SP_CHRNKIDN",
    "SP_CNCR",
    "SP_COPD",
    "SP_DEPRESSN",
    "SP_DIABETES",
    "SP_ISCHMCHT",
    "SP_OSTEOPRS",
    "SP_RA_OA",
    "SP_STRKETIA",
    "MEDREIMB_IP",
    "BENRES_IP",
    "PPPYMT_IP",
    "MEDREIMB_OP",
    "BENRES_OP",
    "PPPYMT_OP",
    "MEDREIMB_CAR",
    "BENRES_CAR",
    "PPPYMT_CAR",
]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

DATE_COLUMNS = ["BENE_BIRTH_DT", "BENE_DEATH_DT"]
MONTH_COLUMNS = [
    "BENE_HI_CVRAGE_TOT_MONS",
    "BENE_SMI_CVRAGE_TOT_MONS",
    "BENE_HMO_CVRAGE_TOT_MONS",
    "PLAN_CVRG_MOS_NUM",
]
# Negative amounts are claim adjustments: kept as they are, never clipped.
MONEY_COLUMNS = [
    "MEDREIMB_IP",
    "BENRES_IP",
    "PPPYMT_IP",
    "MEDREIMB_OP",
    "BENRES_OP",
    "PPPYMT_OP",
    "MEDREIMB_CAR",
    "BENRES_CAR",
    "PPPYMT_CAR",
]
MEDICARE_PAID = ["MEDREIMB_IP", "MEDREIMB_OP", "MEDREIMB_CAR"]
BENEFICIARY_PAID = ["BENRES_IP", "BENRES_OP", "BENRES_CAR"]

# Chronic-condition flags: raw column -> decoded column, in file order.
# Code "1" = condition present, "2" = absent.
CONDITION_FLAGS: dict[str, str] = {
    "SP_ALZHDMTA": "has_alzheimers",
    "SP_CHF": "has_chf",
    "SP_CHRNKIDN": "has_chronic_kidney_disease",
    "SP_CNCR": "has_cancer",
    "SP_COPD": "has_copd",
    "SP_DEPRESSN": "has_depression",
    "SP_DIABETES": "has_diabetes",
    "SP_ISCHMCHT": "has_ischemic_heart_disease",
    "SP_OSTEOPRS": "has_osteoporosis",
    "SP_RA_OA": "has_rheumatoid_or_osteoarthritis",
    "SP_STRKETIA": "has_stroke_or_tia",
}

# Display labels for the explorer charts.
CONDITION_DISPLAY_LABELS: dict[str, str] = {
    "has_alzheimers": "Alzheimer's / Dementia",
    "has_chf": "Congestive Heart Failure",
    "has_chronic_kidney_disease": "Chronic Kidney Disease",
    "has_cancer": "Cancer",
    "has_copd": "COPD",
    "has_depression": "Depression",
    "has_diabetes": "Diabetes",
    "has_ischemic_heart_disease": "Ischemic Heart Disease",
    "has_osteoporosis": "Osteoporosis",
    "has_rheumatoid_or_osteoarthritis": "Rheumatoid Arthritis / Osteoarthritis",
    "has_stroke_or_tia": "Stroke / TIA",
}

# SSA state codes (not FIPS): code, abbreviation, name. 40 and 48 do not
# exist; 54 is the coarsened "other/territory" bucket.
SSA_STATES: list[tuple[str, str, str]] = [
    ("01", "AL", "Alabama"),
    ("02", "AK", "Alaska"),
    ("03", "AZ", "Arizona"),
    ("04", "AR", "Arkansas"),
    ("05", "CA", "California"),
    ("06", "CO", "Colorado"),
    ("07", "CT", "Connecticut"),
    ("08", "DE", "Delaware"),
    ("09", "DC", "District of Columbia"),
    ("10", "FL", "Florida"),
    ("11", "GA", "Georgia"),
    ("12", "HI", "Hawaii"),
    ("13", "ID", "Idaho"),
    ("14", "IL", "Illinois"),
    ("15", "IN", "Indiana"),
    ("16", "IA", "Iowa"),
    ("17", "KS", "Kansas"),
    ("18", "KY", "Kentucky"),
    ("19", "LA", "Louisiana"),
    ("20", "ME", "Maine"),
    ("21", "MD", "Maryland"),
    ("22", "MA", "Massachusetts"),
    ("23", "MI", "Michigan"),
    ("24", "MN", "Minnesota"),
    ("25", "MS", "Mississippi"),
    ("26", "MO", "Missouri"),
    ("27", "MT", "Montana"),
    ("28", "NE", "Nebraska"),
    ("29", "NV", "Nevada"),
    ("30", "NH", "New Hampshire"),
    ("31", "NJ", "New Jersey"),
    ("32", "NM", "New Mexico"),
    ("33", "NY", "New York"),
    ("34", "NC", "North Carolina"),
    ("35", "ND", "North Dakota"),
    ("36", "OH", "Ohio"),
    ("37", "OK", "Oklahoma"),
    ("38", "OR", "Oregon"),
    ("39", "PA", "Pennsylvania"),
    ("41", "RI", "Rhode Island"),
    ("42", "SC", "South Carolina"),
    ("43", "SD", "South Dakota"),
    ("44", "TN", "Tennessee"),
    ("45", "TX", "Texas"),
    ("46", "UT", "Utah"),
    ("47", "VT", "Vermont"),
    ("49", "VA", "Virginia"),
    ("50", "WA", "Washington"),
    ("51", "WV", "West Virginia"),
    ("52", "WI", "Wisconsin"),
    ("53", "WY", "Wyoming"),
    ("54", "OTHER", "Other/Territory"),
]

# Age bands, upper bounds exclusive, in display order; the last band takes
# everything else, including a null age.
AGE_BANDS: list[tuple[int | None, str]] = [(65, "Under 65"), (75, "65-74"), (85, "75-84"), (None, "85+")]
AGE_BAND_LABELS = [label for _, label in AGE_BANDS]

REFERENCE_DATE = "2008-12-31"
REFERENCE_YEAR = 2008
ALL_STATES_LABEL = "All States"

# Landing gate floor for the full annual file.
MIN_EXPECTED_ROWS = 100_000
# Reconcile: Medicare-paid totals of the two paths may differ by at most this.
DEFAULT_COST_TOLERANCE = 1.00

# Accepted values of the coded columns.
ACCEPTED_SEX = [1, 2]
ACCEPTED_RACE = [1, 2, 3, 5]
ACCEPTED_ESRD = ["0", "Y"]

# ---------------------------------------------------------------------------
# Derived names (rules, not data).
# ---------------------------------------------------------------------------
FLAG_COLUMNS: list[str] = list(CONDITION_FLAGS.values())
# Condition label = decoded flag name without the "has_" prefix.
CONDITION_LABELS: dict[str, str] = {flag: flag.removeprefix("has_") for flag in FLAG_COLUMNS}

EXPLORER_COLUMNS: list[str] = [
    "desynpuf_id",
    "state_abbr",
    "state_name",
    "age_band",
    "is_deceased",
    "chronic_condition_count",
    "total_medicare_reimbursement",
    *FLAG_COLUMNS,
]

STATE_SEED_SCHEMA = T.StructType(
    [
        T.StructField("state_code", T.StringType(), True),
        T.StructField("state_abbr", T.StringType(), True),
        T.StructField("state_name", T.StringType(), True),
    ]
)


def _fields(spec: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in spec])


_S, _D, _B, _L, _F, _I = T.StringType(), T.DateType(), T.BooleanType(), T.LongType(), T.DoubleType(), T.IntegerType()

# Output contracts for the marts: names, types, and which columns must be
# non-null at write time.
DIM_BENEFICIARY_CONTRACT = _fields(
    [
        ("desynpuf_id", _S, False),
        ("birth_date", _D, True),
        ("death_date", _D, True),
        ("is_deceased", _B, True),
        ("sex_cd", _L, True),
        ("race_cd", _L, True),
        ("esrd_ind", _S, True),
        ("state_code", _S, True),
        ("state_abbr", _S, True),
        ("state_name", _S, True),
        ("age_2008", _L, True),
        ("age_band", _S, True),
        ("chronic_condition_count", _L, False),
    ]
)
FCT_ANNUAL_COST_CONTRACT = _fields(
    [
        ("desynpuf_id", _S, False),
        ("year", _L, True),
        ("medreimb_ip", _F, True),
        ("medreimb_op", _F, True),
        ("medreimb_car", _F, True),
        ("total_medicare_reimbursement", _F, False),
        ("benres_ip", _F, True),
        ("benres_op", _F, True),
        ("benres_car", _F, True),
        ("total_beneficiary_responsibility", _F, True),
    ]
)
MART_PREVALENCE_CONTRACT = _fields(
    [
        ("condition", _S, False),
        ("state_abbr", _S, True),
        ("state_name", _S, True),
        ("total_beneficiaries_in_state", _L, True),
        ("beneficiaries_with_condition", _L, True),
        ("prevalence_rate", _F, False),
        ("avg_total_cost_with_condition", _F, True),
    ]
)
MART_STATE_SUMMARY_CONTRACT = _fields(
    [
        ("state_code", _S, False),
        ("state_abbr", _S, True),
        ("state_name", _S, True),
        ("beneficiary_count", _L, False),
        ("total_medicare_reimbursement", _F, True),
        ("avg_medicare_reimbursement_per_beneficiary", _F, True),
    ]
)

MART_CONTRACTS: dict[str, T.StructType] = {
    "dim_beneficiary": DIM_BENEFICIARY_CONTRACT,
    "fct_beneficiary_annual_cost": FCT_ANNUAL_COST_CONTRACT,
    "mart_chronic_condition_prevalence": MART_PREVALENCE_CONTRACT,
    "mart_state_cost_summary": MART_STATE_SUMMARY_CONTRACT,
}
