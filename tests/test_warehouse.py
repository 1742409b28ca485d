"""Warehouse model cases: staging decode, cost sums, dim counts, marts and
their contracts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from benelake.operators import quality
from benelake.plans import warehouse
from benelake.schemas import ALL_STATES_LABEL, FLAG_COLUMNS, MART_CONTRACTS, RAW_COLUMNS

SP = RAW_COLUMNS[12:23]


def _models(spark, raw):
    return warehouse.build_from_raw(spark, raw)


def test_staging_all_yes_all_no(spark, raw_rows):
    raw = raw_rows(
        {"DESYNPUF_ID": "Y", "BENE_BIRTH_DT": "19430501", "SP_STATE_CODE": "5", **{c: "1" for c in SP}},
        {"DESYNPUF_ID": "N", "BENE_BIRTH_DT": "19201231", "BENE_DEATH_DT": "20081101", "SP_STATE_CODE": "45",
         **{c: "2" for c in SP}},
    )
    stg = {r["desynpuf_id"]: r for r in _models(spark, raw)["stg_beneficiary_summary"].collect()}
    y, n = stg["Y"], stg["N"]
    assert (y["birth_date"], y["death_date"], y["state_code"]) == (dt.date(1943, 5, 1), None, "05")
    assert all(y[f] is True for f in FLAG_COLUMNS)
    assert (n["birth_date"], n["death_date"], n["state_code"]) == (dt.date(1920, 12, 31), dt.date(2008, 11, 1), "45")
    assert all(n[f] is False for f in FLAG_COLUMNS)


def test_staging_interleaved(spark, raw_rows):
    raw = raw_rows({"SP_STATE_CODE": "10", **{c: ("1" if i % 2 == 0 else "2") for i, c in enumerate(SP)}})
    r = _models(spark, raw)["stg_beneficiary_summary"].first()
    assert [r[f] for f in FLAG_COLUMNS] == [i % 2 == 0 for i in range(11)]
    assert r["state_code"] == "10"


def test_cost_sums(spark, raw_rows):
    raw = raw_rows(
        {"DESYNPUF_ID": "a", "MEDREIMB_IP": "1000.25", "MEDREIMB_OP": "200.5", "MEDREIMB_CAR": "30.75",
         "BENRES_IP": "100", "BENRES_OP": "20", "BENRES_CAR": "3"},
        {"DESYNPUF_ID": "b", "MEDREIMB_IP": "-500", "MEDREIMB_OP": "0", "MEDREIMB_CAR": "120",
         "BENRES_IP": "0", "BENRES_OP": "0", "BENRES_CAR": "40"},
        {"DESYNPUF_ID": "c"},
    )
    got = {r["desynpuf_id"]: (r["total_cost_2008"], r["total_beneficiary_responsibility_2008"])
           for r in _models(spark, raw)["int_beneficiary_annual_cost"].collect()}
    assert got == {"a": (1231.5, 123.0), "b": (-380.0, 40.0), "c": (0.0, 0.0)}


def test_dim_counts(spark, raw_rows):
    raw = raw_rows(
        {"DESYNPUF_ID": "z", "SP_STATE_CODE": "05"},
        {"DESYNPUF_ID": "t", "SP_STATE_CODE": "45", "BENE_DEATH_DT": "20080615", "SP_CHF": "1", "SP_COPD": "1",
         "SP_CNCR": "1"},
        {"DESYNPUF_ID": "e", "SP_STATE_CODE": "05", **{c: "1" for c in SP}},
    )
    dim = {r["desynpuf_id"]: r for r in _models(spark, raw)["dim_beneficiary"].collect()}
    assert [dim[k]["chronic_condition_count"] for k in "zte"] == [0, 3, 11]
    assert [dim[k]["is_deceased"] for k in "zte"] == [False, True, False]
    assert [dim[k]["state_abbr"] for k in "zte"] == ["CA", "TX", "CA"]


@pytest.mark.parametrize("birth,age,band", [("19440101", 64, "Under 65"), ("19431231", 65, "65-74"),
                                            ("19340101", 74, "65-74"), ("19331231", 75, "75-84"),
                                            ("19240101", 84, "75-84"), ("19231231", 85, "85+")])
def test_dim_band_edges(spark, raw_rows, birth, age, band):
    r = _models(spark, raw_rows({"BENE_BIRTH_DT": birth}))["dim_beneficiary"].first()
    assert (r["age_2008"], r["age_band"]) == (age, band)


def test_marts_match_contracts(spark, raw_rows):
    m = _models(spark, raw_rows())
    for name, contract in MART_CONTRACTS.items():
        quality.check_contract(m[name], contract, name)


def test_contract_violation_detected(spark, raw_rows):
    m = _models(spark, raw_rows())
    bad = m["mart_state_cost_summary"].withColumn("beneficiary_count", F.col("beneficiary_count").cast("int"))
    with pytest.raises(quality.ContractViolation):
        quality.check_contract(bad, MART_CONTRACTS["mart_state_cost_summary"], "mart_state_cost_summary")


def test_prevalence_overall_rows(spark):
    from benelake.sources.adapter import member_raw

    prev = _models(spark, member_raw(spark, "/root/testdata/sf0.001"))["mart_chronic_condition_prevalence"]
    rows = prev.collect()
    overall = {r["condition"]: r for r in rows if r["state_name"] == ALL_STATES_LABEL}
    assert len(overall) == 11 and all(r["state_abbr"] is None for r in overall.values())
    by_state = [r for r in rows if r["state_name"] != ALL_STATES_LABEL]
    for cond, o in overall.items():
        parts = [r for r in by_state if r["condition"] == cond]
        assert sum(r["total_beneficiaries_in_state"] for r in parts) == o["total_beneficiaries_in_state"]
        assert sum(r["beneficiaries_with_condition"] for r in parts) == o["beneficiaries_with_condition"]
        assert o["beneficiaries_with_condition"] <= o["total_beneficiaries_in_state"]


def test_null_state_group_is_not_overall(spark, raw_rows):
    # An unknown state gives a by-state group with null labels; the overall
    # row is told apart by grouping(), not by the null.
    raw = raw_rows({"DESYNPUF_ID": "a", "SP_STATE_CODE": "40"}, {"DESYNPUF_ID": "b", "SP_STATE_CODE": "05"})
    prev = _models(spark, raw)["mart_chronic_condition_prevalence"].filter(F.col("condition") == "chf").collect()
    names = sorted((r["state_name"] or "<null>") for r in prev)
    assert names == ["<null>", ALL_STATES_LABEL, "California"]


def test_state_summary_totals(spark, raw_rows):
    raw = raw_rows({"DESYNPUF_ID": "a", "MEDREIMB_IP": "10.01"}, {"DESYNPUF_ID": "b", "MEDREIMB_IP": "10.00"})
    r = _models(spark, raw)["mart_state_cost_summary"].first()
    assert (r["beneficiary_count"], r["total_medicare_reimbursement"]) == (2, 20.01)
    # 20.01 / 2 = 10.005: half-up on the exact decimal.
    assert r["avg_medicare_reimbursement_per_beneficiary"] == 10.01


def test_contract_names_types_and_nulls(spark, raw_rows):
    m = _models(spark, raw_rows())
    quality.check_contract(m["mart_state_cost_summary"], MART_CONTRACTS["mart_state_cost_summary"], "s")
    nulls = m["dim_beneficiary"].withColumn("chronic_condition_count", F.lit(None).cast("bigint"))
    with pytest.raises(quality.DataQualityError, match="chronic_condition_count"):
        quality.raise_on_failures(quality.contract_not_null(nulls, MART_CONTRACTS["dim_beneficiary"], "dim_beneficiary"))
