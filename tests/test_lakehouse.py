"""Bronze / silver / gold cases (the reference's transform tests plus the
semantics it implies but does not test)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from benelake.plans import lakehouse
from benelake.schemas import FLAG_COLUMNS


def _silver(raw):
    return lakehouse.to_silver(lakehouse.to_bronze(raw))


def test_bronze_types(raw_rows):
    b = lakehouse.to_bronze(raw_rows())
    types = dict(b.dtypes)
    assert types["BENE_BIRTH_DT"] == "date" and types["BENE_HI_CVRAGE_TOT_MONS"] == "int"
    assert types["MEDREIMB_IP"] == "double" and types["_ingested_at"] == "timestamp"
    r = b.first()
    assert r["BENE_BIRTH_DT"] == dt.date(1931, 7, 9)
    assert r["BENE_DEATH_DT"] is None
    assert r["BENE_HI_CVRAGE_TOT_MONS"] == 12
    assert isinstance(r["MEDREIMB_IP"], float)
    assert r["_ingested_at"] is not None


def test_age_and_band(raw_rows):
    r = _silver(raw_rows()).first()
    assert (r["age_2008"], r["age_band"]) == (77, "75-84")


@pytest.mark.parametrize(
    "birth,age,band",
    [
        ("19601231", 48, "Under 65"),
        ("19431231", 65, "65-74"),
        ("19331231", 75, "75-84"),
        ("19201231", 88, "85+"),
        ("19440101", 64, "Under 65"),
        ("19340101", 74, "65-74"),
        ("19240101", 84, "75-84"),
        ("19231231", 85, "85+"),
    ],
)
def test_band_edges(raw_rows, birth, age, band):
    r = _silver(raw_rows({"BENE_BIRTH_DT": birth})).first()
    assert (r["age_2008"], r["age_band"]) == (age, band)


def test_deceased(raw_rows):
    s = _silver(raw_rows({"DESYNPUF_ID": "A"}, {"DESYNPUF_ID": "B", "BENE_DEATH_DT": "20080615"}))
    got = {r["DESYNPUF_ID"]: r["is_deceased"] for r in s.collect()}
    assert got == {"A": False, "B": True}


def test_flags_and_count(raw_rows):
    r = _silver(raw_rows({"SP_DIABETES": "1", "SP_CHF": "1", "SP_CNCR": "2"})).first()
    assert (r["has_diabetes"], r["has_chf"], r["has_cancer"]) == (True, True, False)
    assert r["chronic_condition_count"] == 2


def test_flag_count_four(raw_rows):
    r = _silver(raw_rows({"SP_ALZHDMTA": "1", "SP_COPD": "1", "SP_OSTEOPRS": "1", "SP_STRKETIA": "1"})).first()
    assert r["chronic_condition_count"] == 4


def test_state_lookup(raw_rows):
    s = _silver(raw_rows({"DESYNPUF_ID": "A", "SP_STATE_CODE": "05"}, {"DESYNPUF_ID": "B", "SP_STATE_CODE": "54"}))
    got = {r["DESYNPUF_ID"]: (r["state_abbr"], r["state_name"]) for r in s.collect()}
    assert got == {"A": ("CA", "California"), "B": ("OTHER", "Other/Territory")}


def test_unknown_state_kept_with_null_labels(raw_rows):
    r = _silver(raw_rows({"SP_STATE_CODE": "40"})).first()
    assert (r["state_abbr"], r["state_name"]) == (None, None)


def test_negative_money_kept(raw_rows):
    r = _silver(raw_rows({"MEDREIMB_IP": "-3000.00"})).first()
    assert r["MEDREIMB_IP"] == -3000.0


def test_dedupe(raw_rows):
    assert _silver(raw_rows({}, {})).count() == 1


def test_hand_checked_row(raw_rows):
    row = {
        "BENE_BIRTH_DT": "19110801",
        "SP_STATE_CODE": "25",
        "SP_ALZHDMTA": "1",
        "SP_CHF": "1",
        "SP_COPD": "1",
        "SP_DEPRESSN": "1",
        "SP_DIABETES": "1",
        "SP_ISCHMCHT": "1",
        "MEDREIMB_IP": "5060.00",
        "MEDREIMB_OP": "730.00",
        "MEDREIMB_CAR": "2820.00",
    }
    s = _silver(raw_rows(row))
    r = s.first()
    assert (r["age_2008"], r["age_band"], r["is_deceased"]) == (97, "85+", False)
    assert (r["state_abbr"], r["state_name"]) == ("MS", "Mississippi")
    assert r["chronic_condition_count"] == 6 and r["has_cancer"] is False
    g = lakehouse.gold_cost_summary(s).first()
    assert g["total_medicare_reimbursement"] == 8610.0


def test_null_flag_gives_null_count(raw_rows):
    r = _silver(raw_rows({"SP_CHF": None})).first()
    assert r["has_chf"] is None and r["chronic_condition_count"] is None


def test_null_birth_falls_to_last_band(raw_rows):
    r = _silver(raw_rows({"BENE_BIRTH_DT": None})).first()
    assert r["age_2008"] is None and r["age_band"] == "85+"


def test_null_money_gives_null_total(raw_rows):
    g = lakehouse.gold_cost_summary(_silver(raw_rows({"MEDREIMB_OP": None}))).first()
    assert g["total_medicare_reimbursement"] is None


def test_other_flag_code_is_false(raw_rows):
    r = _silver(raw_rows({"SP_CHF": "9"})).first()
    assert r["has_chf"] is False


@pytest.mark.parametrize("col,value", [("BENE_BIRTH_DT", "1940-03-15"), ("BENE_HI_CVRAGE_TOT_MONS", "12.0"),
                                       ("MEDREIMB_IP", "x")])
def test_malformed_values_fail(raw_rows, col, value):
    with pytest.raises(PySparkException):
        lakehouse.to_bronze(raw_rows({col: value})).collect()


def test_lenient_cast_opt_in(raw_rows):
    r = lakehouse.to_bronze(raw_rows({"MEDREIMB_IP": "x"}), strict=False).first()
    assert r["MEDREIMB_IP"] is None


def test_prevalence_drops_null_flags(raw_rows):
    s = _silver(
        raw_rows(
            {"DESYNPUF_ID": "A", "SP_CHF": "1", "MEDREIMB_IP": "100.00"},
            {"DESYNPUF_ID": "B", "SP_CHF": None, "MEDREIMB_IP": "50.00"},
            {"DESYNPUF_ID": "C", "SP_CHF": "2"},
        )
    )
    g = lakehouse.gold_prevalence(s).filter(F.col("condition") == "chf").first()
    assert g["total_beneficiaries_in_state"] == 2
    assert g["beneficiaries_with_condition"] == 1
    assert g["prevalence_rate"] == 0.5
    assert g["avg_total_cost_with_condition"] == 100.0
    other = lakehouse.gold_prevalence(s).filter(F.col("condition") == "cancer").first()
    assert other["total_beneficiaries_in_state"] == 3


def test_silver_column_count(raw_rows):
    assert len(_silver(raw_rows()).columns) == 52
    assert all(c in _silver(raw_rows()).columns for c in FLAG_COLUMNS)


def test_stable_dedupe_keeps_first_copy(raw_rows):
    raw = raw_rows({"MEDREIMB_IP": "9.00"}, {"MEDREIMB_IP": "1.00"}, {"DESYNPUF_ID": "other"})
    s = lakehouse.to_silver(lakehouse.to_bronze(raw), stable=True)
    got = {r["DESYNPUF_ID"]: r["MEDREIMB_IP"] for r in s.collect()}
    assert got == {"T-77": 1.0, "other": 0.0}
    assert s.columns == _silver(raw).columns
    ts = {r["_ingested_at"] for r in s.collect()}
    assert len(ts) == 1 and None not in ts
