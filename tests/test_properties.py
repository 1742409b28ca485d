"""Property checks against plain-Python references: exact half-up rounding
of means and rates, quantiles, cohort filter conjunction, reconcile
tolerance."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from benelake.functions import money
from benelake.operators import cohort, profiling, reconcile
from benelake.operators.quantiles import exact_quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
cents = st.integers(min_value=-500_000, max_value=500_000)


@SETTINGS
@given(st.lists(cents, min_size=1, max_size=40))
def test_money_avg_is_exact_half_up(spark, values):
    df = spark.createDataFrame([(v / 100,) for v in values], "x double")
    got = df.agg(money.money_avg("x").alias("m"), money.money_sum("x").alias("s")).first()
    exact = Decimal(sum(values)) / Decimal(100) / Decimal(len(values))
    want = float(exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    assert got["m"] == want
    assert got["s"] == float(Decimal(sum(values)) / Decimal(100))


@SETTINGS
@given(st.integers(min_value=0, max_value=10_000), st.integers(min_value=1, max_value=10_000))
def test_ratio_is_exact_half_up(spark, k, n):
    k = min(k, n)
    got = spark.range(1).select(money.ratio(F.lit(k), F.lit(n), 4).alias("r")).first()["r"]
    want = float((Decimal(k) / Decimal(n)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP))
    assert got == want


@SETTINGS
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60),
       st.lists(st.floats(min_value=0, max_value=1), min_size=1, max_size=4))
def test_exact_quantiles_property(spark, values, ps):
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    row = exact_quantiles(df, "g", "v", ps, partitions=4).first()
    want = np.quantile(np.array(values, dtype=float), ps)
    for i in range(len(ps)):
        assert row[f"q{i}"] == pytest.approx(want[i], abs=1e-9)


STATES = ["CA", "TX", None]
BANDS = ["Under 65", "65-74", "75-84", "85+"]


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(STATES), st.sampled_from(BANDS), st.booleans(),
                       st.sampled_from([True, False, None]), st.sampled_from([True, False, None])),
             min_size=1, max_size=30),
    st.lists(st.sampled_from(["CA", "TX"]), max_size=2, unique=True),
    st.lists(st.sampled_from(BANDS), max_size=2, unique=True),
    st.sampled_from(["All", "Alive", "Deceased"]),
)
def test_cohort_filter_matches_python(spark, rows, states, bands, status):
    data = [(f"id{i}", s, b, d, x, y) for i, (s, b, d, x, y) in enumerate(rows)]
    df = spark.createDataFrame(
        data, "desynpuf_id string, state_abbr string, age_band string, is_deceased boolean, "
              "has_diabetes boolean, has_chf boolean"
    )
    got = {r[0] for r in cohort.cohort_filter(df, states, bands, ["has_diabetes", "has_chf"], status)
           .select("desynpuf_id").collect()}
    want = {
        i for i, s, b, d, x, y in data
        if (not states or s in states) and (not bands or b in bands) and (bool(x) or bool(y))
        and (status == "All" or (status == "Alive" and not d) or (status == "Deceased" and d))
    }
    assert got == want


@SETTINGS
@given(st.integers(min_value=0, max_value=10**9), st.integers(min_value=-300, max_value=300))
def test_reconcile_tolerance_boundary(spark, total_cents, diff_cents):
    frame = lambda c: spark.createDataFrame([("i", c / 100)], "desynpuf_id string, total_medicare_reimbursement double")
    rows = {r["metric"]: r["ok"] for r in reconcile.report(frame(total_cents), frame(total_cents + diff_cents)).collect()}
    assert rows == {"beneficiary_count": True, "total_medicare_reimbursement": abs(diff_cents) <= 100}


def test_quantiles_without_exchange_reuse(spark):
    """Every branch reads the same ranges, whatever Spark reuses."""
    values = [float(v) for v in np.random.default_rng(8).permutation(20_000)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double").repartition(16)
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        for k in old:
            spark.conf.set(k, "false")
        row = exact_quantiles(df, "g", "v", [0.25, 0.5, 0.75]).first()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [row[f"q{i}"] for i in range(3)] == [4999.75, 9999.5, 14999.25]


def test_describe_keeps_small_values(spark):
    row = profiling.describe(spark.createDataFrame([(0.001,), (0.002,), (0.004,)], "x double"), ["x"], scale=6).first()
    assert (row["mean"], row["min"], row["p50"]) == (0.002333, 0.001, 0.002)
    large = profiling.describe(spark.createDataFrame([(2e17,), (4e17,)], "x double"), ["x"]).first()
    assert large["mean"] == 3e17


@pytest.mark.parametrize(("amounts", "total"), [([0.004] * 1000, 4.0), ([0.1, 0.2] * 500 + [1e-9], 150.000000001), ([123456789.125, -0.0005], 123456789.1245), ([None, 2.5e-12], 2.5e-12)])
def test_amounts_keep_their_own_scale(spark, raw_rows, amounts, total):
    frame = spark.createDataFrame([(f"i{k}", a) for k, a in enumerate(amounts)], "desynpuf_id string, total_medicare_reimbursement double")
    assert reconcile.path_metrics(frame).first()["total_medicare_reimbursement"] == total
    assert cohort.kpis(frame).first()["total_cost"] == total


def test_small_amounts_on_both_paths(spark, raw_rows):
    from benelake.plans import lakehouse, warehouse

    raw = raw_rows(*[{"DESYNPUF_ID": f"i{k}", "MEDREIMB_IP": "0.004", "SP_CHF": "1"} for k in range(1000)])
    silver = lakehouse.to_silver(lakehouse.to_bronze(raw))
    models = warehouse.build_from_raw(spark, raw)
    figures = reconcile.reconcile(lakehouse.gold_cost_summary(silver), models["fct_beneficiary_annual_cost"])
    assert figures["total_medicare_reimbursement"] == 4.0
    state = models["mart_state_cost_summary"].first()
    assert state["total_medicare_reimbursement"] == 4.0 and state["avg_medicare_reimbursement_per_beneficiary"] == 0.0
    mart = models["mart_chronic_condition_prevalence"].where("condition = 'chf'").collect()
    gold = lakehouse.gold_prevalence(silver).where("condition = 'chf'").collect()
    assert {r["avg_total_cost_with_condition"] for r in [*mart, *gold]} == {0.0}


def test_a_difference_just_beyond_the_tolerance_fails(spark):
    frame = lambda x: spark.createDataFrame([("i", x)], "desynpuf_id string, total_medicare_reimbursement double")
    found = {r["metric"]: r for r in reconcile.report(frame(10.0), frame(11.004)).collect()}["total_medicare_reimbursement"]
    assert (found["difference"], found["ok"]) == (1.004, False)
