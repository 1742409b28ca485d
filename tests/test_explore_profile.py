"""Explorer loader and views, histogram step rule, profiling, sampling,
column tests."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from benelake.operators import cohort, cube, dedupe, histogram, profiling, quality, sampling
from benelake.plans import explore, sample, warehouse
from benelake.sources.adapter import member_raw

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    raw = member_raw(spark, SF).persist()
    models = warehouse.build_from_raw(spark, raw)
    ex_raw = explore.load_explorer(spark, "raw", raw=raw)
    ex_marts = explore.load_explorer(spark, "marts", models=models)
    return raw, models, ex_raw, ex_marts


def test_both_sources_same_frame(frames):
    raw, _, ex_raw, ex_marts = frames
    assert ex_raw.columns == ex_marts.columns and len(ex_raw.columns) == 18
    assert ex_raw.count() == raw.count()
    assert ex_raw.exceptAll(ex_marts).count() == 0 and ex_marts.exceptAll(ex_raw).count() == 0


def test_two_builds_in_one_session_do_not_mix(spark):
    small = warehouse.build_from_raw(spark, member_raw(spark, SF))
    large = warehouse.build_from_raw(spark, member_raw(spark, "/root/testdata/sf0.01"))
    assert (small["dim_beneficiary"].count(), large["dim_beneficiary"].count()) == (150, 1500)
    assert small["mart_state_cost_summary"].agg(F.sum("beneficiary_count")).first()[0] == 150


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="no explorer source"):
        explore.load_explorer(spark, "snowflake")


def test_env_default(spark, frames, monkeypatch):
    raw = frames[0]
    monkeypatch.setenv(explore.SOURCE_ENV, "raw")
    assert explore.load_explorer(spark, raw=raw).count() == raw.count()


def test_valid_bands(frames):
    bands = {r[0] for r in frames[3].select("age_band").distinct().collect()}
    assert bands <= {"Under 65", "65-74", "75-84", "85+"}


def test_cohort_cascade(frames):
    ex = frames[3]
    one_state = cohort.cohort_filter(ex, states=["CA"])
    dead = cohort.cohort_filter(ex, states=["CA"], status="Deceased")
    assert ex.count() >= one_state.count() >= dead.count()
    assert all(r["is_deceased"] for r in dead.collect())


def test_empty_cohort_kpis(frames):
    r = cohort.kpis(cohort.cohort_filter(frames[3], states=["OTHER"])).first()
    assert (r["beneficiaries"], r["total_cost"], r["avg_cost"]) == (0, 0.0, 0.0)


def test_condition_any_of(frames):
    ex = frames[3]
    got = cohort.cohort_filter(ex, conditions=["has_diabetes", "has_chf"]).count()
    want = ex.filter(F.coalesce("has_diabetes", F.lit(False)) | F.coalesce("has_chf", F.lit(False))).count()
    assert got == want


def test_bad_status(frames):
    with pytest.raises(ValueError):
        cohort.cohort_filter(frames[3], status="Sick")


def test_state_table_drops_null_keys(frames):
    t = cohort.state_table(frames[3]).collect()
    assert all(r["state_abbr"] is not None for r in t)
    assert [r["beneficiary_count"] for r in t] == sorted((r["beneficiary_count"] for r in t), reverse=True)


def test_histogram_rule(spark):
    df = spark.createDataFrame([(float(x),) for x in range(0, 1001)], "v double")
    h = histogram.histogram(df, "v", 40).orderBy("bin_start").collect()
    step = h[0]["bin_end"] - h[0]["bin_start"]
    # 0..1000 in steps of 25 needs 41 aligned bins, so the next rung (50) is used
    assert step == 50.0 and len(h) <= 40 and sum(r["count"] for r in h) == 1001
    odd = spark.createDataFrame([(float(x),) for x in range(3, 44)], "v double")
    ho = histogram.histogram(odd, "v", 40).collect()
    assert len(ho) <= 40 and sum(r["count"] for r in ho) == 41
    neg = spark.createDataFrame([(-3.0,), (7.0,)], "v double")
    assert histogram.histogram(neg, "v", 40).agg(F.sum("count")).first()[0] == 2


def test_histogram_empty(spark):
    df = spark.createDataFrame([], "v double")
    assert histogram.histogram(df, "v", 40).count() == 0


def test_profile_null_counts(frames):
    nulls = {r["column_name"]: r["null_count"] for r in profiling.null_counts(frames[0]).collect()}
    assert "DESYNPUF_ID" not in nulls and nulls.get("BENE_DEATH_DT", 0) > 0


def test_describe_interpolates(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)], "v double")
    r = profiling.describe(df, ["v"]).first()
    assert (r["p25"], r["p50"], r["p75"]) == (2.25, 4.5, 6.75)
    assert (r["count"], r["mean"], r["min"], r["max"]) == (10, 4.5, 0.0, 9.0)


def test_flag_prevalence_null_differs(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "f string")
    raw_share = df.agg(F.avg(F.coalesce(F.col("f") == "1", F.lit(False)).cast("int"))).first()[0]
    decoded = df.agg(F.avg((F.col("f") == "1").cast("int"))).first()[0]
    assert raw_share == pytest.approx(1 / 3) and decoded == 0.5


def test_sample_is_reproducible(frames):
    raw = frames[0]
    a = sample.generate_sample(raw).collect()
    b = sample.generate_sample(raw).collect()
    assert a == b
    per_state = sample.stratified_part(raw).groupBy("SP_STATE_CODE").count().collect()
    assert all(r["count"] <= 6 for r in per_state)
    ids = [r["DESYNPUF_ID"] for r in a]
    assert len(ids) == len(set(ids))


def test_stratified_plan_limits_before_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    plan = sampling.stratified(df, "g", "id", 6)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dedupe_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (2, "c", 1.0)], "k int, s string, v double")
    got = sorted(tuple(r) for r in dedupe.dedupe_first(df, ["k"]).collect())
    assert got == [(1, "a", 9.0), (2, "c", 1.0)]
    s = dedupe.surplus_duplicates(df, ["k"]).first()
    assert (s["rows"], s["distinct_keys"], s["surplus_rows"]) == (3, 2, 1)


def test_column_tests(spark):
    child = spark.createDataFrame([(1, "x"), (2, "y"), (2, None), (None, "z"), (9, "x")], "k int, v string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    suite = quality.run_suite([
        quality.not_null(child, "k", "c"),
        quality.unique(child, "k", "c"),
        quality.accepted_values(child, "v", ["x", "y"], "c"),
        quality.relationships(child, "k", parent, "k", "c"),
    ])
    got = {r["test"]: r["failures"] for r in suite.collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_values": 1, "relationships": 1}
    with pytest.raises(quality.DataQualityError):
        quality.raise_on_failures(suite)


def test_model_fixture_compare(spark):
    from benelake.schemas import RAW_SCHEMA

    fx = quality.fixture_frame(spark, [{"DESYNPUF_ID": "a", "SP_STATE_CODE": "5"}], RAW_SCHEMA)
    assert fx.first()["BENE_BIRTH_DT"] is None
    assert quality.compare_rows(fx, [{"DESYNPUF_ID": "a", "SP_STATE_CODE": "5"}], "DESYNPUF_ID") == []


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_exact_quantiles_match_numpy(spark, partitions):
    import numpy as np

    from benelake.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(7)
    groups = {
        "ties": rng.integers(0, 5, 300).astype(float),
        "hot": np.concatenate([np.full(200, 42.0), rng.normal(0, 10, 400).round(2)]),
        "single": np.array([3.5]),
        "pair": np.array([1.0, 2.0]),
        "wide": rng.normal(100, 50, 1000).round(2),
    }
    rows = [(g, float(v)) for g, vals in groups.items() for v in vals] + [("ties", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, "g", "v", ps, partitions=partitions).collect()}
    for g, vals in groups.items():
        want = np.quantile(vals, ps)
        for i, p in enumerate(ps):
            assert got[g][f"q{i}"] == pytest.approx(want[i], abs=1e-9), (g, p)


@pytest.mark.parametrize("which", [2, 3])
def test_explorer_deceased_count_matches_raw(frames, which):
    raw, ex = frames[0], frames[which]
    assert ex.filter("is_deceased").count() == raw.filter(F.col("BENE_DEATH_DT").isNotNull()).count()


@pytest.mark.parametrize("which", [2, 3])
def test_explorer_row_recomputed_from_raw(frames, which):
    from benelake.schemas import CONDITION_FLAGS

    raw, ex = frames[0], frames[which]
    first = raw.orderBy("DESYNPUF_ID").first()
    row = ex.filter(F.col("desynpuf_id") == first["DESYNPUF_ID"]).first()
    if all(first[c] is not None for c in CONDITION_FLAGS):
        assert row["chronic_condition_count"] == sum(first[c] == "1" for c in CONDITION_FLAGS)
    want = float(first["MEDREIMB_IP"]) + float(first["MEDREIMB_OP"]) + float(first["MEDREIMB_CAR"])
    assert row["total_medicare_reimbursement"] == pytest.approx(want)
    assert row["is_deceased"] == (first["BENE_DEATH_DT"] is not None)


COHORTS = [
    {}, {"states": ["CA", "TX"]}, {"age_bands": ["65-74", "85+"]}, {"conditions": ["has_diabetes", "has_chf"]}, {"conditions": ["has_stroke_or_tia"]},
    {"status": "Alive"}, {"states": ["CA", "FL", "IL"], "age_bands": ["Under 65"], "conditions": ["has_cancer"], "status": "Deceased"}, {"states": ["OTHER"]},
]


@pytest.mark.parametrize("chosen", COHORTS)
def test_every_figure_from_the_cube_is_the_row_level_one(frames, chosen, spark):
    ex = frames[2].withColumn("total_medicare_reimbursement", F.when(F.col("desynpuf_id") != "Customer#000000007", F.col("total_medicare_reimbursement")))
    rows, cells = cohort.cohort_filter(ex, **chosen), cube.cells(cube.build(ex), **chosen)
    for of in ("kpis", "state_table", "prevalence", "condition_ranking", "state_options"):
        assert getattr(cube, of)(cells).collect() == getattr(cohort, of)(rows).collect(), of


def test_cubes_of_parts_add_up(frames):
    ex = frames[3]
    parts = cube.build(ex.where("age_band = '85+'")).unionByName(cube.build(ex.where("age_band <> '85+'")))
    assert cube.kpis(parts).collect() == cube.kpis(cube.build(ex)).collect()
    with pytest.raises(ValueError, match="unknown condition"):
        cube.cells(parts, conditions=["has_nothing"])
    with pytest.raises(ValueError, match="status"):
        cube.cells(parts, status="Sick")


def plain_histogram(values, max_bins):
    import math

    lo, hi = min(values), max(values)
    span = (hi - lo) or abs(lo) or 1.0
    base = 10.0 ** math.floor(math.log10(span / max_bins))
    step = next(s for s in (base * m for m in histogram.LADDER) if math.floor(hi / s) - math.floor(lo / s) + 1 <= max_bins)
    bins = {}
    for v in values:
        bins[math.floor(v / step)] = bins.get(math.floor(v / step), 0) + 1
    return {(b * step, (b + 1) * step): n for b, n in bins.items()}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("partitions", [1, 7])
def test_ladders_fold_into_the_same_bins(spark, seed, partitions, monkeypatch):
    import numpy as np

    r = np.random.default_rng(seed)
    values = np.round(r.normal(100.0 * seed, 10.0 ** r.integers(0, 6, 30_000)), 2).tolist() + [-250_000.0 * seed] * 100
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").repartition(partitions)
    got = {(x["bin_start"], x["bin_end"]): x["count"] for x in histogram.histogram(df, "v", 40).collect()}
    assert got == plain_histogram(values, 40) and len(got) <= 40


def test_ladder_keeps_few_counts():
    import numpy as np

    r = np.random.default_rng(9)
    parts = [r.normal(0, 10.0**k, 5000) for k in range(-3, 9)]
    ladder = histogram.Ladder()
    for p in parts:
        ladder.add(p)
        assert len(ladder.at) <= 2 * histogram.CELLS
    assert ladder.counts.sum() == 60_000
    whole = np.unique(np.floor(np.concatenate(parts) / 10.0**ladder.power))
    assert ladder.at.tolist() == whole.tolist()
