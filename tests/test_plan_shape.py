"""Structural guards on physical plans: no cross joins or nested-loop joins,
no window without a partition key, ratio-of-sums scorecards, and shuffle-free
joins between the bucketed pipeline tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from benelake.operators import quality
from benelake.plans import explore, pipeline, tiles, warehouse
from benelake.queries import QUERIES
from benelake.sources.adapter import member_raw

SF = "/root/testdata/sf0.001"
FORBIDDEN = {
    "cartesian": r"CartesianProduct",
    "nested_loop": r"BroadcastNestedLoopJoin",
    "unpartitioned_window": r"Window \[[^\]]*\], \[\]",
    "collect": r"collect_list|collect_set|array_agg",
}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_forbidden_operators(spark, key):
    plan = _plan(QUERIES[key](spark, SF))
    hits = [name for name, pat in FORBIDDEN.items() if re.search(pat, plan)]
    assert not hits, hits


def test_scorecard_is_ratio_of_sums(spark):
    s = spark.createDataFrame(
        [("01", 1, 100.0), ("02", 3, 30.0)],
        "state_code string, beneficiary_count long, total_medicare_reimbursement double",
    )
    r = tiles.scorecards(s).first()
    assert r["avg_cost_per_beneficiary"] == 32.5  # 130 / 4, not mean(100, 10) = 55


def test_bucketed_pipeline_joins_need_no_exchange(spark):
    state = F.when(F.col("SP_STATE_CODE") == "40", F.lit("54")).otherwise(F.col("SP_STATE_CODE"))
    raw = member_raw(spark, SF).fillna({"SP_STRKETIA": "2"}).withColumn("SP_STATE_CODE", state)
    ns = pipeline.Namespaces(raw="ps_raw", bronze="ps_b", silver="ps_s", gold="ps_g", marts="ps_m")
    pipeline.run_warehouse(spark, raw, ns, run_tests=False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = spark.table("ps_m.dim_beneficiary")
        fct = spark.table("ps_m.fct_beneficiary_annual_cost")
        ex = explore.from_marts(dim, fct, spark.table("ps_m.stg_beneficiary_summary"))
        assert "SortMergeJoin" in _plan(ex) and "Exchange hashpartitioning" not in _plan(ex)
        cost = warehouse.catalog_models(spark, "ps_m")["int_beneficiary_annual_cost"]
        mart = spark.sql(warehouse.MODELS["mart_state_cost_summary"][0], dim=dim, cost=cost)
        # only the final aggregate shuffles; the dim x cost join does not
        assert len(re.findall(r"Exchange hashpartitioning", _plan(mart))) == 1
        # id-keyed data tests group and join bucketed scans without a shuffle
        for check in (quality.unique(dim, "desynpuf_id", "dim"), quality.unique(fct, "desynpuf_id", "fct"),
                      quality.relationships(fct, "desynpuf_id", dim, "desynpuf_id", "fct")):
            assert "Exchange hashpartitioning" not in _plan(check)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
