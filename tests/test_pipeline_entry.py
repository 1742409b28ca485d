"""End-to-end pipelines on the sf0.001 adapter, idempotence, and the driver
contract (entry / queries / oracle agreement on a subset)."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from benelake.operators import quality
from benelake.plans import pipeline
from benelake.queries import QUERIES
from benelake.sources.adapter import member_raw
from benelake.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"


def test_contract_blocks_null_condition_count(spark):
    # The adapter nulls one flag for some members: the dim contract's
    # not-null constraint on chronic_condition_count must stop the write.
    ns = pipeline.Namespaces(raw="c_raw", bronze="c_bronze", silver="c_silver", gold="c_gold", marts="c_marts")
    with pytest.raises(quality.DataQualityError, match="chronic_condition_count"):
        pipeline.run_warehouse(spark, member_raw(spark, SF), ns, run_tests=False)


def test_data_tests_catch_unknown_state(spark):
    ns = pipeline.Namespaces(raw="d_raw", bronze="d_bronze", silver="d_silver", gold="d_gold", marts="d_marts")
    raw = member_raw(spark, SF).fillna({"SP_STRKETIA": "2"})
    with pytest.raises(quality.DataQualityError, match=r"relationships\(stg.state_code\)"):
        pipeline.run_warehouse(spark, raw, ns)


def _clean(raw):
    # Fill the adapter's deliberate defects so every contract and test holds.
    state = F.when(F.col("SP_STATE_CODE") == "40", F.lit("54")).otherwise(F.col("SP_STATE_CODE"))
    return raw.fillna({"SP_STRKETIA": "2"}).withColumn("SP_STATE_CODE", state)


def test_full_run_and_idempotence(spark):
    raw = _clean(member_raw(spark, SF))
    ns = pipeline.Namespaces(raw="p_raw", bronze="p_bronze", silver="p_silver", gold="p_gold", marts="p_marts")
    first = pipeline.run_full(spark, raw, ns, min_expected_rows=1)
    n = raw.count()
    assert first.counts["raw"] == n and first.counts["silver"] == n
    assert first.counts["fct_beneficiary_annual_cost"] == n
    assert first.extra["reconciled"]["beneficiary_count"] == n
    second = pipeline.run_full(spark, raw, ns, min_expected_rows=1)
    assert second.counts == first.counts
    assert spark.table("p_gold.beneficiary_cost_summary").count() == n


def test_a_bad_run_keeps_the_published_marts(spark):
    ns = pipeline.Namespaces(raw="k_raw", bronze="k_b", silver="k_s", gold="k_g", marts="k_m")
    good = _clean(member_raw(spark, SF))
    res = pipeline.run_warehouse(spark, good, ns)
    assert len(res.extra["tests"]) == 34
    marts = {name: sorted(spark.table(t).collect(), key=str) for name, t in res.tables.items()}
    for bad, why in (
        (good.withColumn("SP_CHF", F.lit(None).cast("string")), "chronic_condition_count"),
        (good.withColumn("SP_STATE_CODE", F.lit("40")), "state_code"),
        (good.unionByName(good.limit(2)), "unique"),
    ):
        with pytest.raises(quality.DataQualityError, match=why):
            pipeline.run_warehouse(spark, bad, ns, run_tests=why != "chronic_condition_count")
        for name, t in res.tables.items():
            spark.catalog.refreshTable(t)
            if name != "dim_beneficiary" or why != "chronic_condition_count":
                assert sorted(spark.table(t).collect(), key=str) == marts[name]
            assert not spark.catalog.tableExists(f"{t}__next")
        assert sorted(spark.table(res.tables["dim_beneficiary"]).collect(), key=str) == marts["dim_beneficiary"]


def test_one_id_on_a_third_of_the_rows_stops_before_the_load(spark):
    ns = pipeline.Namespaces(raw="h_raw", bronze="h_b", silver="h_s", gold="h_g", marts="h_m")
    good = _clean(member_raw(spark, SF))
    hot = good.withColumn("DESYNPUF_ID", F.when(F.abs(F.hash("DESYNPUF_ID")) % 3 == 0, F.lit("hot")).otherwise(F.col("DESYNPUF_ID")))
    with pytest.raises(quality.DataQualityError, match="raw.DESYNPUF_ID"):
        pipeline.run_warehouse(spark, hot, ns)
    assert not spark.catalog.tableExists("h_raw.beneficiary_summary_typed")


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["state_code", "state_abbr", "state_name", "beneficiary_count", "total_medicare_reimbursement",
                          "avg_medicare_reimbursement_per_beneficiary"]


def test_every_query_has_oracle_or_is_documented():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


@pytest.mark.parametrize("key", ["silver_enrich", "mart_prevalence", "cohort_histogram", "describe_money",
                                 "sample_union", "reconcile_report_mutated"])
def test_oracle_agreement(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = entry_mod.queries()[key](spark, SF)
    res = con.sql(entry_mod.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(res.columns)
    order = sorted(sdf.columns)

    def norm(rows, cols):
        idx = [cols.index(c) for c in order]
        return sorted(tuple(repr(r[i]) if not hasattr(r[i], "isoformat") else r[i].isoformat() for i in idx) for r in rows)

    assert norm([tuple(r) for r in sdf.collect()], sdf.columns) == norm(res.fetchall(), res.columns)


def test_failed_landing_keeps_previous_raw(spark):
    ns = pipeline.Namespaces(raw="l_raw", bronze="l_b", silver="l_s", gold="l_g", marts="l_m")
    good = _clean(member_raw(spark, SF))
    first = pipeline.run_ingest(spark, good, ns, min_expected_rows=1)
    n = first.counts["raw"]
    dup = good.unionByName(good.limit(3))
    with pytest.raises(quality.DataQualityError, match="repeat an id"):
        pipeline.run_ingest(spark, dup, ns, min_expected_rows=1)
    assert spark.table("l_raw.beneficiary_summary").count() == n
    assert not spark.catalog.tableExists("l_raw.beneficiary_summary__landing")
    with pytest.raises(quality.DataQualityError, match="lacks 1 of 32 columns"):
        pipeline.run_ingest(spark, good.drop("BENE_DEATH_DT"), ns, min_expected_rows=1)


def test_ingest_writes_manifest_table(spark, tmp_path):
    ns = pipeline.Namespaces(raw="mf_raw", bronze="mf_b", silver="mf_s", gold="mf_g", marts="mf_m")
    src = str(tmp_path / "landed_csv")
    good = _clean(member_raw(spark, SF))
    good.repartition(3).write.mode("overwrite").option("header", True).csv(src)
    from benelake.sources import csv as csv_src

    res = pipeline.run_ingest(spark, csv_src.read_raw_csv(spark, src), ns, 1, source_path=src)
    assert res.extra["manifest_files"] == 3
    rows = spark.table(res.tables["manifest"]).collect()
    assert sum(r["row_count"] for r in rows) == res.counts["raw"] and all(len(r["sha256"]) == 64 for r in rows)
