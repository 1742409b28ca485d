"""Path-parameterised jobs, CSV scans (strict, inferred, seed), single-file
sample output, ordered reads and display formatting."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from benelake import jobs
from benelake.operators import cohort
from benelake.plans import lakehouse
from benelake.schemas import SSA_STATES
from benelake.sources import csv as csv_src
from benelake.sources.adapter import member_raw

SF = "/root/testdata/sf0.001"


def _member_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw_csv")
    member_raw(spark, SF).write.mode("overwrite").option("header", True).csv(path)
    return path


def test_lakehouse_job_paths(spark, tmp_dir):
    src = _member_csv(spark, tmp_dir)
    out = jobs.run_lakehouse_paths(spark, src, os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s"),
                                   os.path.join(tmp_dir, "g"))
    n = member_raw(spark, SF).count()
    assert out["bronze_rows"] == n and out["silver_rows"] == n
    ids = [r["DESYNPUF_ID"] for r in out["preview"]]
    assert len(ids) == 5 and ids == sorted(ids)
    gold = spark.read.parquet(os.path.join(tmp_dir, "g", "beneficiary_cost_summary"))
    assert gold.count() == n


def test_sample_job_single_file(spark, tmp_dir):
    src = _member_csv(spark, tmp_dir)
    out_dir = os.path.join(tmp_dir, "sample")
    report = jobs.run_sample(spark, src, out_dir)
    parts = [f for f in os.listdir(out_dir) if f.endswith(".csv")]
    assert len(parts) == 1
    assert report["sample_rows"] == report["sample_rows"] and report["sample_rows"] > 0
    assert report["source_rows"] == member_raw(spark, SF).count()


def test_inferred_csv_types(spark, tmp_dir):
    src = _member_csv(spark, tmp_dir)
    types = dict(csv_src.read_inferred_csv(spark, src).dtypes)
    assert types["BENE_BIRTH_DT"] == "int" and types["SP_STATE_CODE"] == "int"
    assert types["MEDREIMB_IP"] == "double" and types["DESYNPUF_ID"] == "string"


def test_seed_csv_keeps_leading_zero(spark, tmp_dir):
    path = os.path.join(tmp_dir, "seed.csv")
    with open(path, "w") as fh:
        fh.write("state_code,state_abbr,state_name\n")
        fh.writelines(f"{c},{a},{n}\n" for c, a, n in SSA_STATES)
    seed = csv_src.read_seed_csv(spark, path)
    assert seed.count() == 52
    assert seed.filter(F.col("state_code") == "05").first()["state_abbr"] == "CA"


def test_ordered_prevalence_and_display(spark):
    raw = member_raw(spark, SF)
    prev = lakehouse.ordered_prevalence(lakehouse.gold_prevalence(lakehouse.to_silver(lakehouse.to_bronze(raw))))
    keys = [(r["condition"], r["state_abbr"] or "") for r in prev.collect()]
    assert keys == sorted(keys)
    k = spark.createDataFrame([(1234, 1234567.891, 1000.5)], "beneficiaries long, total_cost double, avg_cost double")
    d = cohort.kpi_display(k).first()
    # Half-to-even at whole dollars, as Python's "{:,.0f}" formats.
    assert (d["beneficiaries"], d["total_cost"], d["avg_cost"]) == ("1,234", "$1,234,568", f"${1000.5:,.0f}")


def test_bucketed_write_one_file_per_bucket(spark, tmp_dir):
    from benelake.sinks import writers

    writers.ensure_database(spark, "bk")
    df = spark.range(5000).selectExpr("CAST(id AS STRING) AS desynpuf_id", "id % 7 AS v").repartition(13)
    writers.overwrite_table(df, "bk.t", bucket_by=(4, "desynpuf_id"))
    loc = spark.sql("DESCRIBE TABLE EXTENDED bk.t").filter("col_name = 'Location'").first()["data_type"]
    files = [f for f in os.listdir(loc.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) == 4 and spark.table("bk.t").count() == 5000


def test_profile_job(spark, tmp_dir):
    src = _member_csv(spark, tmp_dir)
    out = jobs.run_profile(spark, src, os.path.join(tmp_dir, "profile"))
    assert len(out) == 16
    shape = spark.read.json(out["shape"]).first()
    assert shape["rows"] == member_raw(spark, SF).count() and shape["columns"] == 32
    nulls = {r["column_name"] for r in spark.read.json(out["null_counts"]).collect()}
    assert "BENE_DEATH_DT" in nulls and "SP_STRKETIA" in nulls
    domains = spark.read.json(out["flag_domains"]).select("value").distinct().collect()
    assert {r[0] for r in domains} <= {"1", "2"}


def test_text_csv_na_tokens(spark, tmp_dir):
    path = os.path.join(tmp_dir, "na.csv")
    with open(path, "w") as fh:
        fh.write("a,b\nNA,1\n,2\nx,NULL\n")
    plain = csv_src.read_text_csv(spark, path).collect()
    assert [r["a"] for r in plain] == ["NA", None, "x"]
    pandas_like = csv_src.read_text_csv(spark, path, csv_src.PANDAS_NA_TOKENS).collect()
    assert [r["a"] for r in pandas_like] == [None, None, "x"] and pandas_like[2]["b"] is None


def test_create_table_as_select(spark):
    from benelake.sinks import writers

    writers.ensure_database(spark, "ctas")
    spark.range(10).createOrReplaceTempView("ctas_src")
    t = writers.create_table_as_select(spark, "ctas.t", "SELECT id, id * 2 AS twice FROM ctas_src WHERE id < 5")
    assert t.count() == 5
    t2 = writers.create_table_as_select(spark, "ctas.t", "SELECT id FROM ctas_src")
    assert t2.count() == 10 and t2.columns == ["id"]


def test_bucket_count_follows_table_size():
    from benelake.plans.pipeline import bucket_count

    assert bucket_count(116_352) == 8  # small table: the parallelism floor
    assert bucket_count(65_000_000) == 97  # ~26 GB at 400 B/row -> 256 MB buckets
    assert bucket_count(250 * 10**9) == 372_530  # 100 TB: no cap, 256 MB each
    assert bucket_count(0) == 8


def test_explore_job_reads_the_catalog(spark, tmp_dir):
    from benelake.plans import pipeline

    state = F.when(F.col("SP_STATE_CODE") == "40", F.lit("54")).otherwise(F.col("SP_STATE_CODE"))
    raw = member_raw(spark, SF).fillna({"SP_STRKETIA": "2"}).withColumn("SP_STATE_CODE", state)
    ns = pipeline.Namespaces(raw="ex_raw", bronze="ex_b", silver="ex_s", gold="ex_g", marts="ex_m")
    pipeline.run_warehouse(spark, raw, ns, run_tests=False)
    out = jobs.run_explore(spark.newSession(), "ex_m", os.path.join(tmp_dir, "explore"))
    assert spark.read.json(out["kpis"]).first()["beneficiaries"] == raw.count()
    assert spark.read.json(out["histogram"]).agg(F.sum("count")).first()[0] == raw.count()
    some = jobs.run_explore(spark.newSession(), "ex_m", os.path.join(tmp_dir, "some"), states=["CA", "TX"], status="Alive")
    n = spark.read.json(some["kpis"]).first()["beneficiaries"]
    assert 0 < n < raw.count() and some["cards"]["beneficiaries"] == str(n)
    assert {r["state_abbr"] for r in spark.read.json(some["states"]).collect()} <= {"CA", "TX"}
    assert spark.read.json(some["prevalence"]).count() == 11


def test_cli_main_sample(spark, tmp_dir, capsys):
    import json

    src = _member_csv(spark, tmp_dir)
    assert jobs.main(["sample", "--input", src, "--output", os.path.join(tmp_dir, "cli_sample")]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["source_rows"] == member_raw(spark, SF).count() and report["sample_rows"] > 0


def test_model_fixtures(spark, monkeypatch):
    import pytest

    from benelake.operators import quality
    from benelake.plans import fixtures

    assert fixtures.run_fixtures(spark) == list(fixtures.CASES)
    rows, (first, *rest) = fixtures.CASES["dim_beneficiary"]
    monkeypatch.setitem(fixtures.CASES, "dim_beneficiary", (rows, [{**first, "age_band": "85+"}, *rest]))
    with pytest.raises(quality.DataQualityError, match="dim_beneficiary: p.age_band"):
        fixtures.run_fixtures(spark)


def test_a_seed_file_takes_the_place_of_the_built_in_states(spark, tmp_dir):
    from benelake.plans import pipeline

    path = os.path.join(tmp_dir, "seed.csv")
    with open(path, "w") as fh:
        fh.write("state_code,state_abbr,state_name\n")
        fh.writelines(f"{c},{a.lower()},{n}\n" for c, a, n in SSA_STATES)
    state = F.when(F.col("SP_STATE_CODE") == "40", F.lit("54")).otherwise(F.col("SP_STATE_CODE"))
    raw = member_raw(spark, SF).fillna({"SP_STRKETIA": "2"}).withColumn("SP_STATE_CODE", state)
    ns = pipeline.Namespaces(raw="sd_raw", bronze="sd_b", silver="sd_s", gold="sd_g", marts="sd_m")
    pipeline.run_warehouse(spark, raw, ns, run_tests=False, seed=csv_src.read_seed_csv(spark, path))
    assert all(r[0].islower() for r in spark.table("sd_m.dim_beneficiary").select("state_abbr").distinct().collect())
