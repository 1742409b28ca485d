"""Publishing survives a stop at any step, a failed run starts again where it
stopped, and a full run shuffles by the beneficiary id once."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from benelake.operators import quality
from benelake.plans import landing, pipeline
from benelake.sinks import versions, writers
from benelake.sources import csv as csv_src
from benelake.sources.adapter import member_raw

SF = "/root/testdata/sf0.001"
STEPS = ["created", "written", "ready", "pointed", "swept"]


class Stop(Exception):
    pass


def stop_at(monkeypatch, step):
    def reached(name):
        if name == step:
            raise Stop(step)

    monkeypatch.setattr(versions, "reached", reached)


def clean(raw):
    state = F.when(F.col("SP_STATE_CODE") == "40", F.lit("54")).otherwise(F.col("SP_STATE_CODE"))
    return raw.fillna({"SP_STRKETIA": "2"}).withColumn("SP_STATE_CODE", state)


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("bucket_by", [None, (3, "id")])
def test_a_stop_at_any_step_leaves_the_old_or_the_new_table(spark, monkeypatch, step, bucket_by):
    db = f"vs_{step}_{'b' if bucket_by else 'p'}"
    name = f"{db}.t"
    writers.ensure_database(spark, db)
    old, new = spark.range(5), spark.range(100, 107)
    writers.replace_table(old, name, bucket_by)
    rows = lambda: sorted(r[0] for r in spark.table(name).collect())
    want = {"old": list(range(5)), "new": list(range(100, 107))}
    before = spark.table(name)
    with monkeypatch.context() as m:
        stop_at(m, step)
        with pytest.raises(Stop):
            writers.replace_table(new, name, bucket_by)
        assert rows() == want["new" if step in ("pointed", "swept") else "old"]
    assert before.count() == 5  # a reader of the old version goes on
    versions.recover(spark, db)
    assert rows() == want["old" if step in ("created", "written") else "new"]
    with monkeypatch.context() as m:  # a re-run that stops too leaves what there is
        stop_at(m, "written")
        with pytest.raises(Stop):
            writers.replace_table(spark.range(1), name, bucket_by)
    assert rows() in want.values()
    versions.recover(spark, db)
    assert writers.replace_table(spark.range(9), name, bucket_by).count() == 9
    left = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r["isTemporary"]]
    assert "t" in left and len(left) <= 3


def test_a_plain_table_becomes_the_first_version(spark, monkeypatch):
    writers.ensure_database(spark, "vs_plain")
    writers.overwrite_table(spark.range(4), "vs_plain.t")
    assert versions.current(spark, "vs_plain.t") is None
    assert writers.replace_table(spark.range(6), "vs_plain.t").count() == 6
    assert versions.current(spark, "vs_plain.t") == 1
    spark.sql("DROP VIEW vs_plain.t")  # the moment between renaming a plain table and making the view
    assert versions.recover(spark, "vs_plain") == {"vs_plain.t": 1}
    assert spark.table("vs_plain.t").count() == 6


def _ids(counts):
    return sorted(counts.items())


def test_landing_keeps_one_copy_and_counts_all(spark, raw_rows):
    raw = raw_rows(*[{"DESYNPUF_ID": i, "BENRES_IP": str(k)} for i, k in (("a", 3), ("b", 1), ("a", 2), (None, 5), (None, 4), ("a", 2))])
    got = {r["DESYNPUF_ID"]: (r["BENRES_IP"], r["_copies"]) for r in landing.clustered(raw).collect()}
    assert got == {"a": ("2", 3), "b": ("1", 1), None: ("4", 2)}
    assert landing.gate_metrics(landing.clustered(raw), 32).first().asDict() == {"row_count": 6, "column_count": 32, "duplicate_ids": 3}


@pytest.mark.parametrize(("wanted", "partitions", "buckets"), [(8, 8, 8), (9, 8, 16), (8, 200, 8), (9, 200, 10), (3, 211, 211), (1000, 211, 1055)])
def test_buckets_match_the_shuffle(wanted, partitions, buckets):
    assert landing.aligned_buckets(wanted, partitions) == buckets


def _executed(spark, since):
    """Of the SQL executions after the first ``since``: how each exchange of
    the plan that ran deals its rows, and the scans."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    exchanges, scans = [], []
    for i in range(since, found.size()):
        text = found.apply(i).physicalPlanDescription()
        tree = text.split("\n\n\n")[0].split("== Initial Plan ==")[0]
        for number in re.findall(r" Exchange \((\d+)\)", tree):
            exchanges.append(re.search(rf"\n\({number}\) Exchange.*?\nArguments: (.*)", text, re.S)[1].split("\n")[0])
        scans += re.findall(r"Scan (\w+)", tree)
    return exchanges, scans


def _csv(spark, tmp_path):
    path = str(tmp_path / "landed")
    clean(member_raw(spark, SF)).repartition(3).write.option("header", True).csv(path)
    return path


def test_a_full_run_parses_once_and_shuffles_by_id_once(spark, tmp_path):
    path = _csv(spark, tmp_path)
    ns = pipeline.Namespaces(raw="x1_raw", bronze="x1_b", silver="x1_s", gold="x1_g", marts="x1_m")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        since = spark._jsparkSession.sharedState().statusStore().executionsList().size()
        found = pipeline.run_full(spark, csv_src.read_raw_csv(spark, path), ns, 1, source_path=path)
        exchanges, scans = _executed(spark, since)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert found.counts["silver"] == found.counts["raw"]
    by_id = [x for x in exchanges if re.match(r"hashpartitioning\((DESYNPUF_ID|desynpuf_id)#", x)]
    assert len(by_id) == 1 and len(exchanges) > 10 and scans.count("csv") == 1
    manifest = spark.table(found.tables["manifest"]).collect()
    assert len(manifest) == 3 and sum(r["row_count"] for r in manifest) == found.counts["raw"]


def test_a_failed_run_starts_again_where_it_stopped(spark, tmp_path, monkeypatch):
    path = _csv(spark, tmp_path)
    ns = pipeline.Namespaces(raw="rs_raw", bronze="rs_b", silver="rs_s", gold="rs_g", marts="rs_m")
    run = lambda: pipeline.run_full(spark, csv_src.read_raw_csv(spark, path), ns, 1, source_path=path, parallel=False)
    tests = pipeline.model_tests

    def failing(name, models):
        if name == "mart_state_cost_summary":
            return [quality.column_checks(models["dim_beneficiary"].withColumn("x", F.lit(None)), name, ["x"])]
        return tests(name, models)

    with monkeypatch.context() as m:
        m.setattr(pipeline, "model_tests", failing)
        with pytest.raises(quality.DataQualityError, match="mart_state_cost_summary"):
            run()
    kept = ["rs_raw.beneficiary_summary", "rs_raw.beneficiary_summary_typed", "rs_b.beneficiary_summary", "rs_s.beneficiary", "rs_g.beneficiary_cost_summary", "rs_m.dim_beneficiary", "rs_m.fct_beneficiary_annual_cost"]
    numbers = [versions.current(spark, t) for t in kept]
    assert not spark.catalog.tableExists("rs_m.mart_state_cost_summary")
    since = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    found = run()
    assert [versions.current(spark, t) for t in kept] == numbers
    assert "csv" not in _executed(spark, since)[1]
    n = spark.table("rs_raw.beneficiary_summary").count()
    assert {found.counts[k] for k in ("raw", "bronze", "silver", "gold_cost", "dim_beneficiary")} == {n}
    assert found.extra["reconciled"]["beneficiary_count"] == n
    more = clean(member_raw(spark, SF))
    more.union(more.limit(1).withColumn("DESYNPUF_ID", F.lit("one more"))).write.mode("overwrite").option("header", True).csv(path)
    assert run().counts["raw"] == n + 1  # another input is another run
    assert versions.current(spark, "rs_raw.beneficiary_summary") == numbers[0] + 1
