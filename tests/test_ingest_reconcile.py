"""Landing gate, strict CSV scan, manifest, checked load, reconcile."""

from __future__ import annotations

import hashlib
import os

import pytest

from benelake.operators import quality, reconcile
from benelake.schemas import RAW_COLUMNS
from benelake.sinks import writers
from benelake.sources import csv as csv_src


@pytest.mark.parametrize(
    ("ids", "floor", "dropped", "complaint"),
    [
        (["x", "y", "z"], 3, [], None),
        (["x", "y", "z"], 4, [], "3 rows; the floor is 4"),
        (["x", "y", "x", "x"], 1, [], "2 rows of the landing repeat an id"),
        (["x", "x"], 9, ["PLAN_CVRG_MOS_NUM", "BENRES_OP"], "lacks 2 of 32 columns: PLAN_CVRG_MOS_NUM, BENRES_OP"),
        ([None, None], 0, [], "1 rows of the landing repeat an id"),
    ],
)
def test_landing_gate(raw_rows, ids, floor, dropped, complaint):
    landing = raw_rows(*[{"DESYNPUF_ID": i} for i in ids]).drop(*dropped).selectExpr("*", "1 AS more")
    if complaint is None:
        assert quality.validate_landing(landing, floor) == {"row_count": len(ids), "column_count": 33}
    else:
        with pytest.raises(quality.DataQualityError, match=complaint):
            quality.validate_landing(landing, floor)


def _write_csv(raw, path):
    raw.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def test_strict_csv_roundtrip(spark, raw_rows, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    _write_csv(raw_rows({"DESYNPUF_ID": "a"}, {"DESYNPUF_ID": "b", "BENE_DEATH_DT": "20080615"}), path)
    df = csv_src.read_raw_csv(spark, path)
    assert df.columns == RAW_COLUMNS and df.count() == 2
    assert df.filter("BENE_DEATH_DT IS NULL").count() == 1


def test_reordered_header_fails(spark, raw_rows, tmp_dir):
    path = os.path.join(tmp_dir, "reordered")
    cols = RAW_COLUMNS[1:] + RAW_COLUMNS[:1]
    _write_csv(raw_rows().select(*cols), path)
    with pytest.raises(Exception, match="does not conform to the schema"):
        csv_src.read_raw_csv(spark, path).collect()


def test_manifest_counts_and_hashes_each_file(spark, raw_rows, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    raw_rows(*[{"DESYNPUF_ID": f"i{k}"} for k in range(7)]).repartition(2).write.option("header", True).csv(path)
    rows = writers.manifest(spark, path, csv_src.read_raw_csv(spark, path)).collect()
    assert sum(r["row_count"] for r in rows) == 7 and len(rows) == 2
    for r in rows:
        with open(os.path.join(path, r["file"]), "rb") as f:
            data = f.read()
        assert (r["sha256"], r["bytes"]) == (hashlib.sha256(data).hexdigest(), len(data))
        assert r["row_count"] == data.count(b"\n") - 1
    assert {r["row_count"] for r in writers.manifest(spark, path).collect()} == {None}


def test_manifest_of_a_file_over_two_gigabytes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "large.bin")
    with open(path, "wb") as f:
        f.truncate((1 << 31) + 4096)  # sparse: takes no disk
    (row,) = writers.manifest(spark, path).collect()
    expected = hashlib.sha256()
    for _ in range(2048):
        expected.update(bytes(1 << 20))
    expected.update(bytes(4096))
    assert (row["bytes"], row["sha256"]) == ((1 << 31) + 4096, expected.hexdigest())


def test_promotion_checks_the_rows_and_keeps_the_old_table(spark):
    writers.ensure_database(spark, "t_raw")
    writers.replace_table(spark.range(3), "t_raw.kept")
    writers.overwrite_table(spark.range(5), "t_raw.landing")
    with pytest.raises(writers.LoadCheckError, match="5 rows instead of 6"):
        writers.promote_table(spark, "t_raw.landing", "t_raw.kept", 6)
    assert spark.table("t_raw.kept").count() == 3
    assert writers.promote_table(spark, "t_raw.landing", "t_raw.kept", 5) == 5
    assert spark.table("t_raw.kept").count() == 5
    with pytest.raises(Exception, match="missing"):
        writers.publish(spark, "t_raw.missing", "t_raw.kept")
    assert spark.table("t_raw.kept").count() == 5 and not spark.catalog.tableExists("t_raw.kept__previous")


def _paths(spark, lake, wh):
    frame = lambda amounts: spark.createDataFrame([(f"i{k}", a) for k, a in enumerate(amounts)], "desynpuf_id string, total_medicare_reimbursement double")
    return frame(lake), frame(wh)


@pytest.mark.parametrize(
    ("lake", "wh", "complaints"),
    [
        ([10.25, 4.0], [4.0, 10.25], []),
        ([10.25, 4.0], [10.25, 5.0], []),
        ([10.25, 4.0], [10.25, 5.01], ["total_medicare_reimbursement"]),
        ([10.25, 4.0, 0.0], [10.25, 4.0], ["beneficiary_count"]),
        ([1.0], [1.0, 3.0], ["beneficiary_count", "total_medicare_reimbursement"]),
        ([1.0], [None], ["total_medicare_reimbursement"]),
    ],
)
def test_reconcile(spark, lake, wh, complaints):
    if not complaints:
        assert reconcile.reconcile(*_paths(spark, lake, wh)) == {"beneficiary_count": len(lake), "total_medicare_reimbursement": sum(lake)}
        return
    with pytest.raises(reconcile.ReconciliationError) as e:
        reconcile.reconcile(*_paths(spark, lake, wh))
    assert [m for m in reconcile.METRICS if f"{m}:" in str(e.value)] == complaints


def test_mutated_copy_fails(spark):
    from benelake.plans import lakehouse, warehouse
    from benelake.sources.adapter import member_raw

    raw = member_raw(spark, "/root/testdata/sf0.001")
    gold = lakehouse.gold_cost_summary(lakehouse.to_silver(lakehouse.to_bronze(raw)))
    fct = warehouse.build_from_raw(spark, raw)["fct_beneficiary_annual_cost"]
    agreed = reconcile.reconcile(gold, fct)
    assert agreed["beneficiary_count"] == raw.count()
    target = gold.agg({"desynpuf_id": "min"}).first()[0]
    with pytest.raises(reconcile.ReconciliationError, match="apart by 500.0"):
        reconcile.reconcile(reconcile.mutate_one(gold, "desynpuf_id", target), fct)
    rows = {r["metric"]: r for r in reconcile.report(reconcile.mutate_one(gold, "desynpuf_id", target), fct).collect()}
    assert rows["beneficiary_count"]["ok"] and not rows["total_medicare_reimbursement"]["ok"]
    assert rows["total_medicare_reimbursement"]["difference"] == 500.0


def test_duplicates_break_reconcile(spark, raw_rows):
    # The lakehouse dedupes, the warehouse does not: a repeated row must fail.
    from benelake.plans import lakehouse, warehouse

    raw = raw_rows({"DESYNPUF_ID": "a"}, {"DESYNPUF_ID": "a"}, {"DESYNPUF_ID": "b"})
    gold = lakehouse.gold_cost_summary(lakehouse.to_silver(lakehouse.to_bronze(raw)))
    fct = warehouse.build_from_raw(spark, raw)["fct_beneficiary_annual_cost"]
    with pytest.raises(reconcile.ReconciliationError, match="beneficiary_count"):
        reconcile.reconcile(gold, fct)
