"""Exact most frequent values, distinct counts, inferred types."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from benelake.operators import frequent, profiling
from benelake.plans import warehouse
from benelake.sources import infer


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=60), max_size=6), st.integers(1, 8))
def test_summary_bounds_every_count(batches, most):
    own, true = frequent.Summary(most), Counter()
    for b in batches:
        own.add(pa.array(b, pa.int64()))
        true.update(b)
        assert len(own.counts) <= most
    for v in range(31):
        assert own.counts.get(v, 0) <= true[v] <= own.counts.get(v, 0) + own.error


def top(values, k):
    return sorted(Counter(values).items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("case", ["skewed", "flat", "ties", "few", "none"])
def test_most_frequent_is_exact(spark, monkeypatch, case):
    monkeypatch.setattr(frequent, "PER_VALUE", 4)
    monkeypatch.setattr(frequent, "LEAST", 16)
    r = np.random.default_rng(4)
    values = {
        "skewed": (r.zipf(1.4, 20_000) % 5_000).tolist(),
        "flat": r.permutation(3_000).tolist(),
        "ties": [v for v in range(40) for _ in range(500 if v < 25 else 3)] + list(range(100, 900)),
        "few": [1, 2, 2, 3] * 50,
        "none": [],
    }[case]
    df = spark.createDataFrame([(f"v{v:05d}",) for v in values] + [(None,)] * 30, "x string").repartition(6)
    got = [(x["value"], x["count"]) for x in profiling.value_counts(df, "x", 10).collect()]
    assert got == top([f"v{v:05d}" for v in values], 10)


def test_a_million_values_shuffle_little(spark):
    hot = F.when(F.col("id") % 5 == 0, F.col("id") % 7).otherwise(F.col("id") + 1_000)
    df = spark.range(0, 1_000_000, 1, 4).select(hot.alias("x"))
    sent = frequent.summaries(df, "x", frequent.LEAST).count()
    assert sent <= 4 * (frequent.LEAST + 1)
    got = [tuple(r) for r in frequent.most_frequent(df, "x", 7).collect()]
    assert got == top([i % 7 for i in range(0, 1_000_000, 5)], 7)


def test_distinct_counts_copy_no_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2.5), (None, "a", 2.5), (-7, None, 0.0)], "i long, s string, d double")
    found = profiling.distinct_counts(df)
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r["column_name"]: r["n_distinct"] for r in found.collect()} == {"i": 2, "s": 2, "d": 2}


def test_types_merge_over_files(spark, tmp_path):
    for name, rows in (("one", ["id,n,x,t,none,pin", "1,5,7,5,,3"]), ("two", ["id,n,x,t,none,pin", "a,-12,0.5,x y,,4"])):
        (tmp_path / f"{name}.csv").write_text("\n".join(rows) + "\n")
    raw = spark.read.option("header", True).csv(str(tmp_path))
    found = infer.infer_types(raw, raw.columns, {"pin": "string"})
    assert found == {"id": "string", "n": "bigint", "x": "double", "t": "string", "none": "bigint", "pin": "string"}
    one = spark.read.option("header", True).csv(str(tmp_path / "one.csv"))
    assert infer.infer_types(one, one.columns, {"pin": "string"})["x"] == "bigint"
    assert infer.infer_types(raw.limit(0), raw.columns)["t"] == "bigint"


def test_load_types_of_the_annual_file_are_the_inferred_ones(spark, raw_rows):
    raw = raw_rows({"DESYNPUF_ID": "a"}, {"DESYNPUF_ID": "b", "BENE_ESRD_IND": "Y", "BENE_DEATH_DT": "20080102"})
    found = infer.infer_types(raw, raw.columns, warehouse.PINNED_TYPES)
    assert found == warehouse.load_types()
    whole = raw.withColumns({c: F.lit("3") for c in raw.columns if found[c] == "double"})  # amounts without decimals
    types = infer.infer_types(whole, whole.columns, warehouse.PINNED_TYPES)
    assert "double" not in types.values()
    cost = warehouse.register_models(spark, warehouse.inferred_load(whole, types))["fct_beneficiary_annual_cost"].first()
    assert (cost["medreimb_ip"], cost["total_medicare_reimbursement"]) == (3.0, 9.0)
