"""Order keys of doubles, exact sums, quantiles by digits, describe."""

from __future__ import annotations

import math
import statistics
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from benelake.operators import doubles, profiling
from benelake.operators.quantiles import exact_quantiles

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.0, 1 - 2**-53, 1 + 2**-52, 2.0**52, 2.0**53 + 2, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 0.1, 1 / 3]


def bits(x: float) -> int:
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def frame(spark, values):
    return spark.createDataFrame([("g", v) for v in values], "g string, v double")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(), max_size=60))
def test_key_is_the_bits(values):
    values = values + EDGES + [2.0**e for e in range(-1074, 1024, 97)] + [math.nextafter(2.0**e, 0) for e in range(-1070, 1024, 91)]
    got = doubles.keys_of(pa.array([*values, None]))
    assert got.tolist() == [bits(v) for v in values if not math.isnan(v)]


def test_key_comes_back(spark):
    values = EDGES + [2.0**e for e in range(-1074, 1024, 37)] + [-math.nextafter(2.0**e, 0) for e in range(-1070, 1024, 41)]
    rows = doubles.with_key(frame(spark, [*values, None, math.nan]).repartition(1), "v", "k").withColumn("back", doubles.from_key(F.col("k"))).collect()
    assert sorted((r["k"], r["back"]) for r in rows) == sorted((bits(v), v) for v in values)


def exact_moments(values):
    n = len(values)
    return n, float(statistics.mean(map(statistics.Fraction, values))) if n else None, statistics.stdev(map(statistics.Fraction, values)) if n > 1 else None


def folded(values):
    """What the driver has of a column, without Spark."""
    rows = doubles._sums(doubles.keys_of(pa.array(values, pa.float64()))).T.tolist()
    return doubles.moments([dict(zip(("digit", "power", "values", "least", "greatest", *doubles.SUMS), r, strict=True)) for r in rows])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e150, max_value=1e150), max_size=30))
def test_moments_are_exact(values):
    n, mean, std = folded(values)
    want_n, want_mean, want_std = exact_moments(values)
    assert (n, mean) == (want_n, want_mean)
    assert std == want_std or abs(std - want_std) <= math.ulp(want_std)


def test_same_bits_on_any_partitioning(spark):
    r = np.random.default_rng(3)
    values = np.concatenate([r.normal(size=4000) * 10.0 ** r.integers(-9, 9, 4000), [1e16, 1.0, -1e16] * 50, np.full(3000, 0.1)]).tolist()
    found = [profiling.describe(frame(spark, values).repartition(n), ["v"]).first() for n in (1, 200)]
    assert found[0] == found[1]
    n, mean, _ = exact_moments(values)
    assert (found[0]["count"], found[0]["mean"]) == (n, mean)
    assert [found[0][c] for c in ("min", "p25", "p50", "p75", "max")] == [min(values), *np.quantile(values, [0.25, 0.5, 0.75]).tolist(), max(values)]


def test_describe_does_not_round(spark):
    r = profiling.describe(frame(spark, [1e-6, 2e-6, 4e-6]), ["v"]).first()
    assert r["mean"] == float((statistics.Fraction(1e-6) + statistics.Fraction(2e-6) + statistics.Fraction(4e-6)) / 3)
    assert (r["min"], r["p50"], r["max"]) == (1e-6, 2e-6, 4e-6) and r["min"] < r["mean"] < r["max"]
    assert r["std"] == pytest.approx(1.5275252316519467e-06, rel=1e-15)


def test_describe_edge_values(spark):
    df = spark.createDataFrame([(None, 1.0, math.inf, 3), (None, math.nan, 2.0, None)], "none double, one double, inf double, whole int")
    got = {r["column_name"]: r for r in profiling.describe(df, df.columns).collect()}
    assert got["none"][1:] == (0, None, None, None, None, None, None, None)
    assert got["one"][1:] == (1, 1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0)
    assert got["inf"]["count"] == 2 and got["inf"]["mean"] == math.inf and got["inf"]["max"] == math.inf and math.isnan(got["inf"]["std"])
    assert got["whole"]["mean"] == 3.0
    assert profiling.describe(df.limit(0), df.columns).collect() == []


def test_quantiles_need_no_shuffle_of_values(spark):
    values = np.random.default_rng(5).normal(size=5000).tolist()
    found = exact_quantiles(frame(spark, values), "g", "v", [0.1, 0.9], partitions=3)
    assert "rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    row = found.first()
    assert [row["q0"], row["q1"]] == np.quantile(values, [0.1, 0.9]).tolist()


def test_many_groups_and_a_null_group(spark, monkeypatch):
    from benelake.operators import quantiles

    monkeypatch.setattr(quantiles, "MOST_BROADCAST", 10)
    rows = [(f"g{i % 40}" if i % 40 else None, float((i * 7919) % 1009)) for i in range(4000)]
    got = {r["g"]: r["q0"] for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", [0.3]).collect()}
    want = {}
    for g, v in rows:
        want.setdefault(g, []).append(v)
    assert got == {g: float(np.quantile(v, 0.3)) for g, v in want.items()}
