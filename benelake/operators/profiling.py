"""Column profiling in single distributed passes.

Per-column statistics are computed by one aggregate over all columns (then
a one-row unpivot), or by unpivoting to (column, value) rows and grouping by
column - never a driver loop issuing one job per column.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..session import scratch_table
from .doubles import digit_counts, from_key, moments, partial_sums
from .frequent import most_frequent
from .quantiles import interpolated, select_ranks, wanted_ranks

PERCENTILES = (0.25, 0.5, 0.75)


def shape(df: DataFrame) -> DataFrame:
    """``(rows, columns)``; the column count is metadata."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"))


def null_counts(df: DataFrame, nonzero_only: bool = True) -> DataFrame:
    """``(column_name, null_count)``, largest first; columns without nulls
    are dropped unless ``nonzero_only`` is false."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column_name", "null_count")
    if nonzero_only:
        long = long.filter(F.col("null_count") > 0)
    return long.orderBy(F.desc("null_count"), F.asc("column_name"))


def null_rates(df: DataFrame, scale: int = 4) -> DataFrame:
    """``(column_name, null_rate)`` for every column."""
    n = F.count(F.lit(1))
    wide = df.agg(*[money.ratio(F.count_if(F.col(c).isNull()), n, scale).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_rate")


def to_long(df: DataFrame, columns: list[str], value_type: str | None = None) -> DataFrame:
    """``(column_name, value)`` rows for ``columns`` (cast to one type)."""
    sel = df.select(*[(F.col(c).cast(value_type) if value_type else F.col(c)).alias(c) for c in columns])
    return sel.unpivot([], columns, "column_name", "value")


def domains(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values per column as long ``(column_name, value)``
    rows, sorted; a distributed distinct, nothing collected into one row."""
    long = to_long(df, columns, "string").filter(F.col("value").isNotNull())
    return long.distinct().orderBy("column_name", "value")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """``(value, count)`` of non-null values, most frequent first, ties by
    value; ``top`` gives the first n (a top-k report) without shuffling the
    other values (``frequent``)."""
    if top:
        return most_frequent(df, column, top)
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return counted.orderBy(F.desc("count"), F.asc("value"))


def value_counts_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, value, count)`` of the non-null values of several
    columns, in one pass."""
    long = to_long(df, columns, "string").filter(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def text_shares(df: DataFrame, columns: list[str], text: str) -> DataFrame:
    """``(column_name, prevalence)``: share of rows that hold ``text``."""
    wide = df.agg(*[money.share(F.col(c) == text).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "prevalence")


def distinct_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Exact distinct non-null counts, ``(column_name, n_distinct)``. Each
    column is a scan of its own that reads nothing else and combines equal
    values before the shuffle; no row is copied per column, as one aggregate
    over several distinct columns would."""
    cols = columns or df.columns
    each = [
        df.select(F.col(f"`{c}`").alias("value")).where("value is not null").distinct()
        .agg(F.count(F.lit(1)).alias("n_distinct")).select(F.lit(c).alias("column_name"), "n_distinct")
        for c in cols
    ]
    return functools.reduce(DataFrame.unionByName, each)


def describe(df: DataFrame, columns: list[str], scale: int | None = None, stored: bool = False) -> DataFrame:
    """Transposed describe: one row per column - count, mean, std (sample),
    min, linearly interpolated quartiles, max. Nulls and NaN count as missing;
    no rows give no rows.

    Sums are exact (``doubles``), so mean and std are the correctly rounded ones
    on any partitioning; quartiles come from digit histograms (``quantiles``).
    Nothing is rounded unless ``scale`` asks for so many decimals. The columns
    are written to the scratch folder first, unless ``df`` reads ``stored``
    ones and can as well be scanned again. The first pass gives the sums and
    the first digit of every quartile; only counts come to the driver."""
    spark, names = df.sparkSession, ["p25", "p50", "p75"]
    doubles_ = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    values = doubles_ if stored else scratch_table(doubles_)
    parts: dict[str, list[dict]] = {c: [] for c in columns}
    for r in partial_sums(values).collect():
        parts[r["column_name"]].append(r.asDict())
    if not any(parts.values()) and values.isEmpty():
        parts = {}
    rows = [(c, *moments(own), min((p["least"] for p in own), default=None), max((p["greatest"] for p in own), default=None)) for c, own in parts.items()]
    found = spark.createDataFrame(rows, "column_name string, count long, mean double, std double, _least long, _greatest long")
    counts = found.where("count > 0").select(F.col("column_name").alias("_group"), F.col("count").alias("_n"))

    def histogram(wanted: DataFrame, few: list, done: int, bits: int) -> DataFrame:
        if done:
            return digit_counts(values, [(r["_group"], r["_prefix"]) for r in few], done, bits)
        first = [(c, 0, p["digit"], p["values"]) for c, own in parts.items() for p in own]
        return spark.createDataFrame(first, "_g string, _p long, _digit long, _count long").groupBy("_g", "_p", "_digit").agg(F.sum("_count").alias("_count"))

    ps = list(PERCENTILES)
    quartiles = interpolated(select_ranks(histogram, wanted_ranks(counts, ps)), "column_name", ps, names)
    shown = lambda c: F.round(F.col(c), scale).alias(c) if scale is not None else F.col(c)
    return found.join(quartiles, "column_name", "left").select(
        "column_name", "count", shown("mean"), shown("std"), from_key(F.col("_least")).alias("min"), *map(shown, names), from_key(F.col("_greatest")).alias("max")
    )


def negative_amounts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per money column: count of negative rows and the minimum, only for
    columns that have negatives."""
    long = to_long(df, columns, "double")
    agg = long.groupBy("column_name").agg(
        F.count_if(F.col("value") < 0).alias("negative_count"), F.min("value").alias("min_value")
    )
    return agg.filter(F.col("negative_count") > 0)


def sign_shares(df: DataFrame, value: str, scale: int = 4) -> DataFrame:
    """Share of exact zeros and count of negatives of one amount."""
    v = F.col(value)
    return df.agg(
        money.share(v == 0, scale).alias("zero_share"),
        F.count_if(v < 0).alias("negative_count"),
    )
