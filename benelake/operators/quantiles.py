"""Exact, linearly interpolated quantiles per group, without sorting or
shuffling the values.

``percentile`` keeps a map of every distinct value of a group and merges it in
one task; a sort by value moves every row. Here the wanted ranks are found by
radix selection on the values' ordered 64-bit keys (``doubles``): a histogram of
the keys' highest 16 bits tells in which digit each rank lies, the next one is
taken of the rows with that digit alone, and so on until the keys are known; once
few rows are left of each digit, the rest of the key is one digit. Histograms
merge: a task sends at most 65,536 counts for each group and prefix, however its
rows are spread, and a value on a third of the rows is one count.

The keys are written once to the shared scratch folder, so that the input is
computed once; two to four scans of that column follow. The prefixes looked for,
at most two per quantile and group, go to the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_table
from .doubles import DIGIT, from_key, with_key

#: Prefixes that go through the driver and are broadcast; more are checkpointed
#: and joined by a shuffle.
MOST_BROADCAST = 100_000
#: Rows with one prefix from which it is split by one more digit; of fewer, the
#: rest of the key is counted at once.
MOST_KEYS = 1 << 20


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (lineage cut,
    survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def wanted_ranks(counts: DataFrame, ps: list[float]) -> DataFrame:
    """The two ranks around each quantile's position, and what lies between;
    ``counts``: (_group, _n)."""
    each = []
    for i, p in enumerate(ps):
        at = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        for side, rank in ((0, F.floor(at)), (1, F.ceil(at))):
            each.append(F.struct(F.lit(i).alias("_which"), F.lit(side).alias("_side"), rank.alias("_rank"), (at - F.floor(at)).alias("_part")))
    return counts.select("_group", F.lit(0).cast("long").alias("_prefix"), F.col("_n").alias("_left"), F.explode(F.array(*each)).alias("_w")).select("_group", "_prefix", "_left", "_w.*")


def _held(df: DataFrame) -> tuple[DataFrame, list[Row] | None]:
    """``df`` computed, and its rows if they are few."""
    rows = df.limit(MOST_BROADCAST + 1).collect()
    if len(rows) <= MOST_BROADCAST:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), rows
    return materialize(df), None


Histogram = Callable[[DataFrame, "list[Row] | None", int, int], DataFrame]


def select_ranks(histogram: Histogram, wanted: DataFrame) -> DataFrame:
    """(_group, _which, _side, _part, _prefix): the keys at the ranks wanted.
    ``histogram(wanted, rows, done, bits)`` counts the next ``bits`` of the
    keys that begin with ``done`` bits wanted: (_g, _p, _digit, _count)."""
    wanted, rows = _held(wanted)
    done = 0
    while done < 64:
        left = max((r["_left"] for r in rows), default=0) if rows is not None else wanted.agg(F.max("_left")).first()[0]
        bits = DIGIT if not done or left > MOST_KEYS else 64 - done
        upto = Window.partitionBy("_g", "_p").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
        placed = histogram(wanted, rows, done, bits).withColumn("_end", F.sum("_count").over(upto)).withColumn("_start", F.col("_end") - F.col("_count"))
        inside = F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_prefix") == F.col("_p")) & (F.col("_start") <= F.col("_rank")) & (F.col("_rank") < F.col("_end"))
        prefix = F.shiftleft("_prefix", bits).bitwiseOR(F.col("_digit")) if done else F.col("_digit")
        found = placed.join(wanted, inside)
        wanted, rows = _held(found.select("_group", prefix.alias("_prefix"), F.col("_count").alias("_left"), "_which", "_side", (F.col("_rank") - F.col("_start")).alias("_rank"), "_part"))
        done += bits
    return wanted


def interpolated(found: DataFrame, group: str, ps: list[float], names: list[str]) -> DataFrame:
    """One row per group: the group and a column per quantile."""
    found = found.withColumn("_value", from_key(F.col("_prefix")))
    at = lambda i, side: F.max(F.when((F.col("_which") == i) & (F.col("_side") == side), F.col("_value")))
    picks = [c for i in range(len(ps)) for c in (at(i, 0).alias(f"_low{i}"), at(i, 1).alias(f"_high{i}"), F.max(F.when(F.col("_which") == i, F.col("_part"))).alias(f"_part{i}"))]
    low, high, part = ([F.col(f"_{k}{i}") for i in range(len(ps))] for k in ("low", "high", "part"))
    # between equal values, infinite ones too, nothing is interpolated
    between = [F.when(a == b, a).otherwise(a + (b - a) * f).alias(name) for a, b, f, name in zip(low, high, part, names, strict=True)]
    return found.groupBy("_group").agg(*picks).select(F.col("_group").alias(group), *between)


def exact_quantiles(df: DataFrame, group: str, value: str, ps: list[float], names: list[str] | None = None,
                    partitions: int | None = None) -> DataFrame:
    """One row per group: ``group`` plus one column per quantile in ``ps``
    (null and NaN values ignored; groups without values are absent).
    ``partitions`` deals the rows anew first; the result is the same."""
    names = names or [f"q{i}" for i in range(len(ps))]
    if len(names) != len(ps) or any(not 0.0 <= p <= 1.0 or math.isnan(p) for p in ps):
        raise ValueError("need one name per quantile and quantiles in [0, 1]")
    rows = df.select(F.col(group).alias("_group"), F.col(value).cast("double").alias("_value"))
    rows = rows.repartition(partitions) if partitions else rows
    keyed = scratch_table(with_key(rows, "_value", "_key"))

    def histogram(wanted: DataFrame, few: list[Row] | None, done: int, bits: int) -> DataFrame:
        digit = F.shiftright("_key", 64 - done - bits)
        if not done:
            near = keyed.select(F.col("_group").alias("_g"), F.lit(0).cast("long").alias("_p"), digit.alias("_digit"))
        else:
            asked = wanted.select(F.col("_group").alias("_g"), F.col("_prefix").alias("_p")).distinct()
            same = F.col("_group").eqNullSafe(F.col("_g")) & (F.shiftright("_key", 64 - done) == F.col("_p"))
            near = keyed.join(asked if few is None else F.broadcast(asked), same).select("_g", "_p", digit.bitwiseAND(F.lit((1 << bits) - 1)).alias("_digit"))
        return near.groupBy("_g", "_p", "_digit").agg(F.count(F.lit(1)).alias("_count"))

    counts = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    return interpolated(select_ranks(histogram, wanted_ranks(counts, ps)), group, ps, names)
