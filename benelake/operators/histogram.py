"""Equal-width histogram with "nice" bin steps, in one pass over the values.

Step rule (our choice; only the bin cap is given): the smallest step on the
1-2-5 ladder (1, 2, 5, 10, 20, 50, ...) whose bins, aligned to multiples of
the step, cover the value range in at most ``max_bins`` bins.

The step depends on the range of all values, which no task knows. So each task
counts on a decimal ladder: up to ``CELLS`` different values as they are, then
whole multiples of a power of ten that gives at most some ``CELLS`` bins over
the task's own range, and ten times coarser whenever its range outgrows that.
Every step of the final rule is a whole multiple of such a power, so the tasks'
counts fold into the final bins exactly. What the tasks found, a few thousand
counts each, is written once; the range, the step and the bins come from that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import importable, scratch_table

LADDER = (1, 2, 5, 10, 20, 50)
#: Counts that a task keeps; 100 times ``max_bins`` is fine enough for its steps.
CELLS = 4_096


def nice_step(lo: Column, hi: Column, max_bins: int) -> Column:
    """Step expression over the range [lo, hi]."""
    span = F.when(hi - lo > 0, hi - lo).when(F.abs(lo) > 0, F.abs(lo)).otherwise(F.lit(1.0))
    base = F.pow(F.lit(10.0), F.floor(F.log10(span / F.lit(float(max_bins)))))
    step = None
    for m in reversed(LADDER):
        candidate = base * F.lit(float(m))
        fits = F.floor(hi / candidate) - F.floor(lo / candidate) + 1 <= max_bins
        step = candidate if step is None else F.when(fits, candidate).otherwise(step)
    return step


class Ladder:
    """Counts of finite values, exact or in multiples of ``10 ** power``."""

    def __init__(self, cells: int = CELLS):
        self.cells, self.power = cells, None
        self.at, self.counts = np.zeros(0), np.zeros(0, np.int64)
        self.low, self.high = math.inf, -math.inf

    def _place(self, x: np.ndarray) -> np.ndarray:
        if self.power is None:
            return x
        scaled = x / 10.0**self.power if self.power >= 0 else x * 10.0**-self.power
        return np.floor(scaled)

    def _merge(self, at: np.ndarray, counts: np.ndarray) -> None:
        self.at, back = np.unique(np.concatenate((self.at, at)), return_inverse=True)
        total = np.zeros(len(self.at), np.int64)
        np.add.at(total, back, np.concatenate((self.counts, counts)))
        self.counts = total

    def add(self, x: np.ndarray) -> None:
        x = x[np.isfinite(x)]
        if not len(x):
            return
        self.low, self.high = min(self.low, float(x.min())), max(self.high, float(x.max()))
        if self.power is not None:
            self._coarsen()
        found, counts = np.unique(x, return_counts=True)
        self._merge(self._place(found), counts)
        if self.power is None and len(self.at) > self.cells:
            self._coarsen()

    def _coarsen(self) -> None:
        power = math.ceil(math.log10((self.high / self.cells - self.low / self.cells) or 5e-324))
        if self.power is None:
            self.power = max(power, -300)
            at = self._place(self.at)
        elif power > self.power:
            at = np.floor(self.at / 10.0 ** (power - self.power))
            self.power = power
        else:
            return
        counts, self.at, self.counts = self.counts, np.zeros(0), np.zeros(0, np.int64)
        self._merge(at, counts)


def _ladders(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = Ladder()
    for batch in stream:
        found.add(batch.column(0).drop_null().to_numpy(zero_copy_only=False))
    n = len(found.at)
    power = pa.array([found.power] * n, pa.int32())
    yield pa.RecordBatch.from_arrays([power, pa.array(found.at), pa.array(found.counts), pa.array([found.low] * n, pa.float64()), pa.array([found.high] * n, pa.float64())], names=["power", "at", "count", "low", "high"])


def histogram(df: DataFrame, value: str, max_bins: int = 40) -> DataFrame:
    """Rows ``(bin_start, bin_end, count)`` for the values of ``value`` that are
    neither null, NaN nor infinite; no values give no rows. At most ``CELLS`` /
    100 bins keep the tasks' counts fine enough."""
    if not 1 <= max_bins <= CELLS // 100:
        raise ValueError(f"max_bins must be in 1 to {CELLS // 100}")
    importable(df.sparkSession)
    found = scratch_table(df.select(F.col(value).cast("double").alias("x")).mapInArrow(_ladders, "power int, at double, count long, low double, high double"))
    stats = found.agg(F.min("low").alias("lo"), F.max("high").alias("hi"))
    step = stats.select(nice_step(F.col("lo"), F.col("hi"), max_bins).alias("step")).scalar()
    with_step = found.select("power", "at", "count", step.alias("_step"))
    # a step is a whole number of any task's multiples
    whole = F.round(F.col("_step") / F.pow(F.lit(10.0), F.col("power")))
    bin_ = F.when(F.col("power").isNull(), F.floor(F.col("at") / F.col("_step"))).otherwise(F.floor(F.col("at") / whole))
    counted = with_step.select(bin_.alias("bin"), "_step", "count").groupBy("bin", "_step").agg(F.sum("count").alias("count"))
    return counted.select(
        (F.col("bin") * F.col("_step")).alias("bin_start"),
        ((F.col("bin") + 1) * F.col("_step")).alias("bin_end"),
        "count",
    )
