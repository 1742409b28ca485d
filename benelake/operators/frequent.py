"""Exact most frequent values of a column without shuffling all its values.

Each task keeps a bounded summary: counts of at most ``m`` values. When a new
value would be one too many, the (m+1)-th largest count is taken off all of them
and added to the task's error; a value's true count in the task lies between its
kept count and that plus the error. Summed over the tasks, the k-th largest lower
bound is a floor for the answer: a value whose upper bound stays below it is not
among the first k, not even in a tie. What is left is counted in one more pass;
values that are in no summary are ruled out by the total error. Only if the
bounds decide nothing, as when all values are about as frequent, are all counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import importable, scratch_table

#: Values in a task's summary for each one wanted, and at least.
PER_VALUE, LEAST = 64, 1_024
#: Candidates that are broadcast to be counted.
MOST_CANDIDATES = 100_000


class Summary:
    """Counts of at most ``most`` values, and by how much they may be low."""

    def __init__(self, most: int):
        self.most, self.error = most, 0
        self.counts: dict[object, int] = {}

    def add(self, values: pa.Array) -> None:
        found = pc.value_counts(values)
        for value, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True):
            self.counts[value] = self.counts.get(value, 0) + n
        if len(self.counts) > self.most:
            off = sorted(self.counts.values(), reverse=True)[self.most]
            self.counts = {v: n - off for v, n in self.counts.items() if n > off}
            self.error += off


def summaries(df: DataFrame, column: str, most: int) -> DataFrame:
    """(value, low, error): the summaries of all tasks, and of each task a row
    without a value that holds its error."""
    importable(df.sparkSession)
    kind = df.schema[column].dataType
    schema = T.StructType([T.StructField("value", kind), T.StructField("low", T.LongType()), T.StructField("error", T.LongType())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, arrow = Summary(most), None
        for batch in stream:
            arrow = batch.schema.field(0).type
            for a in range(0, batch.num_rows, most):
                own.add(batch.column(0).slice(a, most).drop_null())
        if arrow is not None:
            values = [*own.counts, None]
            yield pa.RecordBatch.from_arrays([pa.array(values, arrow), pa.array([*own.counts.values(), 0], pa.int64()), pa.array([0] * len(own.counts) + [own.error], pa.int64())], names=schema.names)

    return df.select(column).mapInArrow(run, schema)


def most_frequent(df: DataFrame, column: str, k: int) -> DataFrame:
    """(value, count) of the ``k`` most frequent non-null values, ties by value."""
    found = scratch_table(summaries(df, column, max(LEAST, PER_VALUE * k)))
    error = found.agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
    low = found.where("value is not null").groupBy("value").agg(F.sum("low").alias("count"))
    first = lambda counted: counted.orderBy(F.desc("count"), F.asc("value")).limit(k)
    if not error:  # no task left a value out
        return first(low)
    floor = min([r["count"] for r in first(low).collect()][k - 1 :], default=0)
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value"))
    if floor > error:
        candidates = low.where(F.col("count") + error >= floor).select("value")
        if candidates.limit(MOST_CANDIDATES + 1).count() <= MOST_CANDIDATES:
            values = values.join(F.broadcast(candidates), "value", "left_semi")
    return first(values.groupBy("value").agg(F.count(F.lit(1)).alias("count")))
