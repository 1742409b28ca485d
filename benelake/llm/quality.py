"""Quality classifier: random Fourier features over document statistics.

Each text is reduced to a fixed number of statistics (sizes, shares of kinds of
characters and words, repetition). Standardised, they are mapped to cosines of
random directions, whose inner products approximate a Gaussian kernel. Every
partition sums its part of the normal equations, Spark adds the parts row by
row of the matrix, and one ridge solution of fixed size is found on the driver.
Raw scores are then calibrated by isotonic regression (pool adjacent violators
over a histogram of the training scores), so a score is the share of good
documents to expect.

Edge cases: a null or empty text has all statistics 0 and is scored like any
other; without labelled rows every score is 0.5; of labelled rows that repeat
each counts; a text that is not labelled is still scored; other columns are
kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benelake.llm import text

FEATURES = 256
RIDGE = 1e-3
BINS = 1000
STATISTICS = 26


def _mask(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


_UPPER, _LOWER, _DIGIT, _HIGH = _mask((0x41, 0x5A)), _mask((0x61, 0x7A)), _mask((0x30, 0x39)), _mask((0x80, 0xFF))
_BLANK, _LINE = _mask((0x09, 0x0D), (0x20, 0x20)), _mask((0x0A, 0x0A))
_STOP, _PAUSE = _mask((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F)), _mask((0x2C, 0x2C), (0x3A, 0x3B))
_SYMBOL = _mask((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS numbers for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)

    def per_row(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return (sums[edges[1:]] - sums[edges[:-1]]).astype(float)

    kinds = {k: per_row(m[data], offsets) for k, m in (("upper", _UPPER), ("lower", _LOWER), ("digit", _DIGIT), ("high", _HIGH), ("blank", _BLANK), ("line", _LINE), ("stop", _STOP), ("pause", _PAUSE), ("symbol", _SYMBOL), ("shout", _mask((0x21, 0x21))), ("bar", _mask((0x7C, 0x7C))))}
    words = text.Words(data, offsets, text.SPACED)
    rows, count = words.row_of(), np.diff(words.rows).astype(float)
    length = words.ends - words.starts
    first, last = data[words.starts], data[words.ends - 1] if len(words.ends) else data[:0]
    capital = _UPPER[first]
    sums = np.concatenate(([0], np.cumsum(_UPPER[data] | _LOWER[data] | _HIGH[data])))
    letters = sums[words.ends] - sums[words.starts]
    small = np.concatenate(([0], np.cumsum(_LOWER[data] | _HIGH[data])))
    shouted = (small[words.ends] == small[words.starts]) & (letters > 1)
    again = np.zeros(len(rows), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (rows[1:] == rows[:-1])

    def distinct(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        key = np.sort((owner.astype(text.U64) << text.U64(40)) | (text.mix(hashes) >> text.U64(24)))
        key = key[np.concatenate((key[:1] == key[:1], key[1:] != key[:-1]))]
        return np.bincount((key >> text.U64(40)).astype(np.int64), minlength=n).astype(float)

    pairs, at = text.ngrams(words, 2)
    lines = text.Words(data, offsets, ~_LINE)
    n_lines = np.diff(lines.rows).astype(float)
    line_size = (lines.ends - lines.starts).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        by = lambda a, b: np.where(b > 0, a / np.maximum(b, 1e-9), 0.0)
        mean = by(per_row(length, words.rows), count)
        spread = np.sqrt(np.maximum(0, by(per_row(length * length, words.rows), count) - mean**2))
        alphabetic = kinds["upper"] + kinds["lower"] + kinds["high"]
        columns = [
            np.log1p(size), np.log1p(count), mean, spread, by(alphabetic, size), by(kinds["upper"], alphabetic),
            by(kinds["digit"], size), by(kinds["blank"], size), by(kinds["high"], size), by(kinds["pause"], count),
            by(kinds["stop"], count), by(kinds["symbol"], size), by(kinds["shout"], count), by(kinds["bar"], count),
            by(per_row(capital, words.rows), count), by(per_row(shouted, words.rows), count), by(per_row(_SYMBOL[last], words.rows), count),
            by(per_row(letters == 0, words.rows), count), by(per_row(again, words.rows), count), by(distinct(words.hashes, rows), count),
            by(distinct(pairs, rows[at]), np.maximum(count - 1, 0)), by(kinds["line"], count), by(distinct(lines.hashes, lines.row_of()), n_lines),
            np.log1p(by(count, n_lines)), by(per_row(length > 20, words.rows), count), np.log1p(by(per_row((line_size * line_size).astype(np.int64), lines.rows), size)),
        ]
    return np.stack(columns, 1)


class QualityModel:
    """Standardisation, random directions, ridge weights and calibration."""

    def __init__(self, mean, scale, directions, phases, weights, steps):
        self.mean, self.scale, self.directions, self.phases = mean, scale, directions, phases
        self.weights, self.steps = weights, steps

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        cosines = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate((cosines, np.ones((len(z), 1))), 1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        x, y = self.steps
        return np.clip(np.interp(self.raw(stats), x, y), 0, 1)


def _added(rows: DataFrame, partial, width: int) -> np.ndarray:
    """Sum over all partitions of a matrix that ``partial`` makes of each; the
    parts are added row by row in Spark."""
    def emit(stream):
        total = None
        for batch in stream:
            part = partial(batch)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "row"])

    def add(table: pa.Table) -> pa.Table:
        parts = sorted(table.column("row").to_pylist())  # the sum does not depend on the order of tasks
        return pa.table({"i": table.column("i").slice(0, 1).cast(pa.int64()), "row": pa.array([np.sum([np.frombuffer(p) for p in parts], 0).tobytes()], pa.binary())})

    found = rows.mapInArrow(emit, "i long, row binary").groupBy("i").applyInArrow(add, "i long, row binary").collect()
    return np.array([np.frombuffer(r["row"]) for r in sorted(found)]).reshape(-1, width)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def _isotonic(bins: np.ndarray, n: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; the middle score and the level of each pool."""
    pools: list[list[float]] = []
    for x, c, g in zip(bins, n, good, strict=True):
        pools.append([x * c, c, g])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    x = np.array([p[0] / p[1] for p in pools])
    return x, np.array([p[2] / p[1] for p in pools])


def with_statistics(docs: DataFrame, column: str = "text", name: str = "statistics") -> DataFrame:
    """All rows of ``docs`` with their statistics instead of the text."""
    carried = [f for f in docs.schema.fields if f.name != column and f.name != name]
    schema = T.StructType([*carried, T.StructField(name, T.ArrayType(T.FloatType()))])

    def run(stream):
        for batch, data, offsets in text.batches(stream, column):
            stats = statistics(data, offsets).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1) * STATISTICS, pa.int32()), pa.array(stats.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(f.name)) for f in carried], lists], schema.names)

    return docs.mapInArrow(run, schema)


def fit_quality(labelled: DataFrame, statistics_column: str = "statistics", label: str = "quality", features: int = FEATURES, ridge: float = RIDGE, seed: int = 7) -> QualityModel:
    """Model from rows with statistics and a 0/1 label."""
    rows = labelled.select(F.col(statistics_column).alias("s"), F.col(label).cast("double").alias("y")).where("s is not null and y in (0, 1)")

    def moments(batch):
        s, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        return np.stack((s.sum(0), (s * s).sum(0), np.full(STATISTICS, len(y)), np.full(STATISTICS, y.sum())))

    sums = _added(rows, moments, STATISTICS)
    if not len(sums):
        return QualityModel(np.zeros(STATISTICS), np.ones(STATISTICS), np.zeros((STATISTICS, 1)), np.zeros(1), None, None)
    n = sums[2, 0]
    mean = sums[0] / n
    scale = np.sqrt(np.maximum(sums[1] / n - mean**2, 0))
    scale = np.where(scale > 1e-6, scale, 1.0)
    chance = np.random.default_rng(seed)
    directions = chance.normal(0, 1 / np.sqrt(STATISTICS), (STATISTICS, features))
    model = QualityModel(mean, scale, directions, chance.uniform(0, 2 * np.pi, features), None, None)
    width = features + 2

    def normal(batch):
        s, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        z = np.concatenate((model.features(s), y[:, None]), 1)
        return z.T @ z

    total = _added(rows, normal, width)
    a, b = total[:-1, :-1], total[:-1, -1]
    model.weights = np.linalg.solve(a + ridge * n / features * np.eye(width - 1), b)

    def histogram(batch):
        s, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        place = np.clip(np.round((model.raw(s) + 0.5) * BINS / 2), 0, BINS).astype(int)
        return np.stack((np.bincount(place, minlength=BINS + 1), np.bincount(place, y, BINS + 1))).astype(float)

    count, good = _added(rows, histogram, BINS + 1)
    used = np.flatnonzero(count)
    model.steps = _isotonic(used * 2 / BINS - 0.5, count[used], good[used])
    return model


def score_quality(stats: DataFrame, model: QualityModel, statistics_column: str = "statistics", score: str = "score") -> DataFrame:
    """All rows of ``stats`` with a score in 0 to 1 instead of the statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)
    carried = [f for f in stats.schema.fields if f.name not in (statistics_column, score)]
    schema = T.StructType([*carried, T.StructField(score, T.DoubleType())])

    def run(stream):
        for batch in stream:
            s = _matrix(batch.column(batch.schema.get_field_index(statistics_column)))
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(f.name)) for f in carried], pa.array(shared.value.score(s))], schema.names)

    return stats.mapInArrow(run, schema)
