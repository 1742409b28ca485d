"""Exact work with doubles: a whole number that orders them, and sums that do not
depend on the order of the rows.

The key of a double is its own 63 bits (exponent, then fraction) with its sign:
equal numbers have equal keys, a larger number a larger one, -0.0 counts as 0.0.
Spark SQL has no function for a double's bits, so this one step takes Arrow
batches to numpy, where it is a view of the same memory. A number is a whole
mantissa times a power of two; mantissas of one power are added as whole numbers,
and the few sums of a column are put together on the driver. Mean and standard
deviation are then the exact ones, rounded once, on any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import importable

_FRACTION = 52
_BIAS = 1023
_LEAST = 5e-324  # the smallest double above zero
_INFINITE = 2047  # exponent field of the infinities
_LIMB = 18  # bits of a part of a mantissa
_ROWS = 1 << 16  # rows whose squared parts add up exactly in a double
#: Bits of the first digit of a key.
DIGIT = 16
#: Sums of a group of values of one power: of the parts of their mantissas
#: (signed), and of their squares.
SUMS = ("s0", "s1", "s2", "q0", "q1", "q2", "q3", "q4")


def keys_of(values: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Keys of the values that are neither null nor NaN."""
    x = values.drop_null().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    size = (np.abs(x[~np.isnan(x)])).view(np.int64)
    return np.where(x[~np.isnan(x)] < 0, -size, size)


def with_key(df: DataFrame, value: str, key: str) -> DataFrame:
    """``df`` without the rows where the double column ``value`` is null or NaN,
    with the key in its place."""
    importable(df.sparkSession)
    rest = [f for f in df.schema.fields if f.name != value]
    named = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*[F.col(f"`{f.name}`") for f in rest], F.col(value).cast("double"))

    def keyed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = pa.array(keys_of(batch.column(len(rest))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*[f.name for f in rest], key])

    return named.mapInArrow(keyed, T.StructType([*rest, T.StructField(key, T.LongType())]))


def from_key(key: Column) -> Column:
    """The double of a key."""
    size = F.abs(key)
    field = F.shiftright(size, _FRACTION)
    fraction = size.bitwiseAND(F.lit((1 << _FRACTION) - 1)).cast("double")
    found = F.when(field == 0, fraction * _LEAST).when(field == _INFINITE, F.lit(float("inf")))
    found = found.otherwise((fraction / float(1 << _FRACTION) + 1) * F.pow(F.lit(2.0), field - _BIAS))
    return F.when(key < 0, -found).otherwise(found)


def _sums(keys: np.ndarray) -> np.ndarray:
    """Of at most ``_ROWS`` keys: (digit, power, values, least, greatest, the
    sums) of each first digit and power, as rows of whole numbers."""
    size = np.abs(keys)
    field = size >> _FRACTION
    mantissa = (size & ((1 << _FRACTION) - 1)) | np.where(field > 0, np.int64(1 << _FRACTION), 0)
    power = np.maximum(field, 1) - (_BIAS + _FRACTION)
    which = (keys >> (64 - DIGIT)) * 4096 + power + 2048
    kinds, back, n = np.unique(which, return_inverse=True, return_counts=True)
    limbs = [((mantissa >> _LIMB * i) & ((1 << _LIMB) - 1)).astype(np.float64) for i in range(3)]
    a, b, c = limbs
    sign = np.where(keys < 0, -1.0, 1.0)
    terms = [sign * a, sign * b, sign * c, a * a, 2 * a * b, 2 * a * c + b * b, 2 * b * c, c * c]
    order = np.argsort(back, kind="stable")
    first = np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)
    own = keys[order]
    least, greatest = (f.reduceat(own, first) if len(own) else own for f in (np.minimum, np.maximum))
    # every partial sum is a whole number below 2**53
    added = [np.bincount(back, t, len(kinds)).astype(np.int64) for t in terms]
    return np.stack([kinds >> 12, (kinds & 4095) - 2048, n, least, greatest, *added])


_PARTS = T.StructType([T.StructField("column_name", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("digit", "power", "values", "least", "greatest", *SUMS)]])


def partial_sums(df: DataFrame) -> DataFrame:
    """Per column of doubles, first digit of the keys and power of two: number
    of values, least and greatest key, ``SUMS``. A column has at most some
    65,000 rows, usually a few dozen; so has what each task sends."""
    importable(df.sparkSession)
    names = df.columns

    def summed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[int]] = {}
        for batch in stream:
            for name, column in zip(names, batch.columns, strict=True):
                keys = keys_of(column)
                for a in range(0, len(keys), _ROWS):
                    for digit, power, n, least, greatest, *sums in _sums(keys[a : a + _ROWS]).T.tolist():
                        old = held.get((name, digit, power))
                        held[name, digit, power] = [n, least, greatest, *sums] if old is None else [old[0] + n, min(old[1], least), max(old[2], greatest), *map(sum, zip(old[3:], sums, strict=True))]
                        if max(map(abs, held[name, digit, power][3:])) >= 1 << 61:  # hand on before a long is full
                            yield _batch([((name, digit, power), held.pop((name, digit, power)))])
        yield _batch(list(held.items()))

    one = df.mapInArrow(summed, _PARTS)
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    return one.groupBy("column_name", "digit", "power").agg(F.sum("values").alias("values"), F.min("least").alias("least"), F.max("greatest").alias("greatest"), *map(wide, SUMS))


def _batch(rows: list[tuple[tuple, list[int]]]) -> pa.RecordBatch:
    columns = list(zip(*[(*k, *v) for k, v in rows], strict=True)) if rows else [()] * len(_PARTS)
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=_PARTS.names)


def _root(x: Fraction) -> float:
    """The square root, rounded once."""
    if not x:
        return 0.0
    shift = 160 - (x.numerator.bit_length() - x.denominator.bit_length())
    shift += shift % 2
    scaled, rest = divmod(x.numerator << max(shift, 0), x.denominator << max(-shift, 0))
    root = math.isqrt(scaled)
    inexact = bool(rest) or root * root != scaled
    return float(Fraction(2 * root + inexact) / 2 * Fraction(2) ** (-shift // 2))


def moments(parts: list[dict]) -> tuple[int, float | None, float | None]:
    """Number of values, mean and sample standard deviation of one column, from
    its rows of ``partial_sums``; None where there are too few values."""
    n = sum(p["values"] for p in parts)
    if not n:
        return 0, None, None
    added = lambda p, kind, k: sum(int(p[f"{kind}{i}"]) << _LIMB * i for i in range(k))
    infinite = [p for p in parts if p["power"] == _INFINITE - _BIAS - _FRACTION]
    if infinite:
        sign = {Fraction(added(p, "s", 3), p["values"] << _FRACTION) for p in infinite}
        return n, math.inf if sign == {1} else -math.inf if sign == {-1} else math.nan, None if n < 2 else math.nan
    base = min(p["power"] for p in parts)
    total = sum(added(p, "s", 3) << (p["power"] - base) for p in parts)
    squares = sum(added(p, "q", 5) << 2 * (p["power"] - base) for p in parts)
    unit = Fraction(2) ** base
    mean = float(Fraction(total, n) * unit)
    if n < 2:
        return n, mean, None
    return n, mean, _root(Fraction(squares * n - total * total, n * (n - 1)) * unit * unit)


def digit_counts(df: DataFrame, asked: list[tuple[str, int]], done: int, bits: int) -> DataFrame:
    """(_g, _p, _digit, _count): of the doubles in column ``_g`` whose key
    begins with the ``done`` bits ``_p``, one of ``asked``, how many have which
    next ``bits``. A task sends one row for each digit it has met."""
    importable(df.sparkSession)
    names = df.columns
    prefixes = {name: np.array(sorted({p for g, p in asked if g == name}), np.int64) for name in names}
    schema = T.StructType([T.StructField("_g", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("_p", "_digit", "_count")]])

    def counted(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in stream:
            for name, column in zip(names, batch.columns, strict=True):
                if not len(prefixes[name]):
                    continue
                keys = keys_of(column)
                near = keys[np.isin(keys >> (64 - done), prefixes[name])] >> (64 - done - bits)
                own = held.setdefault(name, [])
                own.append(np.unique(near, return_counts=True))
                if len(own) > 32:
                    held[name] = [_added(own)]
        for name, own in held.items():
            found, n = _added(own)
            columns = [pa.array([name] * len(found), pa.string()), pa.array(found >> bits), pa.array(found & ((1 << bits) - 1)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(counted, schema).groupBy("_g", "_p", "_digit").agg(F.sum("_count").alias("_count"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    found, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(found), np.int64)
    np.add.at(counts, back, np.concatenate([p[1] for p in parts]))
    return found, counts
