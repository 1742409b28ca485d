"""Money and ratio expressions.

Row-level totals keep the reference's double arithmetic (a null component
makes the total null). Aggregates that get rounded are computed on exact
decimals: a double sum depends on the order rows arrive in, which changes
with partitioning, so two runs on a 1000-executor cluster could otherwise
round a tie differently. An amount is taken as the decimal of at most 15
digits that its double stands for (what a double holds for certain), at its
own scale: 0.004 stays 0.004, and the noise that adding doubles leaves in the
17th digit goes. Sums hold 18 decimals and 20 digits before them; an amount or
a sum beyond that fails the job.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DECIMAL = "decimal(38,18)"
# Decimals that amounts below each bound keep: 15 digits of the largest.
_DECIMALS = [(1e-3, 18), (1.0, 15), (1e3, 12), (1e6, 9), (1e9, 6), (1e12, 3), (1e13, 2), (1e14, 1)]
# Numerator / denominator types for exact ratios: Spark then divides with 12
# fractional digits, so rounding to <= 4 places never rounds twice.
_NUM = "decimal(30,4)"
_WIDE = "decimal(20,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(*cols: Column | str) -> Column:
    """Plain ``a + b + c``: any null component gives a null total."""
    return functools.reduce(operator.add, [_col(c) for c in cols])


def as_money(c: Column | str) -> Column:
    """The exact decimal that an amount stands for."""
    x = _col(c).cast("double")
    kept = None
    for bound, scale in _DECIMALS:
        here, value = F.abs(x) < bound, x.cast(f"decimal({20 + scale},{scale})").cast(MONEY_DECIMAL)
        kept = F.when(here, value) if kept is None else kept.when(here, value)
    return kept.otherwise(x.cast("decimal(38,0)").cast(MONEY_DECIMAL))


def money_sum(c: Column | str) -> Column:
    """Exact sum of amounts, returned as double (null over no values)."""
    return F.sum(as_money(c)).cast("double")


def money_avg(c: Column | str, scale: int = 2) -> Column:
    """Exact mean of amounts rounded half-up to ``scale`` decimals, as double.
    Null when there is no non-null amount."""
    m = as_money(c)
    return F.round(F.try_divide(F.sum(m), F.count(m).cast(_WIDE)), scale).cast("double")


def ratio(numerator: Column, denominator: Column, scale: int = 4) -> Column:
    """``round(n / d, scale)`` computed on decimals, as double; null if d = 0."""
    return F.round(F.try_divide(numerator.cast(_NUM), denominator.cast(_WIDE)), scale).cast("double")


def share(predicate: Column, scale: int = 4) -> Column:
    """Mean of a boolean (null counts as false) rounded to ``scale``."""
    return ratio(F.sum(F.coalesce(predicate, F.lit(False)).cast("int")), F.count(F.lit(1)), scale)
