"""Decoding expressions: flags, bands, state labels, padding."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AGE_BANDS, AGE_BAND_LABELS, CONDITION_DISPLAY_LABELS, SSA_STATES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_band(age: Column | str) -> Column:
    """Band label by upper bound; a null age falls through to the last band."""
    a = _col(age)
    expr = None
    for upper, label in AGE_BANDS:
        if upper is None:
            return expr.otherwise(F.lit(label))
        expr = F.when(a < upper, F.lit(label)) if expr is None else expr.when(a < upper, F.lit(label))
    return expr


def age_band_sort_key(band: Column | str) -> Column:
    """Display order of a band label (unknown labels sort last)."""
    b = _col(band)
    expr = None
    for i, label in enumerate(AGE_BAND_LABELS[:-1]):
        expr = F.when(b == label, F.lit(i)) if expr is None else expr.when(b == label, F.lit(i))
    return expr.otherwise(F.lit(len(AGE_BAND_LABELS) - 1))


def flag_from_text(raw: Column | str) -> Column:
    """'1' -> true, any other non-null -> false, null -> null (no coalesce)."""
    return _col(raw) == F.lit("1")


def count_true(flags: list[str]) -> Column:
    """Row-wise count of true flags; one null flag makes the count null."""
    return functools.reduce(operator.add, [_col(f).cast("int") for f in flags])


def count_true_nulls_as_false(flags: list[Column]) -> Column:
    """Row-wise count where a null flag counts as not present (profiling)."""
    return functools.reduce(operator.add, [F.coalesce(f, F.lit(False)).cast("int") for f in flags])


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs: list[tuple[str, str]]) -> Column:
    """A constant string map built from one SQL expression (one driver round
    trip instead of one per literal); Catalyst folds it to a constant."""
    return F.expr("map(" + ", ".join(f"{_sql_str(k)}, {_sql_str(v)}" for k, v in pairs) + ")")


def state_lookup(code: Column | str, field: str) -> Column:
    """Code -> 'abbr' or 'name' through a literal map; a miss is null."""
    index = {"abbr": 1, "name": 2}[field]
    return literal_map([(row[0], row[index]) for row in SSA_STATES])[_col(code)]


def pad_code(code: Column | str, width: int = 2) -> Column:
    """Left-pad a numeric code with zeros (text longer than ``width`` is
    truncated, as SQL ``lpad`` does)."""
    return F.lpad(_col(code).cast("string"), width, "0")


def display_label(flag_name: Column | str) -> Column:
    return literal_map(list(CONDITION_DISPLAY_LABELS.items()))[_col(flag_name)]
