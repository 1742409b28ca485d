"""Date parsing and age expressions (all JVM-side column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import REFERENCE_DATE, REFERENCE_YEAR

RAW_DATE_FORMAT = "yyyyMMdd"


def parse_date(col: Column | str, strict: bool = True) -> Column:
    """``yyyyMMdd`` text -> date. Strict by default: under ANSI a malformed
    value fails the job; blank/null stays null. ``strict=False`` maps bad
    values to null instead."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(c, RAW_DATE_FORMAT) if strict else F.try_to_date(c, RAW_DATE_FORMAT)


def age_exact(birth: Column | str) -> Column:
    """Age at the reference date in whole calendar years."""
    b = F.col(birth) if isinstance(birth, str) else birth
    return F.floor(F.months_between(F.lit(REFERENCE_DATE).cast("date"), b) / F.lit(12)).cast("int")


def age_year_diff(birth: Column | str) -> Column:
    """Reference year minus birth year. Equal to ``age_exact`` only because
    the reference date is 31 December."""
    b = F.col(birth) if isinstance(birth, str) else birth
    return (F.lit(REFERENCE_YEAR) - F.year(b)).cast("int")


def age_days365(birth: Column | str) -> Column:
    """Approximate age: elapsed days integer-divided by 365 (profiling only;
    differs from ``age_exact`` near birthdays)."""
    b = F.col(birth) if isinstance(birth, str) else birth
    days = F.datediff(F.lit(REFERENCE_DATE).cast("date"), b)
    return F.floor(days / F.lit(365)).cast("int")
