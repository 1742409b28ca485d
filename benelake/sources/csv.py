"""CSV scans: strict fixed-schema raw file, type-inferring load, seed file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_SCHEMA, STATE_SEED_SCHEMA

# The text tokens pandas' CSV reader turns into missing values
# by default (besides the empty field).
PANDAS_NA_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_raw_csv(spark: SparkSession, path: str, strict_header: bool = True) -> DataFrame:
    """Header row, the fixed 32-string schema, blank -> null.

    With a schema Spark maps columns by position; ``enforceSchema=false``
    makes it check the header names against the schema, so a reordered or
    renamed file fails instead of being silently mis-assigned."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if strict_header:
        reader = reader.option("enforceSchema", False)
    return reader.schema(RAW_SCHEMA).csv(path)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Type-inferring load (an extra pass over the file): codes and dates
    come back as integers, amounts as doubles."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_text_csv(spark: SparkSession, path: str, na_tokens: list[str] | None = None) -> DataFrame:
    """All columns as text, names from the header. Blank fields are null;
    ``na_tokens`` (e.g. ``PANDAS_NA_TOKENS``) also become null, in one
    projection."""
    df = spark.read.option("header", True).csv(path)
    if not na_tokens:
        return df
    return df.select(
        *[F.when(F.col(f"`{c}`").isin(list(na_tokens)), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
          for c in df.columns]
    )


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """State seed with the code pinned to text (keeps the zero of "05")."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(STATE_SEED_SCHEMA).csv(path)
