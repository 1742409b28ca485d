"""Reproducible fixture sample of the raw file: up to 6 rows per state plus
30 deceased beneficiaries, deduplicated by id and shuffled by a seeded
hash. All steps are distributed; the sample is small by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sampling
from ..schemas import ID_COLUMN

PER_STATE = 6
DECEASED = 30
SEED = 42


def stratified_part(raw: DataFrame, per_state: int = PER_STATE, seed: int = SEED) -> DataFrame:
    return sampling.stratified(raw, "SP_STATE_CODE", ID_COLUMN, per_state, seed)


def deceased_part(raw: DataFrame, n: int = DECEASED, seed: int = SEED) -> DataFrame:
    return sampling.fixed_size(raw.filter(F.col("BENE_DEATH_DT").isNotNull()), ID_COLUMN, n, seed)


def generate_sample(raw: DataFrame, per_state: int = PER_STATE, deceased: int = DECEASED, seed: int = SEED) -> DataFrame:
    return sampling.combine(
        [stratified_part(raw, per_state, seed), deceased_part(raw, deceased, seed)], ID_COLUMN, seed + 1
    )


def sample_report(raw: DataFrame, sample: DataFrame) -> DataFrame:
    """One row: source rows, states in source, states covered, deceased rows
    in the sample, sample rows - two one-row aggregates stacked and folded."""
    src = raw.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_distinct("SP_STATE_CODE").alias("source_states"),
        F.lit(None).cast("long").alias("sample_states"),
        F.lit(None).cast("long").alias("deceased_rows"),
        F.lit(None).cast("long").alias("sample_rows"),
    )
    smp = sample.agg(
        F.lit(None).cast("long").alias("source_rows"),
        F.lit(None).cast("long").alias("source_states"),
        F.count_distinct("SP_STATE_CODE").alias("sample_states"),
        F.count_if(F.col("BENE_DEATH_DT").isNotNull()).alias("deceased_rows"),
        F.count(F.lit(1)).alias("sample_rows"),
    )
    both = src.unionByName(smp)
    return both.agg(*[F.max(c).cast("long").alias(c) for c in src.columns])
