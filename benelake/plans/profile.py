"""Profiling report of the raw file: every view as a lazy DataFrame.

Views: shape, null counts and rates, code domains, value counts of the
coded columns (state top 10), distinct counts, flag prevalence with null as
"no", the row-wise flag count described, coverage months and amounts
described, negative amounts, zero/negative total share, approximate age
described and the under-65 share. Each is one distributed pass over the
typed file (or the text file for domains and counts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates, money
from ..operators import profiling
from ..schemas import CONDITION_FLAGS, MEDICARE_PAID, MONEY_COLUMNS, MONTH_COLUMNS
from .lakehouse import to_bronze

SP_COLUMNS = list(CONDITION_FLAGS)
CODED_COLUMNS = ["BENE_SEX_IDENT_CD", "BENE_RACE_CD", "BENE_ESRD_IND"]


def profile_report(raw: DataFrame) -> dict[str, DataFrame]:
    typed = to_bronze(raw)
    total = money.total(*MEDICARE_PAID)
    age = dates.age_days365("BENE_BIRTH_DT")
    report = {
        "shape": profiling.shape(raw),
        "null_counts": profiling.null_counts(raw),
        "null_rates": profiling.null_rates(raw),
        "flag_domains": profiling.domains(raw, SP_COLUMNS),
        "state_top10": profiling.value_counts(raw, "SP_STATE_CODE", 10),
        "distinct_states": profiling.distinct_counts(raw, ["SP_STATE_CODE"]),
        "flag_prevalence": profiling.text_shares(raw, SP_COLUMNS, "1").orderBy(F.desc("prevalence"), F.asc("column_name")),
        "coded_counts": profiling.value_counts_by_column(raw, CODED_COLUMNS),
        "flag_count": profiling.describe(
            raw.select(codes.count_true_nulls_as_false([F.col(c) == "1" for c in SP_COLUMNS]).alias("flag_count")),
            ["flag_count"],
        ),
        "coverage_months": profiling.describe(typed, MONTH_COLUMNS),
        "amounts": profiling.describe(typed, MONEY_COLUMNS),
        "negative_amounts": profiling.negative_amounts(typed, MONEY_COLUMNS),
        "total_cost_signs": profiling.sign_shares(typed.select(total.alias("total_cost")), "total_cost"),
        "total_cost": profiling.describe(typed.select(total.alias("total_cost")), ["total_cost"]),
        "age": profiling.describe(typed.select(age.alias("age_2008")), ["age_2008"]),
        "under_65": typed.agg(money.share(age < 65).alias("under65_share")),
    }
    return report
