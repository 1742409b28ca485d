"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator family, each reading the TESTDATA tables (directly or through the
adapter) in full. Keys match ``benelake.oracle.ORACLE_SQL``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import codes, dates, money
from .operators import cohort, cube, dedupe, histogram, profiling, quality, reconcile, sampling
from .plans import explore, lakehouse, sample, tiles, warehouse
from .schemas import (
    CONDITION_FLAGS,
    FLAG_COLUMNS,
    ID_COLUMN,
    MEDICARE_PAID,
    MONEY_COLUMNS,
    MONTH_COLUMNS,
)
from .sinks import writers
from .sources.adapter import member_raw
from .sources.testdata import read_table, table_path

Query = Callable[[SparkSession, str], DataFrame]

# Fixed explorer filter values used by the cohort queries.
COHORT_STATES = ["CA", "FL", "IL", "MA", "TX"]
COHORT_BANDS = ["65-74", "75-84"]
COHORT_CONDITIONS = ["has_diabetes", "has_chf"]
COHORT_STATUS = "Alive"
WIDE_COHORT_BANDS = ["65-74", "75-84", "85+"]
EMPTY_COHORT_STATES = ["OTHER"]
SP_COLUMNS = list(CONDITION_FLAGS)
MUTATION_AMOUNT = 500.0


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------


def _member(spark, d):
    return member_raw(spark, d)


def _bronze(spark, d):
    return lakehouse.to_bronze(_member(spark, d))


def _silver(spark, d):
    return lakehouse.to_silver(_bronze(spark, d))


def _models(spark, d):
    return warehouse.build_from_raw(spark, _member(spark, d))


def _explorer(spark, d, source="marts"):
    if source == "raw":
        return explore.load_explorer(spark, "raw", raw=_member(spark, d))
    return explore.load_explorer(spark, "marts", models=_models(spark, d))


def _cohort(spark, d):
    return cohort.cohort_filter(_explorer(spark, d), COHORT_STATES, COHORT_BANDS, COHORT_CONDITIONS, COHORT_STATUS)


def _wide_cohort(spark, d):
    return cohort.cohort_filter(_explorer(spark, d), age_bands=WIDE_COHORT_BANDS)


def _cube(spark, d):
    return cube.build(_explorer(spark, d))


# ---------------------------------------------------------------------------
# lakehouse
# ---------------------------------------------------------------------------


def q_bronze_cast(spark, d):
    return _bronze(spark, d).drop("_ingested_at")


def q_silver_enrich(spark, d):
    return _silver(spark, d).drop("_ingested_at")


def _ages(spark, d, fn):
    b = _bronze(spark, d)
    return b.select(F.col(ID_COLUMN).alias("desynpuf_id"), F.col("BENE_BIRTH_DT").alias("birth_date"),
                    fn("BENE_BIRTH_DT").alias("age"))


def q_age_exact(spark, d):
    return _ages(spark, d, dates.age_exact)


def q_age_year_diff(spark, d):
    return _ages(spark, d, dates.age_year_diff)


def q_age_days365(spark, d):
    return _ages(spark, d, dates.age_days365)


def q_age_band_counts(spark, d):
    return _silver(spark, d).groupBy("age_band").agg(F.count(F.lit(1)).alias("beneficiaries"))


def q_state_lookup_map(spark, d):
    s = _silver(spark, d)
    return s.select(F.col(ID_COLUMN).alias("desynpuf_id"), F.col("SP_STATE_CODE").alias("state_code"),
                    "state_abbr", "state_name")


def q_state_lookup_join(spark, d):
    m = _member(spark, d).select(F.col(ID_COLUMN).alias("desynpuf_id"), F.col("SP_STATE_CODE").alias("state_code"))
    seed = F.broadcast(warehouse.state_seed(spark))  # 52 literal rows
    nation = read_table(spark, d, "nation", ["n_nationkey", "n_name"])
    joined = m.join(seed, "state_code", "left").join(
        nation, F.col("state_code").cast("int") - 1 == F.col("n_nationkey"), "left"
    )
    return joined.select("desynpuf_id", "state_code", "state_abbr", "state_name", "n_name")


def q_flag_decode(spark, d):
    s = _silver(spark, d)
    return s.select(F.col(ID_COLUMN).alias("desynpuf_id"), *FLAG_COLUMNS, "chronic_condition_count")


def q_condition_count_dist(spark, d):
    return _silver(spark, d).groupBy("chronic_condition_count").agg(F.count(F.lit(1)).alias("beneficiaries"))


def q_gold_cost_summary(spark, d):
    return lakehouse.gold_cost_summary(_silver(spark, d))


def q_gold_prevalence(spark, d):
    return lakehouse.gold_prevalence(_silver(spark, d))


def q_gold_prevalence_ordered(spark, d):
    return lakehouse.ordered_prevalence(lakehouse.gold_prevalence(_silver(spark, d)))


def q_path_metrics(spark, d):
    return reconcile.path_metrics(lakehouse.gold_cost_summary(_silver(spark, d)))


def q_silver_preview(spark, d):
    s = _silver(spark, d)
    cols = [F.col(ID_COLUMN).alias("desynpuf_id"), "age_2008", "age_band", "is_deceased", "state_abbr",
            "chronic_condition_count"]
    return s.select(*cols).orderBy("desynpuf_id").limit(5)


# ---------------------------------------------------------------------------
# warehouse
# ---------------------------------------------------------------------------


def _model(name):
    def q(spark, d):
        return _models(spark, d)[name]

    q.__name__ = f"q_{name}"
    return q


def q_nation_order_summary(spark, d):
    customer = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    orders = read_table(spark, d, "orders", ["o_custkey", "o_totalprice"])
    nation = read_table(spark, d, "nation", ["n_nationkey", "n_name"])
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(money.as_money("o_totalprice")).alias("order_total")
    )
    joined = customer.join(per_customer, "c_custkey", "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.groupBy("c_nationkey", "n_name").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.coalesce(F.sum("order_count"), F.lit(0)).cast("long").alias("order_count"),
        F.sum("order_total").cast("double").alias("total_order_value"),
        money.money_avg("order_total").alias("avg_order_value_per_customer"),
    )


# ---------------------------------------------------------------------------
# reconcile
# ---------------------------------------------------------------------------


def q_reconcile_report(spark, d):
    gold = lakehouse.gold_cost_summary(_silver(spark, d))
    fct = _models(spark, d)["fct_beneficiary_annual_cost"]
    return reconcile.report(gold, fct)


def q_reconcile_report_mutated(spark, d):
    gold = lakehouse.gold_cost_summary(_silver(spark, d))
    target = gold.agg(F.min("desynpuf_id")).scalar()
    mutated = reconcile.mutate_one(gold, "desynpuf_id", target, MUTATION_AMOUNT)
    return reconcile.report(mutated, _models(spark, d)["fct_beneficiary_annual_cost"])


def q_reconcile_three_decimals(spark, d):
    """Both paths over amounts of a tenth, which have three decimals."""
    tenth = lambda c: (F.col(c).cast("decimal(18,2)") / 10).cast("decimal(18,3)").cast("string")
    raw = _member(spark, d).withColumns({c: tenth(c) for c in MONEY_COLUMNS})
    gold = lakehouse.gold_cost_summary(lakehouse.to_silver(lakehouse.to_bronze(raw)))
    return reconcile.report(gold, warehouse.build_from_raw(spark, raw)["fct_beneficiary_annual_cost"])


# ---------------------------------------------------------------------------
# explorer
# ---------------------------------------------------------------------------


def q_explorer_frame(spark, d):
    return _explorer(spark, d, "marts")


def q_explorer_frame_raw(spark, d):
    return _explorer(spark, d, "raw")


def q_cohort_cube(spark, d):
    cells = _cube(spark, d)
    return cells.withColumn("paid", F.col("paid").cast("double"))


def q_cohort_filter(spark, d):
    return _cohort(spark, d)


def q_cohort_kpis(spark, d):
    return cube.kpis(cube.cells(_cube(spark, d), COHORT_STATES, COHORT_BANDS, COHORT_CONDITIONS, COHORT_STATUS))


def q_cohort_kpis_empty(spark, d):
    return cube.kpis(cube.cells(_cube(spark, d), states=EMPTY_COHORT_STATES))


def q_cohort_state_table(spark, d):
    return cube.state_table(cube.cells(_cube(spark, d), age_bands=WIDE_COHORT_BANDS))


def q_cohort_prevalence(spark, d):
    return cube.prevalence(cube.cells(_cube(spark, d), age_bands=WIDE_COHORT_BANDS))


def q_cohort_histogram(spark, d):
    return histogram.histogram(_wide_cohort(spark, d), "total_medicare_reimbursement", 40)


def q_condition_rank_labelled(spark, d):
    return cube.condition_ranking(_cube(spark, d))


def q_state_options(spark, d):
    return cube.state_options(_cube(spark, d))


# ---------------------------------------------------------------------------
# dashboard tiles
# ---------------------------------------------------------------------------


def q_tile_scorecards(spark, d):
    return tiles.scorecards(_models(spark, d)["mart_state_cost_summary"])


def q_tile_geo(spark, d):
    return tiles.geo(_models(spark, d)["mart_state_cost_summary"])


def q_tile_prevalence_rank(spark, d):
    return tiles.prevalence_rank(_models(spark, d)["mart_chronic_condition_prevalence"])


def q_tile_avg_cost_rank(spark, d):
    return tiles.avg_cost_rank(_models(spark, d)["mart_chronic_condition_prevalence"])


def q_tile_condition_count(spark, d):
    return tiles.condition_count_distribution(_models(spark, d)["dim_beneficiary"])


def q_tile_cost_mix(spark, d):
    m = _models(spark, d)
    return tiles.cost_mix(tiles.cost_mix_source(m["fct_beneficiary_annual_cost"], m["dim_beneficiary"]))


def q_tile_cost_by_band(spark, d):
    m = _models(spark, d)
    return tiles.cost_by_band(tiles.cost_mix_source(m["fct_beneficiary_annual_cost"], m["dim_beneficiary"]))


# ---------------------------------------------------------------------------
# profiling
# ---------------------------------------------------------------------------


def q_profile_shape(spark, d):
    return profiling.shape(_member(spark, d))


def q_profile_nulls(spark, d):
    return profiling.null_counts(_member(spark, d))


def q_profile_null_rate(spark, d):
    return profiling.null_rates(_member(spark, d))


def q_profile_domains(spark, d):
    return profiling.domains(_member(spark, d), SP_COLUMNS)


def q_value_counts_top10(spark, d):
    return profiling.value_counts(read_table(spark, d, "customer", ["c_nationkey"]), "c_nationkey", 10)


def q_value_counts_priority(spark, d):
    return profiling.value_counts(read_table(spark, d, "orders", ["o_orderpriority"]), "o_orderpriority")


def q_value_counts_state_top10(spark, d):
    return profiling.value_counts(_member(spark, d), "SP_STATE_CODE", 10)


DEMOGRAPHIC_CODES = ["BENE_SEX_IDENT_CD", "BENE_RACE_CD", "BENE_ESRD_IND"]


def q_value_counts_demographics(spark, d):
    return profiling.value_counts_by_column(_member(spark, d), DEMOGRAPHIC_CODES)


def _described(df, columns, stored=False):
    """``profiling.describe``; the other engine's standard deviation is good
    for ten digits, so that many are compared."""
    return profiling.describe(df, columns, stored=stored).withColumn("std", F.format_string("%.9e", "std").cast("double"))


def q_describe_total_cost(spark, d):
    b = _bronze(spark, d).select(money.total(*MEDICARE_PAID).alias("total_cost"))
    return _described(b, ["total_cost"])


def q_describe_age(spark, d):
    b = _bronze(spark, d).select(dates.age_days365("BENE_BIRTH_DT").alias("age_2008"))
    return _described(b, ["age_2008"])


def q_nunique(spark, d):
    return profiling.distinct_counts(read_table(spark, d, "customer"))


def q_describe_money(spark, d):
    return _described(_bronze(spark, d), MONEY_COLUMNS)


def q_describe_months(spark, d):
    return _described(_bronze(spark, d), MONTH_COLUMNS)


def q_describe_lineitem(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _described(read_table(spark, d, "lineitem", cols), cols, stored=True)


def q_describe_ratio(spark, d):
    li = read_table(spark, d, "lineitem", ["l_quantity", "l_tax"])
    return _described(li.select((F.col("l_tax") / F.col("l_quantity")).alias("tax_per_unit")), ["tax_per_unit"], stored=True)


def q_negative_amounts(spark, d):
    return profiling.negative_amounts(_bronze(spark, d), MONEY_COLUMNS)


def q_zero_negative_share(spark, d):
    b = _bronze(spark, d).select(money.total(*MEDICARE_PAID).alias("total_cost"))
    return profiling.sign_shares(b, "total_cost")


def q_acctbal_signs(spark, d):
    return profiling.sign_shares(read_table(spark, d, "customer", ["c_acctbal"]), "c_acctbal")


def q_under65_share(spark, d):
    b = _bronze(spark, d)
    return b.agg(money.share(dates.age_days365("BENE_BIRTH_DT") < 65).alias("under65_share"))


def q_raw_flag_prevalence(spark, d):
    return profiling.text_shares(_member(spark, d), SP_COLUMNS, "1")


def q_raw_flag_count_describe(spark, d):
    m = _member(spark, d)
    counted = m.select(codes.count_true_nulls_as_false([F.col(c) == "1" for c in SP_COLUMNS]).alias("flag_count"))
    return _described(counted, ["flag_count"])


# ---------------------------------------------------------------------------
# dedupe, sampling
# ---------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


def q_dup_key_count(spark, d):
    return dedupe.surplus_duplicates(read_table(spark, d, "lineitem", LINE_KEY), LINE_KEY)


def q_dedupe_keyed(spark, d):
    return dedupe.dedupe_first(read_table(spark, d, "lineitem"), LINE_KEY)


def q_stratified_sample(spark, d):
    return sampling.stratified(read_table(spark, d, "customer"), "c_nationkey", "c_custkey", 6)


def q_stratified_docs(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "lang", "source", "n_chars"])
    return sampling.stratified(docs, "lang", "doc_id", 6)


def q_rare_sample(spark, d):
    return sample.deceased_part(_member(spark, d))


def q_sample_union(spark, d):
    return sample.generate_sample(_member(spark, d))


def q_sample_report(spark, d):
    m = _member(spark, d)
    return sample.sample_report(m, sample.generate_sample(m))


# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------


def q_dq_not_null(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, d, "customer", ["c_custkey", "c_name"])
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"])
    return quality.run_suite([
        quality.column_checks(o, "orders", ["o_orderkey", "o_custkey"]),
        quality.column_checks(c, "customer", ["c_custkey", "c_name"]),
        quality.column_checks(li, "lineitem", ["l_orderkey"]),
    ])


def q_dq_unique(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey"])
    c = read_table(spark, d, "customer", ["c_custkey", "c_name"])
    li = read_table(spark, d, "lineitem", LINE_KEY)
    return quality.run_suite([
        quality.unique(o, "o_orderkey", "orders"),
        quality.unique(c, "c_custkey", "customer"),
        quality.unique(c, "c_name", "customer"),
        quality.unique(li, LINE_KEY, "lineitem"),
    ])


def q_dq_accepted_values(spark, d):
    o = read_table(spark, d, "orders", ["o_orderstatus", "o_orderpriority"])
    c = read_table(spark, d, "customer", ["c_mktsegment"])
    li = read_table(spark, d, "lineitem", ["l_returnflag", "l_linestatus"])
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return quality.run_suite([
        quality.column_checks(o, "orders", accepted={"o_orderstatus": ["F", "O", "P"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}),
        quality.column_checks(c, "customer", accepted={"c_mktsegment": segments}),
        quality.column_checks(li, "lineitem", accepted={"l_returnflag": ["A", "N", "R"], "l_linestatus": ["O"]}),
    ])


def q_dq_relationships(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, d, "customer", ["c_custkey"])
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_suppkey"])
    s = read_table(spark, d, "supplier", ["s_suppkey"])
    return quality.run_suite([
        quality.relationships(o, "o_custkey", c, "c_custkey", "orders"),
        quality.relationships(li, "l_orderkey", o, "o_orderkey", "lineitem"),
        quality.relationships(li, "l_suppkey", s, "s_suppkey", "lineitem"),
    ])


def q_warehouse_data_tests(spark, d):
    from .plans.pipeline import data_tests

    return data_tests(_models(spark, d))


# ---------------------------------------------------------------------------
# ingest
# ---------------------------------------------------------------------------


def q_landing_gate(spark, d):
    return quality.gate_metrics(_member(spark, d))


def q_manifest(spark, d):
    path = table_path(d, "lineitem")
    return writers.manifest(spark, path, spark.read.parquet(path)).drop("ingested_at")


def q_deceased_raw_text(spark, d):
    # Blank text for ids ending in 7, to exercise the "blank is alive" rule.
    death = F.when(F.col(ID_COLUMN).endswith("7"), F.lit("")).otherwise(F.col("BENE_DEATH_DT"))
    m = _member(spark, d).withColumn("BENE_DEATH_DT", death)
    return m.select(
        F.col(ID_COLUMN).alias("desynpuf_id"),
        F.col("BENE_DEATH_DT").isNotNull().alias("death_text_present"),
        explore.is_deceased("BENE_DEATH_DT").alias("is_deceased"),
    )


QUERIES: dict[str, Query] = {
    # lakehouse
    "bronze_cast": q_bronze_cast,
    "silver_enrich": q_silver_enrich,
    "age_exact": q_age_exact,
    "age_year_diff": q_age_year_diff,
    "age_days365": q_age_days365,
    "age_band_counts": q_age_band_counts,
    "state_lookup_map": q_state_lookup_map,
    "state_lookup_join": q_state_lookup_join,
    "flag_decode": q_flag_decode,
    "condition_count_dist": q_condition_count_dist,
    "gold_cost_summary": q_gold_cost_summary,
    "gold_prevalence": q_gold_prevalence,
    "gold_prevalence_ordered": q_gold_prevalence_ordered,
    "path_metrics": q_path_metrics,
    "silver_preview": q_silver_preview,
    # warehouse
    "staging": _model("stg_beneficiary_summary"),
    "int_conditions": _model("int_beneficiary_chronic_conditions"),
    "int_annual_cost": _model("int_beneficiary_annual_cost"),
    "dim": _model("dim_beneficiary"),
    "fct": _model("fct_beneficiary_annual_cost"),
    "mart_state_summary": _model("mart_state_cost_summary"),
    "mart_prevalence": _model("mart_chronic_condition_prevalence"),
    "nation_order_summary": q_nation_order_summary,
    # reconcile
    "reconcile_report": q_reconcile_report,
    "reconcile_report_mutated": q_reconcile_report_mutated,
    "reconcile_three_decimals": q_reconcile_three_decimals,
    # explorer
    "explorer_frame": q_explorer_frame,
    "explorer_frame_raw": q_explorer_frame_raw,
    "cohort_cube": q_cohort_cube,
    "cohort_filter": q_cohort_filter,
    "cohort_kpis": q_cohort_kpis,
    "cohort_kpis_empty": q_cohort_kpis_empty,
    "cohort_state_table": q_cohort_state_table,
    "cohort_prevalence": q_cohort_prevalence,
    "cohort_histogram": q_cohort_histogram,
    "condition_rank_labelled": q_condition_rank_labelled,
    "state_options": q_state_options,
    # tiles
    "tile_scorecards": q_tile_scorecards,
    "tile_geo": q_tile_geo,
    "tile_prevalence_rank": q_tile_prevalence_rank,
    "tile_avg_cost_rank": q_tile_avg_cost_rank,
    "tile_condition_count": q_tile_condition_count,
    "tile_cost_mix": q_tile_cost_mix,
    "tile_cost_by_band": q_tile_cost_by_band,
    # profiling
    "profile_shape": q_profile_shape,
    "profile_nulls": q_profile_nulls,
    "profile_null_rate": q_profile_null_rate,
    "profile_domains": q_profile_domains,
    "value_counts_top10": q_value_counts_top10,
    "value_counts_priority": q_value_counts_priority,
    "value_counts_state_top10": q_value_counts_state_top10,
    "value_counts_demographics": q_value_counts_demographics,
    "nunique": q_nunique,
    "describe_money": q_describe_money,
    "describe_months": q_describe_months,
    "describe_lineitem": q_describe_lineitem,
    "describe_ratio": q_describe_ratio,
    "describe_total_cost": q_describe_total_cost,
    "describe_age": q_describe_age,
    "negative_amounts": q_negative_amounts,
    "zero_negative_share": q_zero_negative_share,
    "acctbal_signs": q_acctbal_signs,
    "under65_share": q_under65_share,
    "raw_flag_prevalence": q_raw_flag_prevalence,
    "raw_flag_count_describe": q_raw_flag_count_describe,
    # dedupe, sampling
    "dup_key_count": q_dup_key_count,
    "dedupe_keyed": q_dedupe_keyed,
    "stratified_sample": q_stratified_sample,
    "stratified_docs": q_stratified_docs,
    "rare_sample": q_rare_sample,
    "sample_union": q_sample_union,
    "sample_report": q_sample_report,
    # data quality, ingest
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_relationships": q_dq_relationships,
    "warehouse_data_tests": q_warehouse_data_tests,
    "landing_gate": q_landing_gate,
    "manifest": q_manifest,
    "deceased_raw_text": q_deceased_raw_text,
}
