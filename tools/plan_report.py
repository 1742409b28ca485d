"""Physical-plan census of every registered query (no data is read).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Plans are taken with automatic broadcast joins disabled, i.e. the shape the
plans take when every table is too large to broadcast (the 100 TB case);
only explicitly hinted broadcasts remain (the 52-row literal state seed).
Counts per query: shuffle exchanges by kind, broadcasts, join and aggregate
strategies, windows, scans with pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTS = [
    ("hash_x", r"Exchange hashpartitioning"),
    ("range_x", r"Exchange rangepartitioning"),
    ("single_x", r"Exchange SinglePartition"),
    ("bcast", r"BroadcastExchange"),
    ("smj", r"SortMergeJoin"),
    ("bhj", r"BroadcastHashJoin"),
    ("hash_agg", r"HashAggregate"),
    ("sort_agg", r"SortAggregate"),
    ("obj_agg", r"ObjectHashAggregate"),
    ("window", r"\bWindow \["),
    ("wgl", r"WindowGroupLimit"),
    ("expand", r"\bExpand\b"),
    ("scans", r"FileScan|Scan parquet"),
    ("pushed", r"PushedFilters: \[[^\]]"),
]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from benelake.queries import QUERIES
    from benelake.session import build_session

    import tempfile

    scratch = tempfile.mkdtemp(prefix="benelake-plans-")
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra_conf={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                      "spark.sql.warehouse.dir": os.path.join(scratch, "wh"),
                                      "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}"})
    print("# Plan census\n")
    print(f"Physical plans of the registered queries on `{sf_dir}` with automatic broadcast joins **disabled** "
          "(the shape at 100 TB, where no input table is small); `tools/plan_report.py` regenerates this file.\n")
    print("| query | " + " | ".join(k for k, _ in COUNTS) + " |")
    print("|---|" + "---|" * len(COUNTS))
    def row(name, df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        cells = [str(len(re.findall(p, plan))) for _, p in COUNTS]
        print(f"| {name} | " + " | ".join(cells) + " |")

    for key, fn in QUERIES.items():
        row(key, fn(spark, sf_dir))

    # Pipeline stages as they run in production: each reads the tables the
    # previous stage wrote (typed raw, dim and fct bucketed by the id).
    from pyspark.sql import functions as F

    from benelake.operators import cohort
    from benelake.plans import explore, lakehouse, pipeline, tiles, warehouse
    from benelake.sources.adapter import member_raw

    raw = member_raw(spark, sf_dir)
    state = F.when(F.col("SP_STATE_CODE") == "40", F.lit("54")).otherwise(F.col("SP_STATE_CODE"))
    raw = raw.fillna({"SP_STRKETIA": "2"}).withColumn("SP_STATE_CODE", state)
    ns = pipeline.Namespaces()
    ing = pipeline.run_ingest(spark, raw, ns, 0)
    landed = spark.table(ing.tables["raw"])
    lake = pipeline.run_lakehouse(spark, landed, ns)
    pipeline.run_warehouse(spark, landed, ns, run_tests=False)
    print("\n## Pipeline stages (reading written tables)\n")
    print("| stage | " + " | ".join(k for k, _ in COUNTS) + " |")
    print("|---|" + "---|" * len(COUNTS))
    bronze = spark.table(lake.tables["bronze"])
    silver = spark.table(lake.tables["silver"])
    row("silver <- bronze", lakehouse.to_silver(bronze))
    row("gold_cost <- silver", lakehouse.gold_cost_summary(silver))
    row("gold_prevalence <- silver", lakehouse.gold_prevalence(silver))
    typed = warehouse.register_models(spark, spark.table("claims_raw.beneficiary_summary_typed"))
    for name in ("dim_beneficiary", "fct_beneficiary_annual_cost", "mart_state_cost_summary",
                 "mart_chronic_condition_prevalence"):
        row(f"{name} <- typed raw (bucketed)", typed[name])
    dim = spark.table("claims_marts.dim_beneficiary")
    fct = spark.table("claims_marts.fct_beneficiary_annual_cost")
    stg = spark.table("claims_marts.stg_beneficiary_summary")
    ex = explore.from_marts(dim, fct, stg)
    row("explorer <- dim x fct x stg", ex)
    row("cohort KPIs <- explorer", cohort.kpis(cohort.cohort_filter(ex, ["CA"], ["65-74"], ["has_chf"], "Alive")))
    row("cost mix <- fct x dim", tiles.cost_mix(tiles.cost_mix_source(fct, dim)))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
