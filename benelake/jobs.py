"""Command-line jobs with parameterised paths.

    python -m benelake.jobs lakehouse --input raw.csv --bronze-output B --silver-output S [--gold-output G]
    python -m benelake.jobs sample --input raw.csv --output DIR
    python -m benelake.jobs full --input raw.csv [--min-rows N] [--manifest-output M] [--seed states.csv]
    python -m benelake.jobs fixtures
    python -m benelake.jobs profile --input raw.csv --output DIR
    python -m benelake.jobs explore --output DIR [--namespace N] [--states CA,TX] [--age-bands 65-74,85+]
        [--conditions has_chf] [--status Alive] [--max-bins 40]

The session comes from ``SparkSession.builder`` (the cluster launcher sets
master and ``spark.checkpoint.dir``); every write is a full overwrite.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import cohort, cube, histogram
from .plans import explore, fixtures, lakehouse, pipeline, profile, sample
from .schemas import MIN_EXPECTED_ROWS
from .session import build_session
from .sinks import writers
from .sources import csv as csv_src

PREVIEW_COLUMNS = ["DESYNPUF_ID", "age_2008", "age_band", "is_deceased", "state_abbr", "chronic_condition_count"]


def run_lakehouse_paths(spark: SparkSession, input_path: str, bronze_out: str, silver_out: str,
                        gold_out: str | None = None) -> dict:
    """Strict CSV -> bronze parquet -> (read back) silver parquet -> gold.
    Returns row counts and a 5-row preview (ordered by id, so it is fixed)."""
    raw = csv_src.read_raw_csv(spark, input_path)
    writers.overwrite_parquet(lakehouse.to_bronze(raw), bronze_out)
    bronze = spark.read.parquet(bronze_out)
    writers.overwrite_parquet(lakehouse.to_silver(bronze), silver_out)
    silver = spark.read.parquet(silver_out)
    out = {"bronze_rows": bronze.count(), "silver_rows": silver.count()}
    if gold_out:
        writers.overwrite_parquet(lakehouse.gold_cost_summary(silver), f"{gold_out}/beneficiary_cost_summary")
        writers.overwrite_parquet(lakehouse.gold_prevalence(silver), f"{gold_out}/chronic_condition_prevalence")
    preview = silver.select(*PREVIEW_COLUMNS).orderBy(F.col("DESYNPUF_ID")).limit(5)
    out["preview"] = [r.asDict() for r in preview.collect()]
    return out


def run_sample(spark: SparkSession, input_path: str, output: str) -> dict:
    raw = csv_src.read_raw_csv(spark, input_path)
    smp = sample.generate_sample(raw)
    writers.single_csv(smp, output)
    return sample.sample_report(raw, spark.read.schema(raw.schema).option("header", True).csv(output)).first().asDict()


def run_profile(spark: SparkSession, input_path: str, output: str) -> dict:
    """Write every profiling view as JSON under ``output``; the CSV is parsed
    once, into ``output/_landing``."""
    writers.overwrite_parquet(csv_src.read_raw_csv(spark, input_path), f"{output}/_landing")
    raw = spark.read.parquet(f"{output}/_landing")
    out = {}
    for name, df in profile.profile_report(raw).items():
        df.write.mode("overwrite").json(f"{output}/{name}")
        out[name] = f"{output}/{name}"
    return out


def run_explore(spark: SparkSession, namespace: str, output: str, states: list[str] | None = None, age_bands: list[str] | None = None,
                conditions: list[str] | None = None, status: str = "All", max_bins: int = 40) -> dict:
    """Figures of a cohort: kpis, states, prevalence and the histogram of costs,
    from the marts that an earlier run left in the catalog. The marts are joined
    once, into the cohort cube under ``output``; the figures are sums over its
    cells. The histogram alone reads the cohort's rows."""
    frame = explore.load_explorer(spark, "marts", namespace=namespace)
    writers.overwrite_parquet(cube.build(frame), f"{output}/_cube")
    chosen = (states, age_bands, conditions, status)
    cells = cube.cells(spark.read.parquet(f"{output}/_cube"), *chosen)
    rows = cohort.cohort_filter(frame, *chosen)
    views = {"kpis": cube.kpis(cells), "states": cube.state_table(cells), "prevalence": cube.condition_ranking(cells),
             "histogram": histogram.histogram(rows, "total_medicare_reimbursement", max_bins)}
    for name, df in views.items():
        df.write.mode("overwrite").json(f"{output}/{name}")
    return {name: f"{output}/{name}" for name in views} | {"cards": cohort.kpi_display(cube.kpis(cells)).first().asDict()}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="benelake.jobs")
    sub = parser.add_subparsers(dest="cmd", required=True)
    lk = sub.add_parser("lakehouse")
    lk.add_argument("--input", required=True)
    lk.add_argument("--bronze-output", required=True)
    lk.add_argument("--silver-output", required=True)
    lk.add_argument("--gold-output")
    sm = sub.add_parser("sample")
    sm.add_argument("--input", required=True)
    sm.add_argument("--output", required=True)
    fu = sub.add_parser("full")
    fu.add_argument("--input", required=True)
    fu.add_argument("--min-rows", type=int, default=MIN_EXPECTED_ROWS)
    fu.add_argument("--manifest-output")
    fu.add_argument("--seed", help="CSV of state_code, state_abbr, state_name in place of the built-in list")
    pr = sub.add_parser("profile")
    pr.add_argument("--input", required=True)
    pr.add_argument("--output", required=True)
    ex = sub.add_parser("explore")
    ex.add_argument("--namespace", default=pipeline.Namespaces.marts)
    ex.add_argument("--output", required=True)
    for name in ("states", "age-bands", "conditions"):  # comma-separated
        ex.add_argument(f"--{name}", type=lambda text: text.split(","))
    ex.add_argument("--status", default="All", choices=cohort.STATUSES)
    ex.add_argument("--max-bins", type=int, default=40)
    sub.add_parser("fixtures")
    args = parser.parse_args(argv)

    spark = build_session()
    if args.cmd == "lakehouse":
        result = run_lakehouse_paths(spark, args.input, args.bronze_output, args.silver_output, args.gold_output)
    elif args.cmd == "sample":
        result = run_sample(spark, args.input, args.output)
    elif args.cmd == "profile":
        result = run_profile(spark, args.input, args.output)
    elif args.cmd == "fixtures":
        result = {"models": fixtures.run_fixtures(spark)}
    elif args.cmd == "explore":
        result = run_explore(spark, args.namespace, args.output, args.states, args.age_bands, args.conditions, args.status, args.max_bins)
    else:
        raw = csv_src.read_raw_csv(spark, args.input)
        seed = csv_src.read_seed_csv(spark, args.seed) if args.seed else None
        run = pipeline.run_full(spark, raw, min_expected_rows=args.min_rows, source_path=args.input, seed=seed)
        if args.manifest_output:
            writers.write_manifest(spark.table(run.tables["manifest"]), args.manifest_output)
        result = {"counts": run.counts, "reconciled": run.extra["reconciled"]}
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
