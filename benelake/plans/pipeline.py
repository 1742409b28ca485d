"""Runnable pipelines: ingest, lakehouse, warehouse, and the full run.

Stages hand over through written tables: each stage reads back what the
previous one wrote, so a stage is computed once, a lost executor only
re-runs the current stage, and lineage never grows across stages.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality, reconcile as rec
from ..schemas import (
    ACCEPTED_ESRD,
    ACCEPTED_RACE,
    ACCEPTED_SEX,
    AGE_BAND_LABELS,
    CONDITION_LABELS,
    ID_COLUMN,
    MART_CONTRACTS,
    MIN_EXPECTED_ROWS,
    RAW_COLUMNS,
)
from ..sinks import versions, writers
from ..sources import infer
from . import landing, lakehouse, warehouse


@dataclass
class Namespaces:
    """Database names for each layer."""

    raw: str = "claims_raw"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    marts: str = "claims_marts"

    def all(self) -> list[str]:
        return [self.raw, self.bronze, self.silver, self.gold, self.marts]


@dataclass
class RunResult:
    counts: dict[str, int] = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)
    extra: dict = field(default_factory=dict)


def bucket_count(rows: int, row_bytes: int = 400, target_bytes: int = 256 << 20, floor: int = 8) -> int:
    """Buckets for a beneficiary-grain table: about ``target_bytes`` per
    bucket file however large the table is, at least ``floor`` for
    parallelism. Only the data's size counts, no session setting."""
    return max(floor, -(-rows * row_bytes // target_bytes))


def ensure_namespaces(spark: SparkSession, ns: Namespaces) -> None:
    """Create the databases; bring what an earlier run left to rest."""
    for db in ns.all():
        writers.ensure_database(spark, db)
        versions.recover(spark, db)


def run_ingest(spark: SparkSession, raw: DataFrame, ns: Namespaces, min_expected_rows: int = MIN_EXPECTED_ROWS,
               source_path: str | None = None) -> RunResult:
    """Checksums -> id-clustered landing -> gate -> manifest -> raw table.

    The raw text is parsed once, into the next version of the raw table
    (``plans.landing``); the gate reads that version's counts of copies, and
    only a passing landing is published. A failing one is dropped and the
    published raw table is left untouched. With ``source_path`` the files'
    checksums name the run: if the published raw table came from the same
    files, nothing is parsed again."""
    ensure_namespaces(spark, ns)
    quality.require_columns(raw, RAW_COLUMNS)
    table, run, files = f"{ns.raw}.beneficiary_summary", None, None
    result = RunResult(tables={"raw": table})
    if source_path:
        files = writers.replace_table(writers.checksums(spark, source_path), f"{ns.raw}.landing_files")
        run = f"{landing.run_key(files)}:{min_expected_rows}"
        result.tables["manifest"] = f"{ns.raw}.landing_manifest"
    result.extra["run"] = run
    if known := landing.published_notes(spark, table, run):
        rows, result.extra["buckets"] = int(known["rows"]), int(known["buckets"])
        result.counts["raw"] = rows
        result.extra |= {"gate": {"row_count": rows, "column_count": len(raw.columns)}, "landed_rows": rows, "manifest_files": files.count()}
        return result
    # about 256 MB of the file, or of rows, a bucket
    buckets = bucket_count(landing.landed_bytes(files), 1) if files else bucket_count(raw.select(ID_COLUMN).count())
    staged, buckets = landing.land(raw, table, buckets, from_files=files is not None)
    landed = spark.table(staged)
    try:
        gate = quality.check_gate(landing.gate_metrics(landed, len(raw.columns)).first().asDict(), min_expected_rows)
        if files:
            # One manifest row per landed data file, written as a table (nothing
            # per-file passes through the driver).
            listed = writers.with_row_counts(files, landing.file_counts(landed))
            _, result.extra["manifest_files"] = writers.write_and_count(listed, result.tables["manifest"])
    except quality.DataQualityError:
        versions.abandon(spark, staged)
        raise
    writers.publish(spark, staged, table, {"rows": gate["row_count"], "buckets": buckets, "run": run}, list(raw.columns))
    result.counts["raw"] = gate["row_count"]
    result.extra |= {"gate": gate, "landed_rows": gate["row_count"], "buckets": buckets}
    return result


def _written(spark: SparkSession, name: str, build: Callable[[], DataFrame], bucket_by: tuple[int, str] | None, run: str | None) -> tuple[DataFrame, int]:
    """Write and publish a table, unless this run's input already gave the
    published one; the table and its number of rows."""
    if known := landing.published_notes(spark, name, run):
        return spark.table(name), int(known["rows"])
    return writers.write_and_count(build(), name, bucket_by, {"run": run})


def run_lakehouse(spark: SparkSession, raw: DataFrame, ns: Namespaces, buckets: int | None = None, run: str | None = None,
                  prepared: bool = False) -> RunResult:
    """raw -> bronze -> silver -> two gold tables, each stage read back from
    storage; the gold tables are written concurrently. With ``buckets`` bronze
    and silver keep the landing's clustering, so the dedupe needs no exchange.
    Tables that ``run`` already published are kept; ``prepared``: the namespaces
    are (recovery must not meet the other path's writes)."""
    if not prepared:
        ensure_namespaces(spark, ns)
    res = RunResult()
    by_id = (buckets, ID_COLUMN) if buckets else None
    bronze, res.counts["bronze"] = _written(spark, f"{ns.bronze}.beneficiary_summary", lambda: lakehouse.to_bronze(raw), by_id, run)
    silver, res.counts["silver"] = _written(spark, f"{ns.silver}.beneficiary", lambda: lakehouse.to_silver(bronze), by_id, run)
    # The two gold tables read only silver: submit them together.
    with ThreadPoolExecutor(max_workers=2, thread_name_prefix="benelake-gold") as pool:
        cost_f = pool.submit(_written, spark, f"{ns.gold}.beneficiary_cost_summary", lambda: lakehouse.gold_cost_summary(silver), None, run)
        prev_f = pool.submit(_written, spark, f"{ns.gold}.chronic_condition_prevalence", lambda: lakehouse.gold_prevalence(silver), None, run)
        res.counts["gold_cost"], res.counts["gold_prevalence"] = cost_f.result()[1], prev_f.result()[1]
    res.tables = {
        "bronze": f"{ns.bronze}.beneficiary_summary",
        "silver": f"{ns.silver}.beneficiary",
        "gold_cost": f"{ns.gold}.beneficiary_cost_summary",
        "gold_prevalence": f"{ns.gold}.chronic_condition_prevalence",
    }
    return res


def model_tests(name: str, models: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The column tests of one model (``raw``: the loaded raw table). Not-null
    and accepted-values tests share one aggregate pass; unique and
    relationship tests each need their own grouping."""
    q, df = quality, models[name]
    if name == "raw":
        return [q.column_checks(df, "raw", ["DESYNPUF_ID"]), q.unique(df, "DESYNPUF_ID", "raw")]
    if name == "ssa_state_codes":
        return [q.column_checks(df, name, ["state_code", "state_abbr"]), q.unique(df, "state_code", name), q.unique(df, "state_abbr", name)]
    if name == "stg_beneficiary_summary":
        accepted = {"sex_cd": ACCEPTED_SEX, "race_cd": ACCEPTED_RACE, "esrd_ind": ACCEPTED_ESRD}
        return [
            q.column_checks(df, "stg", ["desynpuf_id", "birth_date", "state_code"], accepted),
            q.unique(df, "desynpuf_id", "stg"),
            q.relationships(df, "state_code", models["ssa_state_codes"], "state_code", "stg"),
        ]
    if name == "int_beneficiary_chronic_conditions":
        return [q.column_checks(df, "int_conditions", ["desynpuf_id", "condition", "has_condition"], {"condition": list(CONDITION_LABELS.values())})]
    if name == "int_beneficiary_annual_cost":
        return [q.column_checks(df, "int_annual_cost", ["desynpuf_id", "total_cost_2008"]), q.unique(df, "desynpuf_id", "int_annual_cost")]
    if name == "dim_beneficiary":
        return [q.column_checks(df, "dim", ["desynpuf_id", "chronic_condition_count"], {"age_band": AGE_BAND_LABELS}), q.unique(df, "desynpuf_id", "dim")]
    if name == "fct_beneficiary_annual_cost":
        return [
            q.column_checks(df, "fct", ["desynpuf_id", "total_medicare_reimbursement"]),
            q.unique(df, "desynpuf_id", "fct"),
            q.relationships(df, "desynpuf_id", models["dim_beneficiary"], "desynpuf_id", "fct"),
        ]
    if name == "mart_chronic_condition_prevalence":
        return [q.column_checks(df, "mart_prevalence", ["condition", "prevalence_rate"])]
    return [q.column_checks(df, "mart_state_summary", ["state_code", "beneficiary_count"]), q.unique(df, "state_code", "mart_state_summary")]


UPSTREAM = ["ssa_state_codes", *warehouse.VIEW_NAMES]


def data_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """All 34 column tests of the warehouse as one suite result."""
    return quality.run_suite([t for name in ("raw", *UPSTREAM, *warehouse.MART_NAMES) for t in model_tests(name, models)])


def run_warehouse(spark: SparkSession, raw: DataFrame, ns: Namespaces, enforce_contracts: bool = True,
                  run_tests: bool = True, buckets: int | None = None, run: str | None = None, prepared: bool = False,
                  seed: DataFrame | None = None) -> RunResult:
    """Seed -> staging -> intermediate -> marts, each model tested before
    anything reads it.

    The id tests of the raw rows come first: they aggregate before they
    shuffle, so a blank or repeated id that holds many rows stops the run
    before the bucketed load would gather them in one task. The typed load,
    dim and fct are bucketed by the id (``buckets``; by default from the row
    count), so the marts' joins and later joins of them need no shuffle.

    A mart is written as its next version; its contract (names and types on the
    plan, not-null constraints on the written rows) and its data tests are
    checked there, and only then it is published. A failing mart's version is
    dropped, the published tables stay, and later marts are not built. Tables
    that ``run`` already published, and so passed their tests, are kept.
    Staging and intermediate models stay as views of the marts' namespace."""
    if not prepared:
        ensure_namespaces(spark, ns)
    res = RunResult()
    passed: list[dict] = []

    def test(name: str, models: Mapping[str, DataFrame]) -> None:
        if run_tests:
            passed.extend(quality.raise_on_failures(quality.run_suite(model_tests(name, models))))

    typed = f"{ns.raw}.beneficiary_summary_typed"
    if known := landing.published_notes(spark, typed, run):
        loaded, buckets = spark.table(typed), int(known["buckets"])
        models = warehouse.register_models(spark, loaded, seed)
    else:
        test("raw", {"raw": raw})
        buckets = buckets or bucket_count(raw.count())
        types = infer.infer_types(raw, RAW_COLUMNS, warehouse.PINNED_TYPES)
        loaded = writers.publish(spark, versions.begin(warehouse.inferred_load(raw, types), typed, (buckets, ID_COLUMN)), typed)
        models = warehouse.register_models(spark, loaded, seed)
        for name in UPSTREAM:
            test(name, models)
        warehouse.create_views(spark, ns.marts, typed, seed)
        versions.annotate(spark, typed, {"run": run, "buckets": buckets})  # loaded and tested
    bucketed = {"dim_beneficiary", "fct_beneficiary_annual_cost"}
    for name in warehouse.MART_NAMES:
        contract, table = MART_CONTRACTS[name], f"{ns.marts}.{name}"
        res.tables[name] = table
        if known := landing.published_notes(spark, table, run):
            models = models.having(**{name: spark.table(table)})
            res.counts[name] = int(known["rows"])
            continue
        if enforce_contracts:
            quality.check_contract(models[name], contract, name)
        staged = versions.begin(models[name], table, (buckets, "desynpuf_id") if name in bucketed else None)
        written = spark.table(staged)
        try:
            found = writers.measured(written, quality.not_null_metrics(contract) if enforce_contracts else {})
            quality.check_not_null_metrics(found, name)
            test(name, models.having(**{name: written}))
        except Exception:
            versions.abandon(spark, staged)
            raise
        published = writers.publish(spark, staged, table, {"rows": found["rows"], "run": run})
        models = models.having(**{name: published})
        res.counts[name] = int(found["rows"])
    res.extra["tests"] = passed
    return res


def run_full(spark: SparkSession, raw: DataFrame, ns: Namespaces | None = None, min_expected_rows: int = MIN_EXPECTED_ROWS,
             tolerance: float = 1.0, source_path: str | None = None, parallel: bool = True, seed: DataFrame | None = None) -> RunResult:
    """Ingest, then the two paths (independent Spark actions, submitted from
    two driver threads so the scheduler overlaps them), then reconcile the
    gold cost summary against the fact table (raises on mismatch). Stage
    wall times are returned in ``extra["stage_seconds"]``.

    With ``source_path`` each published table notes the checksums of the files
    it came from: a run that failed starts again at the first table that is
    missing, reading what is published."""
    ns = ns or Namespaces()
    clock = {}
    t = time.perf_counter()
    ingest = run_ingest(spark, raw, ns, min_expected_rows, source_path)
    clock["ingest"] = time.perf_counter() - t
    landed = spark.table(ingest.tables["raw"])
    given = {"buckets": ingest.extra["buckets"], "run": ingest.extra["run"], "prepared": True}
    t = time.perf_counter()
    if parallel:
        with ThreadPoolExecutor(max_workers=2, thread_name_prefix="benelake-path") as pool:
            lake_f = pool.submit(_timed, run_lakehouse, spark, landed, ns, **given)
            wh_f = pool.submit(_timed, run_warehouse, spark, landed, ns, seed=seed, **given)
            (lake, clock["lakehouse"]), (wh, clock["warehouse"]) = lake_f.result(), wh_f.result()
    else:
        lake, clock["lakehouse"] = _timed(run_lakehouse, spark, landed, ns, **given)
        wh, clock["warehouse"] = _timed(run_warehouse, spark, landed, ns, seed=seed, **given)
    clock["paths"] = time.perf_counter() - t
    t = time.perf_counter()
    agreed = rec.reconcile(
        spark.table(lake.tables["gold_cost"]), spark.table(wh.tables["fct_beneficiary_annual_cost"]), tolerance
    )
    clock["reconcile"] = time.perf_counter() - t
    out = RunResult(
        counts={**ingest.counts, **lake.counts, **wh.counts}, tables={**ingest.tables, **lake.tables, **wh.tables}
    )
    out.extra = {"reconciled": agreed, "stage_seconds": {k: round(v, 3) for k, v in clock.items()}, **ingest.extra}
    return out


def _timed(fn, *args, **kwargs):
    t = time.perf_counter()
    result = fn(*args, **kwargs)
    return result, time.perf_counter() - t
