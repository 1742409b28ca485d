"""Data-quality checks: landing gate, column tests, contracts, unit fixtures.

Column tests return failure counts as DataFrames (one row per test) so a
whole suite is a union of small aggregates; ``raise_on_failures`` turns a
collected result (a handful of rows) into an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ID_COLUMN, MIN_EXPECTED_ROWS, RAW_COLUMNS

class DataQualityError(ValueError):
    pass


def _result(df: DataFrame, test: str, model: str, column: str) -> DataFrame:
    return df.select(
        F.lit(test).alias("test"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.col("failures").cast("long").alias("failures"),
    )


def not_null(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """Failures = rows where ``column`` is null."""
    return _result(df.agg(F.count_if(F.col(column).isNull()).alias("failures")), "not_null", model, column)


def unique(df: DataFrame, column: str | list[str], model: str = "") -> DataFrame:
    """Failures = non-null key values that occur more than once."""
    keys = [column] if isinstance(column, str) else list(column)
    keyed = df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)) if keys else df
    dup = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return _result(dup.agg(F.count(F.lit(1)).alias("failures")), "unique", model, ",".join(keys))


def accepted_values(df: DataFrame, column: str, values: list, model: str = "") -> DataFrame:
    """Failures = distinct non-null values outside ``values``."""
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values))).select(column).distinct()
    return _result(bad.agg(F.count(F.lit(1)).alias("failures")), "accepted_values", model, column)


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str, model: str = "") -> DataFrame:
    """Failures = child rows whose non-null key has no parent row.

    Both sides are reduced to distinct keys first (the child side carrying
    a row count, combined map-side), so a key holding a third of the child
    rows reaches the anti-join as one row - no skewed join partition."""
    keys = parent.select(F.col(field).alias("_k")).distinct()
    per_key = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_c")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    orphans = per_key.join(keys, F.col("_c") == F.col("_k"), "left_anti")
    return _result(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures")), "relationships", model, column)


def column_checks(df: DataFrame, model: str, not_null_cols: list[str] = (),
                  accepted: dict[str, list] | None = None) -> DataFrame:
    """Every not-null and accepted-values test of one model in a single
    aggregate pass, one result row per test."""
    checks = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null_cols]
    for c, values in (accepted or {}).items():
        bad = F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(values)), F.col(c))
        checks.append(("accepted_values", c, F.count_distinct(bad)))
    packed = F.array(
        *[
            F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"), agg.cast("long").alias("failures"))
            for t, c, agg in checks
        ]
    )
    return df.agg(packed.alias("_r")).select(F.explode("_r").alias("r")).select(
        "r.test", F.lit(model).alias("model"), "r.column_name", "r.failures"
    )


def run_suite(results: list[DataFrame]) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def raise_on_failures(suite: DataFrame) -> list[dict]:
    """Collect a suite result (one row per test) and raise if any failed."""
    rows = [r.asDict() for r in suite.collect()]
    failed = [r for r in rows if r["failures"]]
    if failed:
        lines = [f"{r['test']}({r['model']}.{r['column_name']}): {r['failures']} failures" for r in failed]
        raise DataQualityError("data tests failed:\n" + "\n".join(lines))
    return rows


# ---------------------------------------------------------------------------
# Landing gate
# ---------------------------------------------------------------------------


def gate_metrics(df: DataFrame, id_col: str = ID_COLUMN) -> DataFrame:
    """One row ``(row_count, column_count, duplicate_ids)`` in one pass over
    the per-id counts (null ids form one group)."""
    per_id = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_ids"),
    )


def require_columns(df: DataFrame, expected: list[str]) -> None:
    absent = [c for c in expected if c not in df.columns]
    if absent:
        raise DataQualityError(f"the landing lacks {len(absent)} of {len(expected)} columns: {', '.join(absent)}")


def validate_landing(df: DataFrame, min_expected_rows: int = MIN_EXPECTED_ROWS, expected_columns: list[str] = RAW_COLUMNS) -> dict:
    """Row and column counts of a landing, or the first failure: columns, then
    size, then repeated ids. Extra columns are allowed."""
    require_columns(df, expected_columns)
    return check_gate(gate_metrics(df).first().asDict(), min_expected_rows)


def check_gate(found: dict, min_expected_rows: int = MIN_EXPECTED_ROWS) -> dict:
    """The figures of ``gate_metrics`` if they pass."""
    rows, repeated = found["row_count"], found.pop("duplicate_ids")
    for failed, why in ((rows < min_expected_rows, f"the landing has {rows} rows; the floor is {min_expected_rows}"), (repeated, f"{repeated} rows of the landing repeat an id ({ID_COLUMN})")):
        if failed:
            raise DataQualityError(why)
    return found


# ---------------------------------------------------------------------------
# Contracts
# ---------------------------------------------------------------------------


@dataclass
class ContractViolation(ValueError):
    model: str
    problems: list[str]

    def __str__(self) -> str:
        return f"contract for {self.model} violated: " + "; ".join(self.problems)


def check_contract(df: DataFrame, contract: T.StructType, model: str) -> None:
    """Exact column names (in order) and types before a write."""
    expected = [(f.name, f.dataType.simpleString()) for f in contract.fields]
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    problems = []
    if [n for n, _ in expected] != [n for n, _ in actual]:
        problems.append(f"columns {[n for n, _ in actual]} != {[n for n, _ in expected]}")
    else:
        problems += [f"{n}: {a} != {e}" for (n, e), (_, a) in zip(expected, actual, strict=True) if e != a]
    if problems:
        raise ContractViolation(model, problems)


def contract_not_null(df: DataFrame, contract: T.StructType, model: str) -> DataFrame:
    """The contract's not-null constraints as a suite result."""
    return run_suite([column_checks(df, model, [f.name for f in contract.fields if not f.nullable])])


def not_null_metrics(contract: T.StructType) -> dict:
    """Null counts of the contract's not-null columns, as aggregate
    expressions to observe while the table is written."""
    return {f"null:{f.name}": F.count_if(F.col(f.name).isNull()) for f in contract.fields if not f.nullable}


def check_not_null_metrics(metrics: dict, model: str) -> None:
    bad = {k.removeprefix("null:"): v for k, v in metrics.items() if k.startswith("null:") and v}
    if bad:
        lines = [f"not_null({model}.{c}): {n} failures" for c, n in bad.items()]
        raise DataQualityError("contract not-null constraints failed:\n" + "\n".join(lines))


# ---------------------------------------------------------------------------
# Model unit fixtures: fixed rows in -> expected rows out
# ---------------------------------------------------------------------------


def fixture_frame(spark, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Rows may omit columns; omitted columns are null."""
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


def compare_rows(actual: DataFrame, expected: list[dict], key: str) -> list[str]:
    """Compare only the columns named in ``expected``; returns differences."""
    cols = sorted({c for r in expected for c in r})
    got = {r[key]: r for r in (x.asDict() for x in actual.select(*cols).collect())}
    diffs = []
    for exp in expected:
        row = got.get(exp[key])
        if row is None:
            diffs.append(f"missing row {exp[key]!r}")
            continue
        diffs += [f"{exp[key]}.{c}: {row[c]!r} != {v!r}" for c, v in exp.items() if row[c] != v]
    return diffs
