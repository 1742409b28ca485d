"""Versioned tables: a published name is a view over a numbered table.

Writing a new version never touches the published one. The catalog is the
journal: a version is registered as ``writing`` before its first file, becomes
``ready`` when it is complete and checked, and is published by replacing the
view, which is one catalog operation. Whatever step a run stops at, the name
reads the old rows or the new ones. ``recover``, at the start of the next run,
finishes a publication that was ready and drops what was still being written.
The version before the published one is kept for readers that began on it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

STATE, VERSION, NOTE = "benelake.state", "benelake.version", "benelake.note."
_NUMBERED = re.compile(r"^(.+)__v(\d+)$")


def reached(step: str) -> None:
    """Called after each step: created, written, ready, pointed, swept."""


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _numbers(spark: SparkSession, name: str) -> list[int]:
    database, _, base = name.rpartition(".")
    place = f" IN `{database}`" if database else ""
    found = [_NUMBERED.match(r["tableName"]) for r in spark.sql(f"SHOW TABLES{place} LIKE '{base}__v*'").collect() if not r["isTemporary"]]
    return sorted(int(m[2]) for m in found if m and m[1] == base.lower())


def table_of(name: str, number: int) -> str:
    return f"{name}__v{number:06d}"


def current(spark: SparkSession, name: str) -> int | None:
    """The published version of ``name``; None if there is none."""
    number = _properties(spark, name).get(VERSION) if spark.catalog.tableExists(name) else None
    return int(number) if number else None


def notes(spark: SparkSession, name: str) -> dict[str, str]:
    """What ``publish`` noted with the published version."""
    number = current(spark, name)
    if number is None:
        return {}
    found = _properties(spark, table_of(name, number))
    return {k.removeprefix(NOTE): v for k, v in found.items() if k.startswith(NOTE)}


def _set(spark: SparkSession, table: str, properties: dict[str, object]) -> None:
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def annotate(spark: SparkSession, name: str, note: dict[str, object]) -> None:
    """Note more about the published version of ``name``."""
    _set(spark, table_of(name, current(spark, name)), {NOTE + k: v for k, v in note.items()})


def begin(df: DataFrame, name: str, bucket_by: tuple[int, str] | None = None, clustered: bool = False) -> str:
    """Write ``df`` as the next version of ``name`` and return that table's
    name. ``bucket_by=(n, key)`` buckets and sorts it by ``key``; the rows are
    hash-partitioned on the key first, which is the bucket's own hash, so each
    task writes whole buckets (``clustered``: they already are)."""
    spark = df.sparkSession
    table = table_of(name, max([0, *_numbers(spark, name)]) + 1)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    buckets = f" CLUSTERED BY (`{bucket_by[1]}`) SORTED BY (`{bucket_by[1]}`) INTO {bucket_by[0]} BUCKETS" if bucket_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{buckets} TBLPROPERTIES ('{STATE}' = 'writing')")
    reached("created")
    if bucket_by and not clustered:
        df = df.repartition(bucket_by[0], bucket_by[1])
    df.write.mode("overwrite").insertInto(table)
    reached("written")
    return table


def abandon(spark: SparkSession, table: str) -> None:
    """Drop a version that is not going to be published."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _point(spark: SparkSession, name: str, number: int, columns: list[str] | None = None) -> None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        # a plain table of that name becomes version 0, ready like any other
        _set(spark, name, {STATE: "ready"})
        spark.sql(f"ALTER TABLE {name} RENAME TO {table_of(name, 0)}")
    listed = ", ".join(f"`{c}`" for c in columns) if columns else "*"
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{number}') AS SELECT {listed} FROM {table_of(name, number)}")


def _sweep(spark: SparkSession, name: str, number: int) -> None:
    older = [n for n in _numbers(spark, name) if n < number]
    for n in older[:-1]:
        abandon(spark, table_of(name, n))


def publish(spark: SparkSession, staged: str, name: str, note: dict[str, object] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Publish the complete table ``staged`` as ``name`` (of its ``columns``,
    by default all), with what is to be noted about it. A staged table that is
    not a version of ``name`` becomes its next one."""
    found = _NUMBERED.match(staged)
    if not found or found[1] != name:
        number = max([0, *_numbers(spark, name)]) + 1
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table_of(name, number)}")
        staged = table_of(name, number)
    number = int(_NUMBERED.match(staged)[2])
    shown = {NOTE + "columns": ",".join(columns)} if columns else {}
    _set(spark, staged, {STATE: "ready", **shown, **{NOTE + k: v for k, v in (note or {}).items()}})
    reached("ready")
    _point(spark, name, number, columns)
    reached("pointed")
    _sweep(spark, name, number)
    reached("swept")
    return spark.table(name)


def recover(spark: SparkSession, database: str) -> dict[str, int]:
    """Bring ``database`` to rest after a run that stopped somewhere: publish
    the newest ready version of each name, drop unfinished and superseded ones.
    Returns the names whose version changed. Run it while nothing else writes."""
    found: dict[str, list[int]] = {}
    for r in spark.sql(f"SHOW TABLES IN `{database}`").collect():
        if not r["isTemporary"] and (m := _NUMBERED.match(r["tableName"])):
            found.setdefault(m[1], []).append(int(m[2]))
    moved = {}
    for base, numbers in found.items():
        name, numbers = f"{database}.{base}", sorted(numbers)
        newest = _properties(spark, table_of(name, numbers[-1]))
        while newest.get(STATE) != "ready":  # unfinished
            abandon(spark, table_of(name, numbers.pop()))
            if not numbers:
                break
            newest = _properties(spark, table_of(name, numbers[-1]))
        if numbers and current(spark, name) != numbers[-1]:
            shown = newest.get(NOTE + "columns")
            _point(spark, name, numbers[-1], shown.split(",") if shown else None)
            moved[name] = numbers[-1]
        for n in numbers[:-2]:
            abandon(spark, table_of(name, n))
    return moved
