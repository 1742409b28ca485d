"""Writers. Every write replaces the whole table, so re-running a job with the
same input gives the same table and never duplicates rows. A table that others
read is written as a new version and published when it is complete
(``versions``)."""

from __future__ import annotations

import datetime as _dt
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions
from .versions import ensure_database, publish  # noqa: F401  part of this module's interface


class LoadCheckError(ValueError):
    pass


def overwrite_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_table(df: DataFrame, name: str, bucket_by: tuple[int, str] | None = None) -> DataFrame:
    """Full-overwrite managed table; returns a DataFrame reading it back, so
    downstream stages start from storage instead of recomputing the plan.
    ``bucket_by=(n, key)`` buckets the table so later joins on ``key``
    between tables bucketed alike need no shuffle."""
    if bucket_by:
        # Hash-partition on the bucket key first: Spark's bucket id is the
        # same murmur3 hash, so each task writes exactly one bucket file
        # instead of every task writing a file per bucket.
        df = df.repartition(bucket_by[0], bucket_by[1])
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, name: str, bucket_by: tuple[int, str] | None = None) -> DataFrame:
    """Write the whole table as a new version, then publish it."""
    return publish(df.sparkSession, versions.begin(df, name, bucket_by), name)


def create_table_as_select(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    """Create or replace a table from a SQL query."""
    return replace_table(spark.sql(select_sql), name)


def measured(table: DataFrame, metrics: dict[str, Column] | None = None) -> dict:
    """Row count and extra aggregates of a written table, in one pass over
    the columns they name."""
    return table.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()]).first().asDict()


def write_and_count(df: DataFrame, name: str, bucket_by: tuple[int, str] | None = None, note: dict | None = None) -> tuple[DataFrame, int]:
    """Replace a table; the table read back and its number of rows, which is
    noted with the version."""
    spark = df.sparkSession
    staged = versions.begin(df, name, bucket_by)
    rows = int(measured(spark.table(staged))["rows"])
    return publish(spark, staged, name, {**(note or {}), "rows": rows}), rows


def promote_table(spark: SparkSession, source: str, target: str, expected_rows: int) -> int:
    """Publish the already-written ``source`` as ``target`` if it has the
    expected number of rows (nothing is copied)."""
    n = spark.table(source).count()
    if n != expected_rows:
        raise LoadCheckError(f"{source} holds {n} rows instead of {expected_rows}")
    publish(spark, source, target, {"rows": n})
    return n


def single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header - for small outputs only (a sample)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


_BLOCK = 8 << 20


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each file, read in blocks: a file of any size takes one
    block of memory."""
    for batch in batches:
        digests = []
        for path in batch.column(0).to_pylist():
            local = re.sub("^file:/+", "/", path)
            store, place = (pafs.LocalFileSystem(), local) if local.startswith("/") else pafs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with store.open_input_stream(place) as source:
                while block := source.read(_BLOCK):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], ["path", "bytes", "sha256"])


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """``(file, sha256, bytes)`` of each data file of a landed file or folder,
    hashed on the executors, in blocks."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))
    name = F.element_at(F.split("path", "/"), -1)
    # Skip markers and hidden files (_SUCCESS, .crc) on any file system.
    files = files.filter(~name.startswith("_") & ~name.startswith("."))
    return files.mapInArrow(_digest, "path string, bytes long, sha256 string").select(name.alias("file"), "sha256", "bytes")


def with_row_counts(files: DataFrame, counts: DataFrame | None) -> DataFrame:
    """The manifest of ``files`` (``checksums``): each with its number of rows
    from ``counts`` (file, row_count), and the time."""
    if counts is None:
        counted = files.withColumn("row_count", F.lit(None).cast("long"))
    else:
        counted = files.join(counts, "file", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    now = _dt.datetime.now(_dt.UTC).isoformat()
    return counted.select("file", "sha256", "bytes", "row_count", F.lit(now).alias("ingested_at"))


def manifest(spark: SparkSession, path: str, rows: DataFrame | None = None) -> DataFrame:
    """Checksum manifest of a landed file or folder: one row per data file
    ``(file, sha256, bytes, row_count, ingested_at)``. ``rows`` is the data
    read from ``path`` by a file source; each file gets its own row count from
    it."""
    counts = None
    if rows is not None:
        counts = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("row_count"))
    return with_row_counts(checksums(spark, path), counts)


def write_manifest(manifest_df: DataFrame, path: str) -> None:
    manifest_df.write.mode("overwrite").json(path)
