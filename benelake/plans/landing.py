"""The landing table: one row per beneficiary id, clustered by the id.

The raw text is parsed once and crosses the network once, in an aggregate by
the id that counts each id's copies and keeps the copy that sorts first. It
combines on the map side, so an id on a third of all rows, a blank one for
example, is one row per task. The result is written in buckets of the id,
sorted. All later work by the id, the gate's count of repeated ids, the silver
dedupe, the ``unique`` tests, the typed load and the marts' joins, reads those
buckets without another exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ID_COLUMN
from ..sinks import versions

COPIES, SOURCE_FILE = "_copies", "_source_file"


def aligned_buckets(wanted: int, partitions: int) -> int:
    """A number of buckets of at least ``wanted`` that divides the shuffle's
    partitions or is a multiple of them, so that an aggregate's output is
    already dealt by bucket."""
    if wanted >= partitions:
        return partitions * -(-wanted // partitions)
    return next(n for n in range(wanted, partitions + 1) if partitions % n == 0)


def clustered(raw: DataFrame, id_column: str = ID_COLUMN) -> DataFrame:
    """One row per id (null ids are one): the first copy and ``_copies``."""
    rest = [c for c in raw.columns if c != id_column]
    first = F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_first")
    found = raw.groupBy(id_column).agg(F.count(F.lit(1)).alias(COPIES), first)
    return found.select(id_column, *[F.col("_first").getField(c).alias(c) for c in rest], COPIES)


def land(raw: DataFrame, name: str, wanted_buckets: int, from_files: bool) -> tuple[str, int]:
    """Write the landing as the next version of ``name``; its table's name and
    number of buckets. ``from_files``: ``raw`` reads files, whose names are kept."""
    spark = raw.sparkSession
    if from_files:
        raw = raw.withColumn(SOURCE_FILE, F.col("_metadata.file_name"))
    buckets = aligned_buckets(wanted_buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return versions.begin(clustered(raw), name, (buckets, ID_COLUMN), clustered=True), buckets


def gate_metrics(landed: DataFrame, columns: int) -> DataFrame:
    """``(row_count, column_count, duplicate_ids)`` of what was landed, from
    the copies alone."""
    return landed.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).cast("long").alias("row_count"),
        F.lit(columns).cast("long").alias("column_count"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).cast("long").alias("duplicate_ids"),
    )


def file_counts(landed: DataFrame) -> DataFrame:
    """Rows of each source file of a landing without repeated ids."""
    return landed.groupBy(F.col(SOURCE_FILE).alias("file")).agg(F.sum(COPIES).cast("long").alias("row_count"))


def run_key(files: DataFrame) -> str:
    """A name for the input, from the checksums of its files in any order."""
    one = F.xxhash64("file", "sha256", "bytes")
    n, mixed, added = files.agg(F.count(F.lit(1)), F.bit_xor(one), F.sum(one.cast("decimal(38,0)"))).first()
    return f"{n}:{mixed}:{added}"


def landed_bytes(files: DataFrame) -> int:
    return int(files.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0])


def published_notes(spark: SparkSession, name: str, run: str | None) -> dict[str, str] | None:
    """What is noted about ``name`` if this run's input already gave it."""
    found = versions.notes(spark, name) if run else {}
    return found if run and found.get("run") == run else None
