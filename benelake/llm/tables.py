"""Tables written in the shared folder of the session: they cut lineage, and
every executor and the driver can read them again."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benelake.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under spark.checkpoint.dir and read it back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/benelake-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did. On a
    cluster it is shipped with --py-files; a local session needs only this."""
    path = spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join((ROOT, path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of text in the whole column."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, for a helper column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
