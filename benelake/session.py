"""SparkSession construction and the shared checkpoint folder.

On a cluster the session comes from the launcher and already names
``spark.checkpoint.dir`` (a shared, fault-tolerant folder). Only when it is
unset - local runs and tests - do we point it at a scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every plan this package builds.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "benelake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the package defaults applied.

    ``master`` is only set when given; on a cluster leave it to the launcher.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the session's checkpoint folder, creating a scratch one only
    when the session names none (local runs and tests). On a remote (Connect)
    session the server owns the folder and nothing is set here."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return spark.conf.get("spark.checkpoint.dir", None)
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="benelake-ckpt-", dir=os.environ.get("BENELAKE_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", scratch)
    sc.setCheckpointDir(scratch)
    return scratch


def scratch_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back:
    computed once, columnar, and there for every executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/benelake-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did. On a
    cluster it is shipped with --py-files; a local session needs only this."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join((root, path))
