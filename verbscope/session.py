"""Spark session helpers.

The library never creates a session on its own inside an operator; these helpers
are for scripts, tests and the bench. Cluster settings (executor sizes, the shared
checkpoint folder) come from the cluster's own configuration and are only filled
in here when they are unset, as in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library relies on. Session time zone is pinned to UTC
# (timestamps are parsed as UTC and compared against DuckDB); AQE re-plans joins and
# coalesces/splits shuffle partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "verbscope",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in
    ``spark.checkpoint.dir``. Only a local session may leave it unset (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="verbscope-ckpt-"))
    return sc.getCheckpointDir()


def write_and_reread(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the rows, and values that depend on
    how they were partitioned, are fixed from then on."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
