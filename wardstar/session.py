"""Session helpers: a local session for tests/bench and the shared checkpoint dir."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wardstar") -> SparkSession:
    """Local-mode session used by tests and the benchmark.

    On a cluster, build the session from the cluster's own configuration and
    leave ``spark.checkpoint.dir`` to point at the shared folder it names.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WARDSTAR_DRIVER_MEMORY", "8g"))
        .config("spark.sql.timestampType", "TIMESTAMP_NTZ")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used.  Only a local-mode session without the setting (tests) gets
    a fresh scratch folder.  A cluster session without it is a configuration
    error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="wardstar-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at the cluster's shared folder")
    return sc.getCheckpointDir()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For rows that are read several times: they are found once, later reads
    take the columns they need, and the planner knows their size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
