"""SparkSession helpers.

Cluster settings (parallelism, memory, checkpoint folder) come from the
session the caller hands in; the builder below only fills in what is unset,
which is the case in tests and local runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the library relies on for correct results (UTC day boundaries) and
# for runtime re-planning (AQE coalescing, skew-join splitting).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def build_session(master: str | None = None, app_name: str = "shoplens",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        for k, v in LOCAL_CONF.items():
            builder = builder.config(k, v)
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_conf(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on; leave the rest to the cluster."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it (a file system every executor and
    the driver see). Only where it is unset, as in tests, ``fallback`` is
    installed; without one an unset setting is an error, never a local
    temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir() or fallback
