"""Session helpers for local runs (tests, bench).

On a cluster the session comes from the launcher; nothing here overrides a
setting the cluster already made.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Local runs read a few MB: AQE's 1 MB floor per coalesced partition would
    # leave the per-key expansions of the planned curve in one or two tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def local_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "costcurves", extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = {**LOCAL_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for the intermediate tables of one run.

    It lies under ``spark.checkpoint.dir``, the folder that the cluster names for
    what all executors must see. Only a local session may have none; its
    folders lie beside its tables, in the warehouse. The folder is removed
    when the driver's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
