"""Session helpers.

The library never creates a session for a caller that already has one; it
only reads settings from it.  `local_session` exists for tests, the bench
and command-line use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewater")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from `spark.checkpoint.dir`, which the cluster sets to a shared file
    system; where it is unset, a folder under the session's warehouse.  A plain
    local path is refused unless the session is local (or one machine's
    `local-cluster`): on a cluster every node would write its own disk.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if is_local_path(path) and not sc.master.startswith("local"):
            raise ValueError(f"{path} is local to one node; set spark.checkpoint.dir to a shared folder")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")
