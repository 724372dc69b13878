"""Session helper and shared-folder resolution.

On a cluster the session is created by the platform; ``get_spark`` only fills
in settings that are unset, so cluster-provided values always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # a job with Python tasks waits some 50 ms less than over a TCP socket, and no port is opened
    "spark.python.unix.domain.socket.enabled": "true",
}


def get_spark(master: str | None = None, app_name: str = "churnlab", **conf: str) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_LOCAL_DEFAULTS)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a fresh scratch
    folder. On a cluster, where driver and executors have disks of their own, a
    missing setting is an error. The folder is handed to Spark once a session.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="churnlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for host-side checks (tests only)."""
    return path[5:] if path.startswith("file:") else path


def exists_local(path: str) -> bool:
    return os.path.exists(local_path(path))


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    The plan behind it ends here and the files outlive executors; unlike a
    checkpoint of rows they are columnar, so later reads prune and filter.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
