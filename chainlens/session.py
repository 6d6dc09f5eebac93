"""Session defaults and the shared scratch location.

All scratch output (derived JSON inputs, table versions written by tests,
stream checkpoints) goes under ``spark.checkpoint.dir``, which on a cluster is
a shared folder named by the cluster configuration.  Only in local mode, where
driver and tasks are one process, is a folder created when the setting is
absent; on a cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "chainlens", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; in local mode a private one if unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="chainlens-ckpt-")  # one machine: driver and executor threads share it
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint dir for one job's intermediate files."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "chainlens-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


#: Whether Spark drops the shuffle files of a query when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files when they end.  By default the
    files stay until the driver happens to collect what refers to them, so a job of
    many stored steps keeps the exchanges of all of them on disk."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows that several steps read, written to a fresh folder, so that they are made once."""
    path = scratch_path(rows.sparkSession, name)
    with releasing(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
