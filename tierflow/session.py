"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Rows one window group may hold before the ordered operators split it over several tasks.
HOT_GROUP_ROWS_KEY = "spark.tierflow.hotGroupRows"
HOT_GROUP_ROWS_DEFAULT = 2_000_000

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where that costs another shuffle for the aggregate above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # An aggregate or window is not run on a partitioning by some of its keys only: one of them may be hot.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # The first n rows of a key are taken before the shuffle for any n that a task can sort.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000000",
    # Session windows are merged on the map side before their key is shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "tierflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings every query relies on; partition counts stay the caller's."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def hot_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_GROUP_ROWS_KEY, str(HOT_GROUP_ROWS_DEFAULT)))


def share_library(spark: SparkSession) -> None:
    """Puts this library on the path of Python workers started from now on, for drivers that only extended sys.path.

    Executors on other machines need it installed or sent along (``--py-files``), as any Spark job does.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths and root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and work tables: the cluster's, or a fresh local one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierflow-"))
    return spark.sparkContext.getCheckpointDir()


#: Whether the shuffle files of a query go when it ends.
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, the shuffle files of each query go when it ends, not when the driver happens to collect its garbage.

    A job of many queries then needs the disk of its largest one. A result that is read again is computed again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    spark.conf.set(SHUFFLE_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP_KEY) if before is None else spark.conf.set(SHUFFLE_CLEANUP_KEY, before)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
