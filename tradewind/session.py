"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# AQE supplies the physical strategy: runtime broadcast below a measured size, skew-join splitting
# of hot keys, and coalescing of small shuffle partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tradewind",
                  **conf: str) -> SparkSession:
    """A local session for tests and ``bench.py``. On a cluster, pass your own session instead.

    ``conf`` overrides the defaults; set ``spark.driver.memory`` there, to fit the machine.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_tasks(spark: SparkSession) -> int:
    """Partitions of a shuffle before AQE merges small ones."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tradewind-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder is invisible to other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


# Paths handed out so far.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/tradewind/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this process wrote to scratch paths; results that read them become unreadable."""
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
