"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# For every session: partitions of 128 MB, merged at run time from many small ones. 16,384 of
# them hold 2 TB in one shuffle; for more, give the expected size to ``shuffle_settings``.
SCALE_SETTINGS = {
    INITIAL_PARTITIONS: "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
}

_local_base: dict[str, str] = {}


def shuffle_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Partition counts for a job that is expected to shuffle ``shuffle_bytes``.

    The initial count keeps a reduce task near 128 MB without relying on a fixed
    200; AQE merges what turns out to be small, up to the same size, and splits what
    turns out skewed.
    """
    initial = str(max(math.ceil(shuffle_bytes / TARGET_PARTITION_BYTES), 2 * cores))
    return {**SCALE_SETTINGS, "spark.sql.shuffle.partitions": initial, INITIAL_PARTITIONS: initial}


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # one machine has its cores' worth of partitions, not a cluster's
        **({} if (master or "").startswith("local") else SCALE_SETTINGS),
        **(conf or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    The base is the cluster's ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/casebook-{uuid.uuid4().hex}/{label}"


def _local_folder(application: str) -> str:
    """One temporary folder per local application; it goes when Python ends."""
    if application not in _local_base:
        _local_base[application] = tempfile.mkdtemp(prefix="casebook-")
        atexit.register(shutil.rmtree, _local_base[application], ignore_errors=True)
    return _local_base[application]
