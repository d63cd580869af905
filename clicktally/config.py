"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings a click-counting cluster job should start with. The number of shuffle partitions is
# fixed for the life of a streaming checkpoint, so it is left to the caller.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_scratch: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a temporary folder.
    """
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="clicktally-")
    return _local_scratch


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def if_exists(load: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``load`` reads, or None if its path does not exist on its (maybe remote) file system."""
    try:
        return load()
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
