"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(name: str = "dockflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` wins over the defaults.

    Shuffle width is left to the caller: give it as ``**{"spark.sql.shuffle.partitions": ...}`` and set it high on
    a cluster, since adaptive execution merges small partitions but cannot split one before the first shuffle.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names it. Where that is unset, the folder is one below the session's warehouse, which
    executors share as well; a machine's temporary folder is never used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/dockflow-{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries planned in here go when their query ends, not when the driver collects its garbage.

    For queries whose result is written: one that is run again from its frame shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables that this library wrote for the session's scratch folder.

    For the end of a run: frames that still read them cannot be used afterwards.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x").rsplit("/", 1)[0] + "/dockflow-*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(pattern) or []:
        files.delete(found.getPath(), True)
