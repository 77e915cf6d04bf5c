"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
#: Removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes up to which Spark broadcasts a table of its own accord.
BROADCAST = ("spark.sql.autoBroadcastJoinThreshold",
             "spark.sql.adaptive.autoBroadcastJoinThreshold")
SMALL_BROADCAST = 256 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("newsledger")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "16g")))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where everything runs in one process and nothing is named, one temporary folder an
    application stands in; it goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        return named
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        folder = tempfile.mkdtemp(prefix="newsledger-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL_FOLDERS[context.applicationId] = folder
    return _LOCAL_FOLDERS[context.applicationId]


@contextlib.contextmanager
def small_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins that run inside are shuffled from ``SMALL_BROADCAST`` bytes, unless a lower bound is set.

    A broadcast table passes through the driver, unpacked, and stays there until garbage is
    collected; a job of many joins keeps many of them.
    """
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = {key: spark.conf.get(key, None) for key in BROADCAST}
    bounds = before | {BROADCAST[0]: spark.conf.get(BROADCAST[0])}
    try:
        for key, bound in bounds.items():
            if bound is not None and not bound.startswith("-") and to_bytes(bound) > SMALL_BROADCAST:
                spark.conf.set(key, str(SMALL_BROADCAST))
        yield
    finally:
        for key, bound in before.items():
            if bound is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, bound)


def materialize(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Write an intermediate result once and read it back.

    Used where one costly result feeds several branches or a loop. The table survives
    the loss of executors, later reads prune columns, and its real size lets Spark
    choose join strategies. The shuffle files behind it go as soon as it is written: left to
    the driver's garbage collection, those of all steps of a query add up.
    """
    spark = df.sparkSession
    rows = df.select(*keep) if keep else df
    path = f"{shared_folder(spark).rstrip('/')}/newsledger-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(path)
