"""Folders for what is written between passes, in the storage that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where the session names none, one in the warehouse. On a
    cluster a warehouse on the driver's own disk does not do, as executors do not reach it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        one_machine = context.master == "local" or context.master.startswith("local[")
        if not named and not one_machine and warehouse.startswith("file:"):
            raise ValueError(f"set spark.checkpoint.dir: executors do not reach {warehouse}")
        context.setCheckpointDir(named or f"{warehouse}/_checkpoints")
    return context.getCheckpointDir().rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        remove_path(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder. What a lazy result still reads can only go with the driver, which removes it
    when it ends; a caller that is done earlier uses ``remove_path``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove_at_exit, spark, path)
    return path
