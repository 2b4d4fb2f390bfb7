"""Folders and lineage cuts that executors share."""

from __future__ import annotations

import ctypes
import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a folder of this machine only where none is set, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(named)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, so that a lost executor costs no recomputation of what led to them.

    What led to them is let go: Spark deletes shuffle files once the driver's garbage collector finds nothing that refers to
    them, and in a chain of small steps the driver alone would fill its memory last and the executors' disks first.
    """
    spark = df.sparkSession
    shared_dir(spark)
    rows = df.checkpoint(eager=True)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return rows


def give_back_memory() -> None:
    """Return what a Python worker has freed to the system, so that the tasks it is used for next start small."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
