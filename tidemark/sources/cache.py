"""Keeping a table in memory and on disk while it is read again and again, and letting go of what no table uses."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Persist inside the block, release after it. Lost blocks are computed again."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def let_go(spark: SparkSession) -> None:
    """Let shuffles that no table of the program needs any more leave the disk.

    Spark removes a shuffle when the driver's garbage collector finds it unused, which a loop of small plans
    and large shuffles may not bring about for half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
