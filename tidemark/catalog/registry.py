"""What a named query is."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_scratch(spark: SparkSession) -> None:
    """Local sessions over test data may leave `spark.checkpoint.dir` unset; they get a folder.

    Only where driver and executors are one process. The library itself never picks a folder.
    """
    context = spark.sparkContext
    one_process = context.master == "local" or context.master.startswith("local[")
    if one_process and not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
        context.setCheckpointDir(f"{tempfile.gettempdir()}/tidemark-test-data")


@dataclass(frozen=True)
class Query:
    name: str
    compute: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    def run(self, spark: SparkSession, directory: str) -> DataFrame:
        ensure_scratch(spark)
        return self.compute(spark, directory)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on their order, so compared values are rounded."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
