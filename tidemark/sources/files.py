"""Text, CSV and parquet in and out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str, spread: int | None = None) -> DataFrame:
    """One row per text line in column `value`; compressed files are read as they are.

    A gzip file cannot be split, so one file is one task however large it is.
    `spread` deals the lines out over that many partitions before the parsing;
    leave it out when there are at least as many files as cores.
    """
    lines = spark.read.text(path)
    return lines.repartition(spread) if spread else lines


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
) -> DataFrame:
    """CSV with a given schema, or with inferred types (one more pass) when there is none."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def write_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write a one-column string frame as text."""
    df.write.mode("overwrite").option("compression", compression).text(path)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write as parquet, replacing what is there, and return a reader of the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def shared_directory(spark: SparkSession) -> str:
    """The folder that all executors share: `spark.checkpoint.dir`, or what the context's
    checkpoint folder was set to."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path that no other call gets, in the given folder or in the shared one."""
    return f"{folder or shared_directory(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative training cut its lineage where `spark.checkpoint.dir` is set.

    Keeps a folder that the context has; without any, training runs with its whole lineage.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None and configured:
        context.setCheckpointDir(configured)
