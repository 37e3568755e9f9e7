"""Tables that are replaced or grow by commits, of which readers see all or nothing.

A batch is written to a fresh folder and then published by one row in the manifest. The manifest's files
appear by a rename when Spark commits them, and readers know data folders from the manifest only, so a write
that fails half way leaves nothing that anyone reads. A batch whose name is published is not written again.

One writer at a time; readers any number. A reader keeps the folders that it found, which are never changed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MANIFEST = "number long, batch string, path string"


class CommittedTable:
    """Batches in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.manifest = f"{self.folder}/manifest"

    def published(self) -> list[tuple[int, str, str]]:
        """(number, batch, path) of the batches, in the order of their commits; one row for each."""
        empty = self.spark.createDataFrame([], _MANIFEST)
        # Makes the folder on the first call; an append of no rows changes nothing.
        empty.write.mode("append").parquet(self.manifest)
        return sorted(tuple(r) for r in self.spark.read.schema(_MANIFEST).parquet(self.manifest).collect())

    def write(self, batch: str, rows: DataFrame | Callable[[], DataFrame], partition_by: str | None = None) -> bool:
        """Write and publish a batch; False, and nothing is computed, if its name is published."""
        known = self.published()
        if any(name == batch for _, name, _ in known):
            return False
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        writer = (rows() if callable(rows) else rows).write
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        number = known[-1][0] + 1 if known else 0
        entry = self.spark.createDataFrame([(number, batch, path)], _MANIFEST)
        entry.coalesce(1).write.mode("append").parquet(self.manifest)
        return True

    def latest(self) -> DataFrame | None:
        """The rows of the last batch: the table, where every batch replaces it. None before the first."""
        known = self.published()
        return self.spark.read.parquet(known[-1][2]) if known else None

    def everything(self, schema: str) -> DataFrame:
        """The rows of all batches: the table, where batches add to it."""
        paths = [path for _, _, path in self.published()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)
