"""Temporal cutoffs of ratings that keep coming, from kept counts instead of the ratings.

A batch of ratings is folded to exact counts, one row for each of its times, grouped by ranges of time of a
fixed width. A cutoff is found from the totals of the ranges, and then from the times of the one or two
ranges in which it can be. Old ratings are never read again, and batches may come in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.splits import TEMPORAL_THRESHOLDS
from tidemark.sources.committed import CommittedTable

_TIMES = "time long, n long, bucket long"
_BUCKETS = "bucket long, n long"

#: Width of a range unless the caller says otherwise: a day of seconds.
WIDTH = 86_400


class TimeCounts:
    """Exact counts by time in a folder that all executors share; times are whole numbers."""

    def __init__(self, spark: SparkSession, folder: str, width: int = WIDTH) -> None:
        self.spark, self.width = spark, width
        self.times, self.buckets = CommittedTable(spark, f"{folder}/times"), CommittedTable(spark, f"{folder}/ranges")

    def add(self, batch: str, ratings: DataFrame, time_col: str = "timestamp") -> bool:
        """Count a batch; False if a batch of that name is counted. Null times are a range of their own."""
        time = F.col(time_col).cast("long").alias("time")
        counted = ratings.groupBy(time).agg(F.count("*").alias("n"))
        counted = counted.withColumn("bucket", F.expr(f"floor(time / {self.width})").cast("long"))
        # The ranges are published last and decide: times without them belong to a batch that failed. Where
        # the times are published already, the batch's next run takes the ranges from them.
        self.times.write(batch, counted.repartitionByRange("bucket").sortWithinPartitions("bucket"))
        mine = next(path for _, name, path in self.times.published() if name == batch)
        folded = self.spark.read.schema(_TIMES).parquet(mine).groupBy("bucket").agg(F.sum("n").alias("n"))
        return self.buckets.write(batch, folded)

    def _counted_times(self) -> DataFrame:
        done = {batch for _, batch, _ in self.buckets.published()}
        paths = [path for _, batch, path in self.times.published() if batch in done]
        return self.spark.read.schema(_TIMES).parquet(*paths) if paths else self.spark.createDataFrame([], _TIMES)

    def cutoffs(self, thresholds: Sequence[float] = TEMPORAL_THRESHOLDS) -> list[int | None]:
        """For each threshold the first time whose percent rank over all batches reaches it, else None.

        The driver gets the totals of the ranges, a row for each range of time: 10,000 for 27 years of days.
        Of the times only those of two neighbouring ranges for each threshold are read, at most as many as
        the ranges are wide; batches lie sorted by range, so the file scan skips the rest.
        """
        summed = self.buckets.everything(_BUCKETS).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
        total = sum(r.n for r in summed)
        below, ranges = sum(r.n for r in summed if r.bucket is None), []
        for row in sorted((r for r in summed if r.bucket is not None), key=lambda r: r.bucket):
            ranges.append((row.bucket, below))
            below += row.n
        return [self._cutoff(ranges, total, float(t)) for t in thresholds]

    def _cutoff(self, ranges: list[tuple[int, int]], total: int, threshold: float) -> int | None:
        if not ranges:
            return None
        rank = lambda before: before / (total - 1) if total > 1 else 0.0
        # The last range that begins below the threshold; the cutoff is in it, or begins the next one.
        at = max((i for i, (_, before) in enumerate(ranges) if rank(before) < threshold), default=0)
        near = [bucket for bucket, _ in ranges[at : at + 2]]
        times = self._counted_times().filter(F.col("bucket").isin(near)).groupBy("time").agg(F.sum("n").alias("n"))
        before = F.sum("n").over(W.orderBy("time")) - F.col("n") + F.lit(ranges[at][1])
        share = before / (F.lit(total) - 1) if total > 1 else F.lit(0.0)
        return times.select("time", share.alias("rank")).filter(F.col("rank") >= threshold).agg(F.min("time")).first()[0]
