"""Traffic reports of any span of days from kept daily counts, without the log.

A batch of requests is folded to requests per day, country and host, and to one mergeable sketch of the
hosts per day and country. Exact reports fold the counts of their days; estimates of unique hosts merge the
sketches, a few kilobytes for each day and country however many hosts there are.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import accesslog as log
from tidemark.operators.weblog import TOP_HOSTS
from tidemark.plans.traffic import report_of_counts
from tidemark.sources.committed import CommittedTable

_HOSTS = "day date, country string, host string, requests long"
_SKETCHES = "day date, country string, hosts binary, requests long"

#: Sketches have 2 ** LG_K registers: a relative error of 1.04 / 2 ** (LG_K / 2), 1.6 % for 12, in two of three cases.
LG_K = 12


class DailyTraffic:
    """Daily counts in a folder that all executors share; batches may overlap in days and come in any order."""

    def __init__(self, spark: SparkSession, folder: str, suffixes: Mapping[str, str] | None = None, lg_k: int = LG_K) -> None:
        self.spark, self.suffixes, self.lg_k = spark, suffixes, lg_k
        self.hosts, self.sketches = CommittedTable(spark, f"{folder}/hosts"), CommittedTable(spark, f"{folder}/sketches")

    def add(self, batch: str, requests: DataFrame) -> bool:
        """Count a batch of parsed requests (host, ts_text); False if a batch of that name is counted.

        Hosts of no named country are left out. Requests without a readable day count under no day.
        """
        rows = requests.select(log.local_date(F.col("ts_text")).alias("day"), log.country(F.col("host"), self.suffixes).alias("country"), "host")
        counts = rows.filter("country is not null").groupBy("day", "country", "host").agg(F.count("*").alias("requests"))
        # The sketches are published last and decide, as they are made from the written counts.
        self.hosts.write(batch, counts.repartitionByRange("day").sortWithinPartitions("day"))
        path = next(path for _, name, path in self.hosts.published() if name == batch)
        mine = self.spark.read.schema(_HOSTS).parquet(path).groupBy("day", "country")
        return self.sketches.write(batch, mine.agg(F.hll_sketch_agg("host", self.lg_k).alias("hosts"), F.sum("requests").alias("requests")))

    def _within(self, df: DataFrame, first: datetime.date | None, last: datetime.date | None) -> DataFrame:
        if first is not None:
            df = df.filter(F.col("day") >= F.lit(first))
        return df if last is None else df.filter(F.col("day") <= F.lit(last))

    def host_counts(self, first: datetime.date | None = None, last: datetime.date | None = None) -> DataFrame:
        """(country, host, requests) of the days from `first` to `last`; of all requests without either."""
        done = {batch for _, batch, _ in self.sketches.published()}
        paths = [path for _, batch, path in self.hosts.published() if batch in done]
        rows = self.spark.read.schema(_HOSTS).parquet(*paths) if paths else self.spark.createDataFrame([], _HOSTS)
        return self._within(rows, first, last).groupBy("country", "host").agg(F.sum("requests").alias("requests"))

    def report(self, first: datetime.date | None = None, last: datetime.date | None = None, k: int = TOP_HOSTS) -> DataFrame:
        """The country report of those days, exact, without the log."""
        return report_of_counts(self.host_counts(first, last), k)

    def estimates(self, first: datetime.date | None = None, last: datetime.date | None = None) -> DataFrame:
        """(country, requests, unique_hosts): requests exact, hosts as merged sketches estimate them."""
        rows = self._within(self.sketches.everything(_SKETCHES), first, last)
        return rows.groupBy("country").agg(
            F.sum("requests").alias("requests"), F.hll_sketch_estimate(F.hll_union_agg("hosts")).alias("unique_hosts")
        )
