"""Traffic by country from an access log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.weblog import TOP_HOSTS, busiest_hosts, host_counts


def country_report(
    requests: DataFrame,
    k: int = TOP_HOSTS,
    suffixes: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per country: requests, unique hosts, the top host, and the share of the top k."""
    return report_of_counts(host_counts(requests, suffixes), k)


def report_of_counts(counts: DataFrame, k: int = TOP_HOSTS) -> DataFrame:
    """`country_report` of a table (country, host, requests).

    Everything comes from that one table. Totals and top hosts are both
    partitioned by country already, so joining them moves nothing.
    """
    totals = counts.groupBy("country").agg(
        F.sum("requests").alias("requests"), F.count("*").alias("unique_hosts")
    )
    best = (
        busiest_hosts(counts, k)
        .groupBy("country")
        .agg(
            F.max(F.when(F.col("rank") == 1, F.col("host"))).alias("top_host"),
            F.max("requests").alias("top_host_requests"),
            F.sum("requests").alias("top_requests"),
        )
    )
    return totals.join(best, "country").select(
        "country",
        "requests",
        "unique_hosts",
        "top_host",
        "top_host_requests",
        "top_requests",
        (100 * F.col("top_requests") / F.col("requests")).alias("top_percent"),
    )
