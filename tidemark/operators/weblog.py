"""Operators on access logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import accesslog as log
from tidemark.operators.ranking import top_k

TOP_HOSTS = 9


def parse(lines: DataFrame, require_bytes: bool = True) -> DataFrame:
    """Lines to (host, ts_text, request, status, bytes).

    Rows with a missing field are dropped; with `require_bytes=False` those that
    only lack a byte count (written `-`) stay.
    """
    line = F.col("value")
    parsed = lines.select(
        log.host(line).alias("host"),
        log.time_text(line).alias("ts_text"),
        log.request(line).alias("request"),
        log.status(line).alias("status"),
        log.reply_bytes(line).alias("bytes"),
    )
    # A pattern without a match gives '', so only the numbers can be missing. Testing
    # no more than those lets a report that needs the host skip the other patterns.
    return parsed.na.drop(subset=["status", "bytes"] if require_bytes else ["status"])


def host_counts(requests: DataFrame, suffixes: Mapping[str, str] | None = None) -> DataFrame:
    """(country, host, requests) for the hosts of the given countries.

    All further reports per country start from this table, which has one row
    per host instead of one per request.
    """
    return (
        requests.select(log.country(F.col("host"), suffixes).alias("country"), "host")
        .filter(F.col("country").isNotNull())
        .groupBy("country", "host")
        .agg(F.count("*").alias("requests"))
    )


def domain_host_counts(requests: DataFrame) -> DataFrame:
    """(domain, host, requests) for every top-level domain."""
    return (
        requests.select(log.top_level_domain(F.col("host")).alias("domain"), "host")
        .filter(F.col("domain").isNotNull())
        .groupBy("domain", "host")
        .agg(F.count("*").alias("requests"))
    )


def country_requests(
    requests: DataFrame, suffixes: Mapping[str, str] | None = None
) -> DataFrame:
    """(country, requests), with 0 for a country nobody came from.

    One conditional count per country in one pass. A host counts for the first
    suffix it ends with.
    """
    suffixes = log.COUNTRIES if suffixes is None else suffixes
    names = list(suffixes)
    counted = requests.select(log.country(F.col("host"), suffixes).alias("country")).agg(
        *[F.count_if(F.col("country") == name).alias(name) for name in names]
    )
    return counted.unpivot([], names, "country", "requests")


def country_unique_hosts(
    requests: DataFrame, suffixes: Mapping[str, str] | None = None, rsd: float | None = None
) -> DataFrame:
    """(country, unique_hosts); with `rsd` an estimate of that relative error.

    The exact count shuffles each host once per task, by country and host. The
    estimate shuffles one sketch per country and task.
    """
    placed = requests.select(log.country(F.col("host"), suffixes).alias("country"), "host").filter(
        F.col("country").isNotNull()
    )
    distinct = F.count_distinct("host") if rsd is None else F.approx_count_distinct("host", rsd)
    return placed.groupBy("country").agg(distinct.alias("unique_hosts"))


def top_hosts(
    requests: DataFrame,
    k: int = TOP_HOSTS,
    suffixes: Mapping[str, str] | None = None,
) -> DataFrame:
    """(country, host, requests, rank): the k busiest hosts per country; ties go by name."""
    return busiest_hosts(host_counts(requests, suffixes), k)


def busiest_hosts(counts: DataFrame, k: int) -> DataFrame:
    return top_k(counts, k, [F.desc("requests"), F.asc("host")], ["country"])


def host_share(
    requests: DataFrame,
    k: int = TOP_HOSTS,
    suffixes: Mapping[str, str] | None = None,
    rest: str = "Rest",
) -> DataFrame:
    """(country, host, requests, percent): the k busiest hosts, and the rest as one row.

    The totals and the top hosts read one shuffled table of host counts. They
    meet in a group of k + 1 rows per country, so no country is ever a large group.
    """
    counts = host_counts(requests, suffixes)
    best = busiest_hosts(counts, k).select("country", "host", "requests", F.lit(False).alias("whole"))
    totals = counts.groupBy("country").agg(F.sum("requests").alias("requests")).select(
        "country", F.lit(rest).alias("host"), "requests", F.lit(True).alias("whole")
    )
    entry = F.struct("host", "requests")
    per_country = (
        best.unionByName(totals)
        .groupBy("country")
        .agg(
            F.collect_list(F.when(~F.col("whole"), entry)).alias("best"),
            F.sum(F.when(~F.col("whole"), F.col("requests"))).alias("best_requests"),
            F.max(F.when(F.col("whole"), F.col("requests"))).alias("total"),
        )
    )
    remainder = F.struct(
        F.lit(rest).alias("host"), (F.col("total") - F.col("best_requests")).alias("requests")
    )
    return (
        per_country.select(
            "country",
            "total",
            F.explode(F.concat("best", F.array(remainder))).alias("entry"),
        )
        .select(
            "country",
            "entry.host",
            "entry.requests",
            (100 * F.col("entry.requests") / F.col("total")).alias("percent"),
        )
    )


def heatmap(
    requests: DataFrame, suffixes: Mapping[str, str] | None = None
) -> DataFrame:
    """(country, host, day, hour, requests): a full day-by-hour grid of each country's top host.

    Requests are folded to host and grid cell once. The busiest host is found on
    that table and its cells are read from the same shuffle. At most one row per
    named country is broadcast.
    """
    time = F.col("ts_text")
    cell = (log.day_of_month(time) - 1) * log.HOURS + log.hour_of_day(time)
    cells = (
        requests.select(
            log.country(F.col("host"), suffixes).alias("country"),
            "host",
            F.coalesce(cell, F.lit(-1)).alias("cell"),
        )
        .filter(F.col("country").isNotNull() & F.col("host").isNotNull())
        .groupBy("country", "host", "cell")
        .agg(F.count("*").alias("requests"))
    )
    per_host = cells.groupBy("country", "host").agg(F.sum("requests").alias("requests"))
    busiest = busiest_hosts(per_host, 1).select("country", "host")

    grid = busiest.select(
        "country",
        "host",
        F.explode(F.sequence(F.lit(0), F.lit(log.DAYS * log.HOURS - 1))).alias("cell"),
        F.lit(0).cast("bigint").alias("requests"),
        F.lit(True).alias("in_grid"),
    )
    # Inner, on purpose: a semi join would be moved below the folding, which would
    # then read and parse the log a second time.
    visited = cells.join(F.broadcast(busiest), ["country", "host"]).withColumn(
        "in_grid", F.lit(False)
    )
    # Unreadable times are taken out here: a test on `cell` would be pushed below
    # the folding and make it run twice.
    return (
        grid.unionByName(visited)
        .groupBy("country", "host", "cell")
        .agg(F.sum("requests").alias("requests"), F.bool_or("in_grid").alias("in_grid"))
        .filter("in_grid")
        .select(
            "country",
            "host",
            F.expr(f"int(cell DIV {log.HOURS}) + 1").alias("day"),
            F.expr(f"cell % {log.HOURS}").alias("hour"),
            "requests",
        )
    )
