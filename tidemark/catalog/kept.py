"""Queries over state that is kept between batches, and over indexes that are tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.inputs import HOSTS, RATINGS
from tidemark.catalog.registry import Query, rounded
from tidemark.operators import weblog
from tidemark.operators.cutoffs import TimeCounts
from tidemark.operators.daily import DailyTraffic
from tidemark.operators.levels import level_index, with_index
from tidemark.operators.splits import TEMPORAL_THRESHOLDS
from tidemark.sources import fixtures
from tidemark.sources.committed import CommittedTable
from tidemark.sources.files import read_table, scratch_path


def _committed(spark: SparkSession, directory: str) -> DataFrame:
    """Orders replaced by a second batch; the first one comes again and changes nothing."""
    orders = read_table(spark, directory, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    table = CommittedTable(spark, scratch_path(spark, "committed"))
    for batch, rest in (("even", 0), ("odd", 1), ("even", 0)):
        table.write(batch, orders.filter(F.col("o_orderkey") % 2 == rest))
    return table.latest()


def _cutoffs(spark: SparkSession, directory: str) -> DataFrame:
    ratings = fixtures.ratings(spark, directory)
    counts = TimeCounts(spark, scratch_path(spark, "time-counts"))
    for part in (2, 0, 1, 0):
        counts.add(f"users {part} of 3", ratings.filter(F.col("userId") % 3 == part))
    rows = list(zip(TEMPORAL_THRESHOLDS, counts.cutoffs(), strict=True))
    return spark.createDataFrame(rows, "threshold double, cutoff long")


_CUTOFFS = f"""WITH {RATINGS}, ranked AS (
  SELECT timestamp, percent_rank() OVER (ORDER BY timestamp) AS p FROM ratings)
SELECT threshold, min(timestamp) AS cutoff
FROM ranked, (VALUES {", ".join(f"({t}::double)" for t in TEMPORAL_THRESHOLDS)}) AS t(threshold)
WHERE p >= threshold GROUP BY threshold"""


def _traffic(spark: SparkSession, directory: str, *days: datetime.date) -> DataFrame:
    requests = weblog.parse(fixtures.access_log(spark, directory))
    state = DailyTraffic(spark, scratch_path(spark, "daily-traffic"))
    for part in (1, 0, 1):
        state.add(f"part {part}", requests.filter(F.length("request") % 2 == part))
    return rounded(state.report(*days), "top_percent")


_REPORT = """SELECT country, sum(requests)::bigint AS requests, count(*) AS unique_hosts,
       max(host) FILTER (WHERE rank = 1) AS top_host, max(requests) AS top_host_requests,
       (sum(requests) FILTER (WHERE rank <= 9))::bigint AS top_requests,
       round(100.0 * sum(requests) FILTER (WHERE rank <= 9) / sum(requests), 6) AS top_percent
FROM ranked GROUP BY country"""

_DAYS = datetime.date(2024, 1, 5), datetime.date(2024, 1, 20)
_IN_DAYS = " AND ".join(
    f"strptime(split_part(ts_text, ':', 1), '%d/%b/%Y')::date {sign} DATE '{day}'" for sign, day in zip((">=", "<="), _DAYS, strict=True)
)


def _part_index(spark: SparkSession, directory: str) -> DataFrame:
    """Lines with the number of their part's key, the most frequent first; the key is taken as text."""
    lines = read_table(spark, directory, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return with_index(lines, "part", level_index(lines, "part"), "part_index")


QUERIES = [
    Query("snk_committed", _committed, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 1"),
    Query("ratings_cutoffs_kept", _cutoffs, _CUTOFFS),
    Query("log_country_report_kept", _traffic, f"WITH {HOSTS} {_REPORT}"),
    Query(
        "log_country_report_days",
        lambda s, d: _traffic(s, d, *_DAYS),
        f"WITH {HOSTS.replace('FROM parsed JOIN countries', f'FROM (SELECT * FROM parsed WHERE {_IN_DAYS}) JOIN countries')} {_REPORT}",
    ),
    Query(
        "feat_distributed_index",
        _part_index,
        """WITH levels AS (
          SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey::varchar) - 1 AS i
          FROM lineitem GROUP BY l_partkey)
        SELECT l_orderkey, l_linenumber, l_partkey::varchar AS part, i::double AS part_index
        FROM lineitem JOIN levels USING (l_partkey)""",
    ),
]
