"""Access-log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.inputs import ACCESS_LOG, HOSTS, PARSED
from tidemark.catalog.registry import Query, rounded
from tidemark.operators import weblog
from tidemark.plans.traffic import country_report
from tidemark.sources import fixtures
from tidemark.sources.files import read_lines, scratch_path, write_lines


def _requests(spark: SparkSession, directory: str) -> DataFrame:
    return weblog.parse(fixtures.access_log(spark, directory))


def _text_lines(spark: SparkSession, directory: str) -> DataFrame:
    path = scratch_path(spark, "access-log")
    write_lines(fixtures.access_log(spark, directory), path, compression="gzip")
    return read_lines(spark, path)


QUERIES = [
    Query("src_text_lines", _text_lines, f"WITH {ACCESS_LOG} SELECT value FROM access_log"),
    Query(
        "log_parse",
        _requests,
        f"WITH {PARSED} SELECT host, ts_text, request, status, bytes FROM parsed",
    ),
    Query(
        "log_parse_keep_missing_bytes",
        lambda s, d: weblog.parse(fixtures.access_log(s, d), require_bytes=False).na.fill(
            -1, ["bytes"]
        ),
        f"WITH {PARSED} SELECT host, ts_text, request, status, coalesce(bytes, -1) AS bytes "
        "FROM fields WHERE status IS NOT NULL",
    ),
    Query(
        "log_country_requests",
        lambda s, d: weblog.country_requests(_requests(s, d)),
        f"""WITH {HOSTS}
        SELECT c.country, count(p.host) AS requests
        FROM countries c LEFT JOIN parsed p ON ends_with(p.host, c.suffix) GROUP BY c.country""",
    ),
    Query(
        "log_country_unique_hosts",
        lambda s, d: weblog.country_unique_hosts(_requests(s, d)),
        f"""WITH {HOSTS}
        SELECT country, count(DISTINCT host) AS unique_hosts
        FROM parsed JOIN countries ON ends_with(host, suffix) GROUP BY country""",
    ),
    Query(
        "log_host_counts",
        lambda s, d: weblog.domain_host_counts(_requests(s, d)),
        f"""WITH {PARSED}
        SELECT regexp_extract(host, '\\.([^.]*)$', 1) AS domain, host, count(*) AS requests
        FROM parsed WHERE host LIKE '%.%' GROUP BY ALL""",
    ),
    Query(
        "log_top_hosts",
        lambda s, d: weblog.top_hosts(_requests(s, d)),
        f"""WITH {HOSTS}
        SELECT country, host, requests, rank::int AS rank FROM ranked WHERE rank <= 9""",
    ),
    Query(
        "log_top_host",
        lambda s, d: weblog.top_hosts(_requests(s, d), 1).drop("rank"),
        f"WITH {HOSTS} SELECT country, host, requests FROM ranked WHERE rank = 1",
    ),
    Query(
        "log_host_share",
        lambda s, d: rounded(weblog.host_share(_requests(s, d)), "percent"),
        f"""WITH {HOSTS}, named AS (
          SELECT country, CASE WHEN rank <= 9 THEN host ELSE 'Rest' END AS host, requests
          FROM ranked UNION ALL SELECT DISTINCT country, 'Rest', 0 FROM ranked),
        folded AS (
          SELECT country, host, sum(requests)::bigint AS requests FROM named GROUP BY ALL)
        SELECT country, host, requests,
               round(100.0 * requests / sum(requests) OVER (PARTITION BY country), 6) AS percent
        FROM folded""",
    ),
    Query(
        "log_heatmap",
        lambda s, d: weblog.heatmap(_requests(s, d)),
        f"""WITH {HOSTS}, top AS (SELECT country, host FROM ranked WHERE rank = 1),
        visits AS (
          SELECT country, host, day(t)::int AS day, hour(t)::int AS hour, count(*) AS requests
          FROM (SELECT country, host,
                       strptime(split_part(ts_text, ' ', 1), '%d/%b/%Y:%H:%M:%S') AS t
                FROM parsed JOIN top USING (host))
          GROUP BY ALL),
        grid AS (
          SELECT country, host, d::int AS day, h::int AS hour
          FROM top, range(1, 32) AS days(d), range(0, 24) AS hours(h))
        SELECT country, host, day, hour, coalesce(requests, 0) AS requests
        FROM grid LEFT JOIN visits USING (country, host, day, hour)""",
    ),
    Query(
        "log_country_report",
        lambda s, d: rounded(country_report(_requests(s, d)), "top_percent"),
        f"""WITH {HOSTS}
        SELECT country, sum(requests)::bigint AS requests, count(*) AS unique_hosts,
               max(host) FILTER (WHERE rank = 1) AS top_host,
               max(requests) AS top_host_requests,
               (sum(requests) FILTER (WHERE rank <= 9))::bigint AS top_requests,
               round(100.0 * sum(requests) FILTER (WHERE rank <= 9) / sum(requests), 6)
                 AS top_percent
        FROM ranked GROUP BY country""",
    ),
]
