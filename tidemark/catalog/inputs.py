"""The derived inputs of `tidemark.sources.fixtures` as SQL table expressions."""

from __future__ import annotations

from tidemark.functions.accesslog import COUNTRIES, HOST_PATTERN, REQUEST_PATTERN, TIME_PATTERN
from tidemark.sources.schemas import PARTICLE_FEATURES

ACCESS_LOG = """access_log AS (
  SELECT concat('h', user_id::varchar, '.example.', (['de', 'ca', 'sg', 'com'])[(user_id % 4 + 1)::int],
                ' - - [', strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' -0400] "GET /', event_type, '/',
                event_id::varchar, ' HTTP/1.0" ',
                CASE WHEN event_type = 'error' THEN '404 -'
                     ELSE concat('200 ', floor(value * 100)::bigint::varchar) END) AS value
  FROM events)"""

PARSED = f"""{ACCESS_LOG}, fields AS (
  SELECT regexp_extract(value, '{HOST_PATTERN}', 1) AS host,
         regexp_extract(value, '{TIME_PATTERN}', 1) AS ts_text,
         regexp_extract(value, '{REQUEST_PATTERN}', 1) AS request,
         try_cast(string_split(value, ' ')[-2] AS integer) AS status,
         try_cast(string_split(value, ' ')[-1] AS bigint) AS bytes
  FROM access_log),
parsed AS (SELECT * FROM fields WHERE status IS NOT NULL AND bytes IS NOT NULL)"""

_NAMED = ", ".join(f"('{name}', '{suffix}')" for name, suffix in COUNTRIES.items())
HOSTS = f"""{PARSED}, countries(country, suffix) AS (VALUES {_NAMED}),
hosts AS (
  SELECT country, host, count(*) AS requests
  FROM parsed JOIN countries ON ends_with(host, suffix) GROUP BY country, host),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY country ORDER BY requests DESC, host) AS rank
  FROM hosts)"""

POLICIES = """policies AS (
  SELECT o_orderkey AS policy_id, claim_nb, (claim_nb > 0)::int AS has_claim, exposure,
         o_orderstatus AS status, o_orderpriority AS priority, c_mktsegment AS segment,
         o_totalprice AS total_price, c_acctbal AS balance, c_nationkey AS nation
  FROM (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS claim_nb,
               count(*)::double AS exposure
        FROM lineitem GROUP BY l_orderkey)
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey)"""

_MEASURED = ", ".join(
    f'embedding[{i + 1}]::double AS "{name}"' for i, name in enumerate(PARTICLE_FEATURES)
)
PARTICLES = f"""particles AS (
  SELECT vec_id, (label < 5)::int::double AS label, {_MEASURED} FROM embeddings)"""

RATINGS = """ratings AS (
  SELECT o_custkey::int AS "userId", l_partkey::int AS "movieId", ceil(l_quantity / 5) / 2 AS rating,
         epoch(o_orderdate)::bigint AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES = """movies AS (
  SELECT p_partkey::int AS "movieId", p_name AS title,
         concat_ws('|', replace(p_name, ' ', '|'), p_type) AS genres
  FROM part)"""

SCORES = """scores AS (
  SELECT (label < 5)::int::double AS label, (embedding[1] > 0)::int::double AS prediction,
         embedding[1]::double AS score
  FROM embeddings)"""


def hash_fraction(keys: list[str], seed: int) -> str:
    parts = " || ".join(
        f"coalesce(length({key}::varchar)::varchar || ':' || {key}::varchar, 'null') || '|'" for key in keys
    )
    return f"(('0x' || substr(md5({parts} || '{seed}'), 1, 8))::bigint / 4294967296.0)"
