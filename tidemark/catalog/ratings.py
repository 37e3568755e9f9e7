"""Semi-joins, liked movies and genres, with users grouped by a given cluster column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.inputs import MOVIES, RATINGS
from tidemark.catalog.registry import Query, rounded
from tidemark.operators import models, ranking, recsys, sets
from tidemark.sources import fixtures

_CLUSTERS = f"""{RATINGS}, {MOVIES}, clusters AS (
  SELECT DISTINCT "userId" AS id, "userId" % {models.USER_CLUSTERS} AS cluster FROM ratings),
largest AS (
  SELECT cluster, count(*) AS count FROM clusters GROUP BY cluster
  ORDER BY count DESC, cluster LIMIT 1),
users AS (SELECT id FROM clusters JOIN largest USING (cluster)),
theirs AS (SELECT * FROM ratings WHERE "userId" IN (SELECT id FROM users)),
liked AS (
  SELECT "movieId", avg(rating) AS average_rating FROM theirs WHERE rating >= 4
  GROUP BY "movieId" HAVING avg(rating) >= 4)"""


def _genres(items: str) -> str:
    return (
        f"SELECT genre, count(*) AS count FROM (SELECT unnest({items}) AS genre FROM chosen) "
        "GROUP BY genre"
    )


_REPEATED = "string_split(genres, '|')"
_DISTINCT = f"list_distinct({_REPEATED})"


def _clusters(spark: SparkSession, directory: str) -> DataFrame:
    users = fixtures.ratings(spark, directory).select(F.col("userId").alias("id")).distinct()
    return users.withColumn("cluster", F.col("id") % models.USER_CLUSTERS)


def _users(spark: SparkSession, directory: str) -> DataFrame:
    return models.largest_cluster_users(_clusters(spark, directory))


def _liked(spark: SparkSession, directory: str, **options) -> DataFrame:
    ratings = fixtures.ratings(spark, directory)
    return recsys.liked_movies(ratings, _users(spark, directory), **options)


QUERIES = [
    Query(
        "largest_cluster",
        lambda s, d: ranking.largest_group(_clusters(s, d), "cluster"),
        f"WITH {_CLUSTERS} SELECT cluster, count FROM largest",
    ),
    Query(
        "cluster_semi_ratings",
        lambda s, d: recsys.ratings_of(fixtures.ratings(s, d), _users(s, d)),
        f'WITH {_CLUSTERS} SELECT "userId", "movieId", rating, timestamp FROM theirs',
    ),
    Query(
        "liked_movies",
        lambda s, d: rounded(_liked(s, d), "average_rating"),
        f"""WITH {_CLUSTERS}
        SELECT "movieId", round(average_rating, 6) AS average_rating FROM liked""",
    ),
    Query(
        "liked_movies_by_all_ratings",
        lambda s, d: rounded(_liked(s, d, average_of_all=True), "average_rating"),
        f"""WITH {_CLUSTERS}
        SELECT "movieId", round(avg(rating), 6) AS average_rating FROM theirs
        GROUP BY "movieId" HAVING avg(rating) >= 4""",
    ),
    Query(
        "semi_movies",
        lambda s, d: sets.members(fixtures.movies(s, d), _liked(s, d), "movieId"),
        f"""WITH {_CLUSTERS} SELECT "movieId", title, genres FROM movies
        WHERE "movieId" IN (SELECT "movieId" FROM liked)""",
    ),
    Query(
        "left_join_movies",
        lambda s, d: rounded(
            recsys.with_movies(_liked(s, d), fixtures.movies(s, d)), "average_rating"
        ),
        f"""WITH {_CLUSTERS}
        SELECT "movieId", round(average_rating, 6) AS average_rating, title, genres
        FROM liked LEFT JOIN movies USING ("movieId")""",
    ),
    Query(
        "genre_counts",
        lambda s, d: recsys.genre_counts(fixtures.movies(s, d), distinct=False),
        f"WITH {MOVIES}, chosen AS (SELECT genres FROM movies) {_genres(_REPEATED)}",
    ),
    Query(
        "genre_counts_distinct",
        lambda s, d: recsys.genre_counts(fixtures.movies(s, d)),
        f"WITH {MOVIES}, chosen AS (SELECT genres FROM movies) {_genres(_DISTINCT)}",
    ),
    Query(
        "genre_top10",
        lambda s, d: recsys.top_genres(_liked(s, d), fixtures.movies(s, d)),
        f"""WITH {_CLUSTERS}, chosen AS (
          SELECT genres FROM movies WHERE "movieId" IN (SELECT "movieId" FROM liked))
        {_genres(_DISTINCT)} ORDER BY count DESC, genre LIMIT 10""",
    ),
]
