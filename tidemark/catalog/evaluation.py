"""Metrics on given predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.inputs import RATINGS, SCORES
from tidemark.catalog.registry import Query, rounded
from tidemark.operators import metrics
from tidemark.operators.sets import hashed
from tidemark.sources import fixtures


def _user_means(spark: SparkSession, directory: str) -> DataFrame:
    """Ratings predicted by the user's average rating."""
    ratings = fixtures.ratings(spark, directory).select("userId", "rating")
    means = ratings.groupBy("userId").agg(F.avg("rating").alias("prediction"))
    return hashed(ratings, "userId").join(hashed(means, "userId"), ["userId", "_hash"]).drop("_hash")


def _regression(name: str):
    def run(spark: SparkSession, directory: str) -> DataFrame:
        measured = metrics.regression_metrics(_user_means(spark, directory), "rating")
        return rounded(measured.select(name), name)

    return run


_PREDICTED = f"""WITH {RATINGS}, predicted AS (
  SELECT rating, avg(rating) OVER (PARTITION BY "userId") AS prediction FROM ratings)"""

_RANK_SUM = """ranked AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
  FROM scores)
SELECT round((sum(r) FILTER (WHERE label = 1)
              - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
             / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)), 9)
  AS area_under_roc FROM ranked"""

QUERIES = [
    Query(
        "eval_rmse",
        _regression("rmse"),
        f"{_PREDICTED} SELECT round(sqrt(avg((rating - prediction) ** 2)), 6) AS rmse FROM predicted",
    ),
    Query(
        "eval_mse",
        _regression("mse"),
        f"{_PREDICTED} SELECT round(avg((rating - prediction) ** 2), 6) AS mse FROM predicted",
    ),
    Query(
        "eval_mae",
        _regression("mae"),
        f"{_PREDICTED} SELECT round(avg(abs(rating - prediction)), 6) AS mae FROM predicted",
    ),
    Query(
        "eval_auc",
        lambda s, d: rounded(
            metrics.area_under_roc(fixtures.scores(s, d)), "area_under_roc", digits=9
        ),
        f"WITH {SCORES}, {_RANK_SUM}",
    ),
    Query(
        "eval_accuracy",
        lambda s, d: rounded(metrics.accuracy(fixtures.scores(s, d)), "accuracy"),
        f"WITH {SCORES} SELECT round(avg((label = prediction)::int), 6) AS accuracy FROM scores",
    ),
    Query(
        "eval_f1_weighted",
        lambda s, d: rounded(metrics.f1_weighted(fixtures.scores(s, d)), "f1_weighted"),
        f"""WITH {SCORES}, classes AS (SELECT DISTINCT label AS class FROM scores),
        counted AS (
          SELECT class, count(*) FILTER (WHERE label = class) AS support,
                 count(*) FILTER (WHERE prediction = class) AS predicted,
                 count(*) FILTER (WHERE label = class AND prediction = class) AS hits
          FROM classes, scores GROUP BY class)
        SELECT round(sum(support * 2.0 * hits / (support + predicted)) / sum(support), 6)
          AS f1_weighted FROM counted""",
    ),
    Query(
        "eval_confusion",
        lambda s, d: metrics.confusion(fixtures.scores(s, d)),
        f"WITH {SCORES} SELECT label, prediction, count(*) AS n FROM scores GROUP BY ALL",
    ),
]
