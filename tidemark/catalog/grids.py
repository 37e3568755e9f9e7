"""Models of many settings at once, where SQL can add up what they must fulfil.

Without a penalty the predictions of a Poisson or logistic model add up to the labels within every level
of every column that it reads, on its own training rows. Boosted trees of one column predict the group's
majority from the first stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.inputs import POLICIES, hash_fraction
from tidemark.catalog.registry import Query, rounded
from tidemark.operators import batched, features, metrics, models, schema, tuning
from tidemark.operators.splits import k_fold
from tidemark.sources import fixtures
from tidemark.sources.cache import kept
from tidemark.sources.files import read_table

_FOLDS, _SEED = 3, models.CLAIMS_SEED
_LEVELS = ["status", "priority", "segment"]


def _score_equations(spark: SparkSession, directory: str) -> DataFrame:
    """Sums of predictions by level, of models that train side by side on all rows and without each fold."""
    policies = schema.positive_label(fixtures.policies(spark, directory), "claim_nb", "has_claim")
    columns = fixtures.POLICY_FEATURE_COLUMNS
    vectors = features.fit_features(policies, columns).transform(policies)
    fold = k_fold(_FOLDS, ["policy_id"], _SEED)
    problems = [
        batched.Problem(family, label, "l2", 0.0, held_out)
        for family, label in (("poisson", "claim_nb"), ("logistic", "has_claim"))
        for held_out in (None, *range(_FOLDS))
    ]
    with kept(batched.wide_rows(vectors, features.FEATURES, ["claim_nb", "has_claim", "policy_id"], fold)) as rows:
        fitted = batched.fit_batch(rows, problems, tolerance=1e-10).models
    long = batched.score_batch(rows, fitted, held_out=False, keep=["policy_id"])
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("number") + 1)
    long = long.withColumns(
        {"model": of([p.family for p in problems]), "held_out": of([-1 if p.fold is None else p.fold for p in problems])}
    ).filter("fold <> held_out")
    levels = policies.select(F.col("policy_id").cast("double").alias("policy_id"), *_LEVELS).unpivot("policy_id", _LEVELS, "column", "level")
    totals = long.join(levels, "policy_id").groupBy("model", "held_out", "column", "level").agg(F.sum("score").alias("total"))
    return rounded(totals, "total", digits=3)


_TRAINED = f"""{POLICIES}, folded AS (
  SELECT *, floor({hash_fraction(['policy_id'], _SEED)} * {_FOLDS})::int AS fold FROM policies)"""

_EQUATIONS = f"""WITH {_TRAINED}, long AS (
  SELECT model, held_out, "column", level, CASE model WHEN 'poisson' THEN claim_nb ELSE has_claim END AS label
  FROM (SELECT *, unnest(['status', 'priority', 'segment']) AS "column", unnest([status, priority, segment]) AS level FROM folded),
    (VALUES ('poisson'), ('logistic')) AS m(model), (VALUES (-1), (0), (1), (2)) AS f(held_out)
  WHERE fold <> held_out)
SELECT model, held_out, "column", level, sum(label)::double AS total FROM long GROUP BY ALL"""


def _auc_by_group(spark: SparkSession, directory: str) -> DataFrame:
    """The exact curve of every setting and fold: here a coordinate of the vector is the setting's score."""
    rows = read_table(spark, directory, "embeddings")
    settings = [F.struct(F.lit(i).alias("setting"), F.round(F.col("embedding")[i].cast("double"), i + 1).alias("score")) for i in range(4)]
    label = (F.col("label") < 5).cast("double").alias("label")
    long = rows.select((F.col("vec_id") % 3).alias("fold"), label, F.inline(F.array(*settings)))
    return rounded(metrics.area_under_roc(long, by=["setting", "fold"]), "area_under_roc", digits=9)


_AUC_BY_GROUP = """WITH long AS (
  SELECT vec_id % 3 AS fold, (label < 5)::int AS label, setting, round(embedding[setting + 1]::double, setting + 1) AS score
  FROM embeddings, (SELECT unnest([0, 1, 2, 3]) AS setting)),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY setting, fold ORDER BY score)
            + (count(*) OVER (PARTITION BY setting, fold, score) - 1) / 2.0 AS r FROM long)
SELECT setting, fold, round((sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0)
                            / (sum(label) * (count(*) - sum(label))), 9) AS area_under_roc
FROM ranked GROUP BY setting, fold"""


def _staged_boosting(spark: SparkSession, directory: str) -> DataFrame:
    """Rows by label and prediction at each number of iterations, of one fit."""
    orders = read_table(spark, directory, "orders").select(
        (F.col("o_orderstatus") == "O").cast("double").alias("open"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") % 5 == 0).otherwise(F.col("o_orderkey") % 10 < 7).cast("double").alias("label"),
    )
    with kept(features.fit_features(orders, ["open"]).transform(orders)) as vectors:
        model = models.gradient_boosting(maxIter=4, maxDepth=1).fit(vectors)
    return metrics.confusion(tuning.staged_scores(model, vectors, [1, 2, 4]), by=["stage"])


_STAGED = """WITH planted AS (
  SELECT o_orderstatus = 'O' AS open, CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 5 = 0 ELSE o_orderkey % 10 < 7 END::int::double AS label
  FROM orders),
predicted AS (SELECT label, (avg(label) OVER (PARTITION BY open) > 0.5)::int::double AS prediction FROM planted)
SELECT stage, label, prediction, count(*) AS n FROM predicted, (VALUES (1), (2), (4)) AS s(stage) GROUP BY ALL"""


QUERIES = [
    Query("claims_score_equations", _score_equations, _EQUATIONS),
    Query("eval_auc_by_group", _auc_by_group, _AUC_BY_GROUP),
    Query("model_gbt_staged", _staged_boosting, _STAGED),
]
