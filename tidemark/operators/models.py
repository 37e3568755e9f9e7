"""Estimators with the settings of the analyses, and what is read off fitted models.

Training is left to the ML library, whose solvers aggregate gradients,
histograms and normal equations on the executors.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.factorization import Factors
from tidemark.operators.features import FEATURES, feature_names
from tidemark.operators.joint_factorization import factorize_jointly, labelled, partition_labels
from tidemark.operators.ranking import largest_group
from tidemark.sources.cache import kept
from tidemark.sources.files import ensure_checkpoint_dir

# Seeds of the analyses.
CLAIMS_SEED = 24165
PARTICLES_SEED = 14
RATINGS_SEED = 230124165

# Values tried per parameter.
REGULARISATION = [0.001, 0.01, 0.1, 1, 10]
FOREST_GRID = {"maxDepth": [10, 5, 1], "maxBins": [10, 20, 50], "numTrees": [10, 15, 20]}
BOOSTING_GRID = {"maxDepth": [5, 3, 10], "maxIter": [30, 20, 10], "stepSize": [0.2, 0.3, 0.05]}
NETWORK_GRID = {
    "maxIter": [100, 10],
    "blockSize": [20, 30],
    "layers": [[28, 5, 4, 2], [28, 6, 5, 2]],
}

# The two recommender settings (the first is the library default) and clusters.
ALS_SETTINGS = {"Setting1": {}, "Setting2": {"rank": 20, "maxIter": 15, "regParam": 0.02}}
USER_CLUSTERS = 25

# Depth and impurity of the forest, shape of boosting and of the network.
FOREST = {"maxDepth": 10, "impurity": "entropy"}
BOOSTING = {"maxIter": 5, "maxDepth": 10, "lossType": "logistic"}
NETWORK_HIDDEN = [5, 4, 2]
NETWORK = {"maxIter": 100, "blockSize": 128}

#: User and item blocks of the recommender unless the caller says otherwise.
BLOCKS = 10
#: Ratings of a block up to which the library fits the recommender: a task of it holds a block and all factors that it names.
LIBRARY_BLOCK_ROWS = 4_000_000
_ONE_FIT = threading.Lock()


def poisson_regression(
    label_col: str, features_col: str = FEATURES, offset_col: str | None = None, **params
) -> GeneralizedLinearRegression:
    """Counts with a log link; `offset_col` may hold the log of the exposure."""
    model = GeneralizedLinearRegression(
        family="poisson", link="log", labelCol=label_col, featuresCol=features_col, **params
    )
    return model.setOffsetCol(offset_col) if offset_col else model


def logistic_regression(
    label_col: str, penalty: str = "l2", features_col: str = FEATURES, **params
) -> LogisticRegression:
    """Penalty 'l1' or 'l2'; its strength is `regParam`."""
    return LogisticRegression(
        labelCol=label_col,
        featuresCol=features_col,
        elasticNetParam={"l1": 1.0, "l2": 0.0}[penalty],
        **params,
    )


def random_forest(label_col: str = "label", features_col: str = FEATURES, **params):
    settings = FOREST | params
    return RandomForestClassifier(labelCol=label_col, featuresCol=features_col, **settings)


def gradient_boosting(label_col: str = "label", features_col: str = FEATURES, **params):
    settings = BOOSTING | {"seed": PARTICLES_SEED} | params
    return GBTClassifier(labelCol=label_col, featuresCol=features_col, **settings)


def neural_network(
    inputs: int, label_col: str = "label", features_col: str = FEATURES, **params
):
    settings = NETWORK | {"layers": [inputs, *NETWORK_HIDDEN], "seed": CLAIMS_SEED} | params
    return MultilayerPerceptronClassifier(
        labelCol=label_col, featuresCol=features_col, **settings
    )


def recommender(seed: int = RATINGS_SEED, **params) -> ALS:
    """Explicit ratings; pairs with an unseen user or movie get no prediction."""
    return ALS(
        userCol="userId", itemCol="movieId", ratingCol="rating", seed=seed,
        coldStartStrategy="drop", **params,
    )


def _first_users(ratings: DataFrame, blocks: int, rank: int, seed: int) -> DataFrame:
    """(id, features): what the library's fit begins with, which depends on the users and blocks alone."""
    users = ratings.select("userId").distinct().select("userId", F.col("userId").alias("movieId"), F.lit(0.0).alias("rating"))
    return recommender(seed, rank=rank, maxIter=0).setNumBlocks(blocks).fit(users).userFactors


def _fit_by_blocks(
    ratings: DataFrame, blocks: int, rank: int = 10, maxIter: int = 10, regParam: float = 0.1,  # noqa: N803
    nonnegative: bool = False, seed: int = RATINGS_SEED, checkpointInterval: int = 1,
) -> Factors:
    """The library's fit by `factorize_jointly`: the same first factors and iterations, in blocks that do not grow.

    The library begins with users and finds movies first, so both change places. Factors lie in its partitions.
    """
    swapped = ratings.select(
        F.col("movieId").alias("userId"), F.col("userId").alias("movieId"), F.col("rating").cast("float").alias("rating")
    )
    # A fit uses all cores and the disk for its own factors.
    with _ONE_FIT:
        first = _first_users(ratings, blocks, rank, seed)
        found = factorize_jointly(swapped, [F.lit(True)], rank, [maxIter], regParam, seed, nonnegative, first=first)
    factors = found[maxIter].subset(0)
    labels = partition_labels(ratings, blocks)

    def placed(df: DataFrame) -> DataFrame:
        place = labelled(F.pmod(F.col("id"), F.lit(blocks)), labels)
        return df.repartition(blocks, place).sortWithinPartitions("id")

    return Factors(placed(factors.movies), placed(factors.users), rank)


def fit_recommender(ratings: DataFrame, blocks: int = BLOCKS, **params) -> ALSModel | Factors:
    """Fit on the three columns needed; lineage is cut when a checkpoint folder is there.

    `blocks` is the number of user and of item blocks. It belongs to the model: the
    initial factors are drawn per block, so the same ratings, seed and blocks give the
    same factors on any number of cores. In the library a block's ratings and factors must fit in a
    task, and every half iteration moves factors between all pairs of blocks. Beyond `LIBRARY_BLOCK_ROWS`
    ratings for each block the same model is fitted by smaller blocks, but for rounding.

    Moved factors stay on disk until the lineage is cut. With a checkpoint folder that is done in every
    iteration, unless the caller gives another `checkpointInterval`, so the disk holds two half iterations.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    ours = {"rank", "maxIter", "regParam", "nonnegative", "seed", "checkpointInterval"}
    if params.get("maxIter", 10) and ours.issuperset(params) and ratings.count() > LIBRARY_BLOCK_ROWS * blocks:
        return _fit_by_blocks(ratings, blocks, **params)
    model = recommender(**({"checkpointInterval": 1} | params)).setNumBlocks(blocks)
    return model.fit(ratings.select("userId", "movieId", "rating"))


def user_factors(model: ALSModel | Factors) -> DataFrame:
    """(id, features): one vector per user, as k-means needs it."""
    users = model.users if isinstance(model, Factors) else model.userFactors
    return users.select("id", array_to_vector(F.col("features")).alias(FEATURES))


def fit_clusters(
    df: DataFrame, k: int = USER_CLUSTERS, seed: int = RATINGS_SEED, features_col: str = FEATURES
) -> KMeansModel:
    """K-means reads its input once per iteration, so the vectors are kept while it runs."""
    with kept(df.select(features_col)) as vectors:
        return KMeans(
            k=k, seed=seed, featuresCol=features_col, predictionCol="cluster"
        ).fit(vectors)


def cluster_sizes(clusters: DataFrame, top: int | None = 5) -> DataFrame:
    """(cluster, count), largest first; all clusters when `top` is None."""
    sizes = clusters.groupBy("cluster").count().orderBy(F.desc("count"), F.asc("cluster"))
    return sizes if top is None else sizes.limit(top)


def largest_cluster_users(clusters: DataFrame) -> DataFrame:
    """(id) of the users in the largest cluster, as a table."""
    # One row by construction: the first of the ordered sizes.
    largest = largest_group(clusters, "cluster").select("cluster").scalar()
    return clusters.filter(F.col("cluster") == largest).select("id")


def with_score(predictions: DataFrame, score_col: str = "score") -> DataFrame:
    """Add the probability of class 1 as a plain number."""
    return predictions.withColumn(score_col, vector_to_array(F.col("probability"))[1])


def coefficient_table(model, predictions: DataFrame, features_col: str = FEATURES) -> DataFrame:
    """(feature, coefficient), the intercept included; names come from the vector's metadata.

    As long as the feature vector, which the fitted model holds on the driver anyway.
    """
    names = feature_names(predictions, features_col)
    rows = [(name, float(value)) for name, value in zip(names, model.coefficients, strict=True)]
    rows.append(("(intercept)", float(model.intercept)))
    return predictions.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def scored_columns(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys and prediction, plus one probability column per class where there is one."""
    columns = [*keys, "prediction"]
    if "probability" in predictions.columns:
        probability = vector_to_array(F.col("probability"))
        columns += [probability[0].alias("probability_0"), probability[1].alias("probability_1")]
    return predictions.select(*columns)
