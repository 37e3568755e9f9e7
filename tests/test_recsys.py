import time

import pytest

from pyspark.sql import functions as F

from tests.plans import executed
from tidemark.catalog import evaluation
from tidemark.operators import models, recsys, sets


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [(1, 10, 5.0), (1, 11, 2.0), (2, 10, 3.0), (2, 11, 4.5), (3, 12, 5.0)]
    return spark.createDataFrame(rows, "userId int, movieId int, rating double")


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(1,), (2,)], "id int")


@pytest.fixture(scope="module")
def movies(spark):
    rows = [(10, "A", "x|y|x"), (11, "B", "y"), (12, "C", "z")]
    return spark.createDataFrame(rows, "movieId int, title string, genres string")


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_liked_movies(ratings, users):
    assert as_dict(recsys.liked_movies(ratings, users)) == {10: 5.0, 11: 4.5}
    assert as_dict(recsys.liked_movies(ratings, users, average_of_all=True)) == {10: 4.0}


@pytest.fixture
def skewed(spark, tmp_path):
    """A folder where one of 300 users has most ratings, and settings that split it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    path = str(tmp_path / "ratings")
    user = F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 300).cast("int")
    spark.range(60_000).select(user.alias("userId"), F.rand(1).alias("rating")).repartition(8).write.parquet(path)
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark.read.parquet(path)
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_user_is_split_for_aggregated_ids(skewed):
    ids = skewed.groupBy("userId").count().filter("count > 1").select("userId")
    found = sets.members(skewed, ids, "userId")
    assert "skew=true" in executed(found)
    assert found.count() == 60_000


def test_hot_user_is_split_for_means(skewed, monkeypatch):
    monkeypatch.setattr(evaluation.fixtures, "ratings", lambda *_: skewed)
    assert "skew=true" in executed(evaluation._user_means(skewed.sparkSession, ""))


def test_null_keys_are_no_members(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    assert [r.k for r in sets.members(df, df.filter("k is null or k = 1"), "k").collect()] == [1]


def test_repeated_genres(movies):
    assert as_dict(recsys.genre_counts(movies)) == {"x": 1, "y": 2, "z": 1}
    assert as_dict(recsys.genre_counts(movies, distinct=False)) == {"x": 2, "y": 2, "z": 1}


def test_missing_movie_stays_in_the_left_join(spark, movies):
    liked = spark.createDataFrame([(10, 5.0), (99, 4.0)], "movieId int, average_rating double")
    joined = {r.movieId: r.genres for r in recsys.with_movies(liked, movies).collect()}
    assert joined == {10: "x|y|x", 99: None}
    assert as_dict(recsys.genre_counts(recsys.with_movies(liked, movies))) == {"x": 1, "y": 1}


def test_top_genres_cut_ties_by_name(ratings, users, movies):
    liked = recsys.liked_movies(ratings, users)
    assert [tuple(r) for r in recsys.top_genres(liked, movies, 1).collect()] == [("y", 2)]


def test_largest_cluster_users(spark):
    clusters = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id int, cluster int")
    assert sorted(r.id for r in models.largest_cluster_users(clusters).collect()) == [2, 3]
    assert [tuple(r) for r in models.cluster_sizes(clusters).collect()] == [(1, 2), (0, 1)]


def test_moved_factors_of_old_iterations_leave_the_disk(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {name.split("_")[1] for name in (f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files.getAllFiles())) if name.startswith("shuffle_")}
    given = spark.range(4000).selectExpr("cast(id % 97 as int) userId", "cast(id % 89 as int) movieId", "cast(id % 5 as double) rating")
    before = shuffles()
    model = models.fit_recommender(given, blocks=2, rank=2, maxIter=9)
    deadline = time.time() + 20
    # Three shuffles deal out the ratings, two move the factors of the last iteration; 18 halves were left before.
    while len(shuffles() - before) > 8 and time.time() < deadline:
        time.sleep(0.5)
    assert len(shuffles() - before) <= 8
    assert model.userFactors.count() == 97


def test_more_ratings_than_the_library_takes_are_fitted_by_blocks(spark, monkeypatch):
    """A task of the library held a block of a tenth of all ratings and the factors that it names."""
    given = spark.range(4000).selectExpr("cast(id * 31 % 97 as int) userId", "cast(id * id % 89 as int) movieId", "cast(id % 5 as double) rating")
    given = given.repartition(3)
    for params in ({"rank": 3, "maxIter": 3, "regParam": 0.05}, {"rank": 1, "maxIter": 2, "nonnegative": True}):
        library = models.fit_recommender(given, blocks=4, **params)
        with monkeypatch.context() as patch:
            patch.setattr(models, "LIBRARY_BLOCK_ROWS", 999)
            found = models.fit_recommender(given, blocks=4, **params)
        assert not hasattr(found, "userFactors")
        users = lambda m: [[r.id for r in part] for part in models.user_factors(m).rdd.glom().collect()]
        assert users(found) == users(library)
        rows = lambda m: [tuple(r) for r in m.transform(given).groupBy("userId", "movieId").agg(F.round(F.avg("prediction"), 3)).sort("userId", "movieId").collect()]
        for one, other in zip(rows(found), rows(library), strict=True):
            assert one[:2] == other[:2] and abs(one[2] - other[2]) <= 0.0021
