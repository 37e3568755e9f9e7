import math

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tidemark.operators import features, models, tuning
from tidemark.plans import recommender


@pytest.fixture(scope="module")
def policies(spark):
    df = spark.range(600).select(
        "id",
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("area"),
        (F.col("id") % 7).cast("double").alias("power"),
        (F.col("id") % 11).cast("double").alias("noise"),
        (F.col("id") % 7 > 3).cast("int").alias("label"),
        (F.col("id") % 3).alias("claims"),
        (F.col("id") % 2 + 1).cast("double").alias("exposure"),
    )
    return df.persist()


def test_feature_names_follow_the_slots(policies):
    fitted = features.fit_features(policies, ["power", "area"], handle_invalid="error")
    names = features.feature_names(fitted.transform(policies))
    assert names == ["area_ohe_a", "area_ohe_b", "power"]


def test_unseen_level_is_all_zeros(spark, policies):
    fitted = features.fit_features(policies, ["area"])
    odd = spark.createDataFrame([("new",)], "area string")
    assert fitted.transform(odd).first().features.toArray().tolist() == [0.0, 0.0, 0.0]


def test_features_must_be_text_or_numbers(policies):
    with pytest.raises(ValueError):
        features.feature_stages(policies.withColumn("d", F.current_date()), ["d"])


def test_hashed_encoding_takes_any_number_of_levels(spark):
    df = spark.range(120_000).select(F.concat(F.lit("level"), "id").alias("area"), (F.col("id") % 7).alias("power"))
    stages = features.feature_stages(df, ["area", "power"], encoding="hash", slots=1024)
    vectors = features.fit_features(df, ["area", "power"], encoding="hash", slots=1024).transform(df)
    assert len(stages) == 2 and vectors.first().features.size == 1025
    assert len(features.feature_names(vectors)) == 1025
    with pytest.raises(ValueError):
        features.feature_stages(df, ["area"], encoding="other")


def test_claims_run_with_hashed_levels(policies):
    from tidemark.plans.claims import run_claims

    run = run_claims(
        policies.withColumnRenamed("claims", "n"), ["area"], ["id"], "n", "any",
        regularisation=[0.1], cv_fraction=1.0, folds=2, encoding="hash", slots=16,
    )
    assert run.report.count() == 5 and run.coefficients.count() == 3 * 17


def test_factors_do_not_depend_on_the_cores(spark):
    ratings = spark.range(400).select(
        (F.col("id") % 20).cast("int").alias("userId"),
        (F.col("id") * 7 % 31).cast("int").alias("movieId"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
    )
    model = models.fit_recommender(ratings, rank=2, maxIter=2)
    again = models.fit_recommender(ratings.repartition(3), rank=2, maxIter=2)
    factors = lambda m: {r.id: [round(x, 4) for x in r.features] for r in m.userFactors.collect()}
    assert factors(model) == factors(again)
    assert model.userFactors.rdd.getNumPartitions() == models.BLOCKS


def _fit(policies, estimator, columns=("power", "noise")):
    vectors = features.fit_features(policies, list(columns)).transform(policies)
    return estimator.fit(vectors), vectors


def test_l1_is_sparser_than_l2(policies):
    zeros = {}
    for penalty in ("l1", "l2"):
        model, _ = _fit(policies, models.logistic_regression("label", penalty, regParam=0.05))
        zeros[penalty] = sum(abs(c) < 1e-9 for c in model.coefficients)
    assert zeros == {"l1": 1, "l2": 0}


def test_poisson_offset_models_a_rate(policies):
    df = policies.select(
        (F.col("exposure") * 3).alias("n"), F.log("exposure").alias("log_exposure"), "power"
    )
    vectors = features.fit_features(df, ["power"]).transform(df)
    model = models.poisson_regression("n", offset_col="log_exposure").fit(vectors)
    assert model.intercept == pytest.approx(math.log(3), abs=1e-6)
    assert model.coefficients[0] == pytest.approx(0, abs=1e-6)


def test_probabilities_sum_to_one(policies):
    for estimator in (
        models.random_forest(numTrees=3, maxDepth=3),
        models.gradient_boosting(maxIter=2, maxDepth=2),
        models.neural_network(2, maxIter=5),
    ):
        model, vectors = _fit(policies, estimator)
        rows = models.scored_columns(model.transform(vectors), ["id"]).collect()
        assert len(rows) == 600
        assert all(abs(r.probability_0 + r.probability_1 - 1) < 1e-9 for r in rows)


def test_coefficient_table_ends_with_the_intercept(policies):
    model, vectors = _fit(policies, models.logistic_regression("label", "l2", regParam=0.1))
    table = models.coefficient_table(model, model.transform(vectors)).collect()
    assert [r.feature for r in table] == ["power", "noise", "(intercept)"]


def test_grid_has_all_combinations():
    forest = models.random_forest()
    maps = tuning.expand_grid(forest, models.FOREST_GRID)
    assert len(maps) == 27
    assert len({tuple(sorted((p.name, v) for p, v in m.items())) for m in maps}) == 27


def test_cross_validation_tables_and_directions(policies):
    grid = {"regParam": [0.001, 10.0]}
    tuned = tuning.cross_validate(
        policies,
        {
            "rate": tuning.Candidate(models.poisson_regression("claims"), grid, tuning.rmse("claims")),
            "label": tuning.Candidate(
                models.logistic_regression("label", "l2"), grid, tuning.area_under_roc("label")
            ),
        },
        folds=2,
        keys=["id"],
        seed=1,
        prepare=features.feature_stages(policies, ["area", "power", "noise"]),
    )
    for name, pick in (("rate", min), ("label", max)):
        outcome = tuned[name]
        assert outcome.folds.count() == 4
        means = {r.setting: r.value for r in outcome.settings().collect()}
        assert means[outcome.best_setting] == pytest.approx(pick(means.values()))
        best = {r.param: r.value for r in outcome.best().collect()}
        assert best == {"regParam": str(grid["regParam"][outcome.best_setting])}
        assert outcome.model.transform(policies).count() == 600


def test_cross_validation_refuses_a_one_class_fold(spark):
    df = spark.range(20).select("id", F.col("id").cast("double").alias("x"), F.lit(1).alias("label"))
    candidate = tuning.Candidate(
        models.logistic_regression("label"), {"regParam": [0.1]}, tuning.area_under_roc("label")
    )
    with pytest.raises(ValueError):
        tuning.cross_validate(
            df, {"m": candidate}, 2, ["id"], 1, features.feature_stages(df, ["x"])
        )


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.range(900).select(
        (F.col("id") % 30).cast("int").alias("userId"),
        (F.col("id") * 7 % 41).cast("int").alias("movieId"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
        F.col("id").alias("timestamp"),
    ).persist()


def test_recommender_report_and_clusters(ratings):
    splits = recommender.time_splits(ratings, [0.5, 0.8])
    assert [len(s) for s in splits.values()] == [2, 2]
    fitted = recommender.fit_models(splits, {"small": {"rank": 3, "maxIter": 2}})
    report = recommender.report(splits, fitted)
    wide = recommender.wide_report(report).collect()
    assert {r.split for r in wide} == {"50%", "80%"}
    assert all(r.mse == pytest.approx(r.rmse**2) and r.mae <= r.rmse for r in wide)
    model = fitted["80%", "small"]
    clusters = recommender.cluster_users(model, k=4)
    rows = clusters.collect()
    assert len(rows) == 30 and all(len(r.features) == 3 and 0 <= r.cluster < 4 for r in rows)
    liked = recommender.liked_by_largest_cluster(splits["80%"][0], clusters)
    assert all(r.average_rating >= 4 for r in liked.collect())
