"""Models trained side by side against the library's, each on its own."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from tidemark.operators import batched, features, metrics, models, tuning
from tidemark.operators.splits import k_fold


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(900):
        area, power, noise = rng.choice("aaabbc"), rng.gauss(5, 2), rng.gauss(0, 30)
        rate = math.exp(-0.5 + 0.2 * power - 0.6 * (area == "b"))
        n = sum(rng.random() < rate / 12 for _ in range(12))
        out.append((i, area, power, noise, float(n), float(n > 1), math.log(rng.uniform(0.5, 2))))
    schema = "id long, area string, power double, noise double, n double, label double, lo double"
    return spark.createDataFrame(out, schema).repartition(4).persist()


COLUMNS = ["area", "power", "noise"]
STRENGTHS = [0.001, 0.1, 2.0]


def wide(df, columns=("n", "label", "lo")):
    vectors = features.fit_features(df, COLUMNS).transform(df)
    return vectors, batched.wide_rows(vectors, "features", columns, k_fold(3, ["id"], 1)).persist()


@pytest.mark.parametrize(
    ("family", "penalty", "offset"), [("logistic", "l1", None), ("logistic", "l2", None), ("poisson", "l2", None), ("poisson", "l2", "lo")]
)
def test_coefficients_equal_the_library(rows, family, penalty, offset):
    vectors, table = wide(rows)
    label = "n" if family == "poisson" else "label"
    problems = [batched.Problem(family, label, penalty, s, fold, offset=offset) for s in [0.0, *STRENGTHS] for fold in (None, 0, 2)]
    found = batched.fit_batch(table, problems)
    assert all(m.converged for m in found.models) and found.scans < 30
    for model in found.models:
        strict = {"regParam": model.problem.strength, "tol": 1e-12, "maxIter": 500}
        own = vectors if model.problem.fold is None else vectors.filter(k_fold(3, ["id"], 1) != model.problem.fold)
        if family == "poisson":
            expected = models.poisson_regression("n", offset_col=offset, **strict).fit(own)
        else:
            expected = models.logistic_regression("label", penalty, **strict).fit(own)
        # Without a penalty a level's coefficients and the intercept are not unique; their sums are.
        if model.problem.strength:
            assert model.coefficients == pytest.approx(expected.coefficients.toArray(), abs=2e-4), model.problem
            assert model.intercept == pytest.approx(expected.intercept, abs=2e-4)
        scores = expected.transform(own).limit(20).collect()
        for row in scores:
            linear = float(model.coefficients @ row.features.toArray()) + model.intercept + (row.lo if offset else 0)
            mean = math.exp(linear) if family == "poisson" else 1 / (1 + math.exp(-linear))
            assert mean == pytest.approx(row.prediction if family == "poisson" else row.probability[1], abs=5e-4)


def test_scans_do_not_grow_with_the_models(rows):
    _, table = wide(rows)
    few = batched.fit_batch(table, [batched.Problem("logistic", "label", "l1", 0.01, 0)])
    grid = [batched.Problem("logistic", "label", p, s, f) for p in ("l1", "l2") for s in (0.01, 0.02, 0.3) for f in (0, 1, 2)]
    assert batched.fit_batch(table, grid).scans <= 2 * few.scans


def candidates():
    grid = {"regParam": STRENGTHS}
    return {
        "rate": tuning.Candidate(models.poisson_regression("n"), grid, tuning.rmse("n")),
        "l1": tuning.Candidate(models.logistic_regression("label", "l1"), grid, tuning.area_under_roc("label")),
        "l2": tuning.Candidate(models.logistic_regression("label", "l2"), grid, tuning.area_under_roc("label")),
    }


@pytest.mark.parametrize("scale", [False, True])
def test_cross_validation_equals_one_fit_after_the_other(rows, scale):
    stages = features.feature_stages(rows, COLUMNS, scale)
    given = candidates()
    if scale:
        for c in given.values():
            c.estimator.setFeaturesCol("scaledFeatures")
    together = tuning.cross_validate_linear(rows, given, 3, ["id"], 1, stages, scaled=scale)
    apart = tuning.cross_validate(rows, given, 3, ["id"], 1, stages)
    for name in given:
        values = [{(r.setting, r.fold): r.value for r in o[name].folds.collect()} for o in (together, apart)]
        assert values[0].keys() == values[1].keys()
        assert all(values[0][k] == pytest.approx(values[1][k], abs=2e-4) for k in values[0]), (name, values)
        assert together[name].best_setting == apart[name].best_setting
        assert together[name].folds.columns == apart[name].folds.columns


def test_level_that_a_fold_lacks_and_constant_columns(spark):
    df = spark.range(120).select(
        "id",
        F.when(F.col("id") == 7, "rare").otherwise(F.when(F.col("id") % 3 == 0, "a").otherwise("b")).alias("area"),
        F.lit(4.0).alias("power"), (F.col("id") % 5).cast("double").alias("noise"),
        (F.col("id") % 4).cast("double").alias("n"), ((F.col("id") % 5 + F.col("id") % 3) > 3).cast("double").alias("label"), F.lit(0.0).alias("lo"),
    )
    _, table = wide(df)
    problems = [batched.Problem(f, y, p, s, fold) for f, y, p in (("poisson", "n", "l2"), ("logistic", "label", "l1")) for s in (0.0, 0.1) for fold in (0, 1, 2)]
    for model in batched.fit_batch(table, problems).models:
        assert np.isfinite(model.coefficients).all() and model.converged
    assert batched.fit_batch(table.filter("false"), problems[:2]).models[0].converged


def test_long_vectors_are_refused(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense([0.0] * 600), 1.0)], ["features", "label"])
    table = batched.wide_rows(df, "features", ["label"], F.lit(0))
    with pytest.raises(ValueError):
        batched.fit_batch(table, [batched.Problem("logistic", "label", "l2", 0.1)])


def test_grouped_curve_equals_each_group_alone(spark):
    rng = random.Random(5)
    groups = [[("g", k, float(rng.random() < 0.4), round(rng.random() ** (k + 1), k + 1)) for _ in range(400)] for k in range(4)]
    groups.append([("h", 0, 1.0, 0.5), ("h", 0, 1.0, None), ("h", 1, 0.0, None), ("h", 1, 1.0, 0.2)])
    giant = [("big", 0, float(rng.random() < 0.5), rng.random() * 1e-6) for _ in range(6000)]
    rows = [r for g in groups for r in g] + giant
    df = spark.createDataFrame(rows, "name string, k int, label double, score double").repartition(6)
    found = {(r.name, r.k): r.area_under_roc for r in metrics.area_under_roc(df, by=["name", "k"]).collect()}
    keys = {r[:2] for r in rows}
    assert found.keys() == keys
    for name, k in keys:
        alone = metrics.area_under_roc(df.filter((F.col("name") == name) & (F.col("k") == k))).first()[0]
        assert found[name, k] == pytest.approx(alone, abs=1e-12) if alone is not None else found[name, k] is None
    f1 = {r.name: r.f1_weighted for r in metrics.f1_weighted(df.withColumn("prediction", F.round("score")).filter("name <> 'h'"), by=["name"]).collect()}
    for name in f1:
        one = df.withColumn("prediction", F.round("score")).filter(F.col("name") == name)
        assert f1[name] == pytest.approx(metrics.f1_weighted(one).first()[0])


def test_shorter_boosting_is_a_prefix(rows):
    vectors = features.fit_features(rows, COLUMNS).transform(rows)
    fit = lambda **params: models.gradient_boosting(maxDepth=3, **params).fit(vectors)
    whole = fit(maxIter=7, stepSize=0.3)
    staged = tuning.staged_scores(whole, vectors.select("id", "label", "features").orderBy("id").coalesce(1), [1, 3, 7])
    for stage in (1, 3, 7):
        own = models.with_score(fit(maxIter=stage, stepSize=0.3).transform(vectors)).orderBy("id").collect()
        got = staged.filter(F.col("stage") == stage).collect()
        assert [r.prediction for r in got] == [r.prediction for r in own]
        assert [r.score for r in got] == pytest.approx([r.score for r in own], abs=1e-9)


def test_boosting_grid_takes_a_fit_for_all_iterations(rows, monkeypatch):
    grid = {"maxDepth": [1, 2], "maxIter": [2, 5, 3], "stepSize": [0.2]}
    candidate = tuning.Candidate(models.gradient_boosting(), grid, tuning.f1_weighted("label"))
    maps = tuning.expand_grid(candidate.estimator, grid)
    assert sorted(map(len, tuning._shorter_fits(candidate, maps))) == [3, 3]
    stages = features.feature_stages(rows, COLUMNS)
    staged = tuning.cross_validate(rows, {"m": candidate}, 2, ["id"], 1, stages)["m"]
    monkeypatch.setattr(tuning, "_shorter_fits", lambda c, maps: [[s] for s in range(len(maps))])
    apart = tuning.cross_validate(rows, {"m": candidate}, 2, ["id"], 1, stages)["m"]
    assert sorted(staged.folds.collect()) == sorted(apart.folds.collect()) and staged.best_setting == apart.best_setting


def test_poisson_settings_of_a_fold_share_their_scans(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id", "id % 3 a", "id % 7 / 7 b", "double(pmod(xxhash64(id), 3 + id % 3)) label")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    estimator = GeneralizedLinearRegression(family="poisson", link="log", labelCol="label", tol=1e-10, maxIter=100)
    candidate = tuning.Candidate(estimator, {"fitIntercept": [True, False], "regParam": [0.0, 0.1, 10.0]}, tuning.rmse("label"))
    fits, fit = [], GeneralizedLinearRegression._fit
    monkeypatch.setattr(GeneralizedLinearRegression, "_fit", lambda self, rows: fits.append(self) or fit(self, rows))
    tuned = tuning.cross_validate(df, {"m": candidate}, 2, ["id"], 3)["m"]
    # By the library: two settings without intercept but with a strength, on two folds, and the refit.
    assert len(fits) == 5
    fold = k_fold(2, ["id"], 3)
    for row in tuned.folds.collect():
        model = estimator.copy({estimator.fitIntercept: row.fitIntercept, estimator.regParam: row.regParam}).fit(df.filter(fold != row.fold))
        assert row.value == pytest.approx(candidate.metric.value(model.transform(df.filter(fold == row.fold))), rel=1e-7)


def test_packed_rows_are_few_and_whole(spark):
    df = spark.range(50_000, numPartitions=2).selectExpr("int(id % 3) fold", "double(id) label", "array(double(id), 1.0, id / 2) x")
    found = batched.packed(df).collect()
    assert len(found) <= 12
    assert sorted(v for r in found for v in np.frombuffer(r.label)) == list(range(50_000))
    assert sum(len(r.x) for r in found) == 3 * 8 * 50_000 and sum(len(r.fold) for r in found) == 4 * 50_000
    wide = spark.range(10).selectExpr("0 fold", "double(id) label", f"array_repeat(1.0D, {batched.PACKED_NUMBERS // 2}) x")
    assert [len(r.label) for r in batched.packed(wide.coalesce(1)).collect()] == [16] * 5
