import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tidemark.operators import metrics


def auc(spark, rows):
    df = spark.createDataFrame(rows, "label double, score double")
    return metrics.area_under_roc(df).first().area_under_roc


def by_pairs(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_by_hand(spark):
    assert auc(spark, [(1.0, 0.9), (0.0, 0.1)]) == 1.0
    assert auc(spark, [(1.0, 0.1), (0.0, 0.9)]) == 0.0
    assert auc(spark, [(1.0, 0.5), (0.0, 0.5), (0.0, 0.5)]) == 0.5


def test_auc_needs_both_classes(spark):
    assert auc(spark, [(1.0, 0.9)]) is None
    assert auc(spark, []) is None


@pytest.mark.parametrize("levels", [3, 40, 10_000])
def test_auc_equals_counting_pairs(spark, levels):
    rng = random.Random(levels)
    rows = [(float(rng.random() < 0.3), rng.randrange(levels) / levels) for _ in range(600)]
    assert auc(spark, rows) == pytest.approx(by_pairs(rows), abs=1e-12)


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(2)
    rows = [(float(rng.randrange(3)), float(rng.randrange(4))) for _ in range(300)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_f1_and_accuracy_equal_the_library(predictions):
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(predictions)
    assert metrics.f1_weighted(predictions).first()[0] == pytest.approx(f1)
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predictions)
    assert metrics.accuracy(predictions).first()[0] == pytest.approx(accuracy)


def test_regression_metrics_equal_the_library(predictions):
    row = metrics.regression_metrics(predictions).first()
    for name in ("rmse", "mse", "mae"):
        assert row[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(predictions))


def test_all_at_once_reads_the_rows_once(spark, predictions):
    reads = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            reads.add(1)
            yield row

    rows = predictions.filter("label < 2").withColumn("score", F.col("prediction") / 4)
    counted = spark.createDataFrame(rows.rdd.mapPartitions(seen), rows.schema)
    row = metrics.classification_metrics(counted).first()
    assert reads.value == rows.count()
    assert row.f1_weighted == pytest.approx(metrics.f1_weighted(rows).first()[0])
    assert row.area_under_roc == pytest.approx(metrics.area_under_roc(rows).first()[0])


def test_all_at_once_and_long_form(spark, predictions):
    df = predictions.filter("label < 2").withColumn("score", F.col("prediction") / 4)
    row = metrics.classification_metrics(df)
    assert row.first().accuracy == metrics.accuracy(df).first()[0]
    long = metrics.long_form(row.withColumn("m", F.lit("x")), ["m"], ["accuracy", "f1_weighted"])
    assert {r.metric for r in long.collect()} == {"accuracy", "f1_weighted"}
