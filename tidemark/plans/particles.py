"""Comparing tree ensembles and a neural network on a two-class table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import metrics, models, tuning
from tidemark.operators.features import FEATURES
from tidemark.operators.splits import random_split, sample
from tidemark.sources.cache import kept
from tidemark.sources.files import scratch_path, snapshot


@dataclass(frozen=True)
class ClassifierRun:
    report: DataFrame
    """(model, metric, value) on the test rows"""
    best_params: DataFrame
    """(model, param, value)"""
    tuned: dict[str, tuning.Tuned]


FULL_GRIDS = {
    "random_forest": models.FOREST_GRID,
    "gradient_boosting": models.BOOSTING_GRID,
    "neural_network": models.NETWORK_GRID,
}


def subsets(
    df: DataFrame,
    keys: Sequence[str],
    path: str,
    fraction: float = 1.0,
    seed: int = models.PARTICLES_SEED,
    thin_test: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split 70 to 30, keep `fraction` of the training part, write both parts below `path`.

    The test part is thinned as well only with `thin_test`. Returns readers of both.
    """
    train, test = random_split(df, [0.7, 0.3], keys, seed + 1)
    train = sample(train, fraction, keys, seed)
    test = sample(test, fraction, keys, seed) if thin_test else test
    return snapshot(train, f"{path}/train"), snapshot(test, f"{path}/test")


def run_classifiers(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label_col: str = "label",
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
    fraction: float = 1.0,
    folds: int = 5,
    path: str | None = None,
    parallelism: int = 8,
    thin_test: bool = False,
) -> ClassifierRun:
    """Tune each model on the training part, report accuracy, F1 and AUC on the test part.

    `fraction` is the share of the training rows that is used, which bounds the fits; all test
    rows are measured unless `thin_test`. Both parts are written to `path`, a folder that all
    executors share, by default one below `spark.checkpoint.dir`. A table without a key of its
    own is split by all its columns as `keys`; equal rows then share a part.
    """
    grids = FULL_GRIDS if grids is None else grids
    path = path or scratch_path(df.sparkSession, "particles")
    used = dict.fromkeys([*keys, label_col, *features])
    narrow = df.select(*[F.col(f"`{c}`") for c in used])
    train, test = subsets(narrow, keys, path, fraction, thin_test=thin_test)
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    train = assembler.transform(train)
    test = assembler.transform(test).select(label_col, FEATURES)
    estimators = {
        "random_forest": models.random_forest(label_col),
        "gradient_boosting": models.gradient_boosting(label_col),
        "neural_network": models.neural_network(len(features), label_col),
    }
    metric = tuning.f1_weighted(label_col)
    candidates = {
        name: tuning.Candidate(estimators[name], grid, metric) for name, grid in grids.items()
    }
    tuned = tuning.cross_validate(
        train, candidates, folds, keys, models.PARTICLES_SEED, parallelism=parallelism
    )
    values, params = [], []
    with kept(test) as test_rows:
        for name, outcome in tuned.items():
            predictions = models.with_score(outcome.model.transform(test_rows))
            row = metrics.classification_metrics(predictions, label_col).first()
            values += [(name, metric, value) for metric, value in row.asDict().items()]
            params += [(name, p, str(v)) for p, v in outcome.best_params.items()]
    spark = df.sparkSession
    return ClassifierRun(
        report=spark.createDataFrame(values, "model string, metric string, value double"),
        best_params=spark.createDataFrame(params, "model string, param string, value string"),
        tuned=tuned,
    )
