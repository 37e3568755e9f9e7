"""Claim counts and claim occurrence from policy features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import batched, metrics, models, tuning
from tidemark.operators.features import FEATURES, HASH_SLOTS, SCALED, feature_stages
from tidemark.operators.schema import positive_label
from tidemark.operators.splits import CLAIM_FRACTIONS, sample, stratified_split
from tidemark.sources.cache import kept


@dataclass(frozen=True)
class ClaimsRun:
    report: DataFrame
    """(model, metric, value) on the test rows"""
    coefficients: DataFrame
    """(model, feature, coefficient)"""
    tuned: dict[str, tuning.Tuned]


def _side_by_side(rows: DataFrame, stages: Sequence[Estimator], handle_invalid: str, encoding: str) -> bool:
    """Whether all settings can train in common scans: every level has a slot and vectors are short."""
    if encoding == "index" and handle_invalid != "keep":
        return False
    first = Pipeline(stages=list(stages)).fit(rows).transform(rows).select(FEATURES).first()
    return first is not None and first[FEATURES].size <= batched.MAX_WIDTH


def run_claims(
    policies: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    count_col: str = "claim_nb",
    label_col: str = "has_claim",
    fractions: Mapping[object, float] = CLAIM_FRACTIONS,
    regularisation: Sequence[float] = models.REGULARISATION,
    folds: int = 3,
    cv_fraction: float = 0.1,
    refit_on_all: bool = False,
    scale: bool = False,
    handle_invalid: str = "keep",
    encoding: str = "index",
    slots: int = HASH_SLOTS,
    offset_col: str | None = None,
    seed: int = models.CLAIMS_SEED,
    parallelism: int = 8,
) -> ClaimsRun:
    """Tune and test Poisson, L1 and L2 logistic regression.

    Settings are compared on `cv_fraction` of the training rows, all in common scans unless vectors are
    longer than `batched.MAX_WIDTH` or levels may be left out; with
    `refit_on_all` the best one is then fitted on all of them. `scale` trains on
    the scaled vectors. `encoding` and `slots` are those of `feature_stages`. `offset_col` takes the exposure out of the features and
    into the Poisson model as a log offset.
    """
    used = {*keys, *features, count_col, *([offset_col] if offset_col else [])}
    narrow = positive_label(policies.select(*sorted(used)), count_col, label_col)
    if offset_col:
        narrow = narrow.withColumn("_offset", F.log(offset_col))
        features = [f for f in features if f != offset_col]
    train, test = stratified_split(narrow, label_col, fractions, keys, seed)
    chosen = sample(train, cv_fraction, keys, seed + 1)
    stages = feature_stages(train, features, scale, handle_invalid, encoding, slots)
    vector = SCALED if scale else FEATURES

    grid = {"regParam": regularisation}
    candidates = {
        "poisson": tuning.Candidate(
            models.poisson_regression(count_col, vector, "_offset" if offset_col else None),
            grid,
            tuning.rmse(count_col),
        ),
        "logistic_l1": tuning.Candidate(
            models.logistic_regression(label_col, "l1", vector),
            grid,
            tuning.area_under_roc(label_col),
        ),
        "logistic_l2": tuning.Candidate(
            models.logistic_regression(label_col, "l2", vector),
            grid,
            tuning.area_under_roc(label_col),
        ),
    }
    refit_on = train if refit_on_all else None
    with kept(chosen) as chosen_rows:
        if _side_by_side(chosen_rows, stages, handle_invalid, encoding):
            tuned = tuning.cross_validate_linear(
                chosen_rows, candidates, folds, keys, seed + 2, stages, parallelism, refit_on, FEATURES, scale
            )
        else:
            tuned = tuning.cross_validate(chosen_rows, candidates, folds, keys, seed + 2, stages, parallelism, refit_on)
    values, coefficients = [], []
    # All candidates share their feature stages.
    encoder = tuned["poisson"].model.stages[0]
    tested = [count_col, label_col, vector, *(["_offset"] if offset_col else [])]
    with kept(encoder.transform(test).select(*tested)) as vectors:
        for name, outcome in tuned.items():
            model = outcome.model.stages[-1]
            predictions = model.transform(vectors)
            values.append((name, outcome.metric.name, outcome.metric.value(predictions)))
            if name != "poisson":
                accuracy = metrics.accuracy(predictions, label_col).first()[0]
                values.append((name, "accuracy", accuracy))
            coefficients.append(
                models.coefficient_table(model, predictions, vector).select(
                    F.lit(name).alias("model"), "feature", "coefficient"
                )
            )
    spark = policies.sparkSession
    poisson, l1, l2 = coefficients
    return ClaimsRun(
        report=spark.createDataFrame(values, "model string, metric string, value double"),
        coefficients=poisson.unionByName(l1).unionByName(l2),
        tuned=tuned,
    )
