"""Parameter grids and cross-validation on repeatable folds."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import batched, metrics
from tidemark.operators.concurrency import side_by_side
from tidemark.operators.models import with_score
from tidemark.operators.splits import k_fold
from tidemark.sources.cache import kept
from tidemark.sources.files import ensure_checkpoint_dir


@dataclass(frozen=True)
class Metric:
    """A number read from predictions, and the direction in which it improves."""

    name: str
    compute: Callable[[DataFrame], DataFrame]
    larger_is_better: bool
    grouped: Callable[[DataFrame, Sequence[str]], DataFrame]
    """The metric of each group of a table (label, prediction, score), in one job."""

    def value(self, predictions: DataFrame) -> float:
        return self.compute(predictions).first()[self.name]

    def values(self, long: DataFrame, by: Sequence[str]) -> dict[tuple, float]:
        return {tuple(r[c] for c in by): r[self.name] for r in self.grouped(long, by).collect()}


def rmse(label_col: str) -> Metric:
    return Metric(
        "rmse", lambda df: metrics.regression_metrics(df, label_col), False,
        lambda df, by: metrics.regression_metrics(df, by=by),
    )


def area_under_roc(label_col: str) -> Metric:
    return Metric(
        "area_under_roc", lambda df: metrics.area_under_roc(with_score(df), label_col), True,
        lambda df, by: metrics.area_under_roc(df, by=by),
    )


def f1_weighted(label_col: str) -> Metric:
    return Metric(
        "f1_weighted", lambda df: metrics.f1_weighted(df, label_col), True,
        lambda df, by: metrics.f1_weighted(df, by=by),
    )


def expand_grid(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of the values, as parameter maps of the estimator."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


@dataclass(frozen=True)
class Candidate:
    """A model to tune: the values to try per parameter and the metric that decides."""

    estimator: Estimator
    grid: Mapping[str, Sequence]
    metric: Metric


@dataclass(frozen=True)
class Tuned:
    """Outcome of a cross-validation."""

    folds: DataFrame
    """(setting, <one column per parameter>, fold, metric, value)"""
    best_setting: int
    best_params: dict
    model: PipelineModel
    metric: Metric

    def settings(self) -> DataFrame:
        """(setting, <one column per parameter>, metric, value): the mean over the folds."""
        keys = [c for c in self.folds.columns if c not in ("fold", "value")]
        return self.folds.groupBy(*keys).agg(F.avg("value").alias("value"))

    def best(self) -> DataFrame:
        """(param, value) of the best setting, in readable form."""
        rows = [(name, str(value)) for name, value in self.best_params.items()]
        return self.folds.sparkSession.createDataFrame(rows, "param string, value string")


def _plain(value):
    return ",".join(str(v) for v in value) if isinstance(value, list) else value


def _columns_read(estimators: Iterable[Estimator]) -> list[str]:
    params = ("labelCol", "featuresCol", "weightCol", "offsetCol")
    columns = {
        estimator.getOrDefault(name)
        for estimator in estimators
        for name in params
        if estimator.hasParam(name) and estimator.isDefined(name)
    }
    return sorted(columns - {""})


def _is_poisson(estimator: Estimator) -> bool:
    return isinstance(estimator, GeneralizedLinearRegression) and (estimator.getFamily(), estimator.getLink()) == ("poisson", "log")


def _has_batched_form(estimator: Estimator, values: Mapping) -> bool:
    """Whether `batched` minimises what the Poisson estimator does under this parameter map."""
    if {p.name for p in values} - {"regParam", "fitIntercept"}:
        return False
    full = estimator.extractParamMap() | dict(values)
    return bool(full[estimator.fitIntercept] or not full[estimator.regParam])


def _shorter_fits(candidate: Candidate, maps: list[dict]) -> list[list[int]]:
    """Settings that are fitted together: boosting's that differ in the number of iterations only, and those of a
    Poisson regression that `batched` knows; else each its own."""
    estimator = candidate.estimator
    if _is_poisson(estimator) and not estimator.isSet("weightCol") and candidate.metric.name == "rmse":
        together = [setting for setting, values in enumerate(maps) if _has_batched_form(estimator, values)]
        return [together] * bool(together) + [[setting] for setting in range(len(maps)) if setting not in together]
    if not isinstance(estimator, GBTClassifier) or estimator.isSet("validationIndicatorCol"):
        return [[setting] for setting in range(len(maps))]
    groups: dict[tuple, list[int]] = {}
    for setting, values in enumerate(maps):
        rest = tuple(sorted((p.name, repr(v)) for p, v in values.items() if p.name != "maxIter"))
        groups.setdefault(rest, []).append(setting)
    return list(groups.values())


def staged_scores(model: GBTClassificationModel, df: DataFrame, stages: Sequence[int]) -> DataFrame:
    """(stage, label, prediction, score): what the model's first `stage` trees predict, for every stage.

    Boosting adds trees and changes none, so these are the predictions of models of fewer iterations. One
    pass: each tree runs once on a row, and the stages' margins are running sums.
    """
    label, features = model.getOrDefault("labelCol"), model.getOrDefault("featuresCol")
    rows, last = df.select(F.col(label).cast("double").alias("label"), features), max(stages)
    names = [f"_tree_{i}" for i in range(last)]
    for name, tree in zip(names, model.trees, strict=False):
        rows = tree.setFeaturesCol(features).setPredictionCol(name).transform(rows)
    margins, margin = [], F.lit(0.0)
    for at, (name, weight) in enumerate(zip(names, model.treeWeights, strict=False), 1):
        margin = margin + F.lit(float(weight)) * F.col(name)
        if at in stages:
            margins.append(F.struct(F.lit(at).alias("stage"), margin.alias("margin")))
    rows = rows.select("label", F.inline(F.array(*margins)))
    return rows.select(
        "stage", "label", (F.col("margin") > 0).cast("double").alias("prediction"), (1 / (1 + F.exp(-2 * F.col("margin")))).alias("score")
    )


def _errors_side_by_side(candidate: Candidate, maps: Sequence[Mapping], train: DataFrame, test: DataFrame) -> list[float | None]:
    """The metric on `test` of a Poisson regression under each parameter map, None where `batched` found no model."""
    estimator = candidate.estimator
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    offset = estimator.getOffsetCol() if estimator.isSet("offsetCol") and estimator.getOffsetCol() else None
    problems = []
    for values in maps:
        full = estimator.extractParamMap() | dict(values)
        strength, intercept = float(full[estimator.regParam]), full[estimator.fitIntercept]
        problems.append(batched.Problem("poisson", label, "l2", strength, offset=offset, intercept=intercept))
    columns = [label, *([offset] if offset else [])]
    rows, tested = (batched.wide_rows(part, features, columns, F.lit(0)) for part in (train, test))
    first = rows.select(F.size("x").alias("width")).first()
    if first is None or not 0 <= first.width <= batched.MAX_WIDTH:
        return [None] * len(problems)
    models = batched.fit_batch(rows, problems, max_scans=estimator.getMaxIter() + 1).models
    found = [number for number, model in enumerate(models) if model.converged]
    if not found:
        return [None] * len(problems)
    long = batched.score_batch(tested, [models[number] for number in found], held_out=False)
    values = candidate.metric.values(long.withColumnRenamed("score", "prediction"), ["number"])
    errors = {number: values.get((place,)) for place, number in enumerate(found)}
    return [errors.get(number) for number in range(len(problems))]


def cross_validate(
    df: DataFrame,
    candidates: Mapping[str, Candidate],
    folds: int,
    keys: Sequence[str],
    seed: int,
    prepare: Sequence[Estimator] = (),
    parallelism: int = 8,
    refit_on: DataFrame | None = None,
) -> dict[str, Tuned]:
    """Try every setting of every candidate on every fold, then refit the best ones.

    Folds are hashed from the key columns, so they can be repeated and no
    Python function is run on the rows. The feature stages in `prepare` are fitted
    once per fold, whatever the number of settings and candidates; the vectors of
    a fold are kept while all settings train on them, `parallelism` at a time. Boosting
    is fitted once for all its numbers of iterations; strengths of a Poisson regression, with and without
    intercept, share the scans of a fold. The best
    settings are refitted on `refit_on`, else on all of `df`. What reaches the
    driver is one number per fold and setting.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    maps = {name: expand_grid(c.estimator, c.grid) for name, c in candidates.items()}
    tasks = [(name, group) for name, c in candidates.items() for group in _shorter_fits(c, maps[name])]
    columns_read = _columns_read(c.estimator for c in candidates.values())
    fold_of = k_fold(folds, keys, seed)
    scored: list[tuple[str, int, int, float]] = []

    for fold in range(folds):
        train, held_out = df.filter(fold_of != fold), df.filter(fold_of == fold)
        features = Pipeline(stages=list(prepare)).fit(train)
        with (
            kept(features.transform(train).select(*columns_read)) as train_vectors,
            kept(features.transform(held_out).select(*columns_read)) as test_vectors,
        ):

            def measure(task, train=train_vectors, test=test_vectors, fold=fold):
                name, group = task
                candidate = candidates[name]

                def alone(setting):
                    return candidate.metric.value(candidate.estimator.fit(train, maps[name][setting]).transform(test))

                if len(group) == 1:
                    return [(name, group[0], fold, alone(group[0]))]
                if _is_poisson(candidate.estimator):
                    errors = _errors_side_by_side(candidate, [maps[name][setting] for setting in group], train, test)
                    pairs = zip(group, errors, strict=True)
                    return [(name, setting, fold, alone(setting) if error is None else error) for setting, error in pairs]
                iterations = {setting: maps[name][setting][candidate.estimator.maxIter] for setting in group}
                model = candidate.estimator.fit(train, maps[name][max(group, key=iterations.get)])
                long = staged_scores(model, test, sorted(set(iterations.values())))
                values = candidate.metric.values(long, ["stage"])
                return [(name, setting, fold, values.get((iterations[setting],))) for setting in group]

            for rows in side_by_side(spark, measure, tasks, parallelism):
                scored += rows
    return _concluded(df, candidates, maps, scored, prepare, parallelism, refit_on)


def is_batched(candidate: Candidate) -> bool:
    """Whether `cross_validate_linear` trains what the candidate's estimator does."""
    estimator = candidate.estimator
    if set(candidate.grid) != {"regParam"} or not estimator.getFitIntercept() or estimator.isSet("weightCol"):
        return False
    if isinstance(estimator, GeneralizedLinearRegression):
        return estimator.getFamily() == "poisson" and estimator.getLink() == "log"
    return isinstance(estimator, LogisticRegression) and estimator.getElasticNetParam() in (0.0, 1.0) and estimator.getStandardization()


def _problem(estimator: Estimator, strength: float, fold: int | None, scaled: bool) -> batched.Problem:
    if isinstance(estimator, GeneralizedLinearRegression):
        offset = estimator.getOffsetCol() if estimator.isSet("offsetCol") else None
        return batched.Problem("poisson", estimator.getLabelCol(), "l2", strength, fold, scaled, offset)
    penalty = "l1" if estimator.getElasticNetParam() else "l2"
    return batched.Problem("logistic", estimator.getLabelCol(), penalty, strength, fold)


def cross_validate_linear(
    df: DataFrame,
    candidates: Mapping[str, Candidate],
    folds: int,
    keys: Sequence[str],
    seed: int,
    prepare: Sequence[Estimator] = (),
    parallelism: int = 8,
    refit_on: DataFrame | None = None,
    features_col: str = "features",
    scaled: bool = False,
) -> dict[str, Tuned]:
    """`cross_validate` of Poisson and logistic regressions over their strengths, all fits side by side.

    The rows are read once for each step that all models of all folds and settings take together, then
    once for all scores; the metrics of all of them come from one table per kind of metric.

    The stages in `prepare` are fitted once, on all of `df`. A level that a fold's training rows lack has
    no variance there and gets no coefficient, which is how the stages fitted by fold treat it, so
    outcomes are those of `cross_validate` unless stages leave out a level (`handle_invalid` 'error').
    Give the plain vectors as `features_col`, also where the candidates train on scaled ones: `scaled`
    then scales by the deviation on each fold's training rows. Numpy runs in the tasks.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not all(is_batched(c) for c in candidates.values()):
        raise ValueError("only Poisson and logistic regressions over regParam")
    maps = {name: expand_grid(c.estimator, c.grid) for name, c in candidates.items()}
    tasks = [(name, setting, fold) for name in candidates for setting in range(len(maps[name])) for fold in range(folds)]
    problems = []
    for name, setting, fold in tasks:
        estimator = candidates[name].estimator
        problems.append(_problem(estimator, float(maps[name][setting][estimator.regParam]), fold, scaled))
    columns = [c for p in problems for c in (p.label, p.offset) if c]
    vectors = Pipeline(stages=list(prepare)).fit(df).transform(df)
    scored = []
    with kept(batched.wide_rows(vectors, features_col, columns, k_fold(folds, keys, seed))) as rows:
        models = batched.fit_batch(rows, problems).models
        for metric in {c.metric.name: c.metric for c in candidates.values()}.values():
            chosen = [i for i, (name, _, _) in enumerate(tasks) if candidates[name].metric.name == metric.name]
            long = batched.score_batch(rows, [models[i] for i in chosen])
            if metric.name != "area_under_roc":
                long = long.withColumnRenamed("score", "prediction")
            values = metric.values(long, ["number"])
            scored += [(*tasks[i], values.get((at,))) for at, i in enumerate(chosen)]
    return _concluded(df, candidates, maps, scored, prepare, parallelism, refit_on)


def _concluded(
    df: DataFrame,
    candidates: Mapping[str, Candidate],
    maps: Mapping[str, list[dict]],
    scored: Sequence[tuple[str, int, int, float]],
    prepare: Sequence[Estimator],
    parallelism: int,
    refit_on: DataFrame | None,
) -> dict[str, Tuned]:
    """Choose the best settings by (candidate, setting, fold, value) and refit them."""
    spark = df.sparkSession
    columns_read = _columns_read(c.estimator for c in candidates.values())
    if any(value is None for *_, value in scored):
        raise ValueError("a metric is undefined on a fold; use fewer folds")

    best = {}
    for name, candidate in candidates.items():
        totals = [0.0] * len(maps[name])
        for scored_name, setting, _, value in scored:
            if scored_name == name:
                totals[setting] += value
        pick = max if candidate.metric.larger_is_better else min
        best[name] = pick(range(len(totals)), key=totals.__getitem__)

    whole = df if refit_on is None else refit_on
    features = Pipeline(stages=list(prepare)).fit(whole)
    with kept(features.transform(whole).select(*columns_read)) as vectors:

        def refit(name):
            return candidates[name].estimator.fit(vectors, maps[name][best[name]])

        refitted = side_by_side(spark, refit, list(candidates), parallelism)
        fitted = dict(zip(candidates, refitted, strict=True))

    outcome = {}
    for name, candidate in candidates.items():
        params = list(candidate.grid)
        values = [[_plain(m[candidate.estimator.getParam(p)]) for p in params] for m in maps[name]]
        rows = [
            (setting, *values[setting], fold, candidate.metric.name, float(value))
            for scored_name, setting, fold, value in scored
            if scored_name == name
        ]
        outcome[name] = Tuned(
            folds=spark.createDataFrame(rows, ["setting", *params, "fold", "metric", "value"]),
            best_setting=best[name],
            best_params=dict(zip(params, values[best[name]], strict=True)),
            model=PipelineModel(stages=[features, fitted[name]]),
            metric=candidate.metric,
        )
    return outcome
