"""Poisson and logistic regressions of many strengths and folds, trained side by side.

All models read the same vectors; a fold is a mask. One scan yields loss, gradient and curvature of every
model at its own coefficients, summed inside each task with one matrix product per model, then over groups
of tasks. The driver takes a Newton step for each model: a linear solve under an L2 penalty, coordinate
descent on the quadratic model under an L1 penalty. So the scans are as many as the slowest model's steps,
whatever the number of models.

The penalties are those of the ML library. Logistic models penalise coefficients of features scaled to unit
deviation on their own training rows. Poisson models, which the library trains by reweighted least
squares, penalise the plain coefficients against the sum of counts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.cache import kept

# Executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Longest vector: curvature is a matrix of its width for every model.
MAX_WIDTH = 512
#: Groups of tasks whose sums meet in one task before the driver.
GROUPS = 64
#: Numbers of the vectors that are packed together: half a megabyte.
PACKED_NUMBERS = 1 << 16


@dataclass(frozen=True)
class Problem:
    """One model: its family ('poisson' or 'logistic'), label column, penalty ('l1' or 'l2') and strength.

    Rows of `fold` are held out; None trains on all rows. `scaled` penalises a Poisson model's coefficients
    as of features scaled to unit deviation; logistic models do so always. `offset` names a column that
    is added to the linear predictor. Without `intercept` that is 0; such models take no strength here, as the
    library measures their penalty against the sum of predictions instead.
    """

    family: str
    label: str
    penalty: str
    strength: float
    fold: int | None = None
    scaled: bool = False
    offset: str | None = None
    intercept: bool = True


@dataclass(frozen=True)
class Fitted:
    problem: Problem
    coefficients: np.ndarray
    intercept: float
    converged: bool


@dataclass(frozen=True)
class Batch:
    """What training yields: a model for each problem, in order, and how often the vectors were read."""

    models: list[Fitted]
    scans: int


def wide_rows(vectors: DataFrame, features_col: str, columns: Sequence[str], fold) -> DataFrame:
    """fold, the named columns as numbers, and x: the vector as an array."""
    numbers = [F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)]
    return vectors.select(fold.cast("int").alias("fold"), *numbers, vector_to_array(F.col(features_col)).alias("x"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The batch's vectors with a last column of ones."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
    return np.hstack([x, np.ones((batch.num_rows, 1))])


def _number(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def packed(rows: DataFrame) -> DataFrame:
    """`wide_rows` as arrays of numbers, at most `PACKED_NUMBERS` of a vector's in a row (fold, x, *numbers).

    Scans read them without taking each row apart again.
    """
    names = [c for c in rows.columns if c != "x"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            wide = len(whole.column("x").flatten()) // max(whole.num_rows, 1)
            step = max(1, PACKED_NUMBERS // max(wide, 1))
            for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                numbers = [_number(batch, c).astype(np.int32 if c == "fold" else np.float64) for c in names]
                arrays = [batch.column("x").flatten().to_numpy(zero_copy_only=False), *numbers]
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], ["x", *names])

    return rows.mapInArrow(pack, ", ".join(f"`{c}` binary" for c in ("x", *names)))


def _unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches of the rows that were packed."""
    for batch in batches:
        for at in range(batch.num_rows):
            found = {c: np.frombuffer(batch.column(c)[at].as_buffer(), np.int32 if c == "fold" else np.float64) for c in batch.schema.names}
            ends = pa.array(np.arange(len(found["fold"]) + 1, dtype=np.int32) * width)
            columns = [pa.ListArray.from_arrays(ends, pa.array(v)) if c == "x" else pa.array(v) for c, v in found.items()]
            yield pa.RecordBatch.from_arrays(columns, list(found))


def _predictor(batch: pa.RecordBatch, x: np.ndarray, problem: Problem, beta: np.ndarray) -> np.ndarray:
    linear = x @ beta
    return linear if problem.offset is None else linear + _number(batch, problem.offset)


def _mean(problem: Problem, linear: np.ndarray) -> np.ndarray:
    if problem.family == "poisson":
        return np.exp(np.minimum(linear, 700))
    return 0.5 * (1 + np.tanh(linear / 2))


def _loss(problem: Problem, linear: np.ndarray, mean: np.ndarray, y: np.ndarray) -> np.ndarray:
    if problem.family == "poisson":
        return mean - y * linear
    return np.logaddexp(0, linear) - y * linear


def _partial(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    """A task's sums as rows (part, group, values)."""
    group = TaskContext.get().partitionId() % GROUPS
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(total), pa.int32()),
            pa.array([group] * len(total), pa.int32()),
            pa.array(list(total.values()), pa.list_(pa.float64())),
        ],
        ["part", "group", "values"],
    )


def _added(rows: DataFrame, sums) -> dict[int, np.ndarray]:
    """The sums by part: those of the tasks of a group in a task, those of the groups on the driver."""

    def add(table: pa.Table) -> pa.Table:
        values = table.column("values").combine_chunks()
        total = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).sum(0)
        return pa.table({"part": table.column("part")[:1], "values": pa.array([total], pa.list_(pa.float64()))})

    partial = rows.mapInArrow(sums, "part int, group int, values array<double>")
    table = partial.groupBy("part", "group").applyInArrow(add, "part int, values array<double>").toArrow()
    found: dict[int, np.ndarray] = {}
    for part, values in zip(table.column("part").to_pylist(), table.column("values"), strict=True):
        found[part] = found.get(part, 0) + values.values.to_numpy(zero_copy_only=False)
    return found


def _moments(rows: DataFrame, width: int, labels: Sequence[str]) -> dict[int, np.ndarray]:
    """By fold of `packed` rows: how many, sums of the vectors and of their squares, sums of the labels."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in _unpacked(batches, width):
            x, fold = _matrix(batch, width)[:, :-1], _number(batch, "fold")
            y = np.stack([_number(batch, c) for c in labels], 1)
            for f in np.unique(fold).tolist():
                at = fold == f
                values = np.concatenate([[at.sum()], x[at].sum(0), (x[at] ** 2).sum(0), y[at].sum(0)])
                total[f] = total.get(f, 0) + values
        yield _partial(total)

    return _added(rows, sums)


def _derivatives(rows: DataFrame, width: int, problems: Sequence[Problem], betas: dict[int, np.ndarray]) -> dict[int, tuple]:
    """(loss, gradient, curvature) of the problems in `betas`, by number, at those coefficients: one scan of `packed` rows."""
    size = width + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {number: np.zeros(1 + size + size * size) for number in betas}
        for batch in _unpacked(batches, width):
            x, fold = _matrix(batch, width), _number(batch, "fold")
            for number, beta in betas.items():
                problem = problems[number]
                trained = slice(None) if problem.fold is None else fold != problem.fold
                own, y, linear = x[trained], _number(batch, problem.label)[trained], _predictor(batch, x, problem, beta)[trained]
                mean = _mean(problem, linear)
                weight = mean if problem.family == "poisson" else mean * (1 - mean)
                values = total[number]
                values[0] += _loss(problem, linear, mean, y).sum()
                values[1 : 1 + size] += own.T @ (mean - y)
                values[1 + size :] += ((own * weight[:, None]).T @ own).ravel()
        yield _partial(total)

    found = _added(rows, sums)
    return {n: (v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for n, v in found.items()}


def _l2_step(gradient: np.ndarray, curvature: np.ndarray, beta: np.ndarray, penalty: np.ndarray, free: np.ndarray) -> np.ndarray:
    step = np.zeros_like(beta)
    matrix = curvature + np.diag(penalty)
    right = -(gradient + penalty * beta)[free]
    step[free] = np.linalg.lstsq(matrix[np.ix_(free, free)], right, rcond=1e-12)[0]
    return step


def _l1_step(
    gradient: np.ndarray, curvature: np.ndarray, beta: np.ndarray, penalty: np.ndarray, free: np.ndarray, sweeps: int = 1000
) -> np.ndarray:
    """Coordinate descent on the quadratic model with penalty |beta|."""
    at, slope = beta.copy(), gradient.copy()
    columns = np.flatnonzero(free & (np.diag(curvature) > 1e-300))
    for _ in range(sweeps):
        largest = 0.0
        for j in columns:
            bend = curvature[j, j]
            target = at[j] - slope[j] / bend
            new = np.sign(target) * max(0.0, abs(target) - penalty[j] / bend)
            if new != at[j]:
                move, at[j] = new - at[j], new
                slope += move * curvature[:, j]
                largest = max(largest, abs(move) * bend**0.5)
        if largest < 1e-12:
            break
    return at - beta


class _Descent:
    """One problem's way to its minimum: full steps, halved where the objective does not fall."""

    def __init__(self, problem: Problem, moments: dict[int, np.ndarray], width: int, labels: Sequence[str]) -> None:
        used = [m for fold, m in moments.items() if problem.fold is None or fold != problem.fold]
        total = np.sum(used, axis=0) if used else np.zeros(1 + 2 * width + len(labels))
        self.problem, n = problem, max(total[0], 1.0)
        mean = total[1 : 1 + width] / n
        variance = np.maximum(total[1 + width : 1 + 2 * width] / n - mean**2, 0) * n / max(n - 1, 1)
        variance[variance < 1e-14 * np.maximum(1, mean**2)] = 0
        label_sum = total[1 + 2 * width + list(labels).index(problem.label)]
        poisson = problem.family == "poisson"
        self.scale = max(label_sum, 1e-300) if poisson else n
        deviation = np.sqrt(variance) if problem.scaled or not poisson else np.ones(width)
        weight = problem.strength * (deviation if problem.penalty == "l1" else deviation**2)
        self.penalty = np.append(weight, 0.0)
        self.free = np.append(variance > 0, problem.intercept)
        share = min(max(label_sum / n, 1e-12), 1e300 if poisson else 1 - 1e-12)
        self.beta = np.zeros(width + 1)
        self.beta[-1] = np.log(share) if poisson else np.log(share / (1 - share))
        if problem.offset or not problem.intercept:
            self.beta[-1] = 0.0
        self.step, self.length, self.best, self.done = np.zeros(width + 1), 1.0, np.inf, total[0] == 0
        self.converged = bool(self.done)

    def trial(self) -> np.ndarray:
        return self.beta + self.length * self.step

    def _objective(self, loss: float, beta: np.ndarray) -> float:
        size = np.abs(beta) if self.problem.penalty == "l1" else 0.5 * beta**2
        return loss / self.scale + float(self.penalty @ size)

    def take(self, loss: float, gradient: np.ndarray, curvature: np.ndarray, tolerance: float) -> None:
        """Accept the trial point and choose the next step from it, or halve the step."""
        beta = self.trial()
        value = self._objective(loss, beta)
        if not value <= self.best + 1e-13 * max(1.0, abs(self.best)) and self.length > 1e-10:
            self.length /= 2
            return
        self.beta, self.best, self.length = beta, value, 1.0
        solve = _l1_step if self.problem.penalty == "l1" and self.problem.strength else _l2_step
        self.step = solve(gradient / self.scale, curvature / self.scale, beta, self.penalty, self.free)
        # Measured as change of the linear predictor, so that it does not depend on the features' units.
        change = float(self.step @ (curvature / self.scale) @ self.step) ** 0.5
        if change <= tolerance * max(1.0, abs(value)):
            self.beta, self.done, self.converged = self.trial(), True, True


def fit_batch(rows: DataFrame, problems: Sequence[Problem], tolerance: float = 1e-7, max_scans: int = 100) -> Batch:
    """Train all problems on rows (fold, labels, offsets, x), as `wide_rows` makes them.

    The rows are read once and kept packed, which are read once for each common step. Vectors of more than `MAX_WIDTH` numbers are
    refused; use the ML library's trainers for those. Without rows all coefficients are 0.
    """
    if any(p.strength and not p.intercept for p in problems):
        raise ValueError("a model without intercept takes no strength")
    first = rows.select(F.size("x").alias("width")).first()
    width = first.width if first else 0
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of {width} numbers; at most {MAX_WIDTH}")
    labels = sorted({p.label for p in problems})
    with kept(packed(rows)) as numbers:
        moments = _moments(numbers, width, labels)
        descents = [_Descent(p, moments, width, labels) for p in problems]
        scans = 1
        while scans < max_scans and any(not d.done for d in descents):
            betas = {number: d.trial() for number, d in enumerate(descents) if not d.done}
            for number, found in _derivatives(numbers, width, problems, betas).items():
                descents[number].take(*found, tolerance)
            scans += 1
    models = [Fitted(d.problem, d.beta[:-1], float(d.beta[-1]), d.converged) for d in descents]
    return Batch(models, scans)


def score_batch(rows: DataFrame, models: Sequence[Fitted], held_out: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """(number, fold, label, score, *keep): every model's mean for the rows of its fold, or for all rows.

    One scan and one long table for all models; `number` is the model's place in `models`. `keep` names
    number columns of `rows` to pass on.
    """
    betas = [np.append(m.coefficients, m.intercept) for m in models]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fold = _matrix(batch, len(betas[0]) - 1), _number(batch, "fold")
            for number, (model, beta) in enumerate(zip(models, betas, strict=True)):
                at = fold == model.problem.fold if held_out else np.ones(len(fold), bool)
                if not at.any():
                    continue
                mean = _mean(model.problem, _predictor(batch, x, model.problem, beta))[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(at.sum(), number), pa.int32()),
                        pa.array(fold[at], pa.int32()),
                        pa.array(_number(batch, model.problem.label)[at]),
                        pa.array(mean),
                        *(pa.array(_number(batch, c)[at]) for c in keep),
                    ],
                    ["number", "fold", "label", "score", *keep],
                )

    kept = "".join(f", `{c}` double" for c in keep)
    return rows.mapInArrow(score, "number int, fold int, label double, score double" + kept)
