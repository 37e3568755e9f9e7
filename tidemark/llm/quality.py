"""Quality classifier: regularised quadratic discriminant analysis over text statistics.

Statistics become features by square roots and logarithms. Per class, sums and products of them
are added up over all labelled rows in Spark; a class's covariance is shrunk towards the pooled
one and towards its own mean variance. A text's score is the logistic function of the difference
of the two log densities, from Mahalanobis distances with the cached Cholesky factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bloom
from tidemark.llm.learning import labelled_ids
from tidemark.llm.quality_rules import matrix
from tidemark.llm.statistics import COUNTS, count_table

#: Shares of the pooled covariance and of the mean variance in a class's covariance.
POOLED, ROUND = 0.1, 0.02
#: Keeps a covariance positive definite where a feature never varies.
FLOOR = 1e-4


def transformed(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Features with a constant 1 in front; square roots spread shares near 0."""
    values, names = matrix(batch)
    shares = [i for i, name in enumerate(names) if name not in ("log_words", "word_length", "line_words")]
    values[:, shares] = np.sqrt(values[:, shares])
    return np.hstack([np.ones((len(values), 1)), values])


@dataclass
class Discriminant:
    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        density = []
        for mean, inverse, offset in zip(self.means, self.factors, self.offsets, strict=True):
            steps = (features - mean) @ inverse.T
            density.append(offset - (steps * steps).sum(1) / 2)
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def moments(statistics: DataFrame) -> DataFrame:
    """label, i, j, total: sums of products of the features (0 is the constant) over all rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, labels = transformed(batch), batch.column("label").to_numpy(zero_copy_only=False)
            for label in np.unique(labels):
                rows = features[labels == label]
                i, j = np.triu_indices(rows.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), label, np.int32)), pa.array(i), pa.array(j), pa.array((rows.T @ rows)[i, j])],
                    ["label", "i", "j", "total"],
                )

    return statistics.mapInArrow(partial, "label int, i long, j long, total double").groupBy("label", "i", "j").agg(F.sum("total").alias("total"))


def fit_discriminant(statistics: DataFrame) -> Discriminant | None:
    """From a table with label and COUNTS; None unless both labels occur."""
    found = moments(statistics).toArrow().to_pandas()
    width = int(found["i"].max()) + 1 if len(found) else 0
    sums = np.zeros((2, width, width))
    sums[found["label"], found["i"], found["j"]] = found["total"]
    sums[found["label"], found["j"], found["i"]] = found["total"]
    counts = sums[:, 0, 0] if width else np.zeros(2)
    if not counts.all():
        return None
    means = sums[:, 0, 1:] / counts[:, None]
    spread = sums[:, 1:, 1:] / counts[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (spread * counts[:, None, None]).sum(0) / counts.sum()
    factors, offsets = [], []
    for own, count in zip(spread, counts, strict=True):
        covariance = (1 - POOLED) * own + POOLED * pooled
        size = len(covariance)
        covariance = (1 - ROUND) * covariance + (ROUND * np.trace(covariance) / size + FLOOR) * np.eye(size)
        factor = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(factor))
        offsets.append(np.log(count / counts.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(factors), np.array(offsets))


def quality_scores(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row of docs (doc_id, text).

    `training` has doc_id and quality (0 or 1); all its rows are learned from. Null and blank texts are
    scored by their statistics, which are 0. Repeated rows each get their score, and an id that is
    repeated teaches with all its texts. Unless both labels occur, the score is 0.5. An empty table of
    documents gives no rows.
    """
    statistics, labels = count_table(docs), labelled_ids(training, "quality")
    # Statistics of labelled texts, and of the few that a filter of the labelled ids takes for such.
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    _, maybe = bloom.split(narrow, F.xxhash64("doc_id"), labels.select(F.xxhash64("doc_id").alias("h")), "h")
    model = fit_discriminant(count_table(maybe).join(labels, "doc_id").select("label", *COUNTS))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(transformed(batch)[:, 1:]) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return statistics.mapInArrow(rows, "doc_id long, score double")
