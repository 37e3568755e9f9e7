"""Quality rules: base rules on counts, then boosted trees over the texts' statistics.

The trees are fitted on a bounded sample of labelled texts and flattened into node arrays; every
text is then scored in numpy. Repetition, symbols and copied lines can only lower the score, and
the share of distinct words can only raise it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Trees, fit_trees
from tidemark.llm.learning import SAMPLE_ROWS, labelled_ids, one_text, sample
from tidemark.llm.statistics import COUNTS, count_table, ratios

MONOTONE = {"symbols": -1, "bangs": -1, "dup_lines": -1, "repeats": -1, "top_word": -1, "caps_words": -1, "odd_words": -1, "distinct": 1}
#: Texts that score lower are not kept.
THRESHOLD = 0.3


def matrix(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, list[str]]:
    found = ratios({name: batch.column(name).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(name).to_numpy() for name in COUNTS})
    return np.stack(list(found.values()), axis=1), list(found)


def fit_rules(statistics: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Trees:
    """Trees for label 1 from at most `most` labelled rows of a table with the COUNTS columns."""
    chosen = sample(labelled_ids(labels, "quality"), most)  # at most `most` rows of two numbers
    rows = statistics.join(F.broadcast(chosen), "doc_id").limit(most).toArrow().sort_by("doc_id")
    features, names = matrix(rows)
    monotone = {names.index(name): sign for name, sign in MONOTONE.items()}
    return fit_trees(features, rows.column("label").to_numpy().astype(float), monotone)


def judge(statistics: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """Adds base_failed, score and kept."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(trees.scores(matrix(batch)[0]))], [*batch.schema.names, "score"]
            )

    schema = ", ".join(["doc_id long", *(f"{name} long" for name in COUNTS), "score double"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        statistics.select("doc_id", *COUNTS)
        .mapInArrow(rows, schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    )


def quality_rules(docs: DataFrame, training: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the COUNTS columns, base_failed, score and kept of every row of docs (doc_id, text).

    `training` has doc_id and quality (0 or 1). Null and blank texts have no words and fail the base
    rules. Repeated rows each get their result, and an id that is repeated is sampled with the
    text of the smallest hash. An empty table of documents gives no rows. Without labels the score is 0.5 everywhere and only the base rules decide.
    """
    chosen = sample(labelled_ids(training, "quality"), most)  # at most `most` rows of two numbers
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    return judge(count_table(docs), fit_rules(count_table(one_text(labelled)), training, most))
