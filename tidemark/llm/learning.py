"""Bounded labelled samples of tables of statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that a model is fitted on, at any size of the input.
SAMPLE_ROWS = 20_000


def labelled_ids(labels: DataFrame, target: str) -> DataFrame:
    """doc_id, label (0 or 1): one row per id with a label; of several the largest; null ids go."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
    return labels.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))


def sample(rows: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """At most `most` rows, chosen by the hash of their ids; all rows if there are no more.

    A share is kept whose expected size is a twentieth below `most`, so nothing is sorted and no task sends
    more than its own share; the limit behind it only makes the bound certain.
    """
    total = rows.count()
    if total > most:
        steps = 1 << 40
        share = int(0.95 * most / total * steps)
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < share)
    return rows.limit(most)


def one_text(rows: DataFrame) -> DataFrame:
    """Of the rows (doc_id, text, ...) of a bounded sample's ids one for each id: that of the smallest hash of its text."""
    others = [c for c in rows.columns if c != "doc_id"]
    first = F.min(F.struct(F.xxhash64("text").alias("_hash"), *others)).alias("first")
    return rows.groupBy("doc_id").agg(first).select("doc_id", *[f"first.{c}" for c in others])
