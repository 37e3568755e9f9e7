"""Evaluation metrics as one-row DataFrames, or as one row per group where groups are named.

All are plain aggregates: partial sums per task, then one row. The area under
the curve is exact and does not depend on row order or on a number of bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.ranking import counted_ranges, sum_below
from tidemark.sources.cache import kept


def regression_metrics(
    df: DataFrame, label_col: str = "label", prediction_col: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """rmse, mse and mae in one pass."""
    error = F.col(label_col) - F.col(prediction_col)
    found = df.groupBy(*by).agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"))
    return found.select(*by, F.sqrt("mse").alias("rmse"), "mse", "mae")


def accuracy(
    df: DataFrame, label_col: str = "label", prediction_col: str = "prediction"
) -> DataFrame:
    """Share of rows whose label is predicted; rows with a null on either side do not count."""
    return df.select(f"`{label_col}`", f"`{prediction_col}`").selectExpr(
        f"count_if(`{label_col}` = `{prediction_col}`) / count(`{label_col}` = `{prediction_col}`) AS accuracy"
    )


def area_under_roc(
    df: DataFrame,
    label_col: str = "label",
    score_col: str = "score",
    weight: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties count half.

    Null when a class is missing. A positive wins against the negatives with a
    lower score: those of the lower ranges and those before it in its own. No pair is formed,
    and what is added up over all ranges is one row per range. `weight` is how many rows a row
    stands for. With `by` there is one row per group, all found in one job; a group of most rows is
    split into ranges like a whole table.
    """
    times = F.lit(1) if weight is None else weight
    of = lambda label: F.coalesce(F.sum(F.when(F.col(label_col) == label, times)), F.lit(0))
    scored = counted_ranges(df, score_col, {"pos": of(1), "neg": of(0)}, by=by)
    # Twice the wins, so that half a win for a tie stays whole.
    wide = "decimal(38,0)"
    in_range = sum_below("neg", W.partitionBy(*by, "_range").orderBy(score_col))
    per_range = (
        scored.select(
            *by,
            "_range",
            "pos",
            "neg",
            (F.col("pos").cast(wide) * (2 * in_range + F.col("neg"))).alias("wins"),
        )
        .groupBy(*by, "_range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("wins").alias("wins"))
    )
    # As many rows for each group as there are ranges.
    lower = sum_below("neg", W.partitionBy(*by).orderBy("_range"))
    wins = F.sum(F.col("wins") + F.col("pos").cast(wide) * 2 * F.col("lower"))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return per_range.select(*by, "pos", "neg", "wins", lower.alias("lower")).groupBy(*by).agg(
        F.try_divide(wins.cast("double"), 2 * pairs).alias("area_under_roc")
    )


def confusion(
    df: DataFrame, label_col: str = "label", prediction_col: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(
        *by,
        F.col(label_col).cast("double").alias("label"),
        F.col(prediction_col).cast("double").alias("prediction"),
    ).agg(F.count("*").alias("n"))


def f1_weighted(
    df: DataFrame, label_col: str = "label", prediction_col: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """F1 per class, weighted by the class's share of the labels."""
    return _f1_of_counts(confusion(df, label_col, prediction_col, by), by)


def _f1_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Of (label, prediction, n)."""
    seen_as = F.explode(
        F.array(
            F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                     F.lit(0).cast("bigint").alias("predicted")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"),
                     F.col("n").alias("predicted")),
        )
    )
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    per_class = (
        counts.select(*by, seen_as.alias("side"), hits.alias("hits"))
        .groupBy(*by, "side.class")
        .agg(
            F.sum("side.support").alias("support"),
            F.sum("side.predicted").alias("predicted"),
            # Every hit is seen from both sides.
            (F.sum("hits") / 2).alias("hits"),
        )
    )
    f1 = F.coalesce(
        F.try_divide(2 * F.col("hits"), F.col("support") + F.col("predicted")), F.lit(0.0)
    )
    return per_class.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("support") * f1), F.sum("support")).alias("f1_weighted")
    )


def classification_metrics(
    df: DataFrame,
    label_col: str = "label",
    prediction_col: str = "prediction",
    score_col: str = "score",
) -> DataFrame:
    """One row: accuracy, f1_weighted and area_under_roc.

    The rows are read, and scored if they come from a model, once: all three are taken from
    one table of (label, prediction, score) with counts, which is kept until they are known.
    """
    counts = df.groupBy(
        F.col(label_col).cast("double").alias("label"),
        F.col(prediction_col).cast("double").alias("prediction"),
        F.col(score_col).alias("score"),
    ).agg(F.count("*").alias("n"))
    with kept(counts):
        confused = counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
        right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
        compared = F.sum(F.when(F.col("label").isNotNull() & F.col("prediction").isNotNull(), F.col("n")))
        parts = [
            confused.agg(F.try_divide(right, compared)),
            _f1_of_counts(confused),
            area_under_roc(counts, "label", "score", F.col("n")),
        ]
        row = tuple(part.first()[0] for part in parts)
    schema = "accuracy double, f1_weighted double, area_under_roc double"
    return df.sparkSession.createDataFrame([row], schema)


def long_form(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Turn one column per metric into rows (metric, value)."""
    return df.unpivot(ids, metrics, "metric", "value")
