"""Samples and splits that any re-run repeats row for row.

The seeded `sample`, `sampleBy` and `randomSplit` of Spark pick other rows when
the partitioning changes. These hash the row's key instead: no shuffle, no
state, and the complement of a split is its negated predicate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_fraction
from tidemark.operators.ranking import value_ranks

# Shares of the earliest ratings used for training.
TEMPORAL_THRESHOLDS = (0.4, 0.6, 0.8)

# Share kept for training per claim label.
CLAIM_FRACTIONS = {0: 0.7, 1: 0.3}


def _check_fraction(fraction: float) -> None:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"{fraction} is not between 0 and 1")


def sample(df: DataFrame, fraction: float, keys: Sequence[str], seed: int) -> DataFrame:
    """Keep about this fraction of the rows."""
    _check_fraction(fraction)
    return df.filter(hash_fraction(keys, seed) < fraction)


def stratified(
    label_col: str, fractions: Mapping[object, float], keys: Sequence[str], seed: int
) -> Column:
    """Is the row kept, given its label's fraction? Labels without one are not kept."""
    for fraction in fractions.values():
        _check_fraction(fraction)
    share = F.lit(0.0)
    for label, fraction in fractions.items():
        share = F.when(F.col(label_col) == label, fraction).otherwise(share)
    return hash_fraction(keys, seed) < share


def split_by(df: DataFrame, kept: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, rest). Rows whose predicate is null go to the rest; copies stay copies."""
    flag = F.coalesce(kept, F.lit(False))
    return df.filter(flag), df.filter(~flag)


def stratified_split(
    df: DataFrame,
    label_col: str,
    fractions: Mapping[object, float],
    keys: Sequence[str],
    seed: int,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with a training share per label."""
    return split_by(df, stratified(label_col, fractions, keys, seed))


def random_part(weights: Sequence[float], keys: Sequence[str], seed: int) -> Column:
    """Number of the part, from 0, that the row falls in; parts are sized by weight."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    total = float(sum(weights))
    bounds = [edge / total for edge in accumulate(weights)][:-1]
    fraction = hash_fraction(keys, seed)
    part = F.lit(len(weights) - 1)
    for number, bound in reversed(list(enumerate(bounds))):
        part = F.when(fraction < bound, number).otherwise(part)
    return part


def random_split(
    df: DataFrame, weights: Sequence[float], keys: Sequence[str], seed: int
) -> list[DataFrame]:
    part = random_part(weights, keys, seed)
    return [df.filter(part == number) for number in range(len(weights))]


def k_fold(k: int, keys: Sequence[str], seed: int) -> Column:
    """Fold number 0..k-1."""
    if k < 2:
        raise ValueError("at least two folds are needed")
    return F.floor(hash_fraction(keys, seed) * k).cast("int")


def temporal_cutoffs(
    df: DataFrame, time_col: str, thresholds: Sequence[float] = TEMPORAL_THRESHOLDS
) -> DataFrame:
    """One row, one column `cutoff_i` per threshold: the first time whose percent rank reaches it.

    Null when no time does, for instance when all times are equal.
    """
    return value_ranks(df, time_col).select(
        *[
            F.min(F.when(F.col("percent_rank") >= threshold, F.col(time_col))).alias(
                f"cutoff_{i}"
            )
            for i, threshold in enumerate(thresholds)
        ]
    )


def _before(time: Column, cutoff: Column) -> Column:
    # A missing time ranks lowest; a missing cutoff means that no rank reaches the threshold.
    return time.isNull() | cutoff.isNull() | (time < cutoff)


def with_temporal_splits(
    df: DataFrame, time_col: str, thresholds: Sequence[float] = TEMPORAL_THRESHOLDS
) -> DataFrame:
    """Add `split_i` = 'train' or 'test' per threshold. Ties in time stay on one side.

    Comparing percent ranks with a threshold is comparing times with a cutoff,
    so the ranks are never joined to the rows: one narrow pass splits them.
    """
    if any(not 0.0 < t <= 1.0 for t in thresholds):
        raise ValueError("thresholds must be above 0 and at most 1")
    names = [f"cutoff_{i}" for i in range(len(thresholds))]
    cutoffs = temporal_cutoffs(df, time_col, thresholds).select(F.struct(*names)).scalar()
    time = F.col(time_col)
    return (
        df.withColumn("_cutoffs", cutoffs)
        .withColumns(
            {
                f"split_{i}": F.when(
                    _before(time, F.col(f"_cutoffs.{name}")), "train"
                ).otherwise("test")
                for i, name in enumerate(names)
            }
        )
        .drop("_cutoffs")
    )


def temporal_split_at(
    df: DataFrame, time_col: str, cutoff: object
) -> tuple[DataFrame, DataFrame]:
    """(train, test) at a known cutoff: plain predicates that reach the file scan."""
    if cutoff is None:
        return df, df.filter(F.lit(False))
    time = F.col(time_col)
    return df.filter(time.isNull() | (time < F.lit(cutoff))), df.filter(time >= F.lit(cutoff))


def before_cutoff(time: Column, cutoff: object) -> Column:
    """Whether `temporal_split_at` puts a row into the training part; never null."""
    return F.lit(True) if cutoff is None else time.isNull() | (time < F.lit(cutoff))
