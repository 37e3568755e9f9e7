"""Operators on column names, types and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns, but {len(names)} names")
    return df.toDF(*names)


def string_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    among = df.columns if among is None else among
    return [c for c in among if isinstance(df.schema[c].dataType, StringType)]


def numeric_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    among = df.columns if among is None else among
    return [c for c in among if isinstance(df.schema[c].dataType, NumericType)]


def cast_strings_to_double(df: DataFrame) -> DataFrame:
    """Every string column as double; text that is no number becomes null."""
    textual = set(string_columns(df))
    return df.select(
        *[
            F.col(f"`{c}`").try_cast("double").alias(c) if c in textual else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def positive_label(df: DataFrame, count_col: str, label_col: str) -> DataFrame:
    """Add a 0/1 label: is the count above zero?"""
    return df.withColumn(label_col, F.when(F.col(count_col) > 0, 1).otherwise(0))


def class_balance(df: DataFrame, label_col: str) -> DataFrame:
    """One row: class counts, minority share, negative/positive ratio, balancing weights.

    A class weight is n / (2 * n_class), so both classes carry the same total.
    """
    counted = df.agg(
        F.count_if(F.col(label_col) == 1).alias("positives"),
        F.count_if(F.col(label_col) == 0).alias("negatives"),
        F.count("*").alias("total"),
    )
    positives, negatives, total = F.col("positives"), F.col("negatives"), F.col("total")
    return counted.select(
        "positives",
        "negatives",
        "total",
        F.try_divide(F.least(positives, negatives), total).alias("minority_fraction"),
        F.try_divide(negatives, positives).alias("neg_pos_ratio"),
        F.try_divide(total, 2 * negatives).alias("weight_0"),
        F.try_divide(total, 2 * positives).alias("weight_1"),
    )


def with_class_weights(df: DataFrame, label_col: str, weight_col: str = "weight") -> DataFrame:
    """Add the balancing weight of each row's class, for a model's `weightCol`."""
    balance = class_balance(df, label_col).select("weight_0", "weight_1")
    # One row by construction: an aggregate without grouping keys.
    weights = balance.select(F.struct("weight_0", "weight_1")).scalar()
    return (
        df.withColumn("_weights", weights)
        .withColumn(
            weight_col,
            F.when(F.col(label_col) == 1, F.col("_weights.weight_1"))
            .when(F.col(label_col) == 0, F.col("_weights.weight_0")),
        )
        .drop("_weights")
    )
