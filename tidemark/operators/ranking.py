"""Ranks over a whole table, and the best rows per group.

A window without partition keys moves every row to one task. Here the ranked
column is cut into ranges of about equally many distinct values. Sums below a
value are then the total of the lower ranges plus a running sum inside its own.
Any cut points give the same, exact answer; they only balance the work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Most ranges unless the caller says how many. The cut points, one fewer than ranges,
#: travel to every task, and each range is one group of a window.
MAX_RANGES = 4096


def _shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _range_count(df: DataFrame) -> int:
    """Some ranges per shuffle task, so that hashing them to tasks evens out."""
    return min(4 * _shuffle_tasks(df), MAX_RANGES)


def _cut_points(values: DataFrame, column: Column, order_col: str, ranges: int) -> Column:
    """Approximate quantiles of a table that is shuffled by `order_col`, in two levels.

    The values of a shuffle task share a group, so each task sends one sketch. The groups,
    about as many as the root of the tasks, merge side by side; only their cut points
    meet in the last task.
    """
    tasks = _shuffle_tasks(values)
    groups = max(1, round(tasks**0.5))
    shares, accuracy = [i / ranges for i in range(1, ranges)], max(1000, 4 * ranges)
    group = F.pmod(F.pmod(F.hash(order_col), F.lit(tasks)), F.lit(groups))
    per_group = values.groupBy(group.alias("_group")).agg(
        F.percentile_approx(column, shares, accuracy).alias("_cuts")
    )
    points = per_group.select(F.explode("_cuts").alias("_cut"))
    return points.agg(F.percentile_approx("_cut", shares, accuracy)).scalar()


def _with_range(values: DataFrame, order_col: str, cuts: Column, ranges: int) -> DataFrame:
    """Add `_range`, the number of cut points up to the value; -1 for null.

    `ranges` is a power of two. The cut points are searched by halving, one
    projection per step, which stays in generated code; comparing with each of them in turn
    would take longer than the sort that follows.
    """
    columns = values.columns
    found = values.select(*columns, cuts.alias("_cuts"), F.lit(0).alias("_range"))
    step = ranges // 2
    while step:
        reached = F.get("_cuts", F.col("_range") + (step - 1)) <= F.col(order_col)
        found = found.select(
            *columns,
            "_cuts",
            (F.col("_range") + F.when(reached, step).otherwise(0)).alias("_range"),
        )
        step //= 2
    return found.select(
        *columns,
        F.when(F.col(order_col).isNull(), -1).otherwise(F.col("_range")).alias("_range"),
    )


def counted_ranges(
    df: DataFrame,
    order_col: str,
    counts: Mapping[str, Column],
    ranges: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct value of `order_col` with its counts and its `_range`.

    The column holds numbers, dates or timestamps; null is the smallest value.
    Every value of a range is below every value of the next. `ranges` is rounded
    up to a power of two; by default it follows the shuffle partitions up to `MAX_RANGES`.

    With `by` there is a row per group and value. All groups share the cut points, which are
    quantiles of their values together, so no group has more values in a range than all groups
    have in it on average, however its values are spread.
    """
    ranges = 1 << ((_range_count(df) if ranges is None else ranges) - 1).bit_length()
    # The only pass over the rows; copies of a value are folded before the shuffle.
    values = df.groupBy(*by, order_col).agg(*[c.alias(name) for name, c in counts.items()])
    # Counts are never negative. Reading them all the same keeps this plan's shuffle
    # equal to that of `values`, so Spark runs it once for both. The result is one
    # row: an aggregate without keys.
    counted = reduce(add, [F.col(n) for n in counts]) >= 0
    cuts = _cut_points(values, F.when(counted, F.col(order_col)), order_col, ranges)
    return _with_range(values, order_col, cuts, ranges)


def sum_below(column: str, window: WindowSpec) -> Column:
    """Sum over the rows before the current one in an ordered window."""
    return F.coalesce(
        F.sum(column).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )


def value_ranks(df: DataFrame, order_col: str, ranges: int | None = None) -> DataFrame:
    """Per distinct value: `rank` (ties share the lowest) and `percent_rank`."""
    ranged = counted_ranges(df, order_col, {"n": F.count("*")}, ranges)
    # At most `ranges` + 1 rows, so one task and a broadcast are safe.
    per_range = ranged.groupBy("_range").agg(F.sum("n").alias("n"))
    offsets = per_range.select(
        "_range",
        sum_below("n", W.orderBy("_range")).alias("_offset"),
        F.sum("n")
        .over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        .alias("_total"),
    )
    below = F.col("_offset") + sum_below("n", W.partitionBy("_range").orderBy(order_col))
    # A left join, although every range has an offset: an inner join would push
    # its not-null test on `_range` below the aggregation and spoil the shared shuffle.
    return ranged.join(F.broadcast(offsets), "_range", "left").select(
        order_col,
        (below + 1).alias("rank"),
        F.when(F.col("_total") > 1, below / (F.col("_total") - 1))
        .otherwise(0.0)
        .alias("percent_rank"),
    )


def with_ranks(df: DataFrame, order_col: str, ranges: int | None = None) -> DataFrame:
    """Every row with its `rank` and `percent_rank` over the whole table.

    The ranks hold each value once, so however often a value occurs the join
    never multiplies rows and adaptive execution can split its partition.
    """
    ranks = value_ranks(df, order_col, ranges).withColumnRenamed(order_col, "_value")
    joined = df.join(ranks, F.col(order_col).eqNullSafe(F.col("_value")))
    return joined.drop("_value")


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    group: Sequence[str],
    rank_col: str = "rank",
) -> DataFrame:
    """The first k rows of every group, numbered from 1.

    Spark keeps only k rows per group and task before the shuffle, so a group
    with a third of the rows sends k rows per task like any other.
    """
    numbered = df.withColumn(
        rank_col, F.row_number().over(W.partitionBy(*group).orderBy(*order))
    )
    return numbered.filter(F.col(rank_col) <= k)


def largest_group(df: DataFrame, group_col: str) -> DataFrame:
    """One row: the most frequent value with its `count`; the smaller value wins a tie."""
    return (
        df.groupBy(group_col)
        .count()
        .orderBy(F.desc("count"), F.asc(group_col))
        .limit(1)
    )
