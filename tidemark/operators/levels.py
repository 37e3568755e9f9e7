"""Indexes of text columns whose levels are too many for one process.

Levels are ordered as the ML library's indexer orders them, by falling count and then by name, but as a
table: a range shuffle sorts them, each range is numbered where it lies, and the sizes of the ranges, one row
each, give their offsets. No level comes to the driver.
"""

from __future__ import annotations

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.sets import hashed
from tidemark.sources.files import scratch_path, snapshot


def level_index(df: DataFrame, column: str, folder: str | None = None) -> DataFrame:
    """(level, n, index): every distinct value of a text column, numbered from 0; nulls are no level.

    Written below `folder` or `spark.checkpoint.dir`, so that numbers stay what they are.
    """
    counts = df.groupBy(F.col(column).cast("string").alias("level")).agg(F.count("*").alias("n")).filter("level is not null")
    # An id of this kind is the number of the range and the row's place in it.
    placed = counts.repartitionByRange(F.desc("n"), F.asc("level")).sortWithinPartitions(F.desc("n"), F.asc("level"))
    placed = placed.select("level", "n", F.monotonically_increasing_id().alias("_at"))
    placed = snapshot(placed, scratch_path(df.sparkSession, "levels", folder))
    part = F.shiftright("_at", 33).cast("int")
    # A row for each range.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")).alias("_before"))
    index = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("_part", part).join(F.broadcast(sizes), "_part").select("level", "n", index.alias("index"))


def with_index(df: DataFrame, column: str, levels: DataFrame, index_col: str, unseen: float | None = None) -> DataFrame:
    """Add the level's index as a double; rows of an unseen or null level get `unseen`.

    The hash is a second join column, so that the rows of a hot level can be split.
    """
    named = levels.select(F.col("level").alias("_level"), F.col("index").cast("double").alias("_index"))
    rows = hashed(df.withColumn("_level", F.col(column).cast("string")), "_level")
    found = rows.join(hashed(named, "_level"), ["_level", "_hash"], "left")
    value = F.coalesce("_index", F.lit(unseen).cast("double"))
    return found.withColumn(index_col, value).drop("_level", "_hash", "_index")


def with_slots(df: DataFrame, index_col: str, width: int, vector_col: str) -> DataFrame:
    """Add a sparse 0/1 vector of `width` with the index's slot filled; none is for null and from `width` on.

    The vector's type has no built-in constructor for sparse values, so a Python function makes it. No names
    of slots are kept: the table of levels has them.
    """

    @F.udf(VectorUDT())
    def slot(index: float | None) -> SparseVector:
        filled = index is not None and 0 <= index < width
        return SparseVector(width, [int(index)], [1.0]) if filled else SparseVector(width, [], [])

    return df.withColumn(vector_col, slot(index_col))
