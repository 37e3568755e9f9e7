import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tests.plans import count, executed
from tidemark.operators import ranking

SCHEMA = "id int, t bigint"


def built_in(df):
    order = W.orderBy("t")
    return df.select(
        "*", F.rank().over(order).cast("bigint").alias("rank"),
        F.percent_rank().over(order).alias("percent_rank"),
    )


def values(times):
    return list(enumerate(times))


CASES = {
    "ties": [3, 1, 3, 2, 3, 1],
    "nulls": [None, 5, None, 1, 5],
    "one row": [7],
    "no rows": [],
    "all null": [None, None],
    "all equal": [4] * 9,
    "mixed": [random.Random(1).choice([None, *range(50)]) for _ in range(500)],
    "a hot value": [1] * 400 + list(range(200)),
}


@pytest.mark.parametrize("times", CASES.values(), ids=CASES.keys())
@pytest.mark.parametrize("ranges", [2, 7, None])
def test_equals_the_built_in_window(spark, times, ranges):
    df = spark.createDataFrame(values(times), SCHEMA)
    found = sorted(map(tuple, ranking.with_ranks(df, "t", ranges).collect()))
    assert found == sorted(map(tuple, built_in(df).collect()))


@pytest.mark.parametrize("kind", ["double", "date", "timestamp", "timestamp_ntz"])
def test_other_types(spark, kind):
    base = spark.range(100).withColumn("n", F.col("id") * 7 % 10)
    column = (
        F.col("n").cast("double")
        if kind == "double"
        else F.date_add(F.lit("2024-01-01").cast("date"), F.col("n").cast("int")).cast(kind)
    )
    df = base.select("id", column.alias("t"))
    found = sorted(map(tuple, ranking.with_ranks(df, "t").collect()))
    assert found == sorted(map(tuple, built_in(df).collect()))


def test_rows_are_read_once_to_rank_them(spark, tmp_path):
    path = str(tmp_path / "times")
    spark.createDataFrame(values([5, 1, 5, 2]), SCHEMA).write.parquet(path)
    plan = executed(ranking.value_ranks(spark.read.parquet(path), "t"))
    assert count(plan, "FileScan") == 1
    assert "ReadSchema: struct<t:bigint>" in plan


def test_cut_points_meet_in_two_levels(spark, tmp_path):
    """The aggregate without keys reads groups' cut points, about as many groups as the root of the tasks."""
    path = str(tmp_path / "many")
    spark.range(5000).withColumnRenamed("id", "t").repartition(16).write.parquet(path)
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = ranking.value_ranks(spark.read.parquet(path), "t", 64)
        plan = executed(df)
        assert count(plan, "FileScan") == 1
        assert "_group" in plan and "explode(_cuts" in plan
        ranged = ranking.counted_ranges(spark.read.parquet(path), "t", {"n": F.count("*")}, 64)
        sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
        assert len(sizes) == 64 and max(sizes) < 2 * 5000 / 64
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)


def test_top_k_numbers_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 9)], "g string, v int")
    top = ranking.top_k(df, 2, [F.desc("v")], ["g"]).collect()
    assert sorted(map(tuple, top)) == [("a", 2, 2), ("a", 3, 1), ("b", 9, 1)]


def test_largest_group_breaks_ties_on_the_value(spark):
    df = spark.createDataFrame([(c,) for c in (3, 3, 1, 1, 2)], "c int")
    assert tuple(ranking.largest_group(df, "c").first()) == (1, 2)
    assert ranking.largest_group(df.limit(0), "c").count() == 0
