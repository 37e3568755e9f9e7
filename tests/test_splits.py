import pytest
from pyspark.sql import functions as F

from tests.plans import executed
from tidemark.functions.hashing import hash_fraction
from tidemark.operators import splits

KEYS, SEED = ["id"], 7


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4000).withColumn("label", (F.col("id") % 2).cast("int"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_split_is_the_same_under_any_partitioning(rows):
    first = ids(splits.sample(rows, 0.3, KEYS, SEED))
    for n in (1, 4, 7):
        assert ids(splits.sample(rows.repartition(n), 0.3, KEYS, SEED)) == first
    assert ids(splits.sample(rows, 0.3, KEYS, SEED + 1)) != first


def test_sample_size_and_limits(rows):
    assert abs(splits.sample(rows, 0.3, KEYS, SEED).count() - 1200) < 120
    assert splits.sample(rows, 0.0, KEYS, SEED).count() == 0
    assert splits.sample(rows, 1.0, KEYS, SEED).count() == 4000
    with pytest.raises(ValueError):
        splits.sample(rows, 1.5, KEYS, SEED)


def test_stratified_shares_and_complement(rows):
    train, test = splits.stratified_split(rows, "label", {0: 0.7, 1: 0.3}, KEYS, SEED)
    shares = {r.label: r["count"] / 2000 for r in train.groupBy("label").count().collect()}
    assert abs(shares[0] - 0.7) < 0.05 and abs(shares[1] - 0.3) < 0.05
    assert sorted(ids(train) + ids(test)) == list(range(4000))


def test_label_without_a_share_and_null_label_go_to_the_rest(spark):
    df = spark.createDataFrame([(1, 0), (2, 5), (3, None)], "id int, label int")
    train, test = splits.stratified_split(df, "label", {0: 1.0}, KEYS, SEED)
    assert ids(train) == [1] and ids(test) == [2, 3]


def test_complement_keeps_copies(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    kept, rest = splits.split_by(df, F.col("id") == 2)
    assert kept.count() == 1 and rest.count() == 2


def test_random_split_parts_cover_all_rows(rows):
    parts = splits.random_split(rows, [7, 2, 1], KEYS, SEED)
    assert sorted(sum(map(ids, parts), [])) == list(range(4000))
    assert abs(parts[0].count() - 2800) < 150 and abs(parts[2].count() - 400) < 100
    with pytest.raises(ValueError):
        splits.random_part([1, 0], KEYS, SEED)


def test_folds_are_even(rows):
    folds = rows.groupBy(splits.k_fold(5, KEYS, SEED).alias("f")).count().collect()
    assert sorted(r.f for r in folds) == list(range(5))
    assert all(abs(r["count"] - 800) < 120 for r in folds)
    with pytest.raises(ValueError):
        splits.k_fold(1, KEYS, SEED)


def test_splits_do_not_shuffle(rows):
    train, _ = splits.stratified_split(rows, "label", {0: 0.7, 1: 0.3}, KEYS, SEED)
    assert "Exchange" not in executed(train)


TIMES = [1, 2, 2, 3, 4, 5, 6, 7, 8, 9, None]


def test_temporal_split_agrees_with_percent_ranks(spark):
    from tidemark.operators.ranking import with_ranks

    df = spark.createDataFrame([(i, t) for i, t in enumerate(TIMES)], "id int, t bigint")
    split = splits.with_temporal_splits(df, "t").join(with_ranks(df, "t").select("id", "percent_rank"), "id")
    for row in split.collect():
        for i, threshold in enumerate(splits.TEMPORAL_THRESHOLDS):
            expected = "train" if row.percent_rank < threshold else "test"
            assert row[f"split_{i}"] == expected


def test_temporal_split_without_a_cutoff(spark):
    df = spark.createDataFrame([(1, 5), (2, 5)], "id int, t bigint")
    assert splits.temporal_cutoffs(df, "t").first() == (None, None, None)
    assert {r.split_0 for r in splits.with_temporal_splits(df, "t").collect()} == {"train"}
    train, test = splits.temporal_split_at(df, "t", None)
    assert train.count() == 2 and test.count() == 0
    with pytest.raises(ValueError):
        splits.with_temporal_splits(df, "t", [0.0])


def test_known_cutoff_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "times")
    spark.range(10).withColumn("t", F.col("id")).write.parquet(path)
    train, test = splits.temporal_split_at(spark.read.parquet(path), "t", 4)
    assert (train.count(), test.count()) == (4, 6)
    assert "Or(IsNull(t),LessThan(t,4))" in executed(train)
    assert "GreaterThanOrEqual(t,4)" in executed(test)


def test_neighbouring_keys_do_not_run_together(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("null", "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    found = {r[0] for r in df.select(hash_fraction(["x", "y"], 1)).collect()}
    assert len(found) == len(rows)


def test_stratified_query_scans_once(spark):
    from tests.plans import count, executed
    from tidemark.catalog import ALL

    plan = executed(ALL["split_stratified"].run(spark, "/root/testdata/sf0.001"))
    assert count(plan, "FileScan") == 3
