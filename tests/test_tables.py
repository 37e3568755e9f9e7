import gzip

import pytest
from pyspark.sql import functions as F

from tests.plans import executed
from tidemark.operators import schema, sets
from tidemark.operators.splits import random_split
from tidemark.sources import files, inputs, schemas


def test_rename_checks_the_number_of_names(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert schema.rename_positional(df, ["p", "q"]).columns == ["p", "q"]
    with pytest.raises(ValueError):
        schema.rename_positional(df, ["p"])


def test_columns_by_type(spark):
    df = spark.createDataFrame([(1, "a", 2.0, True)], "i int, s string, d double, b boolean")
    assert schema.string_columns(df) == ["s"]
    assert schema.numeric_columns(df, ["d", "b"]) == ["d"]


def test_casting_leaves_other_types_alone(spark):
    df = spark.createDataFrame([("1.5", 3), ("x", 4)], "`a-b` string, n int")
    cast = schema.cast_strings_to_double(df)
    assert cast.dtypes == [("a-b", "double"), ("n", "int")]
    assert [r[0] for r in cast.collect()] == [1.5, None]


def test_class_balance_of_one_class(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "label double")
    row = schema.class_balance(df, "label").first()
    assert (row.positives, row.negatives, row.neg_pos_ratio, row.weight_0) == (2, 0, 0.0, None)


def test_class_weights_carry_the_same_total(spark):
    df = spark.createDataFrame([(float(i % 4 == 0),) for i in range(8)], "label double")
    totals = schema.with_class_weights(df, "label").groupBy("label").agg(F.sum("weight")).collect()
    assert [r[1] for r in totals] == pytest.approx([4.0, 4.0])


def test_subtract_is_except_distinct(spark):
    columns = "a int, b string"
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, None), (4, "y")], columns)
    right = spark.createDataFrame([(2, None), (4, "y"), (9, "z")], columns)
    found = sorted(map(str, sets.subtract_distinct(left, right).collect()))
    assert found == sorted(map(str, left.subtract(right).collect()))
    with pytest.raises(ValueError):
        sets.subtract_distinct(left, right.select("a"))


def test_subtract_shuffles_once(spark):
    left = spark.range(10)
    assert executed(sets.subtract_distinct(left, spark.range(5))).count("Exchange hash") == 1


def test_union_matches_names(spark):
    first = spark.createDataFrame([(1, 2)], "a int, b int")
    second = spark.createDataFrame([(3, 4)], "b int, a int")
    assert [tuple(r) for r in sets.union_all(first, second).collect()] == [(1, 2), (4, 3)]


def test_members_ignores_repeated_ids(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    ids = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert [r.k for r in sets.members(df, ids, "k").collect()] == [1, 1]


def test_gzip_lines_are_spread(spark, tmp_path):
    path = tmp_path / "log.gz"
    with gzip.open(path, "wt") as out:
        out.writelines(f"line {i}\n" for i in range(100))
    df = files.read_lines(spark, str(path), spread=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.distinct().count() == 100
    assert files.read_lines(spark, str(path)).rdd.getNumPartitions() == 1


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "ratings.csv")
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,1112486027\n")
    given = files.read_csv(spark, path, schemas.RATINGS_CSV)
    assert given.dtypes == [
        ("userId", "int"), ("movieId", "int"), ("rating", "double"), ("timestamp", "bigint")
    ]
    inferred = files.read_csv(spark, path)
    assert given.collect() == inferred.collect()
    assert dict(inferred.dtypes)["rating"] == "double"


def test_headerless_csv_keeps_its_first_row(spark, tmp_path):
    names = schemas.PARTICLE_COLUMNS
    (tmp_path / "p.csv").write_text(",".join(["1.0"] * 29) + "\n" + ",".join(["0.0"] * 28 + ["bad"]) + "\n")
    raw = files.read_csv(spark, str(tmp_path / "p.csv"), header=False)
    df = schema.cast_strings_to_double(schema.rename_positional(raw, names))
    assert df.columns == names and df.count() == 2
    assert set(dict(df.dtypes).values()) == {"double"}
    given = files.read_csv(spark, str(tmp_path / "p.csv"), schemas.PARTICLES_CSV, header=False)
    assert given.columns == names and given.count() == 2


def test_snapshot_replaces_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    files.snapshot(spark.range(5), path)
    assert files.snapshot(spark.range(3), path).count() == 3


def test_shared_directory_is_the_configured_one(spark, shared_folder):
    assert files.shared_directory(spark) == shared_folder
    assert files.scratch_path(spark, "x") != files.scratch_path(spark, "x")


def test_checkpoint_folder_is_kept(spark, shared_folder):
    files.ensure_checkpoint_dir(spark)
    assert shared_folder in spark.sparkContext.getCheckpointDir()


def test_no_folder_is_made_up(spark, monkeypatch):
    class Bare:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError):
        files.scratch_path(Bare, "x")
    assert files.scratch_path(Bare, "x", "/given").startswith("/given/x-")
    files.ensure_checkpoint_dir(Bare)


def test_inputs_of_the_analyses_from_csv(spark, tmp_path):
    (tmp_path / "policies.csv").write_text(
        "IDpol,ClaimNb,Exposure,Area,VehPower,VehAge,DrivAge,BonusMalus,VehBrand,VehGas,Density,Region\n"
        "1,0,0.5,C,5,0,55,50,B12,Regular,1217,R82\n"
    )
    policies = inputs.read_policies(spark, str(tmp_path / "policies.csv"))
    assert set(schemas.POLICY_FEATURES) < set(policies.columns) and policies.first().Density == 1217
    (tmp_path / "particles.csv").write_text("\n".join([",".join(f"c{i}" for i in range(29)), *[",".join(["1"] * 29)] * 3]))
    particles = inputs.read_particles(spark, str(tmp_path / "particles.csv"))
    assert particles.columns == schemas.PARTICLE_COLUMNS and particles.count() == 3
    (tmp_path / "movies.csv").write_text('movieId,title,genres\n1,"A, the",x|y\n')
    assert inputs.read_movies(spark, str(tmp_path / "movies.csv")).first().title == "A, the"


def test_table_without_a_key_is_split_by_all_columns(spark):
    df = spark.range(300).select((F.col("id") % 100).cast("double").alias("a"), F.lit(1.0).alias("b"))
    train, test = random_split(df, [0.7, 0.3], df.columns, 3)
    assert train.count() + test.count() == 300
    assert train.join(test, ["a", "b"], "left_semi").count() == 0
