"""Committed tables, kept cutoffs and daily traffic, and indexes as tables."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.plans import executed
from tidemark.operators import features, levels, splits, weblog
from tidemark.operators.cutoffs import TimeCounts
from tidemark.operators.daily import DailyTraffic
from tidemark.plans.traffic import country_report
from tidemark.sources.committed import CommittedTable


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_the_old_or_the_new_table(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path))
    assert table.latest() is None
    assert table.write("one", spark.range(5))
    opened = table.latest()
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.write("two", broken)
    assert ids(table.latest()) == list(range(5)) and [b for _, b, _ in table.published()] == ["one"]
    assert table.write("two", spark.range(3)) and ids(table.latest()) == [0, 1, 2] and ids(opened) == list(range(5))


def test_repeated_batches_are_not_computed(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path))
    assert table.write("a", spark.range(2)) and table.write("b", spark.range(2, 4))
    assert not table.write("a", lambda: pytest.fail("computed again"))
    assert ids(table.everything("id long")) == [0, 1, 2, 3] and ids(CommittedTable(spark, str(tmp_path)).latest()) == [2, 3]
    assert CommittedTable(spark, f"{tmp_path}/none").everything("id long").count() == 0


def expected_cutoffs(df, thresholds):
    row = splits.temporal_cutoffs(df, "timestamp", thresholds).first()
    return list(row)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cutoffs_equal_those_of_all_ratings(spark, tmp_path, seed):
    rng = random.Random(seed)
    times = [rng.choice((None, 50, rng.randrange(-300, 2000), rng.randrange(5) * 100)) for _ in range(300)]
    if seed == 2:
        times = [t for t in times if t is not None]
    thresholds = [0.05, 0.4, 0.6, 0.8, 1.0]
    df = spark.createDataFrame([(t,) for t in times], "timestamp long").repartition(3)
    batches = [df.filter(F.pmod(F.xxhash64(F.coalesce("timestamp", F.lit(7))), F.lit(4)) == i) for i in range(4)]
    order = list(range(4))
    rng.shuffle(order)
    counts = TimeCounts(spark, str(tmp_path), width=100)
    assert counts.cutoffs(thresholds) == [None] * 5
    for at, i in enumerate(order):
        assert counts.add(f"b{i}", batches[i])
        if at == 1:
            assert not counts.add(f"b{i}", batches[i])
    assert counts.cutoffs(thresholds) == expected_cutoffs(df, thresholds)


def test_one_time_and_failed_batch(spark, tmp_path):
    counts = TimeCounts(spark, str(tmp_path), width=10)
    same = spark.createDataFrame([(5,)] * 4, "timestamp long")
    counts.times.write("half", same.groupBy(F.col("timestamp").alias("time")).agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("bucket")))
    assert counts.cutoffs([0.5]) == [None]
    assert counts.add("half", same)
    assert counts.cutoffs([0.5]) == expected_cutoffs(same, [0.5]) == [None]
    one = TimeCounts(spark, f"{tmp_path}/one")
    one.add("b", same.limit(1))
    assert one.cutoffs([0.5]) == expected_cutoffs(same.limit(1), [0.5])


def requests(spark, days, seed=4, many=4000):
    rng = random.Random(seed)
    rows = [(f"h{int(rng.expovariate(0.01))}.x.{rng.choice(('de', 'ca', 'com'))}", f"{rng.choice(days):02d}/Jul/1995:10:00:01 -0400") for _ in range(many)]
    return spark.createDataFrame([*rows, ("odd.de", "no time"), ("odd.de", "31/Foo/1995:1:1:1")], "host string, ts_text string")


def test_daily_reports_equal_those_of_the_log(spark, tmp_path):
    state = DailyTraffic(spark, str(tmp_path))
    parts = [requests(spark, days, seed) for seed, days in enumerate(([1, 2, 3], [3, 4], [9]))]
    for i in (2, 0, 1):
        assert state.add(f"part{i}", parts[i])
    assert not state.add("part0", parts[0])
    whole = parts[0].union(parts[1]).union(parts[2])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(state.report()) == rows(country_report(whole))
    span = whole.filter(F.substring("ts_text", 1, 2).isin("02", "03", "04"))
    dates = datetime.date(1995, 7, 2), datetime.date(1995, 7, 8)
    assert rows(state.report(*dates)) == rows(country_report(span))
    exact = {r.country: r for r in country_report(span).collect()}
    for row in state.estimates(*dates).collect():
        assert row.requests == exact[row.country].requests
        # Four times the stated relative error.
        assert abs(row.unique_hosts - exact[row.country].unique_hosts) <= 4 * 1.04 / 2**6 * exact[row.country].unique_hosts + 1


def test_sketches_merge_and_reports_do_not_read_the_log(spark, tmp_path):
    state = DailyTraffic(spark, str(tmp_path))
    many = spark.range(60_000).select(F.concat(F.lit("h"), F.col("id"), F.lit(".de")).alias("host"), F.lit("01/Jul/1995:0:0:0").alias("ts_text"))
    for part in range(3):
        state.add(str(part), many.filter(F.col("id") % 4 != part))
    row = state.estimates().first()
    assert row.requests == 135_000 and abs(row.unique_hosts / 60_000 - 1) < 4 * 1.04 / 2**6
    assert state.report().first().unique_hosts == 60_000
    assert "regexp" not in executed(state.report())


def test_level_index_equals_the_librarys(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(i, rng.choice(("b", "a", "zz", "é", "", None, f"r{rng.randrange(90)}"))) for i in range(800)], "id long, name string")
    known = df.na.drop()
    found = levels.with_index(df, "name", levels.level_index(df.repartition(5), "name"), "i", unseen=-1.0)
    library = features.index_stage(["name"], "error").fit(known).transform(known)
    assert {r.id: r.i for r in found.collect() if r.name is not None} == {r.id: r.name_index for r in library.collect()}
    assert {r.i for r in found.collect() if r.name is None} == {-1.0}
    vectors = levels.with_slots(found, "i", 4, "v").collect()
    for row in vectors:
        assert row.v.size == 4 and row.v.indices.tolist() == ([int(row.i)] if 0 <= row.i < 4 else [])
    assert levels.level_index(df.limit(0), "name").count() == 0


def test_a_million_levels_stay_a_table(spark, monkeypatch):
    df = spark.range(0, 1_100_000, 1, 8).select(F.concat(F.lit("l"), F.col("id") % 1_000_000).alias("name"))
    monkeypatch.setattr("pyspark.sql.DataFrame.collect", lambda self: pytest.fail("collected"))
    index = levels.level_index(df, "name")
    row = index.agg(F.count("*").alias("n"), F.count_distinct("index").alias("d"), F.min("index").alias("a"), F.max("index").alias("b")).first()
    assert tuple(row) == (1_000_000, 1_000_000, 0, 999_999)
    assert index.filter("n = 2").agg(F.max("index")).first()[0] == 99_999
    assert weblog.TOP_HOSTS
