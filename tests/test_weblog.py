import pytest
from pyspark.sql import functions as F

from tests.plans import count, executed
from tidemark.functions import accesslog
from tidemark.operators import weblog
from tidemark.plans.traffic import country_report

GOOD = 'h1.uni.de - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 6245'


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def visits(spark, *hosts, time="05/Jul/1995:13:00:00 -0400"):
    return weblog.parse(
        lines(spark, *[f'{h} - - [{time}] "GET / HTTP/1.0" 200 1' for h in hosts])
    )


def test_parse_reads_all_fields(spark):
    row = weblog.parse(lines(spark, GOOD)).first()
    assert tuple(row) == ("h1.uni.de", "01/Jul/1995:00:00:01 -0400", "GET /a HTTP/1.0", 200, 6245)


def test_parse_drops_what_has_no_numbers(spark):
    no_bytes = GOOD.replace("6245", "-")
    df = lines(spark, GOOD, no_bytes, "bad line", "", "200")
    assert weblog.parse(df).count() == 1
    kept = weblog.parse(df, require_bytes=False).collect()
    assert {(r.status, r.bytes) for r in kept} == {(200, 6245), (200, None)}


def test_large_replies_are_counted(spark):
    row = weblog.parse(lines(spark, GOOD.replace("6245", str(3 << 31)))).first()
    assert row.bytes == 3 << 31


def test_request_is_the_last_quoted_text(spark):
    line = GOOD.replace('"GET /a HTTP/1.0"', '"GET /"x" HTTP/1.0"')
    assert weblog.parse(lines(spark, line)).first().request == " HTTP/1.0"


def test_missing_time_gives_empty_text(spark):
    assert weblog.parse(lines(spark, "a.de x 200 5")).first().ts_text == ""


def test_top_level_domain(spark):
    df = spark.createDataFrame([("a.b.de",), ("local",), (None,)], "h string")
    found = [r[0] for r in df.select(accesslog.top_level_domain(F.col("h"))).collect()]
    assert found == ["de", None, None]


def test_country_without_visits_counts_zero(spark):
    counted = {r.country: r.requests for r in weblog.country_requests(visits(spark, "a.de", "a.de")).collect()}
    assert counted == {"Germany": 2, "Canada": 0, "Singapore": 0}


def test_suffix_needs_the_dot(spark):
    assert weblog.host_counts(visits(spark, "ade", "a.dex", "de")).count() == 0


def test_own_suffixes(spark):
    df = visits(spark, "a.ac.uk", "b.co.uk")
    found = weblog.host_counts(df, {"Academic": ".ac.uk"}).collect()
    assert [tuple(r) for r in found] == [("Academic", "a.ac.uk", 1)]


def test_no_suffixes_is_an_error(spark):
    with pytest.raises(ValueError):
        accesslog.country(F.col("host"), {})


def test_ties_at_the_cut_go_by_name(spark):
    df = visits(spark, "c.de", "b.de", "a.de", "b.de", "z.ca")
    top = weblog.top_hosts(df, 2).orderBy("country", "rank").collect()
    assert [tuple(r) for r in top] == [
        ("Canada", "z.ca", 1, 1), ("Germany", "b.de", 2, 1), ("Germany", "a.de", 1, 2),
    ]


def test_share_adds_up_with_and_without_a_rest(spark):
    df = visits(spark, *["a.de"] * 5, *["b.de"] * 3, "c.de", "d.de", "x.ca")
    rows = weblog.host_share(df, k=2).collect()
    german = {r.host: (r.requests, r.percent) for r in rows if r.country == "Germany"}
    assert german == {"a.de": (5, 50.0), "b.de": (3, 30.0), "Rest": (2, 20.0)}
    canadian = {r.host: (r.requests, r.percent) for r in rows if r.country == "Canada"}
    assert canadian == {"x.ca": (1, 100.0), "Rest": (0, 0.0)}


def test_share_of_an_empty_log(spark):
    assert weblog.host_share(visits(spark)).count() == 0


def test_heatmap_is_a_full_grid_in_local_time(spark):
    df = visits(spark, "a.de", "a.de", "b.de").unionByName(
        visits(spark, "a.de", time="31/Jul/1995:23:59:59 -0400")
    )
    rows = weblog.heatmap(df).collect()
    assert len(rows) == 31 * 24
    assert {r.host for r in rows} == {"a.de"}
    assert {(r.day, r.hour): r.requests for r in rows if r.requests} == {(5, 13): 2, (31, 23): 1}


def test_heatmap_keeps_unreadable_times_out_of_the_grid(spark):
    df = visits(spark, "a.de").unionByName(visits(spark, "a.de", "a.de", time="no time"))
    rows = weblog.heatmap(df).collect()
    assert len(rows) == 31 * 24
    assert sum(r.requests for r in rows) == 1


def test_unique_hosts_estimate(spark):
    df = visits(spark, "a.de", "b.de", "b.de")
    assert weblog.country_unique_hosts(df).first().unique_hosts == 2
    assert weblog.country_unique_hosts(df, rsd=0.05).first().unique_hosts == 2


def test_country_report(spark):
    df = visits(spark, *["a.de"] * 3, "b.de", "c.de")
    assert tuple(country_report(df, k=2).first()) == ("Germany", 5, 2 + 1, "a.de", 3, 4, 80.0)


@pytest.fixture(scope="module")
def log_file(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "parquet")
    lines(spark, GOOD, GOOD.replace(".de", ".ca")).write.parquet(path)
    return path


@pytest.mark.parametrize("report", [weblog.host_share, weblog.heatmap, country_report])
def test_reports_read_the_log_once(spark, log_file, report):
    plan = executed(report(weblog.parse(spark.read.parquet(log_file))))
    assert count(plan, "FileScan") == 1
    assert count(plan, "CartesianProduct") == count(plan, "BroadcastNestedLoopJoin") == 0


def test_top_hosts_are_cut_before_the_shuffle(spark, log_file):
    plan = executed(weblog.top_hosts(weblog.parse(spark.read.parquet(log_file))))
    assert count(plan, "WindowGroupLimit") == 2


def test_host_reports_skip_the_other_patterns(spark, log_file):
    plan = executed(weblog.host_counts(weblog.parse(spark.read.parquet(log_file))))
    assert plan.count("regexp_extract") and "- - " not in plan
