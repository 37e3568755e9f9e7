"""Totals under inserts, deletes, revisions and repeated batches."""

from tests import oracle
from tests.llm.fixtures import SMALL, empty, table, with_clashes
from tidemark.llm import catalog
from tidemark.llm.token_counts import TOKENIZERS, Rollup, changes, counted

CHANGES = "source string, lang string, tokenizer string, before long, after long"


def totals(rollup):
    return sorted(tuple(r) for r in rollup.totals().select("source", "lang", "tokenizer", "n_docs", "n_tokens").collect())


def test_signed_changes(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path))
    batch = lambda *rows: spark.createDataFrame([("s", None, "t", *r) for r in rows], CHANGES)
    assert totals(rollup) == []
    assert rollup.apply("1", batch((None, 5), (None, 7), (None, 0)))
    assert totals(rollup) == [("s", None, "t", 3, 12)]
    assert rollup.apply("2", batch((7, None), (5, 6)))
    assert totals(rollup) == [("s", None, "t", 2, 6)]
    assert not rollup.apply("2", batch((7, None), (5, 6)))
    assert totals(rollup) == [("s", None, "t", 2, 6)]
    assert Rollup(spark, str(tmp_path)).apply("3", batch((0, None), (6, None)))
    assert totals(rollup) == []


def test_batch_without_commit_is_not_read(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path))
    df = spark.createDataFrame([("s", "l", "t", None, 5)], CHANGES)
    commits, rollup.commits = rollup.commits, "/nonexistent\0/folder"
    try:
        rollup.apply("a/b=c", df)
    except Exception:
        pass
    rollup.commits = commits
    assert totals(rollup) == []
    assert rollup.apply("a/b=c", df) and not rollup.apply("a/b=c", df)
    assert totals(rollup) == [("s", "l", "t", 1, 5)]


def test_moved_document(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path))
    rollup.apply("1", spark.createDataFrame([("s", "l", "t", None, 5)], CHANGES))
    rollup.apply("2", spark.createDataFrame([("s", "l", "t", 5, None), ("s", "m", "t", None, 4)], CHANGES))
    assert totals(rollup) == [("s", "m", "t", 1, 4)]


def test_counts_of_hostile_texts(spark, tmp_path):
    counts = counted(table(spark, [None, "", "a-b é ...", "a-b é ...", "x\u00a0y"], [1, 1, None, 3, 4]), TOKENIZERS)
    rows = [tuple(r) for r in counts.select("`words/1`", "`words/2`", "`symbols/1`").collect()]
    assert rows == [(0, 0, 0), (0, 0, 0), (3, 1, 7), (3, 1, 7), (1, 1, 3)]
    rollup = Rollup(spark, str(tmp_path))
    rollup.apply("1", changes(counts, inserted="words/1"))
    assert totals(rollup) == [("src0", "en", "words/1", 5, 7)]
    rollup.apply("2", changes(counted(empty(spark), TOKENIZERS), inserted="words/1"))
    assert totals(rollup) == [("src0", "en", "words/1", 5, 7)]


def test_versions_are_never_mixed(spark, tmp_path):
    """A revision that was applied to some documents leaves each version's total exact."""
    counts = counted(with_clashes(table(spark, ["a-b é ...", "c d", "..."])), TOKENIZERS)
    rollup = Rollup(spark, str(tmp_path))
    rollup.apply("load", changes(counts, inserted="words/1"))
    rollup.apply("some", changes(counts.filter("doc_id = 0"), deleted="words/1", inserted="words/2"))
    assert totals(rollup) == [("src0", "en", "words/1", 2, 3), ("src0", "en", "words/2", 1, 1)]
    rollup.apply("rest", changes(counts.filter("doc_id > 0"), deleted="words/1", inserted="words/2"))
    assert totals(rollup) == [("src0", "en", "words/2", 3, 3)]


def test_query_equals_sql(spark):
    with oracle.connect(SMALL) as duck:
        expected = duck.execute(catalog.OP5_SQL).df()
    assert oracle.differences(catalog.op5_token_counts(spark, SMALL).toPandas(), expected) == []
