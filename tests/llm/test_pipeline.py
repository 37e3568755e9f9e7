"""Every stage against its decision in plain Python, and the whole against the stages."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm import test_decontaminate, test_jaccard_join, test_secrets
from tests.llm.fixtures import SMALL, empty, table, with_clashes
from tidemark.llm import catalog

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    """A folder with documents that each stage decides on, and the items of the benchmark."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    texts, items = test_decontaminate.hostile()
    english = "the cat and the dog sat on the mat with a hat "
    texts = [t for t in texts if t != ""] + test_secrets.TEXTS + [english * 9, english * 9 + "x", english * 9, "123", "?!", None]
    docs = table(spark, texts)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(enumerate(texts)), items


def expected(texts, items):
    left = {i: t for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    ids = sorted(left)
    component = {int(i): int(c) for i, _, c in test_jaccard_join.expected([(i, left[i]) for i in ids])}
    left = {i: left[i] for i in ids if component[i] == i}
    bad = {row[0] for row in test_decontaminate.expected(sorted(left.items()), items) if row[-1]}
    return {i: t for i, t in left.items() if i not in bad}


def test_whole_pipeline(spark, corpus):
    folder, texts, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        columns = docs.dtypes
        docs = stage(spark, docs, folder).cache()
        assert docs.dtypes == columns, name
    kept = {r.doc_id: r for r in docs.collect()}
    assert set(kept) == set(expected(texts, items)) and len(kept) < len(texts)
    for row in kept.values():
        assert not test_secrets.expected(row.text) and (row.n_chars == len(row.text)), row.text[:80]
    library = tokenizers.Tokenizer.from_file(catalog.vocabulary_path())
    rows = {r.doc_id: r for r in pipeline.run(spark, folder).collect()}
    assert set(rows) == set(kept)
    for doc_id, row in rows.items():
        ids = library.encode(kept[doc_id].text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_clean_texts_are_not_changed(spark, corpus):
    folder, texts, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for row in pipeline.without_secrets(spark, docs, folder).collect():
        if not test_secrets.expected(texts[row.doc_id]) and row.doc_id not in (6, 7):
            assert row.text == texts[row.doc_id] or "[" in row.text


def test_null_and_repeated_ids(spark, corpus):
    folder = corpus[0]
    copy = "one two three four five six seven"
    docs = table(spark, [copy, copy, copy, None, "another text here"], [None, 3, 3, None, None])
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    assert sorted((str(r.doc_id), r.text) for r in docs.collect()) == [("3", copy), ("None", "another text here")]


def test_one_row_of_each_component_where_ids_repeat(spark, corpus):
    near = " ".join(f"w{i}" for i in range(60))
    other, apart = " ".join(f"v{i}" for i in range(60)), "one two three four five six seven"
    texts = [near, other, near + " x", apart, other + " x", other + " y", " ", " ", apart + " eight nine ten eleven"]
    docs = table(spark, texts, [3, 5, 5, 3, 7, 7, 8, 9, None])
    found = sorted((str(r.doc_id), r.text) for r in pipeline.near_duplicates(spark, docs, corpus[0]).collect())
    assert found == sorted([("3", near), ("5", other), ("3", apart), ("8", " "), ("9", " "), ("None", texts[-1])])
    alike = table(spark, [other, other + " x", other + " y"], [7, 7, 7])
    assert pipeline.near_duplicates(spark, alike, corpus[0]).count() == 1


def test_columns_with_clashing_names_pass_through(spark, corpus):
    docs = with_clashes(table(spark, ["one two three four five six seven", "token=abcdefgh and more", None])).withColumn("lang_pred", F.lit("given"))
    for name, stage in pipeline.STAGES[:-1]:
        columns = docs.dtypes
        docs = stage(spark, docs, corpus[0])
        assert docs.dtypes == columns, name
    rows = docs.collect()
    assert len(rows) == 2 and {(r.score, r.lang_pred, r.name) for r in rows} == {("score", "given", "name")}


HELPERS = "_id _text _blob _spans _hash _key _gone _ID h label _h".split()


@pytest.mark.parametrize("ids", [[0, 1, 2, 3, 4, 5], [7, 7, 7, None, None, 8]])
def test_columns_named_like_helpers_pass_through(spark, corpus, ids):
    near = " ".join(f"w{i}" for i in range(60))
    texts = [near, near + " x", "token=abcdefgh and more words here", None, "token=abcdefgh and more words here", "one two three four"]
    docs = table(spark, texts, ids).drop("n_chars")
    for name in HELPERS[:7] + HELPERS[8:]:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce("text", F.lit("none"))))
    given = {r.text: r for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        columns = docs.dtypes
        docs = stage(spark, docs, corpus[0])
        assert docs.dtypes == columns, name
    rows = docs.collect()
    assert rows and all(r["_blob"].endswith(r.text) or "[assign]" in r.text for r in rows)
    for row in rows:
        before = given[row["_text"].removeprefix("_text of ")]
        assert [row[c] for c in docs.columns if c != "text"] == [before[c] if c != "doc_id" else row.doc_id for c in docs.columns if c != "text"] or row.doc_id in ids


def test_rows_that_go_are_found_without_a_shuffle_of_the_rest(spark, corpus):
    docs = table(spark, [f"text {i}" for i in range(2000)])
    gone = spark.createDataFrame([(i,) for i in range(0, 2000, 50)], "doc_id long")
    left = pipeline._without(docs, F.col("doc_id"), gone)
    assert {r.doc_id for r in left.collect()} == {i for i in range(2000) if i % 50}
    sure, maybe = pipeline.bloom.split(docs, F.xxhash64("doc_id"), gone.select(F.xxhash64("doc_id").alias("h")), "h")
    assert "Exchange" not in sure._jdf.queryExecution().executedPlan().toString()
    assert 40 <= maybe.count() < 200 and sure.count() + maybe.count() == 2000
    assert sorted(r.doc_id for r in pipeline._without(docs, F.when(F.col("doc_id") > 5, F.col("doc_id")), gone).collect())[:3] == [0, 1, 2]


def test_no_language_given(spark, corpus):
    texts = ["one two three four five six seven", "123 !?", "的", None, "…"]
    docs = table(spark, texts).withColumn("lang", F.lit(None).cast("string")).withColumn("lettered", F.lit("given"))
    found = pipeline.language_id(spark, docs, corpus[0])
    assert found.dtypes == docs.dtypes
    assert sorted((r.text, r.lang, r.lettered) for r in found.collect()) == [(texts[0], None, "given"), ("的", None, "given")]
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, corpus[0])
    assert sorted(r.doc_id for r in docs.collect()) == [0, 2]


def test_given_languages_stay_and_missing_ones_are_filled(spark, corpus):
    texts = ["the cat sat on the mat", "der hund und die katze", "the mat the cat", "und die katze", "qqq", "12"]
    langs = ["en", "de", "de", None, "xx", "en"]
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(texts, langs, strict=True))], "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang for r in pipeline.language_id(spark, docs, corpus[0]).collect()}
    assert found == {0: "en", 1: "de", 2: "de", 3: "de", 4: "xx"}


def test_no_documents(spark, corpus):
    docs = empty(spark)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, corpus[0])
    assert docs.count() == 0


def test_given_documents(spark):
    found = pipeline.run(spark, SMALL)
    total = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert 0.5 * total < found.count() < total


def test_filters_of_keys_need_no_pandas(spark, monkeypatch):
    asked, given = [], F.pandas_udf
    monkeypatch.setattr(F, "pandas_udf", lambda *args, **more: asked.append(args) or given(*args, **more))
    rows = spark.range(1000).selectExpr("if(id % 10 = 3, null, id * 7) k")
    sure, maybe = pipeline.bloom.split(rows, F.col("k"), spark.range(50).selectExpr("id * 7 h"), "h")
    inside = [r.k for r in maybe.collect()]
    assert inside.count(None) == 100 and {i * 7 for i in range(50) if i % 10 != 3} <= set(inside)
    assert sure.count() + len(inside) == 1000 and len(inside) < 200
    assert ("boolean",) not in asked and not hasattr(pipeline.bloom, "pd")


def _python_steps_of_last_stage(df):
    """Python steps of a plan that no exchange separates from its root."""
    found, hidden = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        hidden = hidden if hidden is not None and depth > hidden else None
        if hidden is None and "Exchange" in line:
            hidden = depth
        elif hidden is None and ("MapInArrow" in line or "EvalPython" in line):
            found.append(line.strip(" :+-"))
    return found


def test_tasks_of_all_stages_have_one_python_worker(spark, corpus, monkeypatch):
    """Steps in a row each take a worker, and an executor's workers stay alive with what they have loaded."""
    folder, _, _ = corpus
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    chained, given = [], type(spark.range(0)).mapInArrow

    def watched(self, *args, **more):
        chained.extend(_python_steps_of_last_stage(self))
        return given(self, *args, **more)

    try:
        rows = spark.range(5).mapInArrow(lambda batches: batches, "id long")
        assert len(_python_steps_of_last_stage(rows)) == 1 and not _python_steps_of_last_stage(rows.repartition(2))
        monkeypatch.setattr(type(rows), "mapInArrow", watched)
        assert pipeline.run(spark, folder).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not chained
