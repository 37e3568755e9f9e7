"""Contamination against a search for every window in every text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import SMALL, empty, table, with_clashes
from tidemark.llm.decontaminate import contamination


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(docs, items, window=13, share=20):
    wanted = []
    for item_id, text in items:
        found = words(text)
        k = min(window, len(found))
        wanted += [(item_id, tuple(found[i : i + k])) for i in range(len(found) - k + 1) if k]
    out = []
    for doc_id, text in docs:
        found = words(text)
        hit, ids = set(), set()
        for k in {len(w) for _, w in wanted}:
            places = {}
            for i in range(len(found) - k + 1):
                places.setdefault(tuple(found[i : i + k]), []).append(i)
            for item_id, w in wanted:
                if len(w) == k and w in places:
                    ids |= {str(item_id)} - {"None"}
                    hit |= {i + j for i in places[w] for j in range(k)}
        out.append((doc_id, len(found), len(hit), sorted(ids), len(hit) > 0 and share * len(hit) >= len(found)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.collect()), key=str)


def hostile():
    random.seed(4)
    vocabulary = ["a", "B", "the", "é", "x1", "of", "dog", "Ünder"]
    text = lambda n: [random.choice(vocabulary) for _ in range(n)]
    items = [" ".join(text(n)) for n in (1, 2, 4, 5, 12, 13, 14, 30, 30, 60)]
    docs = []
    for item in items:
        found = item.split()
        for low, high in ((0, 13), (3, 16), (0, 60), (len(found) - 13, len(found)), (0, 12)):
            inner = found[max(low, 0) : high]
            docs.append("; ".join([*text(random.randrange(30)), *inner, *text(random.randrange(30))]))
            docs.append("-".join(inner).upper())
    docs += [None, "", "?!", " ".join(items * 3), " ".join(text(4000))]
    return docs, [(i, t) for i, t in enumerate(items)] + [(3, items[7]), (99, items[7]), (50, None), (51, "..."), (None, "dog dog dog dog dog")]


@pytest.mark.parametrize("window", [13, 4])
def test_equals_search(spark, window):
    texts, items = hostile()
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    docs = with_clashes(table(spark, texts)).repartition(4)
    assert got(contamination(docs, benchmark, window)) == expected(list(enumerate(texts)), items, window)


def test_repeated_rows_keep_their_results(spark):
    texts = ["one two three", "one two three", "one two three four", None]
    items = [(1, "one two three"), (1, "one two three"), (2, "three four")]
    ids = [5, 5, None, None]
    found = contamination(table(spark, texts, ids), spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == expected(list(zip(ids, texts, strict=True)), items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(empty(spark), none).count() == 0
    assert got(contamination(table(spark, ["a b"]), none)) == [(0, 2, 0, [], False)]


def test_given_documents(spark):
    docs, benchmark = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    rows, items = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()]
    result = got(contamination(docs, benchmark))
    assert result == expected(rows, items)
    assert any(row[-1] for row in result)
