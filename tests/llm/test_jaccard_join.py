"""Components of near copies against all pairs of sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import SMALL, empty, near_copies, table, with_clashes
from tidemark.llm import jaccard_join
from tidemark.llm.components import connected_components
from tidemark.llm.jaccard_join import jaccard_components


def shingles(text, size):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if 0 < len(found) < size:
        return {tuple(found)}
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(rows, size=5, percent=80):
    sets = [shingles(text, size) for _, text in rows]
    edges = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = roots(range(len(rows)), edges)
    ids = {}
    for at, (doc_id, _) in enumerate(rows):
        ids.setdefault(root[at], []).append(doc_id)
    smallest = {r: min((i for i in found if i is not None), default=None) for r, found in ids.items()}
    return sorted((str(d), len(sets[at]), str(smallest[root[at]])) for at, (d, _) in enumerate(rows))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


@pytest.mark.parametrize(("size", "percent"), [(5, 80), (3, 60), (5, 100)])
def test_equals_all_pairs(spark, size, percent):
    texts = near_copies() + [None, None]
    random.seed(1)
    ids = random.sample(range(1000), len(texts))
    docs = with_clashes(table(spark, texts, ids)).repartition(5)
    assert got(jaccard_components(docs, size, percent)) == expected(list(zip(ids, texts, strict=True)), size, percent)


def test_large_group_of_near_copies(spark, monkeypatch):
    """Copies with few and with many changes: some link only through others, some not at all."""
    monkeypatch.setattr(jaccard_join, "FRAGMENT_SHINGLES", 500)
    random.seed(5)
    original = [f"v{i}" for i in range(90)]
    texts = []
    for _ in range(250):
        copy = list(original)
        for _ in range(random.randrange(6)):
            copy[random.randrange(90)] = f"x{random.randrange(40)}"
        texts.append(" ".join(copy))
    assert got(jaccard_components(table(spark, texts))) == expected(list(enumerate(texts)))


def classes_of(docs, size=5):
    stats = jaccard_join.shingle_stats(docs.select("doc_id", "text"), size).filter("n_shingles > 0")
    classes = stats.groupBy("n_shingles", "sig_a").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    return classes.select(F.col("sig_a").alias("name"), F.col("n_shingles").alias("n"), "rep", "copies").cache()


def segments(docs, bits=4, percent=80):
    """(shingles that are shuffled, rows that the fragments' counts make)"""
    docs = docs.select("doc_id", "text")
    classes = classes_of(docs)
    once = jaccard_join._Once(classes, docs.count())
    cut = jaccard_join._segments(docs, 5, bits, percent, once).cache()
    counts = cut.groupBy("fragment").applyInArrow(jaccard_join._count_shared, "name long, shared long")
    return cut.agg(F.sum(F.octet_length("shingles") / 4)).first()[0], counts.count()


def test_rows_do_not_grow_with_fragments_nor_shingles_with_copies(spark):
    random.seed(11)
    passage = [f"p{i}" for i in range(50)]
    texts = [" ".join([*(f"w{i}x{j}" for j in range(150)), *passage, *(f"w{i}y{j}" for j in range(100))]) for i in range(300)]
    docs = table(spark, texts).repartition(6)
    assert segments(docs, bits=4) == segments(docs, bits=10)
    one = " ".join(f"v{i}" for i in range(400))
    single, copies = table(spark, [one]), table(spark, [one] * 20_000).repartition(8)
    assert segments(copies)[0] == segments(single)[0] == jaccard_join.prefix_sizes(np.array([396]), 80)[0]
    assert segments(docs.union(copies.withColumn("doc_id", F.col("doc_id") + 1000)))[1] == segments(docs)[1]


def test_prefixes_of_linked_sets_have_enough_in_common():
    """All sizes and all places of the common elements that are worst for the prefixes."""
    for percent in (60, 80, 90, 100):
        for n in range(1, 130):
            for m in range(n, n * 100 // percent + 2):
                least = -(-(n + m) * percent // (100 + percent))
                if least > n:
                    continue
                first = [int(jaccard_join.prefix_sizes(np.array([x]), percent)[0]) - (x - least) for x in (n, m)]
                assert min(first) >= max(int(jaccard_join.least_shared(np.array([x]), percent)[0]) for x in (n, m)), (percent, n, m)


def test_passage_that_many_components_share(spark):
    """A shingle of very many components that the bounds don't rule out: no pair is lost."""
    random.seed(12)
    passage = [f"p{i}" for i in range(20)]
    texts = []
    for i in range(60):
        base = [*passage, *(f"w{i}x{j}" for j in range(70))]
        texts += [" ".join(base), " ".join([*base, "tail"])]
    assert got(jaccard_components(table(spark, texts))) == expected(list(enumerate(texts)))


def test_repeated_rows_and_null_ids(spark):
    texts = ["a b c d e f g", "a b c d e f g", "a b c d e f g", "k", "k", None, "a b c d e f g", "o p q r s t", "k"]
    ids = [4, 4, None, None, None, 7, 2, None, None]
    assert got(jaccard_components(table(spark, texts, ids))) == expected(list(zip(ids, texts, strict=True)))


def test_no_rows(spark):
    df = jaccard_components(empty(spark))
    assert df.columns == ["doc_id", "n_shingles", "component_id"] and df.count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(jaccard_components(docs)) == expected(rows)


def test_components_equal_union_find(spark):
    random.seed(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = chain + [(random.randrange(90), random.randrange(90)) for _ in range(60)] + [(3, 3), (300, 301), (301, 300)]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    df = connected_components(spark.createDataFrame(edges + [(None, 1)], "a long, b long"))
    assert {r.node: r.root for r in df.collect()} == roots(nodes, [e for e in edges if e[0] != e[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
