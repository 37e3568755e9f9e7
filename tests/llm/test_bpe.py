"""Ids and decoded texts against the tokenizers library; the transducer against a dictionary."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import SMALL, empty, near_copies, table, with_clashes
from tidemark.llm import bpe, lexicon
from tidemark.llm.catalog import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def hostile():
    random.seed(1)
    alphabet = list("abcABC'stremvld019 .,!\n\t\r\x0b\x1c\x1f\u0085\u00a0\u3000éÉßİΣςσǅ①½٣中文😀é\u200b<|\x00")
    alphabet += ["<|endoftext|>", "<|startoftext|>", "n't", "'re", "Hello", "world"]
    texts = ["".join(random.choices(alphabet, k=random.choice((0, 1, 3, 20, 200)))) for _ in range(600)]
    return [*texts, *near_copies(), None, "", "a" * 20000, "<|endoftext|>" * 3, "x<|endoftext|>y", "ΟΔΟΣ"]


def test_equals_the_library(spark, library):
    texts = hostile()
    docs = with_clashes(table(spark, texts)).repartition(3)
    rows = bpe.decode(bpe.encode(docs, vocabulary_path(), lexicon_words=500), vocabulary_path()).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == ids, texts[row.doc_id]
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_given_documents(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in bpe.encode(docs, vocabulary_path()).collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode(texts[row.doc_id], add_special_tokens=False).ids


def test_empty_and_null(spark):
    assert bpe.encode(empty(spark), vocabulary_path()).count() == 0
    rows = bpe.encode(table(spark, [None, "", "a"], [None, 3, 3]), vocabulary_path())
    decoded = bpe.decode(rows.withColumn("ids", F.when(F.octet_length("ids") > 0, F.col("ids"))), vocabulary_path())
    assert sorted((r.doc_id or 0, r.decoded or "-") for r in decoded.collect()) == [(0, "-"), (3, "-"), (3, "a</w>")]


def test_frequent_words(spark):
    docs = table(spark, ["b a b", "B! c-a", None, "é"])
    assert bpe.frequent_words(docs, 4) == [b"a", b"b", b"c", "é".encode()]
    assert bpe.frequent_words(docs, 3) == [b"a", b"b"]
    assert bpe.frequent_words(docs, 0) == bpe.frequent_words(empty(spark), 9) == []


@pytest.mark.parametrize("count", [0, 1, 2, 3000])
def test_transducer_equals_a_dictionary(count):
    random.seed(count)
    words = {"".join(random.choices("abé-", k=random.randrange(1, 9))).encode(): [i, 7][: 1 + i % 2] for i in range(count)}
    compiled = lexicon.compile_lexicon(words)
    for found in (compiled, lexicon.mapped(lexicon.pack(compiled))):
        asked = [*words, b"", b"abab-unknown", b"zz", b"a" * 30]
        ranks = found.ranks(asked)
        got = [list(found.ids[found.at[r] : found.at[r + 1]]) if r >= 0 else None for r in ranks]
        assert got == [words.get(w) for w in asked]


def test_transducer_shares_suffixes():
    words = {f"{stem}{end}".encode(): [0] for stem in "abcdefgh" for end in ("ing", "ed", "s")}
    assert len(lexicon.compile_lexicon(words).final) < 12


def test_long_runs_of_letters_merge_in_short_time(library):
    import time

    with open(vocabulary_path(), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    random.seed(3)
    for text in ("".join(random.choices("etaoinshr", k=60_000)), "ab" * 30_000, "a" * 50_001, "é" * 999):
        begun = time.perf_counter()
        ids = vocabulary.merge(text)
        assert time.perf_counter() - begun < 10
        assert ids == library.encode(text, add_special_tokens=False).ids
