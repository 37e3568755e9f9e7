"""Spelling variants against all pairs of words, and against SQL."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import oracle
from tests.llm.fixtures import LARGER, SMALL, empty, table, with_clashes
from tidemark.llm import catalog, spelling
from tidemark.llm.spelling import _checksums, letter_runs, spelling_variants, word_counts
from tidemark.llm.words import blocks


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v.encode("utf-32-be")), default=None)
        if best is not None and counts[best] >= ratio * counts[word]:
            form[word] = best
    rows = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n, len(near[word]), counts[form[word]] if word in form else None))
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def vocabulary(seed, letters, sizes, many):
    random.seed(seed)
    return {"".join(random.choice(letters) for _ in range(random.choice(sizes))): random.choice((2, 3, 20, 30, 300, 4000)) for _ in range(many)}


@pytest.mark.parametrize(("letters", "sizes", "many"), [("ab", (7, 8, 9), 400), ("aéß𝒳", (1, 2, 3, 4), 200), ("abcd", (5, 6, 12), 500)])
def test_equals_all_pairs(spark, letters, sizes, many):
    counts = vocabulary(1, letters, sizes, many)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").withColumns({"key": F.lit(1), "size": F.lit("s"), "tile": F.lit(0)})
    assert got(spelling_variants(df.repartition(3))) == expected(counts)


def test_key_of_many_words_is_tiled(spark, monkeypatch):
    """Blocks of few words, and dense comparisons smaller than a tile."""
    monkeypatch.setattr(spelling, "SIDE", 5)
    monkeypatch.setattr(spelling, "CELLS", 900)
    counts = {f"prefix{a}{b}": random.choice((2, 30, 400)) for a in "abcdefghijklmnopqrs" for b in "abcdefghijklmnopqrst"}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling_variants(df, block_words=20)) == expected(counts)


def test_long_words_chains_and_ties(spark):
    long = "z" * 40_000
    counts = {long: 2, long + "y": 50, "y" + long: 50, "abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "abcdefghij": 1000, "bcdefghij": 100, "": 1, "q": 10}
    df = spark.createDataFrame([*counts.items(), (None, 9)], "word string, n long")
    rows = got(spelling_variants(df))
    assert rows == expected(counts)
    assert {r[0]: r[2] for r in rows}["abcdefg"] == "abcdefghij"
    with pytest.raises(ValueError):
        spelling_variants(df, ratio=1)


def runs(text):
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), r) for r in re.findall("[A-Za-zÀ-ÿ]+", text or "")]
    return [r for r in low if len(r) >= 7]


def counted(rows, period):
    found = Counter()
    for doc_id, text in rows:
        for run in runs(text):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if period and h % period == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= 7
    return +found


@pytest.mark.parametrize("period", [0, 1, 3, 31])
def test_counts_equal_a_plain_loop(spark, monkeypatch, period):
    monkeypatch.setattr(spelling, "COUNTED_WORDS", 20)
    random.seed(6)
    letters = "aBzÀÿ×÷éœ’-_ \n0"
    texts = ["".join(random.choice(letters[: random.choice((9, 15))]) for _ in range(random.choice((5, 60, 900)))) for _ in range(120)]
    texts += [None, "", "ÀÀÀÀÀÀÀ", "x" * 300_000, "Straßenbahn STRASSENBAHN straßenbahn", "àbcdefgh", "漢字漢字漢字漢字", "tail éééééééé"]
    ids = [random.choice((None, -5, i, 10**15)) for i in range(len(texts))]
    df = word_counts(with_clashes(table(spark, texts, ids)).repartition(3), 7, period)
    assert {r.word: r.n for r in df.collect()} == counted(zip(ids, texts, strict=True), period)


def test_checksums():
    import pyarrow as pa

    text = "abc é zzzzzzzz"
    block = next(blocks(pa.array([text])))
    words, points = letter_runs(block)
    sums = _checksums(block, words, np.array([zlib.crc32(b"12:")] * 3, np.uint32))
    assert sums.tolist() == [zlib.crc32(f"12:{w}".encode()) for w in text.split()] and points.tolist() == [3, 1, 8]


def test_no_rows(spark):
    assert got(spelling_variants(word_counts(empty(spark)))) == []


@pytest.mark.parametrize("folder", [SMALL, LARGER])
def test_query_equals_sql(spark, folder):
    with oracle.connect(folder) as duck:
        rows = duck.execute(f"select word, form, root, n, n_near, form_n from ({catalog.OP13_SQL})").fetchall()
    assert got(catalog.op13_spelling_variants(spark, folder)) == sorted(rows)
