"""The parser against a plain longest-match search, and held-out accuracy."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixtures import LARGER, empty, table, with_clashes
from tidemark.llm import catalog, language
from tidemark.llm.language import PIECE, identify, learn, letters_of
from tidemark.llm.words import blocks


def sample(spark, texts):
    return spark.createDataFrame(texts, "lang string, text string")


def phrases(symbols, text):
    """Greedy longest matches; a symbol that the sample lacks is a phrase of its own."""
    count, at = 0, 0
    while at < len(symbols):
        end = at + 1
        while end < len(symbols) and symbols[at : end + 1] in text:
            end += 1
        count, at = count + 1, end
    return count


def test_phrases_equal_longest_matches(spark):
    random.seed(6)
    sources = {"xx": "abcab bca ééa", "yy": "ddd cab zz"}
    parser = learn(sample(spark, list(sources.items())))
    texts = ["".join(random.choices("abcdzé qQÉ!", k=n)) for n in (1, 2, 30, 255, 256, 257, 900)]
    (block,) = blocks(pa.array(texts))
    symbols, bounds = letters_of(block)
    got = parser.phrases(symbols, bounds)
    for i, source in enumerate(sorted(sources)):
        (sample_block,) = blocks(pa.array([sources[source]]))
        text = letters_of(sample_block)[0].tobytes() + b"\0"
        for row in range(len(texts)):
            whole = symbols[bounds[row] : bounds[row + 1]].tobytes()
            expected = sum(max(1, phrases(whole[p : p + PIECE], text)) for p in range(0, len(whole), PIECE))
            assert got[i][row] == expected, (source, texts[row])


def test_texts_without_language(spark):
    parser = learn(sample(spark, [("en", "the cat sat on the mat"), ("de", "der hund und die katze"), (None, "zzz"), ("fr", None)]))
    assert parser.languages == ["de", "en"]
    texts = ["the mat", "und der hund", None, "", "123 !?", "的", "…", "THE CAT " * 5000]
    found = {r.doc_id: r for r in identify(with_clashes(table(spark, texts)), parser).collect()}
    assert [found[i].lang_pred for i in range(5)] == ["en", "de", "und", "und", "und"]
    assert found[5].lang_pred in parser.languages and found[6].lang_pred == "und" and found[7].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_nothing_learned_and_no_rows(spark):
    parser = learn(sample(spark, []))
    assert [tuple(r) for r in identify(table(spark, ["abc"]), parser).collect()] == [(0, "und", 0.0)]
    assert identify(empty(spark), parser).count() == 0


def test_repeated_rows(spark):
    parser = learn(sample(spark, [("en", "abc")]))
    assert identify(table(spark, ["abc", "abc", "b"], [1, 1, None]), parser).count() == 3


def test_held_out_accuracy(spark):
    found = catalog.op9_language_id(spark, LARGER)
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").toPandas()
    assert len(rows) == docs.count() and rows.held_out.any()
    held = rows[rows.held_out]
    assert np.mean(held.lang == held.lang_pred) > 0.98


def test_sample_is_bounded(spark):
    rows = [("en", f"text {i} " * 50) for i in range(3 * language.SAMPLE_ROWS)]
    parser = learn(sample(spark, rows))
    assert len(parser.tables(0).table) < 2 * language.SAMPLE_BYTES * 256


def test_copies_and_long_texts_leave_room_for_others(spark):
    words = [f"{a}{b}{c}" * 4 for a in "bcdf" for b in "aeio" for c in "lmnr"][: language.SAMPLE_ROWS - 2]
    rows = [("en", w) for w in words] + [("en", "xy " * 20_000), ("en", "yx " * 20_000)] + [("en", "copied " * 200)] * 500
    parser = learn(sample(spark, rows[:-500]))
    (block,) = blocks(pa.array(words))
    assert (parser.phrases(*letters_of(block))[0] == 1).all()
    parser = learn(sample(spark, rows[2:]))
    (block,) = blocks(pa.array(words[2:]))
    assert (parser.phrases(*letters_of(block))[0] == 1).sum() >= len(words) - 3


def test_shares():
    assert language.shares(np.array([100, 5, 50]), 60).tolist() == [28, 5, 27]
    assert language.shares(np.array([3, 4]), 60).tolist() == [3, 4]


@pytest.mark.parametrize("text", ["É", "ÀÉÎ", "straße"])
def test_capitals_of_accented_letters(text):
    (block,) = blocks(pa.array([text]))
    assert letters_of(block)[0].tobytes().decode() == text.lower()


def test_many_languages_are_parsed_in_groups(spark, monkeypatch):
    """500 labels: a task holds the tables of one group, and the groups' result is that of all at once."""
    monkeypatch.setattr(language, "SAMPLE_BYTES", 400)
    random.seed(9)
    words = {f"l{i:03}": ["".join(random.choices("abcdefghijkl", k=5)) for _ in range(12)] for i in range(500)}
    rows = [(name, " ".join(random.choices(own, k=40))) for name, own in words.items() for _ in range(2)]
    parser = learn(sample(spark, rows))
    assert len(parser.languages) == 500 and len(parser.groups) == -(-500 // language.GROUP)
    largest = max(parser.tables(n).table.nbytes for n in range(len(parser.groups)))
    # Twice as many states as letters, a cell of four bytes for each symbol.
    assert largest <= language.GROUP * 2 * 400 * 4 * 20
    chosen = sorted(words)[::25]
    texts = [" ".join(random.choices(words[name], k=30)) for name in chosen]
    found = {r.doc_id: r.lang_pred for r in identify(table(spark, texts), parser).collect()}
    assert [found[i] for i in range(len(texts))] == chosen


def test_pieces_rarely_change_the_winner(spark, monkeypatch):
    """Whole texts in one piece against pieces of 256 letters: the share of texts with another language."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    parser = learn(docs.filter("doc_id % 4 <> 2").select("lang", "text"))
    texts = docs.select("text").toPandas()["text"]
    texts = [t for t in texts if len(t) < 4000]
    (block,) = blocks(pa.array(texts), size=1 << 30)
    ((pieces, _, _),) = parser.decide([block])
    monkeypatch.setattr(language, "PIECE", 4096)
    ((whole, _, _),) = parser.decide([block])
    assert len(texts) > 700 and sum(a != b for a, b in zip(pieces, whole, strict=True)) <= len(texts) // 200
