"""Statistics and words of blocks against a plain loop over each text."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixtures import near_copies
from tidemark.llm import statistics, words


def expected(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, copied = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copied += line in seen
            seen.add(line)
    windows = list(zip(found, found[1:], found[2:], strict=False))
    times = Counter(windows)
    repeated = {at + k for at, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return {
        "n_words": len(found),
        "n_chars": len(text),
        "word_chars": sum(map(len, found)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": copied,
        "n_repeat_words": len(repeated),
        "n_distinct": len(set(found)),
        "n_top_word": max(Counter(found).values(), default=0),
    }


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_statistics_equal_a_plain_loop(monkeypatch, size):
    monkeypatch.setattr(words, "BLOCK_BYTES", size)
    random.seed(3)
    alphabet = "ab A\n\t.é!#\r\x0b1ß😀"
    texts = ["".join(random.choices(alphabet, k=random.choice((0, 1, 5, 40, 300)))) for _ in range(300)]
    texts += [None, "", "\n\n", "a a a a\na a a a\n\n b", "a b c a b c", "x", *near_copies()]
    rows = 0
    for block in words.blocks(pa.array(texts)):
        got = statistics.text_statistics(block)
        for row in range(block.rows):
            for name, value in expected(texts[block.first + row] or "").items():
                assert got[name][row] == value, (name, texts[block.first + row])
        rows += block.rows
    assert rows == len(texts)


def test_blocks_of_a_slice_and_of_no_rows():
    texts = pa.array(["a", "bb", None, "ccc dd"])
    (block,) = words.blocks(texts.slice(1, 3))
    assert block.bounds.tolist() == [0, 2, 2, 8]
    assert list(words.blocks(pa.array([], pa.string()))) == []


def test_hashes_do_not_depend_on_the_place():
    (block,) = words.blocks(pa.array(["one two", "x two one", "two"]))
    found = words.find_words(block, words.NOT_SPACE)
    hashes = words.word_hashes(block, found)
    assert hashes[0] == hashes[4] and hashes[1] == hashes[3] == hashes[5]
    assert len(np.unique(hashes)) == 3
