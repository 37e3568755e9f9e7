"""Statistics of whole texts, computed for a block of rows at once.

Ratios of a text without words or characters are 0. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import (
    NOT_SPACE,
    Block,
    Words,
    blocks,
    find_words,
    mix,
    small_batches,
    window_hashes,
    windows_inside,
    word_hashes,
)


def _class(characters: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[np.frombuffer(characters, np.uint8)] = 1
    return table


_FIRST_BYTE = np.ones(256, np.int64)
_FIRST_BYTE[0x80:0xC0] = 0
_UPPER = _class(bytes(range(65, 91)))
_LOWER = _class(bytes(range(97, 123)))
_DIGIT = _class(bytes(range(48, 58)))
_SYMBOL = _class(b"#*$%&|<>")
_MARK = _class(b".,;:!?")
_BANG = _class(b"!")
_WIDE = _class(bytes(range(0xC0, 0x100)))
_LETTER = _UPPER + _LOWER + _class(bytes(range(0x80, 0x100)))


def running(values: np.ndarray) -> np.ndarray:
    """Sums of everything before each place; differences of them are sums of spans."""
    return np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])


def _per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = running(values)
    return total[at[1:]] - total[at[:-1]]


def _in_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that are equal only for equal rows too."""
    return mix(hashes + mix(rows.astype(np.uint64) + np.uint64(1)))


def repeated_words(hashes: np.ndarray, words: Words, size: int = 3) -> np.ndarray:
    """Which words lie in a window of `size` words that its row holds twice or more."""
    first, rows = windows_inside(words, size)
    keys = _in_row(window_hashes(hashes, size)[first], rows)
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = first[times[which] > 1]
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, again, 1)
    np.add.at(steps, again + size, -1)
    return np.cumsum(steps)[:-1] > 0


def line_counts(block: Block, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those equal to an earlier line of the row), split at \\n only."""
    breaks = np.flatnonzero(block.data == 10)
    begins = np.unique(np.concatenate([block.bounds[:-1], breaks + 1, block.bounds[-1:]]))
    begins = begins[begins < len(block.data)]
    ends = np.concatenate([begins[1:], [len(block.data)]]).astype(np.int64)[: len(begins)]
    ends = ends - ((ends > begins) & (block.data[np.maximum(ends, 1) - 1] == 10)) if len(begins) else ends
    used = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, begins)
    lines = Words(begins[used], ends[used], np.zeros(1, np.int64))
    rows = np.searchsorted(block.bounds, lines.starts, "right") - 1
    keys = _in_row(word_hashes(block, lines), rows)
    _, first = np.unique(keys, return_index=True)
    counts = np.bincount(rows, minlength=block.rows)
    return counts, counts - np.bincount(rows[first], minlength=block.rows)


def text_statistics(block: Block) -> dict[str, np.ndarray]:
    """name: one number for each row. The counts are whole numbers."""
    data, bounds = block.data, block.bounds
    words = find_words(block, NOT_SPACE)
    hashes, rows, n = word_hashes(block, words), words.rows(), words.counts
    out: dict[str, np.ndarray] = {"n_words": n}

    first_bytes = running(_FIRST_BYTE[data])
    lengths = first_bytes[words.ends] - first_bytes[words.starts]
    out["n_chars"] = first_bytes[bounds[1:]] - first_bytes[bounds[:-1]]
    out["word_chars"] = _per_row(lengths, words.at)
    for name, table in (
        ("n_upper", _UPPER),
        ("n_lower", _LOWER),
        ("n_digits", _DIGIT),
        ("n_symbols", _SYMBOL),
        ("n_marks", _MARK),
        ("n_bangs", _BANG),
        ("n_wide", _WIDE),
    ):
        out[name] = _per_row(table[data], bounds)
    out["n_lines"], out["n_dup_lines"] = line_counts(block, words)
    out["n_repeat_words"] = _per_row(repeated_words(hashes, words).astype(np.int64), words.at)

    keys = _in_row(hashes, rows)
    _, at, times = np.unique(keys, return_index=True, return_counts=True)
    out["n_distinct"] = np.bincount(rows[at], minlength=block.rows)
    top = np.zeros(block.rows, np.int64)
    np.maximum.at(top, rows[at], times)
    out["n_top_word"] = top
    upper, lower, letters = (running(t[data]) for t in (_UPPER, _LOWER, _LETTER))
    spans = lambda total: total[words.ends] - total[words.starts]
    out["n_caps_words"] = _per_row(((spans(upper) > 1) & (spans(lower) == 0)).astype(np.int64), words.at)
    out["n_odd_words"] = _per_row((spans(letters) == 0).astype(np.int64), words.at)
    out["n_short_words"] = _per_row((lengths <= 3).astype(np.int64), words.at)
    out["n_long_words"] = _per_row((lengths >= 12).astype(np.int64), words.at)
    return out


COUNTS = (
    "n_words n_chars word_chars n_upper n_lower n_digits n_symbols n_marks n_bangs n_wide n_lines "
    "n_dup_lines n_repeat_words n_distinct n_top_word n_caps_words n_odd_words n_short_words n_long_words"
).split()


def row_features(
    docs: DataFrame, columns: dict[str, str], compute: Callable[[Block], dict[str, np.ndarray]], lower: bool = False
) -> DataFrame:
    """doc_id and the computed columns (name: Spark type) for every row of docs (doc_id, text)."""
    kinds = {"long": np.int64, "double": np.float64}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), lower):
                found = compute(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        *(pa.array(found[name].astype(kinds[kind])) for name, kind in columns.items()),
                    ],
                    ["doc_id", *columns],
                )

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        rows, ", ".join(["doc_id long", *(f"{name} {kind}" for name, kind in columns.items())])
    )


def count_table(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS for every row."""
    return row_features(docs, dict.fromkeys(COUNTS, "long"), text_statistics)


def ratios(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Shares between 0 and about 1 from the counts, and log sizes."""
    c = {name: counts[name].astype(float) for name in COUNTS}
    per = lambda name, base: c[name] / np.maximum(c[base], 1)
    return {
        "log_words": np.log1p(c["n_words"]),
        "word_length": np.log1p(per("word_chars", "n_words")),
        "upper": per("n_upper", "word_chars"),
        "digits": per("n_digits", "word_chars"),
        "symbols": per("n_symbols", "word_chars"),
        "marks": per("n_marks", "n_words"),
        "bangs": per("n_bangs", "n_words"),
        "wide": per("n_wide", "word_chars"),
        "line_words": np.log1p(per("n_words", "n_lines")),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "distinct": per("n_distinct", "n_words"),
        "top_word": per("n_top_word", "n_words"),
        "caps_words": per("n_caps_words", "n_words"),
        "odd_words": per("n_odd_words", "n_words"),
        "short_words": per("n_short_words", "n_words"),
        "long_words": per("n_long_words", "n_words"),
    }
