"""Words, word hashes and word windows of many texts at once, on the bytes of an Arrow column.

All functions work on a `Block`: the UTF-8 bytes of consecutive rows and the row boundaries in
them. Words are maximal runs of bytes of a given class and never cross a row. Hashes have 64
bits and depend on the bytes of the words only, so they agree between tasks and runs.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows are worked on in blocks of about this many bytes; one longer row is a block of its own.
#: A block's arrays of numbers take some hundred times as much.
BLOCK_BYTES = 1 << 18

#: Texts reach Python in batches of at most about this many bytes, or of one row.
BATCH_BYTES = 4 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def small_batches(docs: DataFrame) -> DataFrame:
    """The same rows, in a session whose batches for Python have at most `BATCH_BYTES`.

    A batch is held by the executor and by its Python worker at once, so this bounds what long texts take.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(rows: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The batch function `rows`, before and after which the worker gives freed memory back.

    Workers serve one task after the other, and what the one before has freed would else stay with them.
    """

    @functools.wraps(rows)
    def run(batches: Iterator) -> Iterator:
        _give_back()
        yield from rows(batches)
        _give_back()

    return run


def byte_class(pattern_bytes: bytes, inverted: bool = False) -> np.ndarray:
    """Table of 256 booleans: which bytes belong to words."""
    table = np.zeros(256, bool)
    table[np.frombuffer(pattern_bytes, np.uint8)] = True
    return ~table if inverted else table


#: `[^\x20\x09-\x0D]+`
NOT_SPACE = byte_class(b" \t\n\x0b\x0c\r", inverted=True)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after lower-casing A-Z
ALPHANUMERIC = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Block:
    """Rows `first` to `first + len(bounds) - 1` of a batch; null texts are empty."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Start and end bytes of the block's words; row r has words `at[r]` to `at[r + 1]`."""

    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.counts)


def blocks(texts: pa.Array, lower: bool = False, size: int | None = None) -> Iterator[Block]:
    """Cut a string column into blocks of whole rows, of about `size` bytes."""
    size = size or BLOCK_BYTES
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        part = data[offsets[row] : offsets[end]]
        yield Block(row, LOWER[part] if lower else part, offsets[row : end + 1] - offsets[row])
        row = end


def find_words(block: Block, letters: np.ndarray) -> Words:
    inside = np.zeros(len(block.data) + 2, bool)
    inside[1:-1] = letters[block.data]
    filled = block.bounds[:-1] < block.bounds[1:]
    before, after = inside[:-2].copy(), inside[2:].copy()
    before[block.bounds[:-1][filled]] = False
    after[block.bounds[1:][filled] - 1] = False
    starts = np.flatnonzero(inside[1:-1] & ~before)
    ends = np.flatnonzero(inside[1:-1] & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, block.bounds))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < size:
        size = max(size, BLOCK_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers = tables[0], tables[1]
    return _powers


def word_hashes(block: Block, words: Words) -> np.ndarray:
    """A polynomial in the word's bytes, taken from running sums, then mixed."""
    powers, inverses = _power_tables(len(block.data) + 1)
    sums = np.zeros(len(block.data) + 1, np.uint64)
    np.cumsum((block.data + np.uint64(1)) * powers[: len(block.data)], out=sums[1:])
    return mix((sums[words.ends] - sums[words.starts]) * inverses[words.starts])


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of `size` neighbouring words, row borders not regarded."""
    count = max(0, len(hashes) - size + 1)
    folded = np.full(count, size, np.uint64)
    for shift in range(size):
        folded = folded * np.uint64(0xD6E8FEB86659FD93) + hashes[shift : shift + count]
    return mix(folded)


def windows_inside(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, row) of each window that lies in one row."""
    counts = np.maximum(words.counts - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    skipped = np.cumsum(counts) - counts
    return np.arange(len(rows)) - skipped[rows] + words.at[:-1][rows], rows


def shingle_sets(block: Block, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingles of each row of a lower-cased block.

    A row of fewer words than `size`, but not none, has its whole word sequence as the only
    shingle; a row without words has none.
    """
    words = find_words(block, NOT_SPACE)
    hashes = word_hashes(block, words)
    first, rows = windows_inside(words, size)
    values = window_hashes(hashes, size)[first]
    few = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(few):
        whole = [window_hashes(hashes[words.at[r] : words.at[r + 1]], int(words.counts[r]))[0] for r in few]
        values, rows = np.concatenate([values, np.array(whole, np.uint64)]), np.concatenate([rows, few])
        order = np.argsort(rows, kind="stable")
        values, rows = values[order], rows[order]
    bounds = np.searchsorted(rows, np.arange(block.rows + 1))
    kept = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    sizes = np.array([len(k) for k in kept], np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *kept]), np.concatenate([[0], np.cumsum(sizes)])
