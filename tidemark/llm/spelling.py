"""Spelling variants of words: pairs one edit apart, found by dense prefix and suffix tiles.

Two words are near if one code point inserted, deleted or replaced makes one the other. That is the
case exactly if their common prefix and common suffix together reach the longer length less one.

1. `word_counts` folds whole texts to distinct words with their occurrences, inside each task first.
2. `_keyed`: cut into four parts, two near words agree in all but one, so they meet under the key of the
   rest. A word is keyed for its own length and, as the longer of a pair, for one less: eight small rows.
   Keys that one word alone has end here.
3. A key of very many words is dealt to blocks, and each pair of blocks is a tile of its own, so no
   task gets more than two blocks of one key.
4. `_near_in_tiles` lays a tile's words out as padded matrices of code points, from the left and from
   the right, and compares block with block.
5. A word's form is its most frequent near word where that is frequent enough; `_roots` follows forms
   to the last by doubling. Counts grow by `ratio` from form to form, so that takes few rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import Block, Words, blocks, small_batches, word_hashes
from tidemark.sources.files import scratch_path, snapshot

#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 150_000
#: Words of one key that one block holds; a tile has two blocks.
BLOCK_WORDS = 2048
#: Words of a dense comparison on each side, and its cells at once.
SIDE, CELLS = 64, 1 << 21
PARTS = 4

_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8, and of no other character
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(97, 123), _LEAD]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def letter_runs(block: Block) -> tuple[Words, np.ndarray]:
    """Maximal runs of `[a-z\\u00C0-\\u00FF]` in the rows of a lower-cased block, and their code points."""
    data, lead = block.data, block.data == _LEAD
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _LETTERS[data]
    inside[2:-1] |= lead[:-1]
    filled = block.bounds[:-1] < block.bounds[1:]
    before, after = inside[:-2].copy(), inside[2:].copy()
    before[block.bounds[:-1][filled]] = False
    after[block.bounds[1:][filled] - 1] = False
    starts = np.flatnonzero(inside[1:-1] & ~before)
    ends = np.flatnonzero(inside[1:-1] & ~after) + 1
    leads = np.concatenate([[0], np.cumsum(lead)])
    return Words(starts, ends, np.searchsorted(starts, block.bounds)), ends - starts - (leads[ends] - leads[starts])


def _checksums(block: Block, words: Words, seeds: np.ndarray) -> np.ndarray:
    """crc32 of each word's bytes, carried on from a checksum."""
    sizes = words.ends - words.starts
    order = np.argsort(-sizes, kind="stable")
    state, starts = ~seeds[order], words.starts[order]
    active = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")
    for at, count in enumerate(active.tolist()):
        head = state[:count]
        state[:count] = _CRC[(head ^ block.data[starts[:count] + at]) & np.uint32(0xFF)] ^ (head >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = ~state
    return out


def word_counts(docs: DataFrame, least: int = 7, drop_period: int = 0) -> DataFrame:
    """word, n: occurrences of every word of `least` code points or more in the texts of docs (doc_id, text).

    Words are maximal runs of `[A-Za-z\\u00C0-\\u00FF]` with A-Z lower-cased. With `drop_period` p, a word whose
    crc32 of "<doc_id>:<word>" p divides loses the code point at that number modulo its length, which
    plants misspellings repeatably; a null doc_id is written as nothing. Null texts have no words.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def found(batch: pa.RecordBatch, table: dict[str, int]) -> None:
        for block in blocks(batch.column("text"), lower=True):
            words, points = letter_runs(block)
            wide = np.flatnonzero(points >= least)
            rows = words.rows()[wide]
            words, points = Words(words.starts[wide], words.ends[wide], np.zeros(0, np.int64)), points[wide]
            data, plain = block.data.tobytes(), np.ones(len(wide), bool)
            if drop_period and len(wide):
                ids = batch.column("doc_id").slice(block.first, block.rows).to_pylist()
                seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
                sums = _checksums(block, words, seeds[rows])
                plain = sums % np.uint32(drop_period) != 0
                for at in np.flatnonzero(~plain).tolist():
                    if points[at] > least:
                        word, place = data[words.starts[at] : words.ends[at]].decode(), int(sums[at]) % int(points[at])
                        word = word[:place] + word[place + 1 :]
                        table[word] = table.get(word, 0) + 1
                words = Words(words.starts[plain], words.ends[plain], words.at)
            _, first, counts = np.unique(word_hashes(block, words), return_index=True, return_counts=True)
            spans = zip(words.starts[first].tolist(), words.ends[first].tolist(), counts.tolist(), strict=True)
            for start, end, count in spans:
                word = data[start:end].decode()
                table[word] = table.get(word, 0) + count

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, int] = {}
        pack = lambda: pa.RecordBatch.from_pydict(
            {"word": pa.array(table.keys(), pa.string()), "n": pa.array(table.values(), pa.int64())}
        )
        for batch in batches:
            found(batch, table)
            if len(table) > COUNTED_WORDS:
                yield pack()
                table.clear()
        yield pack()

    return docs.mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _keyed(words: DataFrame) -> DataFrame:
    """key, size, word, n: one row for each part that may differ, and for each length of the shorter word."""
    length = F.length("word")
    keys = []
    for less in (0, 1):
        size = length - less
        for part in range(PARTS):
            begin, end = F.floor(size * part / PARTS).cast("int"), F.floor(size * (part + 1) / PARTS).cast("int")
            tail = size - end
            rest = F.xxhash64(
                F.lit(part), size, F.col("word").substr(F.lit(1), begin), F.col("word").substr(length - tail + 1, tail)
            )
            keys.append(F.struct(rest.alias("key"), size.alias("size")))
    return words.select("word", "n", F.explode(F.array(*keys)).alias("k")).select("k.key", "k.size", "word", "n")


def _tiles(keyed: DataFrame, block_words: int) -> DataFrame:
    """key, size, tile, words: the words (word, n, block) of a key, in tiles of two blocks at most."""
    held = keyed.groupBy("key", "size").agg(F.count("*").alias("held")).filter("held > 1")
    hashed = lambda df: df.withColumn("_h", F.xxhash64("key", "size"))
    rows = hashed(keyed).join(hashed(held), ["key", "size", "_h"])
    parts = F.ceil(F.col("held") / block_words).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    pair = lambda other: F.concat_ws("-", F.least(F.col("block"), other), F.greatest(F.col("block"), other))
    rows = rows.withColumn("tile", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), pair)))
    return rows.groupBy("key", "size", "tile").agg(F.collect_list(F.struct("word", "n", "block")).alias("words"))


class _Points:
    """The code points of many words, laid out as padded matrices from the left or from the right."""

    def __init__(self, words: list[str]) -> None:
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)

    def common(self, a: np.ndarray, b: np.ndarray, mirrored: bool) -> np.ndarray:
        """(k, g, h): code points that words a (k, g) and b (k, h) have in common at that end."""
        width = int(max(self.sizes[a].max(), self.sizes[b].max()))
        a, b = self._matrix(a, width, mirrored), self._matrix(b, width, mirrored)
        differ = a[:, :, None, :] != b[:, None, :, :]
        return np.where(differ.any(-1), differ.argmax(-1), width)

    def _matrix(self, words: np.ndarray, width: int, mirrored: bool) -> np.ndarray:
        place, sizes = np.arange(width), self.sizes[words][..., None]
        at = self.ends[words][..., None] - 1 - place if mirrored else self.ends[words][..., None] - sizes + place
        return np.where(place < sizes, self.data[np.clip(at, 0, len(self.data) - 1)], np.uint32(0))

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(k, g, h): which words of a and b are one edit apart."""
        n, m = self.sizes[a][:, :, None], self.sizes[b][:, None, :]
        least = np.minimum(n, m)
        same = np.minimum(self.common(a, b, False), least) + np.minimum(self.common(a, b, True), least)
        return (np.abs(n - m) <= 1) & (same >= np.maximum(n, m) - 1)


def _block_pairs(starts: np.ndarray, sizes: np.ndarray, widths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(k, g) and (k, h) word numbers whose comparisons cover every pair inside each group.

    Groups of the same size and of like word lengths are stacked; large ones are compared block by block.
    """
    order = np.lexsort((widths, sizes))
    order = order[sizes[order] > 1]
    while len(order):
        size, width = int(sizes[order[0]]), max(8, int(widths[order[0]]))
        side = min(size, SIDE)
        many = max(1, CELLS // (side * side * width))
        alike = (sizes[order[:many]] == size) & (widths[order[:many]] <= 2 * width)
        taken = int(alike.argmin()) if not alike.all() else len(alike)
        some, order = starts[order[:taken]][:, None], order[taken:]
        cuts = [(a, min(a + SIDE, size)) for a in range(0, size, SIDE)]
        for i, a in enumerate(cuts):
            for b in cuts[i:]:
                yield some + np.arange(*a), some + np.arange(*b)


def _near_in_tiles(tiles: DataFrame) -> DataFrame:
    """word, other, other_n in both directions; a pair comes once for each key that it shares."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            items, sizes = lists.flatten(), lists.value_lengths().to_numpy()
            words, counts, block = items.field("word"), items.field("n").to_numpy(), items.field("block").to_numpy()
            points = _Points(words.to_pylist())
            starts = np.cumsum(sizes) - sizes
            shorter = np.repeat(batch.column("size").to_numpy(), sizes)
            tile = np.repeat(np.array(["-" in t and t.split("-")[0] != t.split("-")[1] for t in batch.column("tile").to_pylist()], bool), sizes)
            widths = np.maximum.reduceat(points.sizes, starts) if len(starts) else starts
            left, right = [], []
            for a, b in _block_pairs(starts, sizes, widths):
                near = points.near(a, b)
                k, g, h = np.nonzero(near)
                left.append(a[k, g])
                right.append(b[k, h])
            a, b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (left, right))
            # Both longer than the key's length: another key's work. One block of a tile of two: another tile's.
            fits = (a != b) & (np.minimum(points.sizes[a], points.sizes[b]) == shorter[a]) & (~tile[a] | (block[a] != block[b]))
            a, b = a[fits], b[fits]
            yield pa.RecordBatch.from_arrays(
                [words.take(np.concatenate([a, b])), words.take(np.concatenate([b, a])), pa.array(counts[np.concatenate([b, a])])],
                ["word", "other", "other_n"],
            )

    return tiles.mapInArrow(rows, "word string, other string, other_n long").distinct()


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """word, root for rows (word, form): the last word that forms lead to. Chains must not be circles."""
    state, round_ = snapshot(forms.select("word", F.col("form").alias("root")), f"{folder}/roots-0"), 0
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = state.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        round_ += 1
        joined = snapshot(joined, f"{folder}/roots-{round_}")
        if joined.filter("further is not null").isEmpty():
            return joined.select("word", "root")
        state = joined.select("word", "root")


def spelling_variants(counts: DataFrame, ratio: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of counts (word, n); words are distinct.

    n_near counts the words one edit away. form is the near word of the largest n (ties: the smallest in
    code-point order) if that n, form_n, is `ratio` times the word's or more, else null. root is where
    forms lead from the word in the end, the word itself without a form.

    Null words are left out, an empty word is a word, other columns are ignored, an empty table gives no
    rows. `ratio` is 2 at least, so that forms form no circle.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    folder = scratch_path(counts.sparkSession, "spelling")
    words = counts.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")).filter("word is not null")
    words = snapshot(words, f"{folder}/words")
    near = _near_in_tiles(_tiles(_keyed(words), block_words)).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    form = (-F.col("best.less") >= ratio * F.col("n")) & (F.col("n") > 0)
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form, F.col("best.other")).alias("form"),
        F.when(form, -F.col("best.less")).alias("form_n"),
    )
    found = snapshot(found, f"{folder}/found")
    roots = _roots(found.filter("form is not null"), folder)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
