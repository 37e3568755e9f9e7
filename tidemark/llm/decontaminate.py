"""Benchmark decontamination as a prefix-filtered set join with exact windows.

A window is 13 consecutive words of a benchmark item (an item of fewer words is one window). A text
contains a window only if it contains all of its word shingles, so one shingle of each window, its
prefix under an order by rarity, is necessary. Rarity is the shingle's count in the texts, then in
the benchmark's windows, then its hash, which lets neighbouring windows pick the same shingle.

1. The benchmark is cut into distinct windows with their shingles.
2. One pass over the texts counts the benchmark's shingles in them (added up per batch before the
   shuffle); each window gets its rarest shingle as anchor.
3. A second pass looks for anchors. What it finds is joined with the windows on the anchor. Length
   and position bounds drop windows that would begin before the text or end after it; then the
   words themselves are compared.

Both passes skip positions with a Bloom filter of at most 8 MB. Only found positions are shuffled,
with the words around them; the benchmark is never broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bloom
from tidemark.llm.words import (
    ALPHANUMERIC,
    Block,
    Words,
    blocks,
    find_words,
    lean,
    mix,
    small_batches,
    window_hashes,
    windows_inside,
    word_hashes,
)
from tidemark.sources.files import scratch_path, snapshot

SHINGLE = 5
_BETWEEN = re.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _between(block: Block, words: Words, first: int, last: int) -> str:
    """The words `first` to `last - 1`, one space between."""
    raw = block.data[words.starts[first] : words.ends[last - 1]].tobytes()
    return _BETWEEN.sub(b" ", raw).decode("utf-8", "replace")


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, words, k, width, shingles: the windows of every item."""

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), lower=True):
                words = find_words(block, ALPHANUMERIC)
                hashes = word_hashes(block, words)
                out: list[list] = [[], [], [], [], []]
                for row in range(block.rows):
                    begin, end = int(words.at[row]), int(words.at[row + 1])
                    k = min(window, end - begin)
                    width = min(SHINGLE, k)
                    if not k:
                        continue
                    shingles = window_hashes(hashes[begin:end], width).view(np.int64)
                    for at in range(begin, end - k + 1):
                        out[0].append(batch.column("item_id")[block.first + row].as_py())
                        out[1].append(_between(block, words, at, at + k))
                        out[2].append(k)
                        out[3].append(width)
                        out[4].append(shingles[at - begin : at - begin + k - width + 1])
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                    ["item_id", "words", "k", "width", "shingles"],
                )

    return benchmark.mapInArrow(cut, "item_id long, words string, k int, width int, shingles array<long>")


def _places(block: Block, words: Words, widths: list[int], known: bloom.Bloom) -> Iterator[tuple]:
    """(width, hashes, first words, rows) of the shingles that the filter lets through."""
    hashes = word_hashes(block, words)
    for width in widths:
        first, rows = windows_inside(words, width)
        values = window_hashes(hashes, width)[first]
        hit = np.flatnonzero(known.has(values))
        yield width, values[hit], first[hit], rows[hit]


def _shingle_counts(docs: DataFrame, widths: list[int], known: bloom.Bloom) -> DataFrame:
    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for block in blocks(batch.column("text"), lower=True):
                for _, values, _, _ in _places(block, find_words(block, ALPHANUMERIC), widths, known):
                    found.append(values)
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(counts)], ["shingle", "times"]
            )

    found = docs.select("text").mapInArrow(count, "shingle long, times long")
    return found.groupBy("shingle").agg(F.sum("times").alias("times"))


def _with_anchor(windows: DataFrame, docs: DataFrame, widths: list[int]) -> DataFrame:
    """words, k, width, anchor, shift of each distinct window; shift: words before the anchor."""
    distinct = windows.groupBy("words").agg(*[F.first(c).alias(c) for c in ("k", "width", "shingles")])
    single = distinct.select("words", F.posexplode("shingles").alias("shift", "shingle"))
    own = single.groupBy("shingle").agg(F.count("*").alias("own"))
    counted = own.join(_shingle_counts(docs, widths, bloom.build(own, "shingle")), "shingle", "left")
    rarity = F.struct(F.coalesce("times", F.lit(0)).alias("times"), "own", "shingle", "shift")
    # A further join column has both sides shuffled, so that a shingle of very many items can be split.
    hashed = lambda df: df.withColumn("_h", F.xxhash64("shingle"))
    best = hashed(single).join(hashed(counted), ["shingle", "_h"]).groupBy("words").agg(F.min(rarity).alias("best"))
    return distinct.join(best, "words").select(
        "words", "k", "width", F.col("best.shingle").alias("anchor"), F.col("best.shift").alias("shift")
    )


def _scan(docs: DataFrame, widths: list[int], window: int, known: bloom.Bloom) -> DataFrame:
    """A row for every text: doc_id, key_a, key_b (of its words), n_words, and its anchors found,
    each with place, the words around and the place of the first of those."""

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_type = pa.list_(
            pa.struct([("anchor", pa.int64()), ("place", pa.int32()), ("begin", pa.int32()), ("around", pa.string())])
        )
        for batch in batches:
            for block in blocks(batch.column("text"), lower=True):
                words = find_words(block, ALPHANUMERIC)
                hashes = word_hashes(block, words)
                order = np.arange(len(hashes), dtype=np.uint64) - np.repeat(words.at[:-1], words.counts).astype(np.uint64)
                keys = []
                for salt in (0xA4093822299F31D0, 0x082EFA98EC4E6C89):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes + mix(order + np.uint64(salt))))])
                    keys.append((total[words.at[1:]] - total[words.at[:-1]]).view(np.int64))
                found: list[list] = [[] for _ in range(block.rows)]
                for _, values, first, rows in _places(block, words, widths, known):
                    for value, at, row in zip(values.view(np.int64).tolist(), first.tolist(), rows.tolist(), strict=True):
                        start, end = int(words.at[row]), int(words.at[row + 1])
                        begin, last = max(start, at - window + 1), min(end, at + window)
                        around = _between(block, words, begin, last)
                        found[row].append({"anchor": value, "place": at - start, "begin": begin - start, "around": around})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.rows),
                        *(pa.array(k) for k in keys),
                        pa.array(words.counts),
                        pa.array(found, found_type),
                    ],
                    ["doc_id", "key_a", "key_b", "n_words", "found"],
                )

    return docs.mapInArrow(
        scan,
        "doc_id long, key_a long, key_b long, n_words long, "
        "found array<struct<anchor: bigint, place: int, begin: int, around: string>>",
    )


def _covered(spans: Column) -> Column:
    """Words in the union of sorted (start, stop) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("upto"))
    return F.aggregate(
        spans,
        zero,
        lambda s, x: F.struct(
            (s["total"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], s["upto"]))).alias("total"),
            F.greatest(s["upto"], x["stop"]).alias("upto"),
        ),
        lambda s: s["total"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids as strings), contaminated for every row of `docs`.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A word is hit if it lies in
    an occurrence of a window of `benchmark` (item_id, text). A text is contaminated if words are hit
    and at least one in `share` is.

    Null and wordless texts have no words and no hits; such items have no windows. Repeated rows of
    `docs` each get their result; repeated items count by their id once, and a null item_id marks words
    but is not listed. Empty tables give no rows, or no hits. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "decontaminate")
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    windows = snapshot(benchmark_windows(items, window), f"{folder}/windows")
    widths = sorted(r.width for r in windows.select("width").distinct().collect())
    anchored = snapshot(_with_anchor(windows, docs, widths), f"{folder}/anchors")
    known = bloom.build(anchored.select("anchor").distinct(), "anchor")
    scanned = snapshot(_scan(docs, widths, window, known), f"{folder}/texts")

    found = scanned.filter("size(found) > 0").select("key_a", "key_b", "n_words", F.explode("found").alias("f"))
    found = found.select("key_a", "key_b", "n_words", "f.*")
    start = F.col("place") - F.col("shift")
    occurs = (
        found.join(anchored, "anchor")
        .withColumn("start", start)
        .filter("start >= begin and start + k <= n_words")
        .filter(F.array_join(F.slice(F.split("around", " "), F.col("start") - F.col("begin") + 1, F.col("k")), " ") == F.col("words"))
        .select("key_a", "key_b", "words", "start", (F.col("start") + F.col("k")).alias("stop"))
        .distinct()
    )
    spans = occurs.groupBy("key_a", "key_b").agg(
        _covered(F.sort_array(F.collect_set(F.struct("start", "stop")))).alias("n_hit")
    )
    listed = (
        occurs.select("key_a", "key_b", "words")
        .distinct()
        .join(windows.select("words", "item_id").filter("item_id is not null").distinct(), "words")
        .groupBy("key_a", "key_b")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    hits = spans.join(listed, ["key_a", "key_b"], "left").withColumn("_hash", F.xxhash64("key_a", "key_b"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    # A further join column has both sides shuffled, so that a text of very many rows can be split.
    rows = scanned.select("doc_id", "key_a", "key_b", "n_words").withColumn("_hash", F.xxhash64("key_a", "key_b"))
    return rows.join(hits, ["key_a", "key_b", "_hash"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
