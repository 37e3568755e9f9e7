"""Toxicity: boosted trees over dense features of whole texts, with isotonic calibration.

The features are densities of insulting words (a given list, a list learned from the labels, and
the given list after undoing digit-for-letter spelling), how many insults stand near a
second-person word, and rates of capitals, punctuation and obfuscated words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Trees, fit_trees
from tidemark.llm.learning import SAMPLE_ROWS, labelled_ids, one_text, sample
from tidemark.llm.statistics import running
from tidemark.llm.words import LOWER, NOT_SPACE, Block, Words, blocks, byte_class, find_words, lean, small_batches, word_hashes
from tidemark.sources.cache import kept

# Common English insults, and words that address the reader in four languages.
INSULTS = (
    "asshole bastard clown coward creep cretin disgusting dumb dumbass filth filthy fool garbage hideous idiot "
    "idiotic idiots imbecile jerk liar loser losers lowlife moron morons moronic nasty parasite pathetic pig rat "
    "rubbish scum scumbag stupid sucker trash ugly useless vermin vile weirdo worthless wretch"
).split()
ADDRESS = "you your yours yourself youre u ur du dich dir dein deine tu te toi ton ta vous votre tú ti usted ustedes vos".split()

#: Words on each side of an insult in which an addressing word counts as near.
NEAR = 5

_LETTERS = byte_class(bytes([*range(97, 123), *range(0x80, 0x100)]))
_UNDO = LOWER.copy()
_UNDO[np.frombuffer(b"0134578@$", np.uint8)] = np.frombuffer(b"oieastbas", np.uint8)
_PUNCTUATION = np.zeros(256, np.int64)
_PUNCTUATION[np.frombuffer(b"!?.,;:*#%&$@", np.uint8)] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_ODD = np.zeros(256, np.int64)
_ODD[np.frombuffer(b"0123456789@$*#!", np.uint8)] = 1


def hashes_of(words: Sequence[str]) -> np.ndarray:
    """Sorted hashes, as `word_hashes` gives them for the words in texts."""
    block = next(blocks(pa.array([" ".join(words)])), None) if words else None
    return np.unique(word_hashes(block, find_words(block, NOT_SPACE))) if block else np.zeros(0, np.uint64)


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


FEATURES = (
    "insults insults_any learned learned_any undone near address capitals capital_words punctuation "
    "bangs odd_words log_words word_length"
).split()


class Features:
    """Matrix of FEATURES for the rows of a block."""

    def __init__(self, learned: Sequence[str] = (), insults: Sequence[str] = INSULTS) -> None:
        self.insults, self.learned, self.address = hashes_of(insults), hashes_of(learned), hashes_of(ADDRESS)

    def __call__(self, block: Block) -> np.ndarray:
        small = Block(block.first, LOWER[block.data], block.bounds)
        words = find_words(small, _LETTERS)
        hashes = word_hashes(small, words)
        per = lambda flags, w: np.diff(running(flags.astype(np.int64))[w.at])
        insult, learned, address = (_among(hashes, k) for k in (self.insults, self.learned, self.address))
        row = words.rows()
        place = np.arange(len(hashes))
        low, high = np.maximum(place - NEAR, words.at[row]), np.minimum(place + NEAR + 1, words.at[row + 1])
        addressed = running(address.astype(np.int64))
        near = (insult | learned) & (addressed[high] - addressed[low] > 0)

        spaced = find_words(block, NOT_SPACE)
        undone_block = Block(block.first, _UNDO[block.data], block.bounds)
        undone_words = find_words(undone_block, _LETTERS)
        undone = _among(word_hashes(undone_block, undone_words), self.insults)
        spans = lambda table, w: (t := running(table[block.data]))[w.ends] - t[w.starts]
        upper, odd = spans(_UPPER, spaced), spans(_ODD, spaced)
        letters = running(_LETTERS[small.data].astype(np.int64))
        inside = letters[spaced.ends] - letters[spaced.starts]
        marks = _ODD[block.data[spaced.ends - 1]]
        n, m = np.maximum(words.counts, 1), np.maximum(spaced.counts, 1)
        size = np.maximum(np.diff(block.bounds), 1)
        of = lambda table: np.diff(running(table[block.data])[block.bounds])
        bang = np.zeros(256, np.int64)
        bang[33] = 1
        columns = {
            "insults": per(insult, words) / n,
            "insults_any": np.minimum(per(insult, words), 3),
            "learned": per(learned, words) / n,
            "learned_any": np.minimum(per(learned, words), 3),
            "undone": np.maximum(per(undone, undone_words) - per(insult, words), 0) / n,
            "near": per(near, words) / n,
            "address": per(address, words) / n,
            "capitals": of(_UPPER) / size,
            "capital_words": per((upper > 1) & (upper * 2 > inside), spaced) / m,
            "punctuation": of(_PUNCTUATION) / size,
            "bangs": of(bang) / size,
            "odd_words": per((odd > marks) & (inside > 1), spaced) / m,
            "log_words": np.log1p(spaced.counts),
            "word_length": np.diff(block.bounds) / m,
        }
        return np.stack([columns[name].astype(float) for name in FEATURES], axis=1)


#: More insults can only raise the score.
MONOTONE = {name: 1 for name in ("insults", "insults_any", "learned", "learned_any", "undone", "near")}


def _distinct_words(block: Block) -> tuple[Block, Words, np.ndarray, np.ndarray]:
    """(lower-cased block, words, places of each row's distinct words, their rows)."""
    small = Block(block.first, LOWER[block.data], block.bounds)
    words = find_words(small, _LETTERS)
    hashes, rows = word_hashes(small, words), words.rows()
    _, first = np.unique(np.stack([rows.astype(np.uint64), hashes]), axis=1, return_index=True)
    return small, words, first, rows[first]


#: A text is explained by so many learned words.
EXPLAINED = 3


def learn_words(rows: DataFrame, insults: Sequence[str] = INSULTS) -> tuple[list[str], list[str]]:
    """(words that mark label 1, those of `insults` that stay) from rows (text, label).

    Candidates are all words far more frequent, by distinct texts, under label 1. Of them words are taken
    one by one, each time the one found in most texts not yet explained, until none is found in enough of
    them, so that the other words of a copied toxic text are not taken for insults. A given insult goes if
    the texts use it without being toxic, as happens with words that mean something else in another
    language. Copies of a text count once for each of its labels. Without both labels nothing is learned
    and all insults stay.
    """
    with kept(rows.select("text", "label").distinct()) as texts:
        return _learn_words(texts, insults)


def _learn_words(rows: DataFrame, insults: Sequence[str]) -> tuple[list[str], list[str]]:
    """`learn_words` from distinct rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            names, marks = [], []
            for block in blocks(batch.column("text")):
                small, words, first, row = _distinct_words(block)
                data = small.data.tobytes()
                names += [data[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
                marks.append(labels[block.first + row])
            if names:
                found = np.concatenate(marks).astype(np.int64)
                table = pa.table({"word": pa.array(names, pa.binary()), "yes": found, "no": 1 - found})
                table = table.group_by("word").aggregate([("yes", "sum"), ("no", "sum")]).rename_columns(["word", "yes", "no"])
                yield from table.to_batches()

    n = rows.agg(F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no")).first()
    if not n.yes or not n.no:
        return [], list(insults)
    counted = rows.mapInArrow(count, "word binary, yes long, no long").groupBy("word").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    odds = (F.col("yes") + 0.5) / n.yes / ((F.col("no") + 0.5) / n.no)
    least = max(3, n.yes // 400)
    marks = (F.col("yes") >= least) & (F.col("odds") >= 20)
    found = counted.withColumn("odds", odds).filter(marks | F.col("word").isin([w.encode() for w in insults]))
    # Words that meet `least`, of a bounded sample.
    found = [(bytes(r.word).decode("utf-8", "replace"), r) for r in found.withColumn("marks", marks).collect()]
    harmless = {w for w, r in found if r.no > 0 and r.odds < 5}
    insults = [w for w in insults if w not in harmless]
    candidates = [w for w, r in sorted(found, key=lambda x: (-x[1].yes, x[1].word)) if r.marks]
    if not candidates:
        return [], insults
    (block,) = blocks(pa.array([" ".join(candidates)]))
    unsorted = word_hashes(block, find_words(block, NOT_SPACE))
    order = np.argsort(unsorted)
    known = unsorted[order]

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                small, words, first, row = _distinct_words(block)
                hashes = word_hashes(small, words)[first]
                hit = _among(hashes, known)
                held = order[np.searchsorted(known, hashes[hit])].astype(np.int32)
                bounds = np.searchsorted(row[hit], np.arange(block.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(bounds, held)], ["held"])

    # One row per sampled text at most: the sample is bounded.
    held = rows.filter("label = 1").select("text").mapInArrow(hold, "held array<int>").toArrow().column("held").combine_chunks()
    return [candidates[i] for i in cover([row.values.to_numpy() for row in held], len(candidates), least)], insults


def cover(held: Sequence[np.ndarray], n: int, least: int) -> list[int]:
    """Of the numbers below n those taken one by one, each time the one held by most rows left, the smallest of several.

    A row goes when EXPLAINED of its numbers are taken. It ends when no number is held by `least` rows.
    """
    sizes = np.array([len(h) for h in held], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    numbers = np.concatenate([np.zeros(0, np.int64), *held]).astype(np.int64)
    by_number = np.argsort(numbers, kind="stable")
    rows = np.repeat(np.arange(len(held)), sizes)[by_number]
    at = np.searchsorted(numbers[by_number], np.arange(n + 1))
    times, left = np.diff(at), np.full(len(held), EXPLAINED)
    taken: list[int] = []
    while n and times[best := int(times.argmax())] >= least:
        taken.append(best)
        own = rows[at[best] : at[best + 1]]
        left[own] -= 1
        for row in own[left[own] == 0].tolist():
            times[numbers[bounds[row] : bounds[row + 1]]] -= 1
        times[best] = -len(held) - 1
    return taken


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of the rising fit by pooling neighbours that violate the order."""
    order = np.argsort(scores, kind="stable")
    pools: list[list[float]] = []  # [first score, last score, sum, count]
    for x, y in zip(scores[order].tolist(), labels[order].tolist(), strict=True):
        if pools and pools[-1][1] == x:
            pools[-1][2] += y
            pools[-1][3] += 1
        else:
            pools.append([x, x, y, 1])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, last, total, count = pools.pop()
            pools[-1][1:] = [last, pools[-1][2] + total, pools[-1][3] + count]
    places = np.array([p for a, b, _, _ in pools for p in ((a, b) if a < b else (a,))])
    values = np.array([t / c for a, b, t, c in pools for _ in range(2 if a < b else 1)])
    return places, values


#: Parts of the sample; each is scored by trees that have not seen it, for the calibration.
PARTS = 4


def _fit(features: np.ndarray, labels: np.ndarray, part: np.ndarray) -> tuple[Trees, tuple[np.ndarray, np.ndarray]]:
    """Trees fitted on all rows, and their margins' calibration from rows held out part by part."""
    monotone = {FEATURES.index(name): sign for name, sign in MONOTONE.items()}
    margins = np.zeros(len(labels))
    for number in range(PARTS):
        out = part == number
        margins[out] = fit_trees(features[~out], labels[~out], monotone).margins(features[out])
    return fit_trees(features, labels, monotone), isotonic(margins, labels)


def toxicity_scores(docs: DataFrame, training: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row of docs (doc_id, text).

    `training` has doc_id and toxic (0 or 1); at most `most` of its rows are fitted on, an id that is
    repeated with the text of the smallest hash. Null and blank texts are scored by their features, which
    are 0. Repeated rows each get their score. Without both labels the score is 0.5. An empty table of
    documents gives no rows.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chosen = sample(labelled_ids(training, "toxic"), most)  # at most `most` rows of two numbers
    rows = one_text(docs.join(F.broadcast(chosen), "doc_id"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                part = batch.slice(block.first, block.rows)
                values = pa.array(list(features(block)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), values], ["doc_id", "label", "values"])

    with kept(rows):
        features = Features(*learn_words(rows))
        found = rows.mapInArrow(measure, "doc_id long, label int, values array<double>")
        found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).limit(most).toArrow()
    found = found.sort_by("doc_id")
    labels = found.column("label").to_numpy().astype(float)
    values = np.array(found.column("values").to_pylist(), float).reshape(len(labels), len(FEATURES))
    both = 0 < labels.sum() < len(labels)
    trees, (places, heights) = _fit(values, labels, found.column("part").to_numpy()) if both else (None, (None, None))

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                scores = np.interp(trees.margins(features(block)), places, heights) if trees else np.full(block.rows, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(block.first, block.rows), pa.array(scores)], ["doc_id", "score"]
                )

    return docs.mapInArrow(score, "doc_id long, score double")
