"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton, which tells how far a
text can be followed inside the sample. A text is parsed greedily into longest matches; the
language that needs the fewest phrases, normalised by the length of its sample, wins.

The automata are built in one task per language. They are sent to the tasks as arcs, less than a megabyte
for a language, in groups of `GROUP` languages; a task lays one group after the other out as flat tables
and walks many pieces of texts through all tables of the group at once. So what a task holds does not grow
with the number of languages, and the driver never holds more than a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import LOWER, Block, blocks, lean, small_batches
from tidemark.sources.files import scratch_path, snapshot

#: Bytes of text that a language's automaton is built from.
SAMPLE_BYTES = 24_000
#: Documents per language that the sample is taken from.
SAMPLE_ROWS = 40
#: A text is cut into pieces of this many letters, which are parsed side by side.
PIECE = 256
#: Languages whose tables a task holds at a time: some 6 MB each for a script of 30 letters.
GROUP = 8
#: Buckets in which a language's texts of smallest hash are chosen before they meet.
BUCKETS = 64
#: Rows of chosen hashes that are sent to all tasks, 32 bytes each; more are joined by a shuffle.
MOST_BROADCAST = 200_000
UNKNOWN = "und"
#: Columns that `tagged` adds.
FOUND = ("lang_pred", "score", "lettered")

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = True
_IS_LETTER[0x80:] = True


def letters_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, bounds): letters in lower case, one 0 for each run of anything else between.

    Bytes of other scripts stand for themselves; the accented capitals of Latin-1 become small.
    """
    data = LOWER[block.data]
    if len(data):
        capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
        data[1:][capital] += 0x20
    letter = _IS_LETTER[data]
    before = np.zeros(len(data), bool)
    before[1:] = letter[:-1]
    first = block.bounds[:-1][block.bounds[:-1] < block.bounds[1:]]
    before[first] = False
    kept = letter | before
    total = np.concatenate([[0], np.cumsum(kept)])
    return np.where(letter, data, 0)[kept].astype(np.uint8), total[block.bounds]


def _automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton, state 0 first."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text.tolist():
        new = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in to[at]:
            to[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = to[at][symbol]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                copy = len(to)
                to.append(dict(to[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and to[at].get(symbol) == target:
                    to[at][symbol] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return to


def shares(sizes: np.ndarray, total: int) -> np.ndarray:
    """What each of `sizes` gets of `total`: an equal share, and of what smaller ones leave again an equal share."""
    given = np.zeros(len(sizes), np.int64)
    for done, place in enumerate(np.argsort(sizes, kind="stable").tolist()):
        given[place] = min(sizes[place], (total - given.sum()) // (len(sizes) - done))
    return given


def _arcs(group: pa.Table) -> pa.Table:
    """From one language's sample rows: its arcs (state, symbol, next) as packed numbers."""
    rows = sorted(zip(group.column("place").to_pylist(), group.column("text").to_pylist(), strict=True))
    pieces = [np.append(letters_of(block)[0], 0).astype(np.uint8) for _, text in rows for block in blocks(pa.array([text]))]
    sizes = np.array([len(p) for p in pieces])
    sample = np.concatenate([np.append(p[: n - 1], 0).astype(np.uint8) for p, n in zip(pieces, shares(sizes, SAMPLE_BYTES), strict=True)])
    arcs = [(s, c, t) for s, out in enumerate(_automaton(sample)) for c, t in out.items()]
    packed = np.array(arcs, np.int32).tobytes()
    return pa.table({"lang": group.column("lang")[:1], "size": [len(sample)], "arcs": pa.array([packed], pa.binary())})


@dataclass
class Tables:
    """Automata of a group of languages in one table. A cell holds where its next state's cells begin, or,
    inverted, where a new phrase goes on that begins with the symbol; from a root every symbol begins one."""

    symbol: np.ndarray
    table: np.ndarray
    roots: np.ndarray

    def phrases(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Phrases of each row (second axis) in each language (first axis)."""
        sizes = np.diff(bounds)
        pieces = -(-sizes // PIECE)
        row = np.repeat(np.arange(len(sizes)), pieces)
        order = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = bounds[:-1][row] + order * PIECE
        length = np.minimum(bounds[1:][row] - begin, PIECE)
        longest = np.argsort(-length, kind="stable")
        begin, length, row = begin[longest], length[longest], row[longest]
        symbols = np.append(self.symbol[symbols], np.zeros(PIECE, np.int32))
        active = np.searchsorted(-length, -np.arange(PIECE), "left")
        at = np.repeat(self.roots[:, None], len(row), 1)
        count = np.zeros(at.shape, np.int32)
        for step in range(int(length[0]) if len(length) else 0):
            n = active[step]
            cell = self.table[at[:, :n] + symbols[begin[:n] + step]]
            sign = cell >> 31
            count[:, :n] -= sign
            at[:, :n] = cell ^ sign
        return np.array([np.bincount(row, weights=c, minlength=len(sizes)) for c in count])


def laid_out(group: list[tuple[str, int, bytes]]) -> Tables:
    """The tables of rows (language, size, arcs)."""
    arcs = [np.frombuffer(packed, np.int32).reshape(-1, 3) for _, _, packed in group]
    symbol = np.zeros(256, np.int32)
    seen = np.unique(np.concatenate([[0], *(a[:, 1] for a in arcs)]))
    symbol[:] = len(seen)  # of no sample
    symbol[seen] = np.arange(len(seen))
    width, begin = len(seen) + 1, 0
    tables, roots = [np.zeros(0, np.int32)], []
    for a in arcs:
        states = int(a[:, 2].max(initial=0)) + 1
        table = np.full((states, width), -1, np.int64)
        table[a[:, 0], symbol[a[:, 1]]] = begin + a[:, 2].astype(np.int64) * width
        start = np.where(table[0] >= 0, table[0], begin)
        table = np.where(table >= 0, table, ~start)
        table[0] = ~start
        tables.append(table.astype(np.int32).ravel())
        roots.append(begin)
        begin += states * width
    return Tables(symbol, np.concatenate(tables), np.array(roots, np.int32))


@dataclass
class Parser:
    """The learned languages, with the bits of a phrase in each, and their automata in groups."""

    languages: list[str]
    bits: np.ndarray
    groups: list[Broadcast] = field(default_factory=list)
    _held: tuple[int, Tables] | None = None

    def tables(self, number: int) -> Tables:
        """Those of a group; the last one asked for is held."""
        if self._held is None or self._held[0] != number:
            self._held = None
            self._held = number, laid_out(self.groups[number].value)
        return self._held[1]

    def phrases(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Phrases of each row (second axis) in each language (first axis)."""
        found = [self.tables(n).phrases(symbols, bounds) for n in range(len(self.groups))]
        return np.concatenate([np.zeros((0, len(bounds) - 1)), *found])

    def decide(self, texts: list[Block]) -> list[tuple[list[str], np.ndarray, np.ndarray]]:
        """(language, score, has a letter) of each row, for each of several blocks."""
        cut = [letters_of(block) for block in texts]
        # Each group's tables are laid out once for all blocks.
        per_group = []
        for number in range(len(self.groups)):
            tables = self.tables(number)
            per_group.append([tables.phrases(*one) for one in cut])
        return [self._choose(block, *one, [g[i] for g in per_group]) for i, (block, one) in enumerate(zip(texts, cut, strict=True))]

    def _choose(self, block: Block, symbols: np.ndarray, bounds: np.ndarray, counts: list[np.ndarray]) -> tuple:
        languages, scores = [UNKNOWN] * block.rows, np.zeros(block.rows)
        ascii_letters = np.concatenate([[0], np.cumsum((symbols > 0) & (symbols < 0x80))])[bounds]
        known = np.diff(ascii_letters) > 0
        for row in np.flatnonzero(~known & (np.diff(bounds) > 0)):
            text = block.data[block.bounds[row] : block.bounds[row + 1]].tobytes().decode("utf-8", "replace")
            known[row] = any(map(str.isalpha, text))
        if not self.languages or not known.any():
            return languages, scores, known
        bits = np.concatenate(counts) * self.bits[:, None] / np.maximum(np.diff(bounds), 1)
        best = bits.argmin(0)
        scores = np.where(known, 1 / np.exp(-4 * (bits - bits.min(0))).sum(0), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], scores, known


def learn(labelled: DataFrame) -> Parser:
    """Parser of the languages in column lang of labelled (lang, text); null languages are not used.

    The sample are `SAMPLE_ROWS` distinct texts per language, those with the smallest hash, with equal
    shares of `SAMPLE_BYTES` letters. Hashes are chosen first, by bucket and then among the buckets' choices, so
    only the sample's texts are shuffled and no task gets more than some thousand hashes of a language.
    An empty table gives a parser of no languages.
    """
    rows = labelled.filter("lang is not null and text rlike '\\\\p{L}'").select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("place"))
    chosen = rows.select("lang", "place", F.pmod("place", F.lit(BUCKETS)).alias("bucket")).distinct()
    for keys in (("lang", "bucket"), ("lang",)):
        order = Window.partitionBy(*keys).orderBy("place")
        chosen = chosen.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= SAMPLE_ROWS).drop("n")
    spark = labelled.sparkSession
    chosen = snapshot(chosen.drop("bucket"), scratch_path(spark, "language-samples"))
    # `SAMPLE_ROWS` small rows for each language: sent to the tasks unless the languages are thousands.
    if chosen.count() <= MOST_BROADCAST:
        chosen = F.broadcast(chosen)
    rows = rows.join(chosen, ["lang", "place"], "left_semi").distinct()
    built = rows.groupBy("lang").applyInArrow(_arcs, "lang string, size long, arcs binary")
    built = snapshot(built, scratch_path(spark, "automata"))
    # A name and a number for each language; the arcs come group by group.
    sizes = {row.lang: row["size"] for row in built.select("lang", "size").collect()}
    names, groups = sorted(sizes), []
    for begin in range(0, len(names), GROUP):
        found = built.filter(F.col("lang").isin(names[begin : begin + GROUP])).collect()
        groups.append(spark.sparkContext.broadcast(sorted((row.lang, row["size"], bytes(row.arcs)) for row in found)))
    return Parser(names, np.log2([max(sizes[n], 2) for n in names]) if names else np.zeros(0), groups)


def tagged(docs: DataFrame, parser: Parser) -> DataFrame:
    """docs with columns lang_pred, score and lettered, which replace columns of these names; see `identify`.

    `lettered` tells whether the text has a letter, whatever was learned.
    """
    languages, bits, groups = parser.languages, parser.bits, parser.groups

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(languages, bits, groups)
        for batch in batches:
            texts = list(blocks(batch.column("text")))
            for block, decided in zip(texts, parser.decide(texts), strict=True):
                found = [pa.array(x, kind) for x, kind in zip(decided, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(block.first, block.rows).columns, *found], [*batch.schema.names, *FOUND])

    docs = small_batches(docs).drop(*FOUND).withColumn("text", F.col("text").cast("string"))
    added = [T.StructField(name, kind) for name, kind in zip(FOUND, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True)]
    return docs.mapInArrow(rows, T.StructType([*docs.schema.fields, *added]))


def identify(docs: DataFrame, parser: Parser) -> DataFrame:
    """doc_id, lang_pred, score of every row of docs (doc_id, text).

    `lang_pred` is one of the learned languages; ties go to the first by name. It is `und`, with score
    0, where the text is null or has no letter, or where nothing was learned. The score is between 0
    and 1, and higher the more bits per letter the other languages need. Whole texts are parsed;
    their pieces of `PIECE` letters each begin a phrase. Repeated rows each get their result, and an
    empty table gives none.
    """
    return tagged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), parser).drop("text", "lettered")
