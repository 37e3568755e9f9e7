"""Packing of tokenized documents into sequences by best-fit decreasing.

Documents are encoded and cut to pieces of the capacity at most. Best-fit decreasing takes pieces by
falling length and puts each into the open sequence with the least room that is enough for it. What it does
depends on the lengths alone, and there are no more lengths than the capacity, so the plan is made from a
histogram: sequences with the same room left are one lot, a segment tree over the remaining capacities
finds the tightest lot by one descent, and a run of pieces of one length is placed in a step. That
yields the packing that a piece-by-piece run over all documents yields, whatever their number; the plan has
at most some hundred thousand rows (`MAX_PLAN_ROWS`) for a capacity of 1,024, and a few thousand as a rule.

Pieces find their place in the plan by their rank among those of the same length. Tasks that encode number
their pieces by length as they write them; a table of counts by task and length turns that into ranks.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import _byte_characters, _ragged
from tidemark.llm.words import Block, Words, blocks, lean, small_batches, word_hashes
from tidemark.sources.files import scratch_path, snapshot

# Fixed values of the vocabulary's kind: the pattern that cuts texts to pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Segments whose ids a task remembers.
KNOWN_SEGMENTS = 400_000
BLOCK = 1 << 19


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(tokens, special strings) with their ids, of a file of byte-level BPE whose merges are in the order of the ids."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    octet = {c: b for b, c in enumerate(_byte_characters())}
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    return {bytes(map(octet.__getitem__, t)): i for t, i in content["model"]["vocab"].items() if t not in special}, special


def segments(block: Block) -> Words:
    """Cut rows before each space that follows a printable ASCII character other than white space.

    No piece of the pattern goes over such a place and none depends on what is beyond it, so the ids of a
    text are those of its segments, one after the other.
    """
    cut = np.zeros(len(block.data), bool)
    before = block.data[:-1]
    cut[1:] = (block.data[1:] == 0x20) & (before > 0x20) & (before < 0x7F)
    cut[block.bounds[:-1][block.bounds[:-1] < block.bounds[1:]]] = True
    starts = np.flatnonzero(cut)
    return Words(starts, np.append(starts[1:], len(block.data))[: len(starts)], np.searchsorted(starts, block.bounds))


class Encoder:
    """Ids of blocks of texts; segments seen before are looked up."""

    def __init__(self, tokens: dict[bytes, int], special: dict[str, int]) -> None:
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens=special)
        self.special = [s.encode() for s in special]
        self._forget()

    def _forget(self) -> None:
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.sizes, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _one(self, text: bytes) -> list[int]:
        if any(s in text for s in self.special):
            return self.encoding.encode(text.decode(), allowed_special="all")
        return self.encoding.encode_ordinary(text.decode())

    def block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all rows, and where each row's end."""
        found = segments(block)
        hashes, first, which = np.unique(word_hashes(block, found), return_index=True, return_inverse=True)
        if len(self.known) > KNOWN_SEGMENTS:
            self._forget()
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        fresh = np.flatnonzero(new)
        if len(fresh):
            data = block.data.tobytes()
            spans = zip(found.starts[first[fresh]].tolist(), found.ends[first[fresh]].tolist(), strict=True)
            ids = [self._one(data[a:b]) for a, b in spans]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.pool = np.concatenate([self.pool, np.fromiter((i for one in ids for i in one), np.uint32, int(sizes.sum()))])
            number = len(self.number) + np.arange(len(fresh))
            self.known, self.number = np.insert(self.known, at[fresh], hashes[fresh]), np.insert(self.number, at[fresh], number)
            at = np.searchsorted(self.known, hashes)
        number = self.number[at][which]
        ids = self.pool[_ragged(self.starts[number], self.sizes[number])]
        return ids, np.concatenate([[0], np.cumsum(self.sizes[number])])[found.at][1:]


def token_pieces(docs: DataFrame, vocabulary_file: str, capacity: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, part, nth: every document's ids, cut to pieces.

    A document's ids are those of its text (null: empty) and then `end_id`. Those of more than `capacity` are
    cut so that all pieces but the first are full. ids are unsigned 32-bit integers, little end first, and
    ids_crc32 is their checksum. nth numbers the pieces of one length in task `part`.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_file))

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, counter, part = Encoder(*vocabulary.value), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for block in blocks(batch.column("text"), size=BLOCK):
                ids, ends = encoder.block(block)
                ids = np.insert(ids, ends, np.uint32(end_id)).astype("<u4")
                sizes = np.diff(ends + np.arange(1, len(ends) + 1), prepend=0)
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = (sizes - capacity * (pieces - 1))[row]
                length = np.where(piece == 0, head, capacity)
                start = np.where(piece == 0, 0, head + capacity * (piece - 1))
                edges = np.concatenate([[0], np.cumsum(length)])
                data = ids.tobytes()
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                kinds, first, counts = np.unique(length[order], return_index=True, return_counts=True)
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - np.repeat(first, counts) + np.repeat(counter[kinds], counts)
                counter[kinds] += counts
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(row), [None, pa.py_buffer((4 * edges).astype(np.int64)), pa.py_buffer(data)]
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array(row + block.first)),
                        "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start, pa.int64()),
                        "length": pa.array(length, pa.int64()),
                        "ids": packed.cast(pa.binary()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                        "part": pa.array(np.full(len(row), part), pa.int32()),
                        "nth": pa.array(nth),
                    }
                )

    return docs.mapInArrow(rows, "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, part int, nth long")


class CapacityTree:
    """Segment tree over remaining capacities 0 to `capacity`: in which of them sequences are open."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << (capacity + 1).bit_length()
        self.open = bytearray(2 * self.leaves)

    def set(self, room: int, is_open: bool) -> None:
        node = room + self.leaves
        self.open[node] = is_open
        while node > 1:
            node >>= 1
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of `least` or more in which a sequence is open."""
        node = least + self.leaves
        if self.open[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """(steps, sequences) of best-fit decreasing for counts of pieces by length.

    Steps are rows (length, first, each, sequence, offset): the pieces of a length from rank `first` on go
    to sequences from `sequence` on, `each` of them side by side in one, beginning at `offset`.
    """
    tree, lots, steps, opened = CapacityTree(capacity), defaultdict(list), [], 0

    def put(room: int, sequence: int, many: int) -> None:
        if many and room:
            lots[room].append((sequence, many))
            tree.set(room, True)

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        rank, count = 0, counts[length]
        while rank < count:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                many = -(-(count - rank) // each)
                sequence, opened = opened, opened + many
            else:
                sequence, many = lots[room].pop()
                each = room // length
                if not lots[room]:
                    tree.set(room, False)
            placed = min(count - rank, many * each)
            full, rest = divmod(placed, each)
            steps.append((length, rank, each, sequence, capacity - room))
            put(room - each * length, sequence, full)
            put(room - rest * length, sequence + full, int(rest > 0))
            put(room, sequence + full + (rest > 0), many - full - (rest > 0))
            rank += placed
    return np.array(steps, np.int64).reshape(-1, 5), opened


#: A step empties or cuts a lot. Each length cuts at most one, which makes two more, and opens two; a lot
#: takes at most 44 different lengths up to 1,024, as 1 + 2 + .. + 45 is more.
MAX_PLAN_ROWS = 4 * 1024 * 44


def packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces (length, part, nth, ...), a written table; drops part and nth.

    nth numbers the pieces of equal part and length from 0 without gaps. Offsets in a sequence leave no gaps.
    """
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = snapshot(counts, scratch_path(pieces.sparkSession, "piece-counts"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps, _ = best_fit_plan(totals, capacity)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    until = [totals[k] for k in steps[:, 0].tolist()]
    until[:-1] = np.where(steps[1:, 0] == steps[:-1, 0], steps[1:, 1], until[:-1]).tolist() if len(steps) > 1 else until[:-1]
    names = ["length", "first", "each", "sequence", "begin"]
    plan = pa.table({**dict(zip(names, steps.T, strict=True)), "until": pa.array(until, pa.int64())})
    plan = F.broadcast(pieces.sparkSession.createDataFrame(plan)).alias("plan")

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("before"))
    placed = pieces.join(counts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth")).alias("p")
    nth = F.col("rank") - F.col("plan.first")
    placed = placed.join(plan, (F.col("p.length") == F.col("plan.length")) & (nth >= 0) & (F.col("rank") < F.col("plan.until")))
    return placed.select(
        *[f"p.{c}" for c in pieces.columns if c not in ("part", "nth")],
        (F.col("plan.sequence") + F.expr("(rank - plan.first) div plan.each")).alias("sequence_id"),
        (F.col("plan.begin") + nth % F.col("plan.each") * F.col("p.length")).alias("offset"),
    )


def pack(docs: DataFrame, vocabulary_file: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset of every piece of docs (doc_id, text).

    Every row of docs is one document, whatever ids others have; null and empty texts are the `end_id`
    alone. Special strings of the vocabulary in a text become their ids. Other columns are ignored. An empty
    table gives no rows. See `token_pieces` for how documents are cut and `packed` for where pieces go.
    """
    pieces = token_pieces(docs, vocabulary_file, capacity, end_id)
    return packed(snapshot(pieces, scratch_path(docs.sparkSession, "token-pieces")), capacity)
