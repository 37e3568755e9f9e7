"""Encoding and decoding with a word-level BPE vocabulary.

Frequent words of the texts, counted over all of them, are compiled with their ids into a minimal
acyclic transducer, which every task memory-maps. A block's distinct pieces walk through it
together; those that it does not know are merged exactly, pair by pair, many side by side.

The vocabulary file is that of a public tokenizer: NFC, lower case, pieces cut by its pattern,
bytes as printable characters, an end-of-word mark. Its special strings in a text are tokens.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import lexicon as lex
from tidemark.llm.words import NOT_SPACE, Words, blocks, byte_class, find_words, lean, small_batches, word_hashes
from tidemark.sources.cache import kept

#: Most words that are compiled; it bounds the transducer, not what can be encoded.
LEXICON_WORDS = 60_000
#: Pieces that are merged side by side, and the longest that are.
MERGED_ROWS, MERGED_LENGTH = 4096, 64
#: Texts of this many bytes are cut together; larger blocks have fewer distinct words for their size and take more memory.
BLOCK = 1 << 18

_LETTERS = byte_class(bytes([*range(97, 123), *range(0x80, 0x100)]))
_END = "</w>"


def _byte_characters() -> list[str]:
    """The printable character of each byte in vocabularies of this kind."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in table)
    table |= {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class Vocabulary:
    """Ids, ranks of merges and special strings of a vocabulary file."""

    def __init__(self, text: str) -> None:
        file = json.loads(text)
        model = file["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.characters = _byte_characters()
        # \s of the file's pattern is the Unicode property; here \s has some more characters.
        split = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"\s", r"\p{White_Space}") + r"|\n")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def tokens(self) -> list[bytes]:
        """UTF-8 of every id's token."""
        names = {**{i: t for t, i in self.ids.items()}, **{i: t for t, i in self.special.items()}}
        return [names.get(i, "").encode() for i in range(max(names) + 1)]

    def cut(self, words: str) -> list[str]:
        """Pieces of newline-separated words, and the newlines."""
        if not words.isascii():
            words = unicodedata.normalize("NFC", words).replace("Σ", "σ")
        return self.pieces.findall(words.lower())

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece: the pair that was learned first is joined wherever it stands, and so on."""
        parts: list[str | None] = [self.characters[b] for b in piece.encode()]
        parts[-1] += _END
        n, rank = len(parts), self.rank
        # The parts as a linked list, the pairs in a heap by rank and place: n log n for a long run of letters.
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[pair], at) for at, pair in enumerate(zip(parts, parts[1:])) if pair in rank]  # noqa: B905
        heapq.heapify(heap)
        while heap:
            found, at = heapq.heappop(heap)
            right = after[at]
            if parts[at] is None or right >= n or rank.get((parts[at], parts[right])) != found:
                continue
            parts[at], parts[right], after[at] = parts[at] + parts[right], None, after[right]
            if after[at] < n:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n and (pair := (parts[left], parts[after[left]])) in rank:
                    heapq.heappush(heap, (rank[pair], left))
        parts = [p for p in parts if p is not None]
        return [self.ids[p] for p in parts]


def _steps(times: Column) -> Column:
    """Counts in steps of an eighth of a doubling: a few hundred values at any size."""
    return F.floor(F.log2(times.cast("double")) * 8).cast("int")


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent runs of letters of all texts in lower case, sorted; `most` at the most.

    A histogram of the counts gives the least count that is frequent, so that tasks send no words but
    those. Words of the step that would pass `most` are left out together.
    """

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, times = [], []
            for block in blocks(batch.column("text"), lower=True, size=BLOCK):
                words = find_words(block, _LETTERS)
                _, first, counts = np.unique(word_hashes(block, words), return_index=True, return_counts=True)
                data = block.data.tobytes()
                names += [data[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
                times.append(counts)
            if names:
                table = pa.table({"word": pa.array(names, pa.binary()), "times": np.concatenate(times)})
                table = table.group_by("word").aggregate([("times", "sum")]).rename_columns(["word", "times"])
                yield from table.to_batches()

    counted = docs.select("text").mapInArrow(count, "word binary, times long").groupBy("word")
    counted = counted.agg(F.sum("times").alias("times")).withColumn("step", _steps(F.col("times")))
    with kept(counted):
        sizes = {row.step: row["count"] for row in counted.groupBy("step").count().collect()}
        total, least = 0, max(sizes, default=0) + 1
        while least - 1 >= 0 and total + sizes.get(least - 1, 0) <= most:
            least -= 1
            total += sizes.get(least, 0)
        return sorted(bytes(row.word) for row in counted.filter(F.col("step") >= least).select("word").collect())


def compile_words(words: Sequence[bytes], vocabulary: Vocabulary) -> lex.Lexicon:
    """Transducer of those words that are one piece and stay as they are when normalised."""
    entries = {}
    for word in words:
        try:
            text = word.decode()
        except UnicodeDecodeError:
            continue
        if vocabulary.cut(text) == [text]:
            entries[word] = vocabulary.merge(text)
    return lex.compile_lexicon(entries)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of every span, one after the other."""
    skipped = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - skipped, sizes)


class Merges:
    """The merge rules as tables over ids, applied to many pieces at once."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, ids = vocabulary, vocabulary.ids
        self.width = max(ids.values()) + 1
        found = sorted(
            (ids[a] * self.width + ids[b], rank, ids[a + b])
            for (a, b), rank in vocabulary.rank.items()
            if a in ids and b in ids and a + b in ids
        )
        table = np.array(found, np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.joined = table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)
        self.inner = np.array([ids[c] for c in vocabulary.characters], np.int32)
        self.last = np.array([ids[c + _END] for c in vocabulary.characters], np.int32)

    def _rules(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined id) of pairs; the rank of a pair without a rule is `_NEVER`."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], _NEVER), self.joined[at]

    def apply(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of the pieces, one after the other."""
        sizes = np.zeros(len(pieces), np.int64)
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        while order and len(pieces[order[-1]]) > MERGED_LENGTH:
            long = order.pop()
            found[long] = np.array(self.vocabulary.merge(pieces[long].decode()), np.int32)
            sizes[long] = len(found[long])
        for begin in range(0, len(order), MERGED_ROWS):
            rows = order[begin : begin + MERGED_ROWS]
            symbols, lengths = self._together([pieces[i] for i in rows])
            sizes[rows] = lengths
            for i, row, length in zip(rows, symbols, lengths.tolist(), strict=True):
                found[i] = row[:length]
        return np.concatenate([np.zeros(0, np.int32), *found]), sizes

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (padded with -1) and lengths; each step joins every row's foremost best pair."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(lengths.max())
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        place = np.arange(width)
        symbols = np.where(place < lengths[:, None], self.inner[data], -1)
        rows = np.arange(len(pieces))
        symbols[rows, lengths - 1] = self.last[data[rows, lengths - 1]]
        symbols = np.hstack([symbols, np.full((len(pieces), 1), -1, symbols.dtype)])
        ranks, joined = self._rules(symbols[:, :-1], symbols[:, 1:])
        done, ends = symbols.copy(), lengths.copy()
        while len(rows):
            at = ranks.argmin(1)
            each = np.arange(len(rows))
            going = ranks[each, at] != _NEVER
            stopped = ~going
            done[rows[stopped], : symbols.shape[1]], ends[rows[stopped]] = symbols[stopped], lengths[stopped]
            if stopped.any():
                rows, symbols, ranks, joined, lengths, at = (x[going] for x in (rows, symbols, ranks, joined, lengths, at))
                each = np.arange(len(rows))
            if not len(rows):
                break
            new = joined[each, at]
            after = place[: symbols.shape[1] - 1] >= at[:, None] + 1
            symbols[:, :-1] = np.where(after, symbols[:, 1:], symbols[:, :-1])
            symbols[:, -1] = -1
            symbols[each, at] = new
            shifted = place[: ranks.shape[1] - 1] >= at[:, None] + 1
            for table, empty in ((ranks, _NEVER), (joined, 0)):
                table[:, :-1] = np.where(shifted, table[:, 1:], table[:, :-1])
                table[:, -1] = empty
            lengths = lengths - 1
            ranks[each, at], joined[each, at] = self._rules(new, symbols[each, at + 1])
            inside = np.flatnonzero(at > 0)
            before = at[inside] - 1
            ranks[inside, before], joined[inside, before] = self._rules(symbols[inside, before], new[inside])
        return done, ends


_NEVER = np.int32(1 << 30)


class Encoder:
    def __init__(self, vocabulary: Vocabulary, lexicon: lex.Lexicon) -> None:
        self.vocabulary, self.lexicon, self.merges = vocabulary, lexicon, Merges(vocabulary)

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, starts, sizes): where the ids of distinct pieces are."""
        data = [p.encode() for p in pieces]
        ranks = self.lexicon.ranks(data)
        unknown = np.flatnonzero(ranks < 0)
        merged, merged_sizes = self.merges.apply([data[i] for i in unknown])
        at, known = self.lexicon.at, len(self.lexicon.ids)
        starts, sizes = at[ranks], at[np.minimum(ranks + 1, len(at) - 1)] - at[ranks]
        starts[unknown], sizes[unknown] = known + np.cumsum(merged_sizes) - merged_sizes, merged_sizes
        return np.concatenate([self.lexicon.ids, merged.astype(np.uint32)]), starts, sizes

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, starts, sizes): where the ids of distinct words without white space are."""
        special = {i: parts for i, w in enumerate(words) if "<|" in w and len(parts := self.vocabulary.specials.split(w)) > 1}
        cut = self.vocabulary.cut("\n".join("" if i in special else w for i, w in enumerate(words)) if special else "\n".join(words))
        number: dict[str, int] = {}
        codes = np.fromiter((number.setdefault(p, len(number)) for p in cut), np.int64, len(cut))
        breaks = codes == number.get("\n", -1)
        pool, starts, sizes = self.pieces(["" if p == "\n" else p for p in number])
        codes, owner = codes[~breaks], np.cumsum(breaks)[~breaks]
        flat = pool[_ragged(starts[codes], sizes[codes])]
        of_words = np.bincount(owner, weights=sizes[codes], minlength=len(words)).astype(np.int64)
        starts = np.cumsum(of_words) - of_words
        for i, parts in special.items():
            ids = [self.vocabulary.special[p] if p in self.vocabulary.special else p for p in parts]
            ids = np.array([x for p in ids for x in ([p] if isinstance(p, int) else self.one(p))], np.uint32)
            starts[i], of_words[i] = len(flat), len(ids)
            flat = np.concatenate([flat, ids])
        return flat, starts, of_words

    def one(self, text: str) -> list[int]:
        return self.words([text])[0].tolist() if text else []

    def block(self, data: bytes, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): ids of all words in their order, and how many each has."""
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if not len(first):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = [
            data[a:b].decode("utf-8", "replace")
            for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)
        ]
        pool, starts, sizes = self.words(texts)
        return pool[_ragged(starts[which], sizes[which])], sizes[which]


def _tables(docs: DataFrame, vocabulary_file: str, lexicon_words: int) -> tuple:
    with open(vocabulary_file, encoding="utf-8") as file:
        text = file.read()
    compiled = compile_words(frequent_words(docs, lexicon_words), Vocabulary(text))
    context = docs.sparkSession.sparkContext
    return context.broadcast(lex.pack(compiled)), context.broadcast(text)


def _packed(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column of rows that end at `ends`."""
    places, data = pa.py_buffer((ends * 4).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, places, data]).cast(pa.binary())


def _texts(ids: pa.Array, token) -> pa.Array:
    """The tokens of each row's ids with one space between."""
    buffers = (row.as_buffer() for row in ids)
    texts = [None if b is None else b" ".join(map(token, np.frombuffer(b, "<u4").tolist())) for b in buffers]
    return pa.array(texts, pa.binary()).cast(pa.string())


def encode(docs: DataFrame, vocabulary_file: str, lexicon_words: int = LEXICON_WORDS, decoded: bool = False) -> DataFrame:
    """doc_id, ids of every row of docs (doc_id, text): unsigned 32-bit integers, little end first.

    With `decoded` a column of that name has what `decode` makes of the ids, in the same pass.
    Null and blank texts have no ids. Special strings of the file become their ids; no others are
    added. Repeated rows each get their result; an empty table gives none.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tables, source = _tables(docs, vocabulary_file, lexicon_words)

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(source.value)
        encoder, token = Encoder(vocabulary, lex.mapped(tables.value)), vocabulary.tokens().__getitem__
        for batch in batches:
            for block in blocks(batch.column("text"), size=BLOCK):
                words = find_words(block, NOT_SPACE)
                ids, sizes = encoder.block(block.data.tobytes(), words, word_hashes(block, words))
                packed = _packed(ids, np.concatenate([[0], np.cumsum(sizes)])[words.at])
                columns = {"doc_id": batch.column("doc_id").slice(block.first, block.rows), "ids": packed}
                if decoded:
                    columns["decoded"] = _texts(packed, token)
                yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(rows, "doc_id long, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, vocabulary_file: str) -> DataFrame:
    """Adds column decoded to a table with column ids: the tokens with one space between.

    The file names no decoder, so end-of-word marks stay. Null ids give null, no ids an empty text;
    an unknown id is an empty token.
    """
    with open(vocabulary_file, encoding="utf-8") as file:
        tokens = encoded.sparkSession.sparkContext.broadcast(Vocabulary(file.read()).tokens())

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.value
        token = lambda i: known[i] if i < len(known) else b""
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _texts(batch.column("ids"), token)], [*batch.schema.names, "decoded"]
            )

    kept = encoded.drop("decoded")
    return kept.mapInArrow(rows, T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())]))
