"""Ids against the tokenizers library, packing against plain best-fit decreasing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.fixtures import LARGER, empty, near_copies, table, with_clashes
from tidemark.llm import catalog, packing
from tidemark.llm.packing import MAX_PLAN_ROWS, CapacityTree, best_fit_plan, pack

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(FILE)


def plain_best_fit(lengths, capacity):
    """How full the sequences are, each piece put into the tightest open one.

    Which of equally full sequences a piece takes changes their contents, but not this.
    """
    open_, out = [], []
    for length in sorted(lengths, reverse=True):
        fits = [s for s in open_ if capacity - sum(s) >= length]
        tightest = min(fits, key=lambda s: capacity - sum(s), default=None)
        if tightest is None:
            tightest = []
            out.append(tightest)
            open_.append(tightest)
        tightest.append(length)
        open_ = [s for s in open_ if sum(s) < capacity]
    return Counter(sum(s) for s in out)


def by_plan(counts, capacity):
    steps, opened = best_fit_plan(counts, capacity)
    rooms = defaultdict(int)
    for i, (length, first, each, sequence, offset) in enumerate(steps.tolist()):
        last = steps[i + 1][1] if i + 1 < len(steps) and steps[i + 1][0] == length else counts[length]
        for rank in range(first, last):
            at, place = sequence + (rank - first) // each, offset + (rank - first) % each * length
            assert rooms[at] == place
            rooms[at] += length
    assert len(rooms) == opened and all(r <= capacity for r in rooms.values())
    return Counter(rooms.values())


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    random.seed(seed)
    capacity = random.choice((1, 2, 7, 16, 40, 64))
    lengths = [random.randint(1, capacity) for _ in range(random.choice((0, 1, 60, 400)))] + [capacity] * (seed % 3)
    assert by_plan(Counter(lengths), capacity) == plain_best_fit(lengths, capacity)


def test_plan_does_not_grow_with_the_pieces():
    random.seed(4)
    shares = {length: random.randint(1, 50) for length in range(1, 1025)}
    rows = [len(best_fit_plan({k: n * many for k, n in shares.items()}, 1024)[0]) for many in (1, 1000, 10**6)]
    assert rows[2] < MAX_PLAN_ROWS and rows[2] < 2 * rows[1], rows


def test_tree_finds_the_tightest():
    random.seed(8)
    tree, rooms = CapacityTree(100), set()
    for _ in range(2000):
        room = random.randint(0, 100)
        is_open = random.random() < 0.3
        tree.set(room, is_open)
        (rooms.add if is_open else rooms.discard)(room)
        least = random.randint(0, 100)
        assert tree.tightest(least) == min((r for r in rooms if r >= least), default=None)


def expected_pieces(rows, capacity):
    out = Counter()
    for doc_id, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]
        cut = len(ids) % capacity or capacity
        cuts = [0, *range(cut, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            out[doc_id, piece, a, b - a, tuple(ids[a:b])] += 1
    return out


def check(df, rows, capacity):
    got = df.collect()
    ids = [tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    assert Counter((r.doc_id, r.piece, r.start, r.length, i) for r, i in zip(got, ids, strict=True)) == expected_pieces(rows, capacity)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for found in sequences.values():
        ends = np.cumsum([length for _, length in sorted(found)])
        assert [offset for offset, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] <= capacity
    fills = Counter(sum(n for _, n in found) for found in sequences.values())
    assert fills == plain_best_fit([r.length for r in got], capacity)
    return got


def hostile():
    spaces = ["a  b", " a\n b ", "  ", "\t\t x", "é à ü", "x  y", "x 　 y", "a\x1c b", "don't we'll 'S 's", "1 22 333 !? ...", "a\u0085 b"]
    special = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endof text|>", " <|endoftext|>  "]
    return [None, "", *spaces, *special, "x" * 3000, "token " * 900, *near_copies()[-9:]]


@pytest.mark.parametrize("capacity", [1024, 40])
def test_equals_the_library(spark, capacity):
    texts = hostile()
    docs = with_clashes(table(spark, texts)).repartition(4)
    check(pack(docs, FILE, capacity), list(enumerate(texts)), capacity)


def test_every_character_and_blocks(spark, monkeypatch):
    """Each code point beside letters, digits and spaces; small blocks, few remembered segments, a text over many blocks."""
    monkeypatch.setattr(packing, "BLOCK", 1 << 12)
    monkeypatch.setattr(packing, "KNOWN_SEGMENTS", 500)
    points = [chr(c) for c in range(1, 0x3400) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x1F300, 0x1F700)]
    texts = ["".join(f"{c}a{c} 1{c}  {c}" for c in points[i : i + 40]) for i in range(0, len(points), 40)]
    random.seed(3)
    texts.append(" ".join(random.choice(texts[0].split()) + random.choice("abc .") for _ in range(20_000)))
    check(pack(table(spark, texts), FILE, 512), list(enumerate(texts)), 512)


def test_null_and_repeated_ids(spark):
    texts = ["same text", "same text", "same text", None, "other"]
    check(pack(table(spark, texts, [3, 3, None, None, 3]), FILE, 8), list(zip([3, 3, None, None, 3], texts, strict=True)), 8)


def test_no_rows(spark):
    df = pack(empty(spark), FILE)
    assert df.columns == ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"] and df.count() == 0


def test_query_on_given_documents(spark):
    rows = catalog.op11_best_fit_packing(spark, LARGER).collect()
    lengths = [r.length for r in rows]
    packed = len({r.sequence_id for r in rows})
    assert packed == sum(plain_best_fit(lengths, 1024).values())
    assert packed <= 1.01 * -(-sum(lengths) // 1024) + 1
