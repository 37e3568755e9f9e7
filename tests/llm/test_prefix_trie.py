"""Prefix tries against a walk over all prefixes in plain Python, and against SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests import oracle
from tests.llm.fixtures import LARGER, SMALL
from tidemark.llm import catalog, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns)] for c, turns in found.items()}


def with_heads(convs, period=20, heads=4):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        source = c - (abs(c) % period if c >= 0 else -(abs(c) % period))
        out[c] = convs.get(source, [])[:h] + turns[h:]
    return out


def expected(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, found in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(found) - 1) * words
    rows = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((len(node), min(found), parent, len(found), children[node], leaves[node], saved[node], digest))
    return sorted(rows, key=str)


def got(df):
    columns = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def tries(spark, rows, columns, period=20, heads=4):
    turns = prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA).withColumns({"place": F.lit("x"), "t1": F.lit("y")}))
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns, period, heads), columns=columns)


def conversations(seed, many=120, longest=14):
    random.seed(seed)
    rows = []
    for c in range(many):
        size = random.choice((0, 1, 2, 3, longest))
        rows += [(c, t, random.choice("ua"), random.choice(("", "a b", "c", None))) for t in range(size)]
    return rows


@pytest.mark.parametrize(("columns", "seed"), [(8, 1), (3, 2), (1, 3)])
def test_equals_a_walk_over_prefixes(spark, columns, seed):
    rows = conversations(seed, 120 if columns > 1 else 40, 14 if columns > 1 else 6)
    assert got(tries(spark, rows, columns)) == expected(with_heads(sequences(rows)))


def test_long_conversations_that_share_blocks(spark):
    """Many blocks below one another: sums reach the root by doubling."""
    trunk = [(t, "u", f"turn {t} x") for t in range(61)]
    rows = [(100, *t) for t in trunk] + [(c, *t) for c in range(101, 109) for t in trunk[: (c - 100) * 7]]
    rows += [(c, 61 + i, "a", f"own {c}") for c in range(101, 104) for i in range(20)]
    turns = prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA))
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("size"))
    assert got(prefix_trie.prefix_trie(turns, convs, columns=2)) == expected(sequences(rows))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(0, None, None, None), (0, 1, "u", "x"), (0, 1, "u", "x"), (0, 1, "a", None), (0, -3, "u", "y")]
    rows += [(None, 1, "u", "lost"), (7, None, "u", None), (7, None, None, "u"), (-7, 2, "u", "a\x00b"), (-20, 0, "u", "head"), (27, 5, "", "")]
    assert got(tries(spark, rows, 8)) == expected(with_heads(sequences(rows)))


def test_many_conversations_end_at_one_node(spark):
    rows = [(c, 0, "u", "common") for c in range(30_000)] + [(40_000 + c, t, "u", f"{c % 7}") for c in range(300) for t in range(2)]
    turns = prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA).repartition(8))
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("size"))
    assert got(prefix_trie.prefix_trie(turns, convs)) == expected(sequences(rows))


def test_no_rows(spark):
    assert got(tries(spark, [], 8)) == []
    assert got(tries(spark, [(None, 0, "u", "x")], 8)) == []


@pytest.mark.parametrize("folder", [SMALL, LARGER])
def test_query_equals_sql(spark, folder):
    with oracle.connect(folder) as duck:
        rows = duck.execute(f"select {', '.join(['depth', 'conv_id', 'parent_conv_id', 'n_convs', 'n_children', 'n_leaves', 'saved_tokens', 'ends_sha256'])} from ({catalog.OP12_SQL})").fetchall()
    assert got(catalog.op12_prefix_trie(spark, folder)) == sorted(rows, key=str)
