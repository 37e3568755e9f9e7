"""Tries of conversation prefixes by ROLLUP over positional turn columns.

Two conversations share a trie node as long as their first turns are the same. The turns of a block of
`columns` places are as many columns, and one ROLLUP over them makes all prefixes of the block; the
grouping id is the prefix's length. Longer conversations have further blocks, whose rows begin with the
node at which the block before ended, so one ROLLUP serves all blocks together.

A node is named by its depth and 128 bits: the XOR of a hash of place and turn for each turn, which a
running window yields for every place. So a node knows its parent's name without a walk.

What is summed over subtrees goes up by a second ROLLUP, of the nodes themselves. A block's sums reach the
blocks above it by doubling: in round k every block has the sums of all blocks that are less than 2**k
below it. Conversations of one block take no round, others as many as the logarithm of their blocks.

The digest of the conversations that end at a node is that of one long text. It is hashed over chunks in
their order, as a stream: a range shuffle makes the chunks, so a node at which a third of all
conversations ends is many tasks' work, and the last task reads one row for each chunk.

A conversation's turns are numbered by a window, sorted in one task (which spills).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.files import scratch_path, snapshot

#: Places of a block: the columns of the ROLLUP.
COLUMNS = 8
NODE = ("depth", "node_a", "node_b")


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn_id, words of every turn of turns (conv_id, turn, role, text).

    A conversation is ordered by turn, null first, then by role and text; null role and text are empty.
    turn_id is 128 bits of role and text, words counts `[^\\x20\\x09-\\x0D]+`. Rows without conv_id go.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
    rows = rows.filter("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    named = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), named.alias("turn_id"), words.alias("words"))


def rebuilt(placed: DataFrame, period: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): every conversation c with the head of conversation c - c % period.

    The first h = crc32(c) % heads turns are replaced by as many of that conversation's (all if it has
    fewer, none if there is none). turns has the columns of `numbered`, conversations conv_id and size;
    a conversation of which nothing is left has size 0.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    convs = placed.groupBy("conv_id").agg(F.max("place").alias("had"))
    convs = convs.withColumns({"h": h, "source": F.col("conv_id") - F.col("conv_id") % period})
    sources = placed.filter((F.col("conv_id") % period == 0) & (F.col("place") < heads))
    head = F.sort_array(F.collect_list(F.struct("place", "turn_id", "words")))
    sources = sources.groupBy(F.col("conv_id").alias("source")).agg(head.alias("head"))
    convs = convs.join(sources, "source", "left").withColumn("head", F.slice(F.coalesce("head", F.array()), 1, F.col("h")))
    convs = convs.withColumn("taken", F.size("head"))
    heads_of = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.place", "t.turn_id", "t.words")
    own = placed.withColumn("h", h).filter("place > h").join(convs.select("conv_id", "taken"), "conv_id")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "turn_id", "words")
    size = F.col("taken") + F.greatest(F.col("had") - F.col("h"), F.lit(0))
    return heads_of.union(own), convs.select("conv_id", size.alias("size"))


def _hashes(place: Column, turn: Column) -> tuple[Column, Column]:
    place = place.cast("int")
    return F.xxhash64(place, turn), F.xxhash64(turn, place)


def _blocks(turns: DataFrame, convs: DataFrame, columns: int) -> DataFrame:
    """conv_id, block, prior_a, prior_b and the block's turns t1.. (turn_id, words); null beyond the last.

    prior names the node at which the block before ended. Every conversation has its block 0.
    """
    upto = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    a, b = _hashes(F.col("place"), F.col("turn_id"))
    before = lambda c: F.coalesce(F.bit_xor(c).over(upto), F.lit(0).cast("long"))
    at = ((F.col("place") - 1) % columns).alias("at")
    rows = turns.select(
        "conv_id", F.floor((F.col("place") - 1) / columns).cast("int").alias("block"), at,
        F.struct("turn_id", "words").alias("t"), before(a).alias("a"), before(b).alias("b"),
    )
    first = F.col("at") == 0
    rows = rows.groupBy("conv_id", "block").agg(
        F.max(F.when(first, F.col("a"))).alias("prior_a"),
        F.max(F.when(first, F.col("b"))).alias("prior_b"),
        *[F.max(F.when(F.col("at") == i, F.col("t"))).alias(f"t{i + 1}") for i in range(columns)],
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("struct<turn_id: binary, words: long>")
    turnless = convs.filter("size = 0").select(
        "conv_id", F.lit(0).alias("block"), zero.alias("prior_a"), zero.alias("prior_b"), *[none.alias(f"t{i + 1}") for i in range(columns)]
    )
    return rows.union(turnless)


def _prefixes(rows: DataFrame, columns: int, aggregates: list[Column]) -> DataFrame:
    """One row for each prefix of the blocks' turns: prior, t1.. (null beyond), at (its turns in the block).

    A block's empty prefix is the node at which the block before ended, so only block 0 has one.
    """
    turns = [f"t{i + 1}" for i in range(columns)]
    prior = F.struct("block", "prior_a", "prior_b").alias("prior")
    grouped = rows.select(prior, *turns, *[c for c in rows.columns if c not in ("block", "prior_a", "prior_b", *turns)])
    found = grouped.rollup("prior", *turns).agg(F.grouping_id().alias("grouped"), *aggregates)
    found = found.filter("prior is not null").withColumn("at", F.lit(columns) - F.bit_count("grouped"))
    last = F.element_at(F.array(*turns), F.greatest(F.col("at"), F.lit(1)).cast("int"))
    real = F.when(F.col("at") == 0, F.col("prior.block") == 0).otherwise(last.isNotNull())
    return found.filter(real).drop("grouped")


def _nodes(blocks: DataFrame, columns: int) -> DataFrame:
    """Every node: its name, its parent's name, its place in its block, and its members."""
    found = _prefixes(blocks, columns, [F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")])
    a, b = [F.col("prior.prior_a")], [F.col("prior.prior_b")]
    for i in range(columns):
        here, turn = F.col("prior.block") * columns + i + 1, F.col(f"t{i + 1}")
        for side, value in zip((a, b), _hashes(here, turn["turn_id"]), strict=True):
            side.append(F.when(turn.isNotNull(), value).otherwise(F.lit(0).cast("long")))
    xor = lambda side: reduce(lambda x, y: x.bitwiseXOR(y), side)
    last = F.coalesce(*[F.col(f"t{i + 1}") for i in reversed(range(columns))])
    found = found.withColumns({"depth": (F.col("prior.block") * columns + F.col("at")).cast("long"), "node_a": xor(a), "node_b": xor(b)})
    up_a, up_b = _hashes(F.col("depth"), last["turn_id"])
    return found.withColumns(
        {
            "words": F.coalesce(last["words"], F.lit(0).cast("long")),
            "up_a": F.col("node_a").bitwiseXOR(F.coalesce(up_a, F.lit(0).cast("long"))),
            "up_b": F.col("node_b").bitwiseXOR(F.coalesce(up_b, F.lit(0).cast("long"))),
        }
    ).withColumns({c: F.when(F.col("depth") > 0, F.col(c)) for c in ("up_a", "up_b")})


def _ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """NODE, conv_id: the node at which every conversation ends."""
    a, b = _hashes(F.col("place"), F.col("turn_id"))
    found = turns.groupBy("conv_id").agg(F.max("place").cast("long").alias("depth"), F.bit_xor(a).alias("node_a"), F.bit_xor(b).alias("node_b"))
    zero = F.lit(0).cast("long")
    empty = convs.filter("size = 0").select("conv_id", *[zero.alias(c) for c in NODE])
    return found.select("conv_id", *NODE).union(empty)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """(node, first row, end row) of each run of rows of one node."""
    keys = [batch.column(c).to_numpy() for c in NODE]
    changed = np.zeros(batch.num_rows, bool)
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        if end > start:
            yield tuple(int(key[start]) for key in keys), start, end


def _ends_digests(ends: DataFrame) -> DataFrame:
    """NODE, ends_sha256: SHA-256 of each node's conv_ids in ascending order, comma-joined."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column("conv_id").to_pylist(), []
            for node, start, end in _runs(batch):
                out.append((*node, ids[start], ",".join(map(str, ids[start:end]))))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*NODE, "first", "chunk"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        pack = lambda rows: pa.RecordBatch.from_pylist(
            [dict(zip((*NODE, "ends_sha256"), row, strict=True)) for row in rows],
            pa.schema([*[(c, pa.int64()) for c in NODE], ("ends_sha256", pa.string())]),
        )
        for batch in batches:
            texts, done = batch.column("chunk"), []
            for found, start, end in _runs(batch):
                if found != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state, lead = found, hashlib.sha256(), b""
                else:
                    lead = b","
                for at in range(start, end):
                    state.update(lead + texts[at].as_buffer().to_pybytes())
                    lead = b","
            yield pack(done)
        if node is not None:
            yield pack([(*node, state.hexdigest())])

    name = ", ".join(f"{c} long" for c in NODE)
    parts = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(chunks, f"{name}, first long, chunk string")
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digests, f"{name}, ends_sha256 string")


def _sums_below(nodes: DataFrame, columns: int, folder: str) -> DataFrame:
    """NODE, below_leaves, below_saved: sums over all nodes of the blocks that begin at a node, and further."""
    sums = [F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved")]
    roots = nodes.filter("prior.block > 0").groupBy("prior").agg(*sums)
    block = (F.col("depth") / columns).cast("int")
    starts = nodes.filter((F.col("at") == columns)).select(
        F.struct(block.alias("block"), F.col("node_a").alias("prior_a"), F.col("node_b").alias("prior_b")).alias("prior"), F.col("prior").alias("up")
    )
    state = roots.join(starts, "prior", "left").withColumn("up", F.when(F.col("up.block") > 0, F.col("up")))
    state = snapshot(state.select("prior", "up", "leaves", "saved"), f"{folder}/below-0")
    most = state.agg(F.max("prior.block")).first()[0] or 0
    hashed = lambda df, key: df.withColumn("_h", F.xxhash64(key))
    for round_ in range(math.ceil(math.log2(most)) if most > 1 else 0):
        more = state.filter("up is not null").groupBy("up").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        above = state.select(F.col("prior").alias("up"), F.col("up").alias("next"))
        state = (
            hashed(state, "up")
            .join(hashed(above, "up"), ["up", "_h"], "left")
            .join(more.withColumnRenamed("up", "prior"), "prior", "left")
            .select(
                "prior",
                F.col("next").alias("up"),
                (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            )
        )
        state = snapshot(state, f"{folder}/below-{round_ + 1}")
    return state.select(
        (F.col("prior.block") * columns).cast("long").alias("depth"), F.col("prior.prior_a").alias("node_a"),
        F.col("prior.prior_b").alias("node_b"), F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"),
    )


def prefix_trie(turns: DataFrame, conversations: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """The trie of turns (conv_id, place, turn_id, words) and conversations (conv_id, size): a row per node.

    conv_id: the smallest conversation that starts with the node's turns, its members. depth: how many turns;
    0 is the root, of which all conversations are members. parent_conv_id: that of the parent, null at the
    root. n_convs: members. n_children. n_leaves: nodes without children in the subtree, itself included.
    saved_tokens: over the subtree, (n_convs - 1) times the words of each node's last turn, which is what
    storing shared prefixes once saves. ends_sha256: digest of the members that have no further turn.

    A node is found again by conv_id and depth. Places run from 1 without gaps; null ids are not allowed
    (`numbered` drops them). Without conversations there are no rows, not even a root.
    """
    spark = turns.sparkSession
    folder = scratch_path(spark, "prefix-trie")
    turns = snapshot(turns.select("conv_id", F.col("place").cast("int").alias("place"), "turn_id", "words"), f"{folder}/turns")
    conversations = snapshot(conversations.select("conv_id", "size"), f"{folder}/conversations")
    blocks = snapshot(_blocks(turns, conversations, columns), f"{folder}/blocks")
    nodes = snapshot(_nodes(blocks, columns), f"{folder}/nodes")

    parent = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("node_a"), F.col("up_b").alias("node_b")]
    children = nodes.filter("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, list(NODE), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")})
    nodes = snapshot(nodes.join(_ends_digests(_ends(turns, conversations)), list(NODE), "left"), f"{folder}/with-children")

    # A further join column has both sides shuffled, so that a node of very many children can be split.
    hashed = lambda df, *key: df.withColumn("_h", F.xxhash64(*key))
    above = nodes.select(F.col("depth").alias("up_depth"), F.col("node_a").alias("up_a"), F.col("node_b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    key = ("up_depth", "up_a", "up_b")
    named = hashed(nodes.withColumn("up_depth", F.col("depth") - 1), *key).join(hashed(above, *key), [*key, "_h"], "left")
    rows = named.join(_sums_below(nodes, columns, folder), list(NODE), "left")
    kept = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "ends_sha256"]
    rows = rows.select(
        "prior.*",
        *[f"t{i + 1}" for i in range(columns)],
        F.struct(*kept).alias("own"),
        (F.col("leaf") + F.coalesce("below_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("below_saved", F.lit(0))).alias("saved"),
    )
    # The shallowest node below a prefix is that of the prefix itself.
    sums = [F.min("own").alias("own"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")]
    return _prefixes(rows, columns, sums).select(
        *[f"own.{c}" for c in kept[:-1]],
        "n_leaves",
        "saved_tokens",
        F.coalesce("own.ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
