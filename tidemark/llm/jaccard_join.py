"""Exact Jaccard join on word shingles by vertical partitioning.

The shingles have one global order, rare ones first. The order is cut into fragments; a pair's
overlap is counted in each fragment separately and the counts are summed per pair.

1. `shingle_stats` folds every text to its set's size and signature. Equal sets are one class, so
   exact copies cost one row each from here on.
2. `shared_classes` looks at the prefix of each set in the order of the hashes, 30 % of it for a threshold
   of 80 %: sets that link have a tenth of the smaller's shingles in common in their prefixes. It cuts the
   prefixes by ranges of the hash and counts in each fragment which of a class's shingles another class
   has too. Most texts end here, after one shuffle of their prefixes with 32 bits for a shingle and 96 for
   a class and fragment (a clash of two can only keep a class too many). A class is cut from one row, and
   shingles that several classes of a batch have are folded, so neither a large group of copies nor a
   passage that very many texts share fills a fragment.
3. `ordered_sets` makes the sets of the rest again, with whole 64-bit shingles, in the global order:
   the power of two below the number of classes that hold the shingle, then its hash.
4. `_entries` are the prefixes: two sets that link share a shingle whose places in both leave
   enough room for the overlap (the positional bound covers the length bound).
5. Stars: in each shingle's list every set is compared with the one that has the shingle foremost.
   The sets linked so far form components. A second pass compares what is left *across*
   components; pairs inside one cannot change the result, so a group of thousands of near copies
   is never expanded into pairs, and no link between components is lost.
6. `verified` counts overlaps fragment by fragment for the candidate pairs and sums.

Classes are named by 64 bits of their signature: two different sets share a name, and then count
as one, with probability 2**-64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bloom
from tidemark.llm.components import connected_components
from tidemark.llm.words import blocks, lean, mix, shingle_sets, small_batches
from tidemark.sources.cache import kept as kept_in_memory
from tidemark.sources.files import scratch_path, snapshot

#: Shingles of a fragment when classes are counted; a task holds about six bytes of each.
FRAGMENT_SHINGLES = 2_500_000
SLICES_LOG2 = 3
#: Classes with more than this part of all rows are cut from one row only; others may be cut from several.
LARGE_CLASSES = 100_000
#: The name under which a shingle goes on that several classes of a batch have.
_MARK = np.iinfo(np.int64).min
#: Equal steps of the hash at which each level of the global order is cut.
STEPS = 2


def _signatures(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums of the set's mixed elements, independent of each other; 0 for an empty set."""
    sums = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(salt)))])
        sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return sums[0], sums[1]


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    for batch in batches:
        for block in blocks(batch.column("text"), lower=True):
            hashes, bounds = shingle_sets(block, size)
            yield batch.slice(block.first, block.rows), (hashes, bounds, *_signatures(hashes, bounds))


def shingle_stats(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, sig_a, sig_b of every row."""

    @lean
    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, (_, bounds, a, b) in _sets(batches, size):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(bounds)), pa.array(a), pa.array(b)],
                ["doc_id", "n_shingles", "sig_a", "sig_b"],
            )

    return docs.mapInArrow(stats, "doc_id long, n_shingles long, sig_a long, sig_b long")


class _Once:
    """Which rows are further copies of classes that have many, by filters of bounded size.

    Every representative passes: of each class that the filter of large classes lets through, rightly or
    not, the representative is in the second filter. A further copy may pass, which changes no result.
    """

    def __init__(self, classes: DataFrame, rows: int) -> None:
        many = max(2, math.ceil(rows / LARGE_CLASSES))
        self.large = _filter_of_names(classes.filter(F.col("copies") >= many), bits_per_key=512)
        self.first = _filter_of_names(classes, self.large)

    def further(self, names: np.ndarray, ids: pa.Array) -> np.ndarray:
        names, ids = names.view(np.uint64), ids.fill_null(0).to_numpy().view(np.uint64)
        return self.large.has(mix(names)) & ~self.first.has(mix(names ^ mix(ids)))


def _filter_of_names(classes: DataFrame, within: bloom.Bloom | None = None, bits_per_key: int = 16) -> bloom.Bloom:
    """Of hashes of the names, or of name and representative of the classes that a filter lets through."""

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        names, ids = (batch.column(c).fill_null(0).to_numpy().view(np.uint64) for c in ("name", "rep"))
        return mix(names) if within is None else mix(names ^ mix(ids))[within.has(mix(names))]

    return bloom.build_of(classes.select("name", "rep"), hashes, bits_per_key)


def _more(n: np.ndarray | int, percent: int) -> np.ndarray:
    """How many shingles beyond the shortest necessary prefix are tested, plus one: more of them cost more
    rows and let through fewer sets."""
    return np.maximum(1, n * (100 - percent) // 200)


def prefix_sizes(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-n * percent // 100) + _more(n, percent), 0)


def least_shared(n: np.ndarray, percent: int) -> np.ndarray:
    """Sets that link have so many shingles in common in their prefixes, of any global order.

    The overlap o is at least percent of either size. The k-th common shingle has o - k common ones after
    it, so it is among the first n - o + k of both; k is bounded by the smallest partner's prefix.
    """
    return _more(-(-n * percent // 100), percent)


def _prefixes(batch: pa.RecordBatch, size: int, percent: int, once: _Once) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, owners, shingles) of a batch's classes, without repeats, in the order of the shingles."""
    names, shingles = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for part, (hashes, bounds, name, _) in _sets(iter([batch]), size):
        n = np.diff(bounds)
        taken = np.where(once.further(name, part.column("doc_id")), 0, prefix_sizes(n, percent))
        place = np.arange(len(hashes)) - np.repeat(bounds[:-1], n)
        shingles.append(mix(hashes[place < np.repeat(taken, n)]))
        names.append(np.repeat(name, taken))
    shingles = np.concatenate(shingles)
    names, owners = np.unique(np.concatenate(names), return_inverse=True)
    order = np.lexsort((owners, shingles))
    owners, shingles = owners[order], shingles[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (shingles[1:] != shingles[:-1])
    return names, owners[new], shingles[new]


def _segments(docs: DataFrame, size: int, bits: int, percent: int, once: _Once) -> DataFrame:
    """fragment, and packed for a batch of rows: names, sizes of their segments, shingles.

    Shingles that several classes of the batch have are counted here: one row of a negative fragment has the
    names and their counts, and of such a shingle a single mark goes on, so that a shingle of very many
    classes is one entry for each batch.
    """

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, owners, shingles = _prefixes(batch, size, percent, once)
            if not len(names):
                continue
            first = np.ones(len(shingles), bool)
            first[1:] = shingles[1:] != shingles[:-1]
            common = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1] > 1
            hits = np.bincount(owners[common], minlength=len(names))
            owners = np.where(common, len(names), owners)[~common | first]
            shingles, names = shingles[~common | first], np.append(names, _MARK)
            fragment = (shingles >> np.uint64(64 - bits)).astype(np.int32)
            order = np.lexsort((owners, fragment))
            owners, fragment = owners[order], fragment[order]
            rest = ((shingles[order] >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            found, at = np.unique(fragment, return_index=True)
            columns: list[list] = [[], [], []]
            for begin, end in zip(at, [*at[1:], len(fragment)], strict=True):
                who, sizes = np.unique(owners[begin:end], return_counts=True)
                columns[0].append(names[who].tobytes())
                columns[1].append(sizes.astype(np.uint32).tobytes())
                columns[2].append(rest[begin:end].tobytes())
            counted = np.flatnonzero(hits)
            columns[0].append(names[counted].tobytes())
            columns[1].append(hits[counted].astype(np.uint32).tobytes())
            columns[2].append(b"")
            aside = -1 - int(names[0] & ((1 << bits) - 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*found.tolist(), aside], pa.int32()), *(pa.array(c, pa.binary()) for c in columns)],
                ["fragment", "names", "sizes", "shingles"],
            )

    return docs.mapInArrow(cut, "fragment int, names binary, sizes binary, shingles binary")


def _count_shared(group: pa.Table) -> pa.Table:
    """name, shared: one row for each shingle in the fragment that another class has too.

    The fragment is worked on in slices of its hashes, so that little more than itself is in memory.
    """

    def column(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(name)])

    names, sizes = column("names", np.int64), column("sizes", np.uint32)
    if group.column("fragment")[0].as_py() < 0:
        return pa.table({"name": names, "shared": sizes.astype(np.int64)})
    names, owner = np.unique(names, return_inverse=True)
    owner = np.repeat(owner.astype(np.uint32), sizes)
    shingles = column("shingles", np.uint32)
    slice_of = (shingles >> np.uint32(32 - SLICES_LOG2)).astype(np.uint8)
    out = [np.zeros(0, np.int64)]
    for number in range(1 << SLICES_LOG2):
        here = slice_of == number
        keys = np.unique((shingles[here].astype(np.uint64) << np.uint64(32)) | owner[here])
        found = keys >> np.uint64(32)
        same = found[1:] == found[:-1]
        shared = np.zeros(len(keys), bool)
        shared[1:] |= same
        shared[:-1] |= same
        out.append(names[(keys[shared] & np.uint64(0xFFFFFFFF)).astype(np.int64)])
    held = np.concatenate(out)
    held = held[held != _MARK]
    return pa.table({"name": held, "shared": np.ones(len(held), np.int64)})


def shared_classes(docs: DataFrame, classes: DataFrame, size: int, percent: int, bits: int | None = None) -> DataFrame:
    """Those classes whose prefixes have as many shingles in common with others as sets that link must have."""
    of = classes.agg(F.sum("n").alias("n"), F.sum("copies").alias("rows")).first()
    tested = (of.n or 0) * (100 - percent) * 3 / 200
    bits = bits or max(4, math.ceil(math.log2(max(1, tested / FRAGMENT_SHINGLES))))
    once = _Once(classes, of.rows or 0)
    counted = (
        _segments(docs, size, bits, percent, once)
        .groupBy("fragment")
        .applyInArrow(_count_shared, "name long, shared long")
        .groupBy("name")
        .agg(F.sum("shared").alias("shared"))
    )
    at_least = F.expr(f"greatest(1, ((n * {percent} + 99) div 100) * {100 - percent} div 200)")
    return classes.join(counted, "name").filter(F.col("shared") >= at_least).drop("shared")


def _set_rows(docs: DataFrame, size: int, wanted: bloom.Bloom) -> DataFrame:
    """doc_id, name, shingles of the rows whose id the filter lets through, null ids included."""

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            known = wanted.has(mix(ids.fill_null(0).to_numpy().view(np.uint64)))
            chosen = batch.filter(pa.array(known | ids.is_null().to_numpy(zero_copy_only=False)))
            for part, (hashes, bounds, name, _) in _sets(iter([chosen]), size):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(name), lists], ["doc_id", "name", "shingles"])

    return docs.mapInArrow(rows, "doc_id long, name long, shingles array<long>")


def ordered_sets(docs: DataFrame, kept: DataFrame, size: int, percent: int, unique_ids: bool) -> DataFrame:
    """name, n, own, parts: shingles that no other kept set has are only counted (`own`), the rest
    is listed in the global order as (level, shingle). Sets with too few of these go.

    Each kept class is taken back from one row. A filter of those rows' ids lets the scan drop nearly
    all others before it makes sets, so that texts are not shuffled; the join then is exact.
    """
    wanted = bloom.build_ids(kept, "rep")
    one = kept.select(F.col("rep").alias("doc_id"), "name")
    sets = _set_rows(docs, size, wanted).alias("s").join(
        one.alias("k"), (F.col("s.name") == F.col("k.name")) & F.col("s.doc_id").eqNullSafe(F.col("k.doc_id"))
    )
    sets = sets.select("s.name", "s.shingles")
    if not unique_ids:
        sets = sets.dropDuplicates(["name"])
    single = sets.select("name", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    hashed = lambda df: df.withColumn("_h", F.xxhash64("shingle"))
    levels = single.groupBy("shingle").count().filter("count > 1")
    levels = levels.select("shingle", F.floor(F.log2("count")).cast("int").alias("level"))
    ordered = (
        hashed(single)
        .join(hashed(levels), ["shingle", "_h"])
        .groupBy("name", "n")
        .agg(F.sort_array(F.collect_list(F.struct("level", "shingle"))).alias("parts"))
        .withColumn("own", F.col("n") - F.size("parts"))
        .filter(F.size("parts") * 100 >= F.col("n") * percent)
    )
    with kept_in_memory(sets):
        return snapshot(ordered, scratch_path(docs.sparkSession, "jaccard-sets"))


class _Bound:
    """The threshold `percent`, in whole numbers: overlap o of sets of n and m shingles links when
    100 o >= percent (n + m - o)."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def links(self, overlap: Column, n: Column, m: Column) -> Column:
        return overlap * (100 + self.percent) >= (n + m) * self.percent

    def largest_partner(self, n: Column, place: Column) -> Column:
        """No larger set can link through a shingle at that place (from 0)."""
        return F.floor((n - place) * (100 + self.percent) / self.percent) - n


def _entries(sets: DataFrame, bound: _Bound) -> DataFrame:
    """shingle, name, n, place, most: the shingles through which a set may still link."""
    places = sets.select("name", "n", "own", F.posexplode("parts").alias("at", "part")).select(
        F.col("part.shingle").alias("shingle"), "name", "n", (F.col("own") + F.col("at")).alias("place")
    )
    return places.filter((F.col("n") - F.col("place")) * 100 >= F.col("n") * bound.percent).withColumn(
        "most", bound.largest_partner(F.col("n"), F.col("place"))
    )


def _side(entries: DataFrame, suffix: str) -> DataFrame:
    columns = [c for c in entries.columns if c != "shingle"]
    return entries.select("shingle", F.xxhash64("shingle").alias("_h"), *[F.col(c).alias(c + suffix) for c in columns])


def _fits() -> Column:
    return (F.col("n_a") <= F.col("most_b")) & (F.col("n_b") <= F.col("most_a"))


def _star_pairs(entries: DataFrame) -> DataFrame:
    foremost = F.struct((F.col("place") / F.col("n")).alias("depth"), "name", "n", "most")
    stars = entries.groupBy("shingle").agg(F.min(foremost).alias("s"), F.count("*").alias("c")).filter("c > 1")
    stars = _side(stars.select("shingle", "s.name", "s.n", "s.most"), "_a")
    return (
        _side(entries, "_b")
        .join(stars, ["shingle", "_h"])
        .filter((F.col("name_a") != F.col("name_b")) & _fits())
        .select(F.col("name_a").alias("a"), F.col("name_b").alias("b"), F.col("n_a"), F.col("n_b"))
        .distinct()
    )


def _cross_pairs(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of sets in different components that the bounds allow.

    Before the join, an entry stays only if its list has a set of another component that is small
    enough for it and has enough room itself; lists of one component vanish here.
    """
    entries = entries.join(roots.select(F.col("node").alias("name"), "root"), "name", "left").withColumn(
        "root", F.coalesce("root", "name")
    )
    of_list = Window.partitionBy("shingle")
    held = entries.groupBy("shingle", "root").agg(F.min("n").alias("small"), F.max("most").alias("room"))
    held = held.withColumns(
        {
            "first": F.min(F.struct("small", "root")).over(of_list),
            "widest": F.max(F.struct("room", "root")).over(of_list),
        }
    )
    held = held.withColumns(
        {
            "second": F.min(F.when(F.col("root") != F.col("first.root"), F.col("small"))).over(of_list),
            "wide": F.max(F.when(F.col("root") != F.col("widest.root"), F.col("room"))).over(of_list),
        }
    )
    rivals = held.select(
        "shingle",
        "root",
        F.when(F.col("root") == F.col("first.root"), F.col("second")).otherwise(F.col("first.small")).alias("rival_small"),
        F.when(F.col("root") == F.col("widest.root"), F.col("wide")).otherwise(F.col("widest.room")).alias("rival_room"),
    ).filter("rival_small is not null and rival_room is not null")
    hashed = lambda df: df.withColumn("_h", F.xxhash64("shingle", "root"))
    left = (
        hashed(entries)
        .join(hashed(rivals), ["shingle", "root", "_h"])
        .filter("rival_small <= most and n <= rival_room")
        .drop("_h", "rival_small", "rival_room")
    )
    return (
        _side(left, "_a")
        .join(_side(left, "_b"), ["shingle", "_h"])
        .filter((F.col("root_a") < F.col("root_b")) & _fits())
        .select(F.col("name_a").alias("a"), F.col("name_b").alias("b"), F.col("n_a"), F.col("n_b"))
        .distinct()
    )


def verified(pairs: DataFrame, sets: DataFrame, bound: _Bound) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted by fragment of the order and summed per pair."""
    step = F.shiftrightunsigned(F.col("part.shingle"), 64 - int(math.log2(STEPS)))
    segments = (
        sets.select("name", F.explode("parts").alias("part"))
        .groupBy("name", F.col("part.level").alias("level"), step.alias("step"))
        .agg(F.collect_list("part.shingle").alias("segment"))
    )
    a = segments.select(F.col("name").alias("a"), "level", "step", F.col("segment").alias("segment_a"))
    b = segments.select(F.col("name").alias("b"), "level", "step", F.col("segment").alias("segment_b"))
    return (
        pairs.join(a, "a")
        .join(b, ["b", "level", "step"])
        .withColumn("partial", F.size(F.array_intersect("segment_a", "segment_b")))
        .groupBy("a", "b", "n_a", "n_b")
        .agg(F.sum("partial").alias("overlap"))
        .filter(bound.links(F.col("overlap"), F.col("n_a"), F.col("n_b")))
        .select("a", "b")
    )


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs` (doc_id, text; others are ignored).

    Rows link when the Jaccard similarity of their sets of `size`-word shingles is at least
    `percent` / 100, compared in whole numbers. Words are split at ASCII white space after
    lower-casing A-Z. `component_id` is the smallest doc_id that links reach, the row's own included.

    Null and blank texts: 0 shingles, linked with nothing. Fewer words than `size`: the whole
    sequence is the one shingle. Repeated rows and ids stay rows. A null doc_id takes part in the
    links but is never a component_id, unless all ids of its component are null. An empty table
    gives no rows.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bound, folder = _Bound(percent), scratch_path(docs.sparkSession, "jaccard")
    stats = snapshot(shingle_stats(docs, size), f"{folder}/stats")
    classes = stats.filter("n_shingles > 0").groupBy("n_shingles", "sig_a", "sig_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = classes.select(F.col("sig_a").alias("name"), F.col("n_shingles").alias("n"), "rep", "copies")
    classes = snapshot(classes, f"{folder}/classes")
    kept = snapshot(shared_classes(docs, classes, size, percent), f"{folder}/kept")
    unique_ids = stats.groupBy("doc_id").count().filter("count > 1").isEmpty()
    sets = ordered_sets(docs, kept, size, percent, unique_ids)
    entries = _entries(sets, bound)
    roots = connected_components(verified(_star_pairs(entries), sets, bound))
    more = verified(_cross_pairs(entries, roots), sets, bound)
    roots = connected_components(more.union(roots.select("node", "root")))
    named = classes.join(roots.select(F.col("node").alias("name"), "root"), "name", "left")
    named = named.withColumn("root", F.coalesce("root", "name"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component"))
    named = named.join(smallest, "root").select("name", "n", "component")
    return stats.join(
        named, (F.col("sig_a") == F.col("name")) & (F.col("n_shingles") == F.col("n")), "left"
    ).select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
