"""Bloom filters of fixed largest size: the one thing of unbounded tables that is sent to all tasks.

With 16 bits for a key a filter is full at `2**MAX_BITS_LOG2 / 16` keys, 4 million. Beyond that it lets more
and more rows through to the exact join that follows; at some 50 million it lets through most of them, and
plans shuffle those rows as a plain join would.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import mix

#: No filter is larger than 2**26 bits (8 MB), whatever it holds; a full one lets more through.
MAX_BITS_LOG2 = 26
_CHUNK_LOG2 = 16  # bits of a chunk that one task fills


class Bloom:
    def __init__(self, bits: np.ndarray) -> None:
        self.bytes = bits
        self.mask = np.uint64(len(bits) * 8 - 1)

    def __contains__(self, value: int) -> bool:
        return bool(self.has(np.array([value], np.uint64))[0])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """For 64-bit hashes: False means that the filter's table doesn't have it."""
        found = self._bit(hashes & self.mask)
        maybe = np.flatnonzero(found)
        found[maybe] = self._bit((hashes[maybe] >> np.uint64(32)) & self.mask)
        return found

    def _bit(self, places: np.ndarray) -> np.ndarray:
        return (self.bytes[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 > 0


def build_ids(ids: DataFrame, column: str) -> Bloom:
    """Filter of a column of whole numbers, to be asked for `mix` of them."""
    return build_of(ids.select(column), lambda batch: mix(batch.column(0).drop_null().to_numpy().view(np.uint64)))


def build(hashes: DataFrame, column: str, bits_per_key: int = 16) -> Bloom:
    """Filter of a column of hashes. Chunks of bits are filled in tasks; the driver joins them."""
    hashes = hashes.select(F.col(column).alias("h"))
    return _filled(hashes.filter("h is not null"), hashes.count(), _hashes, bits_per_key)


def build_of(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits_per_key: int = 16) -> Bloom:
    """Filter of the hashes that a function makes of each batch of rows.

    They are made where the bits are chosen: two Python steps in a row would be two workers for each core.
    """

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(hashes(batch))], pa.int64())], ["n"])

    n = rows.mapInArrow(sizes, "n long").agg(F.sum("n").alias("n")).first().n or 0
    return _filled(rows, n, hashes, bits_per_key)


def _hashes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _filled(rows: DataFrame, n: int, hashes: Callable[[pa.RecordBatch], np.ndarray], bits_per_key: int) -> Bloom:
    log2 = min(MAX_BITS_LOG2, max(_CHUNK_LOG2, int(n * bits_per_key).bit_length()))
    mask = np.uint64((1 << log2) - 1)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = hashes(batch)
            both = np.unique(np.concatenate([values & mask, (values >> np.uint64(32)) & mask])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both >> _CHUNK_LOG2), pa.array(both)], ["chunk", "place"])

    def fill(group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _CHUNK_LOG2, np.uint8)
        bits[group.column("place").to_numpy() & ((1 << _CHUNK_LOG2) - 1)] = 1
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"chunk": group.column("chunk")[:1], "bits": pa.array([packed], pa.binary())})

    filled = rows.mapInArrow(places, "chunk long, place long").distinct().groupBy("chunk").applyInArrow(fill, "chunk long, bits binary")
    table = np.zeros(1 << log2 >> 3, np.uint8)
    width = 1 << _CHUNK_LOG2 >> 3
    for row in filled.collect():
        table[row.chunk * width : (row.chunk + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return Bloom(table)


def may_have(key: Column, known: Broadcast) -> Column:
    """Whether the sent filter's table may have the hash `key`; it may have a null one.

    Only the key goes to Python. A Python step right after it would take a worker of its own: ask there instead.
    """

    # On Arrow arrays: pandas would take 27 MB of every Python worker for as long as it lives.
    @F.arrow_udf("boolean")
    def has(keys: pa.Array) -> pa.Array:
        return pa.array(known.value.has(keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))

    return F.coalesce(has(F.coalesce(key, F.lit(0).cast("long"))) | key.isNull(), F.lit(True))


def split(rows: DataFrame, key: Column, hashes: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(without, maybe): rows whose hash `key` surely isn't in the table's column of hashes, and the rest.

    Nothing is shuffled. A null key may be in the table.
    """
    maybe = may_have(key, rows.sparkSession.sparkContext.broadcast(build(hashes, column)))
    return rows.filter(~maybe), rows.filter(maybe)
