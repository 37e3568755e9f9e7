"""Repeatable pseudo-random numbers from row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_fraction(keys: Sequence[str], seed: int) -> Column:
    """Uniform number in [0, 1) that depends on the key columns and the seed only.

    Unlike `rand(seed)` it does not change with the partitioning, so a split
    stays the same when a lost task is run again or the input is re-read.
    """
    if not keys:
        raise ValueError("at least one key column is needed")
    texts = [F.col(k).cast("string") for k in keys]
    # Lengths keep ("a|b", "c") from ("a", "b|c"), and a null from an absent part.
    parts = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("null")) for t in texts]
    text = F.concat_ws("|", *parts, F.lit(str(seed)))
    digits = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**32))
