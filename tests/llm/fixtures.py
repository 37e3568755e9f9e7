"""Small hostile tables: nulls, empty and long texts, ties, repeated rows, columns with clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def with_clashes(docs: DataFrame) -> DataFrame:
    """Further columns, named like those that operators use inside."""
    for name in "name n words start stop label score shingle root blob ids rules item_id a b".split():
        docs = docs.withColumn(name, F.lit(name))
    return docs


def table(spark: SparkSession, texts: list, ids: list | None = None) -> DataFrame:
    ids = ids or list(range(len(texts)))
    rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def near_copies(seed: int = 7) -> list[str]:
    """Texts at many distances from a few originals, shared passages, short and blank texts."""
    random.seed(seed)
    words = [f"w{i}" for i in range(60)] + ["Ä", "é", "THE", "the"]
    text = lambda n: [random.choice(words) for _ in range(n)]
    passage, out = text(30), []
    for size in (4, 5, 8, 40, 120):
        original = text(size)
        for _ in range(14):
            copy = list(original)
            for _ in range(random.choice((0, 0, 1, 1, 2, 3, 6))):
                copy[random.randrange(len(copy))] = random.choice(words)
            if random.random() < 0.3:
                copy = copy[random.randrange(3) :]
            out.append(random.choice((" ", "\n", " \t")).join(copy))
    out += [" ".join([*text(20), *passage]) for _ in range(12)]
    out += ["", " \n\t", "a", "a", "A", "a b", "a b c d", "a b c d e", "x " * 400, "x " * 300, " ".join(text(3000))]
    return out
