"""Token counts as rollups kept up to date by deltas.

A change holds a document's count before and after it: an insert has no count before, a delete none
after, a count that was revised both. Changes add to the totals by source, language and tokenizer
version with their sign, so a batch is folded to a row per key before it is stored, and totals are sums of
batches. A new tokenizer version is a new key: its counts are inserted and the old version's deleted, in one
batch, so no total ever mixes versions.

A batch is written to a folder of its own and then committed by its name. A batch whose name is
committed is not applied again; one that failed before its commit is not read, and its next run
replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")


def folded(changes: DataFrame) -> DataFrame:
    """KEYS, n_docs and n_tokens: the signed sums of rows (KEYS, before, after). Null keys are keys."""
    one = lambda c: F.when(F.col(c).isNotNull(), 1).otherwise(0)
    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    return changes.groupBy(*KEYS).agg(
        F.sum(one("after") - one("before")).cast("long").alias("n_docs"),
        F.sum(count("after") - count("before")).alias("n_tokens"),
    )


class Rollup:
    """The totals in a folder that all executors share."""

    BATCH = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch string"

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.deltas, self.commits = spark, f"{folder}/deltas", f"{folder}/commits"
        for path, schema in ((self.deltas, self.BATCH), (self.commits, "batch string")):
            spark.createDataFrame([], schema).write.mode("append").parquet(path)

    def committed(self) -> DataFrame:
        return self.spark.read.schema("batch string").parquet(self.commits).distinct()

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of rows (KEYS, before, after); False if it was committed before.

        tokenizer is its name and version. Repeated rows count as often as they come; a batch of no rows is
        committed and changes nothing.
        """
        if not self.committed().filter(F.col("batch") == batch).isEmpty():
            return False
        stored = folded(changes).withColumn("batch", F.lit(batch))
        folder = F.sha2(F.lit(batch), 256)
        name = self.spark.range(1).select(folder).first()[0]
        stored.write.mode("overwrite").parquet(f"{self.deltas}/at={name}")
        self.spark.range(1).select(F.lit(batch).alias("batch")).write.mode("append").parquet(self.commits)
        return True

    def totals(self) -> DataFrame:
        """KEYS, n_docs, n_tokens of all committed batches; keys without documents and tokens go."""
        rows = self.spark.read.option("recursiveFileLookup", True).schema(self.BATCH).parquet(self.deltas)
        rows = rows.join(self.committed(), "batch", "left_semi")
        summed = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.filter("n_docs <> 0 or n_tokens <> 0")


#: Countable tokens of a text by tokenizer version: what a token is, as a pattern.
TOKENIZERS = {
    "words/1": r"[^\x20\x09-\x0D]+",
    "words/2": r"[^\x20\x09-\x0D]*[A-Za-z0-9][^\x20\x09-\x0D]*",
    "symbols/1": r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]",
}


def counted(docs: DataFrame, tokenizers: dict[str, str]) -> DataFrame:
    """doc_id, source, lang, copy (hash of the text, null for none) and a column per tokenizer.

    Null texts have no tokens. Repeated rows count as often as they come; an empty table gives no rows.
    Columns are named after the tokenizers, so other columns of docs don't clash.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.sha2("text", 256).alias("copy"),
        *[F.regexp_count(text, F.lit(pattern)).cast("long").alias(name) for name, pattern in tokenizers.items()],
    )


def changes(counts: DataFrame, deleted: str | None = None, inserted: str | None = None) -> DataFrame:
    """Rows for `Rollup.apply` from a table of counts by tokenizer version.

    The documents go from the totals of version `deleted` and come to those of version `inserted`; either may
    be None. With both it is a revision, and as one batch it moves from one version to the other at once.
    """
    none = F.lit(None).cast("long")
    sides = []
    if deleted:
        sides.append(F.struct(F.lit(deleted).alias("tokenizer"), F.col(f"`{deleted}`").alias("before"), none.alias("after")))
    if inserted:
        sides.append(F.struct(F.lit(inserted).alias("tokenizer"), none.alias("before"), F.col(f"`{inserted}`").alias("after")))
    return counts.select("source", "lang", F.inline(F.array(*sides)))
