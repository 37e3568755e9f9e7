"""From raw documents to token ids: the stages of the corpus, each on what the one before kept.

Rows with null or repeated ids are rows like others. Decisions that depend on the text alone are
joined by the text's hash, so they hold whatever the ids are. Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import Query, ensure_scratch
from tidemark.llm import bloom, bpe, language
from tidemark.llm.catalog import bpe_digests, vocabulary_path
from tidemark.llm.decontaminate import contamination
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.secrets import masked, secret_spans
from tidemark.sources.files import read_table, scratch_path, snapshot

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter go; a missing language is filled in, if any was learned.

    A given language stays, whatever the parser takes the text for. Null and empty texts have no letter;
    an empty table stays empty.
    """
    ensure_scratch(spark)
    parser = language.learn(docs.select("lang", "text"))
    given = {name: f"_given_{name}" for name in language.FOUND if name in docs.columns}
    found = language.tagged(docs.withColumnsRenamed(given), parser).filter("lettered")
    if parser.languages:
        found = found.withColumn("lang", F.coalesce("lang", "lang_pred"))
    found = found.drop(*language.FOUND)
    return found.withColumnsRenamed({hidden: name for name, hidden in given.items()}).select(docs.columns)


def _hidden(docs: DataFrame, *names: str) -> list[str]:
    """Column names for use inside a stage that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for n in (f"_{name}{'_' * i}" for i in range(len(taken) + 1)) if n not in taken) for name in names]


def _long(key: Column) -> Column:
    return F.xxhash64(key)


def _without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """Rows whose key isn't in the one column of gone; null keys stay.

    A filter of the keys that go, which are few, lets most rows through without a shuffle; the rest is joined.
    """
    name, (own, other, own_hash, other_hash) = gone.columns[0], _hidden(docs, "key", "gone", "hash", "gone_hash")
    sure, maybe = bloom.split(docs, _long(key), gone.select(_long(F.col(name)).alias("h")), "h")
    maybe = maybe.withColumns({own: key, own_hash: _long(key)})
    gone = gone.select(F.col(name).alias(other), _long(F.col(name)).alias(other_hash))
    same = (F.col(own) == F.col(other)) & (F.col(own_hash) == F.col(other_hash))
    return sure.union(maybe.join(gone, same, "left_anti").select(docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays: the one with the smallest id.

    Documents without an id come last and count as one where their texts are equal. Of rows that share
    the smallest id the one with the smallest hash of its text stays. Null and blank texts are components
    of their own, by id. An empty table stays empty.
    """
    ensure_scratch(spark)
    if not docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return _near_duplicates_of_repeated_ids(spark, docs)
    own = F.xxhash64("text").bitwiseAND(2**62 - 1).bitwiseOR(2**62)
    key = F.coalesce(F.col("doc_id").cast("long"), own)
    found = jaccard_components(docs.select(key.alias("doc_id"), "text"))
    gone = found.filter("doc_id <> component_id").select("doc_id")
    return _without(docs, key, snapshot(gone, scratch_path(spark, "near-duplicates")))


def _near_duplicates_of_repeated_ids(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`near_duplicates` where an id may hold several texts: texts are compared by their hash, and the
    row that stays is named by id and hash. Texts without words are components of their own, by id."""
    key = F.xxhash64("text")
    own = key.bitwiseAND(2**62 - 1).bitwiseOR(2**62)
    text_, id_ = _hidden(docs, "text", "id")
    rows = docs.withColumns({text_: key, id_: F.coalesce(F.col("doc_id").cast("long"), own)})
    found = jaccard_components(rows.select(F.col(text_).alias("doc_id"), "text")).distinct()
    found = snapshot(found, scratch_path(spark, "near-duplicates")).withColumnRenamed("doc_id", text_)
    pairs = rows.select(id_, text_).distinct().join(found, text_)
    alone = F.when(F.col("n_shingles") == 0, F.col(id_))
    kept = pairs.groupBy("component_id", alone.alias("alone")).agg(F.min(F.struct(id_, text_)).alias("first"))
    rows = rows.join(snapshot(kept.select("first.*"), scratch_path(spark, "representatives")), [id_, text_], "left_semi")
    return rows.dropDuplicates([id_, text_]).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain too much of the benchmark go; a null text contains nothing and stays."""
    ensure_scratch(spark)
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = contamination(texts, read_table(spark, sf_dir, "benchmark")).filter("contaminated")
    found = snapshot(found.select("doc_id").distinct(), scratch_path(spark, "contaminated"))
    return _without(docs, F.xxhash64("text"), found)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; all documents stay. Null texts have none and stay null.

    n_chars, if there, becomes the length of a text that is masked.
    """
    ensure_scratch(spark)
    blob_, spans_ = _hidden(docs, "blob", "spans")
    found = secret_spans(docs).filter("size(spans) > 0").select(F.col("blob").alias(blob_), F.col("spans").alias(spans_))
    found = snapshot(found.dropDuplicates([blob_]), scratch_path(spark, "spans"))
    blob = F.sha2("text", 256)
    sure, maybe = bloom.split(docs, F.when(blob.isNotNull(), _long(blob)), found.select(_long(F.col(blob_)).alias("h")), "h")
    rows = maybe.join(found, blob == F.col(blob_), "left")
    hit = F.col(spans_).isNotNull()
    rows = rows.withColumn("text", F.when(hit, masked(F.col("text"), F.col(spans_))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.when(hit, F.length("text")).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return sure.union(rows.select(docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the kept texts and what they decode to, as digests; a null text counts as empty."""
    return bpe_digests(bpe.encode(docs, vocabulary_path(), decoded=True))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("encoding", encoded),
]

#: Suffix automata and exact token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = snapshot(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = Query("pipeline", run, ORACLE_SQL)
