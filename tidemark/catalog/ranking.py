"""Ranks, samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.inputs import POLICIES, RATINGS, hash_fraction
from tidemark.catalog.registry import Query
from tidemark.operators import ranking, schema, splits
from tidemark.operators.models import CLAIMS_SEED, PARTICLES_SEED
from tidemark.sources import fixtures
from tidemark.sources.files import read_table


def _labelled(spark: SparkSession, directory: str) -> DataFrame:
    policies = fixtures.policies(spark, directory).select("policy_id", "claim_nb")
    return schema.positive_label(policies, "claim_nb", "has_claim")


def _stratified(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    return splits.stratified_split(
        _labelled(spark, directory), "has_claim", splits.CLAIM_FRACTIONS, ["policy_id"], CLAIMS_SEED
    )


def _tagged(spark: SparkSession, directory: str) -> DataFrame:
    chosen = splits.stratified("has_claim", splits.CLAIM_FRACTIONS, ["policy_id"], CLAIMS_SEED)
    return _labelled(spark, directory).withColumn(
        "split", F.when(chosen, "train").otherwise("test")
    )


def _parts(spark: SparkSession, directory: str) -> DataFrame:
    part = splits.random_part([0.7, 0.3], ["vec_id"], PARTICLES_SEED).alias("part")
    return read_table(spark, directory, "embeddings").select("vec_id", part)


def _line_sample(spark: SparkSession, directory: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    lines = read_table(spark, directory, "lineitem").select(*keys, "l_quantity")
    return splits.sample(lines, 0.1, keys, CLAIMS_SEED)


_SHARE = " ".join(
    f"WHEN {label} THEN {fraction}" for label, fraction in splits.CLAIM_FRACTIONS.items()
)
_KEPT = f"{hash_fraction(['policy_id'], CLAIMS_SEED)} < (CASE has_claim {_SHARE} END)"
_RANKED = f"""WITH {RATINGS}, ranked AS (
  SELECT *, rank() OVER (ORDER BY timestamp NULLS FIRST) AS rank,
         percent_rank() OVER (ORDER BY timestamp NULLS FIRST) AS percent_rank FROM ratings)"""
_SPLITS = ", ".join(
    f"CASE WHEN percent_rank < {threshold} THEN 'train' ELSE 'test' END AS split_{i}"
    for i, threshold in enumerate(splits.TEMPORAL_THRESHOLDS)
)

QUERIES = [
    Query(
        "ratings_percent_rank",
        lambda s, d: ranking.with_ranks(fixtures.ratings(s, d), "timestamp").drop("rank"),
        f'{_RANKED} SELECT "userId", "movieId", rating, timestamp, percent_rank FROM ranked',
    ),
    Query(
        "ratings_sorted",
        lambda s, d: ranking.with_ranks(fixtures.ratings(s, d), "timestamp")
        .drop("percent_rank")
        .orderBy("timestamp", "userId", "movieId"),
        f"""{_RANKED} SELECT "userId", "movieId", rating, timestamp, rank FROM ranked
        ORDER BY timestamp, "userId", "movieId" """,
    ),
    Query(
        "ratings_temporal_split",
        lambda s, d: splits.with_temporal_splits(fixtures.ratings(s, d), "timestamp"),
        f'{_RANKED} SELECT "userId", "movieId", rating, timestamp, {_SPLITS} FROM ranked',
    ),
    Query(
        "split_stratified",
        _tagged,
        f"""WITH {POLICIES} SELECT policy_id, claim_nb, has_claim,
        CASE WHEN {_KEPT} THEN 'train' ELSE 'test' END AS split FROM policies""",
    ),
    Query(
        "split_complement",
        lambda s, d: _stratified(s, d)[1],
        f"WITH {POLICIES} SELECT policy_id, claim_nb, has_claim FROM policies WHERE NOT ({_KEPT})",
    ),
    Query(
        "sample_bernoulli",
        _line_sample,
        f"""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE {hash_fraction(["l_orderkey", "l_linenumber"], CLAIMS_SEED)} < 0.1""",
    ),
    Query(
        "split_random",
        _parts,
        f"""SELECT vec_id, CASE WHEN {hash_fraction(["vec_id"], PARTICLES_SEED)} < 0.7
        THEN 0 ELSE 1 END AS part FROM embeddings""",
    ),
    Query(
        "kfold_assign",
        lambda s, d: _labelled(s, d).select(
            "policy_id", splits.k_fold(3, ["policy_id"], CLAIMS_SEED).alias("fold")
        ),
        f"""WITH {POLICIES} SELECT policy_id,
        floor({hash_fraction(["policy_id"], CLAIMS_SEED)} * 3)::int AS fold FROM policies""",
    ),
]
