"""Sources, sinks, schema and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.inputs import PARTICLES, POLICIES
from tidemark.catalog.registry import Query, rounded
from tidemark.operators import schema, sets
from tidemark.sources import fixtures
from tidemark.sources.files import read_csv, read_table, scratch_path, snapshot, write_csv
from tidemark.sources.schemas import PARTICLE_COLUMNS

_PART_CSV = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double"
)
_PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


def _csv(spark: SparkSession, directory: str, given: str | None) -> DataFrame:
    path = scratch_path(spark, "part-csv")
    columns = [field.split()[0] for field in _PART_CSV.split(", ")]
    write_csv(read_table(spark, directory, "part").select(*columns), path)
    return read_csv(spark, path, given)


def _parquet(spark: SparkSession, directory: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    written = snapshot(read_table(spark, directory, "orders"), path)
    return written.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


def _renamed(spark: SparkSession, directory: str) -> DataFrame:
    vector = F.col("embedding")
    unnamed = read_table(spark, directory, "embeddings").select(
        (F.col("label") < 5).cast("double").alias("_c0"),
        *[vector[i].cast("double").alias(f"_c{i + 1}") for i in range(28)],
    )
    return schema.rename_positional(unnamed, PARTICLE_COLUMNS)


def _casts(spark: SparkSession, directory: str) -> DataFrame:
    text = read_table(spark, directory, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("price_text"),
        F.col("o_custkey").cast("string").alias("customer_text"),
        "o_orderpriority",
    )
    return schema.cast_strings_to_double(text)


def _balances(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    customers = read_table(spark, directory, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    )
    suppliers = read_table(spark, directory, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")
    )
    return customers, suppliers


def _never_returned(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem")
    pair = ["l_partkey", "l_suppkey"]
    return sets.subtract_distinct(
        lines.select(*pair), lines.filter(F.col("l_returnflag") == "R").select(*pair)
    )


def _claim_label(spark: SparkSession, directory: str) -> DataFrame:
    policies = fixtures.policies(spark, directory).select("policy_id", "claim_nb")
    return schema.positive_label(policies, "claim_nb", "has_claim")


def _weighted(spark: SparkSession, directory: str) -> DataFrame:
    particles = fixtures.particles(spark, directory).select("vec_id", "label")
    return rounded(schema.with_class_weights(particles, "label"), "weight")


_BALANCE_ROUNDED = ["minority_fraction", "neg_pos_ratio", "weight_0", "weight_1"]

QUERIES = [
    Query("src_csv_roundtrip", lambda s, d: _csv(s, d, _PART_CSV), _PART_SQL),
    Query(
        "src_csv_inferred",
        lambda s, d: _csv(s, d, None),
        _PART_SQL.replace("p_partkey,", "p_partkey::int AS p_partkey,"),
    ),
    Query(
        "snk_parquet_roundtrip",
        _parquet,
        """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
           FROM orders""",
    ),
    Query(
        "schema_rename_positional",
        _renamed,
        f"WITH {PARTICLES} SELECT * EXCLUDE (vec_id) FROM particles",
    ),
    Query(
        "schema_cast_strings",
        _casts,
        """SELECT o_orderkey, o_totalprice AS price_text, o_custkey::double AS customer_text,
                  try_cast(o_orderpriority AS double) AS o_orderpriority FROM orders""",
    ),
    Query(
        "claim_label", _claim_label, f"WITH {POLICIES} SELECT policy_id, claim_nb, has_claim FROM policies"
    ),
    Query(
        "class_balance",
        lambda s, d: rounded(
            schema.class_balance(fixtures.particles(s, d), "label"), *_BALANCE_ROUNDED
        ),
        f"""WITH {PARTICLES}, counted AS (
          SELECT count(*) FILTER (WHERE label = 1) AS positives,
                 count(*) FILTER (WHERE label = 0) AS negatives, count(*) AS total FROM particles)
        SELECT *, round(least(positives, negatives) / total, 6) AS minority_fraction,
               round(negatives / positives, 6) AS neg_pos_ratio,
               round(total / (2 * negatives), 6) AS weight_0,
               round(total / (2 * positives), 6) AS weight_1 FROM counted""",
    ),
    Query(
        "class_weights",
        _weighted,
        f"""WITH {PARTICLES}
        SELECT vec_id, label, round(count(*) OVER () / (2 * count(*) OVER (PARTITION BY label)), 6)
          AS weight FROM particles""",
    ),
    Query(
        "setop_union_all",
        lambda s, d: sets.union_all(*_balances(s, d)),
        """SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
           UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""",
    ),
    Query(
        "setop_subtract",
        _never_returned,
        """SELECT l_partkey, l_suppkey FROM lineitem
           EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'""",
    ),
]
