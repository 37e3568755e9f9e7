"""The analysis inputs as pure functions of the driver's tables.

No input file of the analyses is at hand, so log lines, policies, particles,
ratings and movies are derived from parquet tables with the same shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import read_table
from tidemark.sources.schemas import PARTICLE_COLUMNS, PARTICLE_FEATURES


def access_log(spark: SparkSession, directory: str) -> DataFrame:
    """One log line per event; hosts end in .de, .ca, .sg or .com, errors have no byte count."""
    zone = F.element_at(
        F.array(*[F.lit(z) for z in ("de", "ca", "sg", "com")]),
        (F.col("user_id") % 4 + 1).cast("int"),
    )
    reply = F.when(F.col("event_type") == "error", F.lit("404 -")).otherwise(
        F.concat(F.lit("200 "), F.floor(F.col("value") * 100).cast("string"))
    )
    return read_table(spark, directory, "events").select(
        F.concat(
            F.lit("h"), F.col("user_id").cast("string"), F.lit(".example."), zone,
            F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /'),
            F.col("event_type"), F.lit("/"), F.col("event_id").cast("string"),
            F.lit(' HTTP/1.0" '), reply,
        ).alias("value")
    )


def policies(spark: SparkSession, directory: str) -> DataFrame:
    """One policy per order that has lines; returned lines are its claims."""
    lines = (
        read_table(spark, directory, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count_if(F.col("l_returnflag") == "R").alias("claim_nb"),
            F.count("*").cast("double").alias("exposure"),
        )
    )
    orders = read_table(spark, directory, "orders")
    customers = read_table(spark, directory, "customer")
    return (
        lines.join(orders, "o_orderkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("policy_id"),
            "claim_nb",
            "exposure",
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("c_mktsegment").alias("segment"),
            F.col("o_totalprice").alias("total_price"),
            F.col("c_acctbal").alias("balance"),
            F.col("c_nationkey").alias("nation"),
        )
    )


POLICY_FEATURE_COLUMNS = [
    "exposure", "status", "priority", "segment", "total_price", "balance", "nation",
]


def particles(spark: SparkSession, directory: str) -> DataFrame:
    """A 0/1 label, 28 measurements, and the row's key: the particle table has 28, so each vector of 64 is cut."""
    vector = F.col("embedding")
    return read_table(spark, directory, "embeddings").select(
        F.col("vec_id"),
        (F.col("label") < 5).cast("double").alias(PARTICLE_COLUMNS[0]),
        *[
            vector[i].cast("double").alias(name)
            for i, name in enumerate(PARTICLE_FEATURES)
        ],
    )


def ratings(spark: SparkSession, directory: str) -> DataFrame:
    """One rating per order line: customers rate parts with 0.5 to 5 points."""
    orders = read_table(spark, directory, "orders")
    lines = read_table(spark, directory, "lineitem")
    ordered = F.col("o_orderdate")
    epoch_seconds = (
        F.unix_date(F.to_date(ordered)).cast("bigint") * 86400
        + F.hour(ordered) * 3600 + F.minute(ordered) * 60 + F.second(ordered)
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
        epoch_seconds.alias("timestamp"),
    )


def movies(spark: SparkSession, directory: str) -> DataFrame:
    """One movie per part; the words of its name and its type are the genres."""
    return read_table(spark, directory, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", F.replace("p_name", F.lit(" "), F.lit("|")), "p_type").alias("genres"),
    )


def scores(spark: SparkSession, directory: str) -> DataFrame:
    """A 0/1 label with a score and a thresholded prediction for it."""
    score = F.col("embedding")[0].cast("double")
    return read_table(spark, directory, "embeddings").select(
        (F.col("label") < 5).cast("double").alias("label"),
        (score > 0).cast("double").alias("prediction"),
        score.alias("score"),
    )
