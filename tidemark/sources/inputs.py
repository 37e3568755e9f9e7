"""The CSV inputs of the analyses, with their schemas.

Only particles have no key of their own. Give all columns as the key then; equal rows
share a part of every split and fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.schema import rename_positional
from tidemark.sources import schemas
from tidemark.sources.files import read_csv


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    """One policy per line, key `IDpol`, features `schemas.POLICY_FEATURES`, label `ClaimNb`."""
    return read_csv(spark, path, schemas.POLICIES_CSV)


def read_particles(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Label and 28 measurements per line, named by their position whatever the header says."""
    df = read_csv(spark, path, schemas.PARTICLES_CSV, header)
    return rename_positional(df, schemas.PARTICLE_COLUMNS)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RATINGS_CSV)


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.MOVIES_CSV)
