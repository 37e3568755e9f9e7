"""Feature pipelines: index, one-hot encode, assemble, scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    FeatureHasher,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.schema import numeric_columns, string_columns

FEATURES = "features"
SCALED = "scaledFeatures"

HASHED = "hashed_levels"

#: Slots of the hashed encoding unless the caller says otherwise.
HASH_SLOTS = 4096


def index_stage(columns: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """Strings to numbers, most frequent first and ties by name; all columns in one pass."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid=handle_invalid,
    )


def one_hot_stage(columns: Sequence[str]) -> OneHotEncoder:
    """Indexes to 0/1 vectors without the last level."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_ohe" for c in columns],
        dropLast=True,
    )


def hash_stage(columns: Sequence[str], slots: int = HASH_SLOTS) -> FeatureHasher:
    """All columns' levels into one 0/1 vector of `slots`, by hash; levels may share a slot.

    Nothing is fitted and no level is kept anywhere, so their number does not matter.
    """
    return FeatureHasher(
        inputCols=list(columns), categoricalCols=list(columns), outputCol=HASHED, numFeatures=slots
    )


def scale_stage() -> StandardScaler:
    """Divide by the sample deviation; no centring, so sparse vectors stay sparse."""
    return StandardScaler(inputCol=FEATURES, outputCol=SCALED, withStd=True, withMean=False)


def feature_stages(
    df: DataFrame,
    columns: Sequence[str],
    scale: bool = False,
    handle_invalid: str = "keep",
    encoding: str = "index",
    slots: int = HASH_SLOTS,
) -> list:
    """Stages for the given columns: encoded strings first, then numbers as they are.

    The result is in column `features`, or `scaledFeatures` when `scale`.

    `encoding` 'index' gives each level of a string column a slot; the levels are kept on
    the driver and sent to every task, so use it for columns whose levels fit there. With
    `handle_invalid` 'keep' an unseen level becomes all zeros; with 'error' it stops the
    job, and the least frequent level has no slot of its own. `encoding` 'hash' puts the
    levels of all string columns into `slots` slots and has no limit of levels.
    """
    if encoding not in ("index", "hash"):
        raise ValueError(f"encoding is 'index' or 'hash', not {encoding!r}")
    categorical = string_columns(df, columns)
    numeric = numeric_columns(df, columns)
    other = set(columns) - set(categorical) - set(numeric)
    if other:
        raise ValueError(f"neither text nor number: {sorted(other)}")
    stages, encoded = [], []
    if categorical and encoding == "hash":
        stages, encoded = [hash_stage(categorical, slots)], [HASHED]
    elif categorical:
        stages = [index_stage(categorical, handle_invalid), one_hot_stage(categorical)]
        encoded = [f"{c}_ohe" for c in categorical]
    stages.append(VectorAssembler(inputCols=encoded + numeric, outputCol=FEATURES))
    if scale:
        stages.append(scale_stage())
    return stages


def fit_features(
    df: DataFrame,
    columns: Sequence[str],
    scale: bool = False,
    handle_invalid: str = "keep",
    encoding: str = "index",
    slots: int = HASH_SLOTS,
) -> PipelineModel:
    stages = feature_stages(df, columns, scale, handle_invalid, encoding, slots)
    return Pipeline(stages=stages).fit(df)


def feature_names(df: DataFrame, features_col: str = FEATURES) -> list[str]:
    """Slot names in slot order, from the vector column's metadata."""
    attributes = df.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = [slot for group in attributes.values() for slot in group]
    return [slot["name"] for slot in sorted(slots, key=lambda slot: slot["idx"])]


def flatten_vector(df: DataFrame, vector_col: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one double column per slot."""
    array = vector_to_array(F.col(vector_col))
    return df.withColumns({name: array[i] for i, name in enumerate(names)}).drop(vector_col)
