"""Reading executed plans."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def executed(df: DataFrame) -> str:
    """The final plan after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def count(plan: str, operator: str) -> int:
    return len(re.findall(rf"\b{operator}\b", plan))
