"""What the planner knows of a result's size."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate of a result's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
