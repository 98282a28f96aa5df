"""Folding ordered operations per key by aggregation alone.

Every question asked here ("the last value of a field since the last reset") is a
maximum over the order number, so partial aggregates cut each key to one row per task
before the shuffle. A key that holds a third of all rows costs no more than another.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_known(field: str, seq: str, known: Column) -> list[Column]:
    """Last value of ``field`` among rows where it is known, and the place of that row."""
    at = F.when(known, F.col(seq))
    return [F.max_by(F.col(field), at).alias(f"_v_{field}"), F.max(at).alias(f"_p_{field}")]


def survives(field: str, reset: str = "_reset", cleared: str = "_cleared") -> Column:
    """Whether the last known value is not older than the last reset and the last clear."""
    at = F.col(f"_p_{field}")
    return F.coalesce(
        (F.col(reset).isNull() | (at >= F.col(reset)))
        & (F.col(cleared).isNull() | (at > F.col(cleared)))
        & at.isNotNull(),
        F.lit(False),
    )


def surviving_value(field: str, dtype) -> Column:
    return F.when(survives(field), F.col(f"_v_{field}")).otherwise(F.lit(None).cast(dtype))
