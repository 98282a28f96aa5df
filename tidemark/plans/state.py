"""Saved cursors: an append-only table, one row per saved position."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

STATE = "statement_name string, last_id long, cursor_value string, updated_at timestamp, version long"


def _stamp() -> tuple:
    now = time.time_ns()
    return now // 1000, now


def read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(STATE).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def current(state: DataFrame) -> DataFrame:
    """The last saved row per statement since the last clear."""
    cleared = state.filter("statement_name IS NULL").agg(F.max("version")).scalar()
    live = state.filter(
        F.col("statement_name").isNotNull()
        & (cleared.isNull() | (F.col("version") > cleared))
    )
    row = F.struct("last_id", "cursor_value", "updated_at")
    return live.groupBy("statement_name").agg(F.max_by(row, "version").alias("r")).select(
        "statement_name", "r.*"
    )


def save(spark: SparkSession, path: str, cursors: dict[str, str]) -> None:
    """Append cursors. The number beside a cursor that is no number is 0."""
    micros, version = _stamp()
    rows = [(name, cursor) for name, cursor in cursors.items()]
    df = spark.createDataFrame(rows, "statement_name string, cursor_value string").select(
        "statement_name",
        F.coalesce(F.col("cursor_value").try_cast("bigint"), F.lit(0)).alias("last_id"),
        "cursor_value",
        F.timestamp_micros(F.lit(micros)).alias("updated_at"),
        F.lit(version).alias("version"),
    )
    df.coalesce(1).write.mode("append").parquet(path)


def saved_cursor(spark: SparkSession, path: str, statement: str) -> str | None:
    """A statement's cursor: the saved text, else the saved number; None before its first run."""
    state = read(spark, path)
    row = None if state is None else current(state).filter(F.col("statement_name") == statement).first()
    if row is None:
        return None
    if row.cursor_value and row.cursor_value.strip():
        return row.cursor_value
    return None if row.last_id is None else str(row.last_id)


def cursor_of(
    spark: SparkSession, path: str, statement: str, numeric: bool = True
) -> str:
    """``saved_cursor``, or the start that is shown for a statement that never ran."""
    found = saved_cursor(spark, path, statement)
    return ("0" if numeric else "") if found is None else found


def clear(spark: SparkSession, path: str) -> int:
    """Forget all cursors; returns how many there were."""
    state = read(spark, path)
    if state is None:
        return 0
    count = current(state).count()
    micros, version = _stamp()
    mark = spark.range(1).select(
        F.lit(None).cast("string").alias("statement_name"),
        F.lit(0).cast("long").alias("last_id"),
        F.lit(None).cast("string").alias("cursor_value"),
        F.timestamp_micros(F.lit(micros)).alias("updated_at"),
        F.lit(version).alias("version"),
    )
    mark.coalesce(1).write.mode("append").parquet(path)
    return count
