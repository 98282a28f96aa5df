"""Transactions, order within them, and runs of filtered changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import lsn as L
from tidemark.plans.order import last_before, rank_in_groups

# fixed value: filtered changes in a row above which a warning is due
BACKLOG_LIMIT = 10_000


def tx_summary(changes: DataFrame, lsn: str = "lsn") -> DataFrame:
    """First and last position and number of events of each transaction."""
    return changes.groupBy("txid").agg(
        L.unrank(F.min(L.rank(F.col(lsn)))).alias("first_lsn"),
        L.unrank(F.max(L.rank(F.col(lsn)))).alias("last_lsn"),
        F.count(F.lit(1)).alias("event_count"),
    )


def tx_table_summary(changes: DataFrame) -> DataFrame:
    """Number of events of each transaction per table."""
    return changes.groupBy("txid", "table").agg(F.count(F.lit(1)).alias("event_count"))


def tx_markers(log: DataFrame) -> DataFrame:
    """BEGIN and COMMIT rows as transaction events."""
    status = F.when(F.col("op") == "begin", "BEGIN").when(F.col("op") == "commit", "END")
    return log.filter(F.col("op").isin("begin", "commit")).select(
        "seq", "lsn", F.col("txid").cast("string").alias("id"), status.alias("status")
    )


def tx_order(changes: DataFrame, seq: str = "seq", slices: int | None = None) -> DataFrame:
    """Place of each change in its transaction, and among its transaction's changes to
    the same table."""
    return rank_in_groups(
        changes.select(seq, "txid", "table"),
        [F.col(seq)],
        {"total_order": ["txid"], "table_order": ["txid", "table"]},
        slices,
    )


def commit_sequence(log: DataFrame, seq: str = "seq", slices: int | None = None) -> DataFrame:
    """For each change, the position of the last COMMIT before it.

    ``log`` holds the COMMIT rows too.
    """
    narrow = log.select(seq, "lsn", "txid", "op")
    marked = last_before(
        narrow, [F.col(seq)], "lsn", F.col("op") == "commit", "last_commit_lsn", slices
    )
    return marked.filter(~F.col("op").isin("begin", "commit"))


def mark_last_snapshot_row(snapshot: DataFrame, order: str) -> DataFrame:
    """Add ``snapshot``: ``last`` on the last row, ``true`` on the others."""
    last = snapshot.agg(F.max(order)).scalar()
    return snapshot.withColumn(
        "snapshot", F.when(F.col(order) == last, "last").otherwise("true")
    )


def backlog_runs(
    log: DataFrame,
    emitted: Column,
    seq: str = "seq",
    heartbeats: bool = False,
    limit: int = BACKLOG_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """Runs of rows that were filtered out, with the warnings each run is worth.

    The rows of a run share the last emitted row before them, so grouping by that row
    needs no second sort, and a run of any length is counted in parts.
    """
    flagged = log.select(F.col(seq), emitted.alias("_emitted"))
    placed = last_before(
        flagged, [F.col(seq)], seq, F.col("_emitted"), "_after", slices
    )
    runs = (
        placed.filter(~F.col("_emitted"))
        .groupBy("_after")
        .agg(
            F.min(seq).alias("run_start"),
            F.max(seq).alias("run_end"),
            F.count(F.lit(1)).alias("run_length"),
        )
    )
    warnings = F.lit(0) if heartbeats else F.expr(f"run_length div {limit + 1}")
    return runs.select(
        "run_start", "run_end", "run_length", warnings.cast("long").alias("warnings")
    )
