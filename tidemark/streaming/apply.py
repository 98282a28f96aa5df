"""A change stream applied to a keyed table, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions import lsn as L
from tidemark.operators.changes import skip_truncates
from tidemark.operators.positions import keep_after, stop_at
from tidemark.operators.transactions import tx_markers, tx_summary
from tidemark.plans.keyed_table import KeyedTable, stream_name
from tidemark.plans.snapshot_modes import Plan, plan


def apply_stream(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    decode: Callable[[DataFrame], DataFrame] = lambda df: df,
    available_now: bool = True,
    interval: str = "5 seconds",
    after_lsn: int | None = None,
    stop_lsn: int | None = None,
    tx_path: str | None = None,
    truncates: str = "skip",
):
    """Start the stream and return its query.

    ``decode`` turns log rows (with ``seq`` and ``lsn``) into change rows. A batch that
    is replayed after a crash finds its number in the table's manifest or overwrites its
    own folder, so nothing is applied twice. Batches are known by checkpoint and number: a
    stream with a new checkpoint adds its changes to the table. With ``truncates``
    "include", a truncate (op ``t``) empties the table before the changes behind it. Every batch leaves a manifest row, with or
    without changes in it. Rows up to ``after_lsn`` are part of the snapshot the table
    holds and are left out, as are rows behind the first that reaches ``stop_lsn``. With ``tx_path`` transaction events go there; without, BEGIN and COMMIT
    rows only move the position.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        if after_lsn is not None:
            rows = keep_after(rows, after_lsn)
        if stop_lsn is not None:
            rows = rows.limit(0) if reached(spark, table, stop_lsn) else stop_at(rows, stop_lsn)
        seen = rows.agg(
            F.count(F.lit(1)).alias("n"), L.unrank(F.max(L.rank(F.col("lsn")))).alias("lsn")
        ).first()
        if tx_path:
            write_transactions(rows, tx_path, number, checkpoint)
        changes, emptied = skip_truncates(decode(rows), truncates), False
        if truncates == "include":
            at = changes.filter("op = 't'").agg(F.max(table.seq)).first()[0]
            if emptied := at is not None:
                changes = changes.filter(F.col(table.seq) > at)
        changes = changes.filter(F.col("op").isin("c", "r", "u", "d"))
        table.write_batch(
            changes, number, rows_in=seen.n, max_lsn=seen.lsn, stream=checkpoint, emptied=emptied
        )

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def reached(spark: SparkSession, table: KeyedTable, stop: int) -> bool:
    """Whether a finished batch got to a position."""
    at = L.rank(F.col("max_lsn")) >= L.rank(F.lit(stop).cast("long"))
    return bool(table.manifest(spark).filter("kind = 'delta'").agg(F.bool_or(at)).first()[0])


def write_transactions(rows: DataFrame, path: str, number: int, stream: str = "") -> None:
    """BEGIN and END events of a batch; an END tells how many events the transaction had.

    Counts of transactions that are not ended are kept beside the events, one folder for each
    batch, so a transaction may be cut by any number of batches, and a replayed
    batch starts from what the one before it left.
    """
    spark, name = rows.sparkSession, stream_name(stream)
    counted = "id string, event_count long"
    counts = tx_summary(rows.filter(F.col("op").isin("c", "u", "d"))).select(
        F.col("txid").cast("string").alias("id"), "event_count"
    )
    try:
        before = spark.read.schema(counted).parquet(f"{path}-open/{name}/{number - 1}")
        counts = counts.unionByName(before).groupBy("id").agg(F.sum("event_count").alias("event_count"))
    except AnalysisException as error:  # the first batch
        if "PATH_NOT_FOUND" not in str(error):
            raise
    markers = tx_markers(rows)
    ended = F.when(F.col("status") == "END", F.coalesce("event_count", F.lit(0)))
    events = markers.join(counts, "id", "left").withColumn("event_count", ended)
    events.write.mode("overwrite").parquet(f"{path}/_stream={name}/_batch={number}")
    still = counts.join(markers.filter("status = 'END'").select("id").distinct(), "id", "left_anti")
    still.write.mode("overwrite").parquet(f"{path}-open/{name}/{number}")


def progress(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """One row per batch: rows read, keys changed, last position. The heartbeat."""
    return (
        table.manifest(spark)
        .filter("kind = 'delta'")
        .groupBy("stream", "batch")
        .agg(*[F.max(c).alias(c) for c in ("rows_in", "rows_out", "max_lsn")])
        .drop("stream")
    )


def catch_up_then_snapshot(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    snapshot: Callable[[], DataFrame],
    stop_lsn: int,
    decode: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Stream up to a position, then replace the table by a snapshot taken there."""
    apply_stream(stream, table, checkpoint, decode, stop_lsn=stop_lsn).awaitTermination()
    table.replace(snapshot())


def capture(
    spark: SparkSession,
    mode: str,
    table: KeyedTable,
    snapshot: Callable[[str | None, int | None], DataFrame],
    snapshot_lsn: int | None,
    stream: Callable[[], DataFrame],
    checkpoint: str,
    decode: Callable[[DataFrame], DataFrame] = lambda df: df,
    custom: Callable[[str], Plan] | None = None,
    log_start: int | None = None,
    name: str = "",
    **options,
):
    """Run what a snapshot mode asks for, given what an earlier run left behind.

    ``snapshot(query, position)`` reads the table as of a position: all of it if ``query`` is None.
    A plan that wants the snapshot at the log's start gets it at ``log_start``, others at
    ``snapshot_lsn``. A plan with a query per table asks it for ``name``; without a query the table has
    no snapshot, only its stream. The position is kept with the table: changes up to it
    are part of the snapshot and are left out, also by later runs that take none. Returns
    the stream's query, or None if the mode does not stream.
    """
    todo = plan(mode, table.snapshot_state(spark), custom)
    query = todo.select(name) if todo.select is not None else None
    if todo.snapshot and (todo.select is None or query is not None):
        if todo.at_log_start and log_start is None:
            raise ValueError(f"mode {mode} takes the snapshot where the log starts, so it needs that position")
        at = log_start if todo.at_log_start else snapshot_lsn
        table.begin_snapshot(spark)
        table.replace(snapshot(query, at), lsn=at)
    if not todo.stream:
        return None
    return apply_stream(stream(), table, checkpoint, decode, after_lsn=table.snapshot_lsn(spark), **options)
