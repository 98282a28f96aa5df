"""Filters and event shapes of the change log."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------
#: schemas that never take part in capture, and tables likewise
SYSTEM_SCHEMAS = ["pg_catalog", "sys_catalog", "information_schema"]
TEMP_TABLES = r".*\.pg_temp.*"
# -------------------------------------------------------------------------------------


def _any(patterns: str | None) -> str | None:
    """One anchored, case-blind expression for a comma-separated list."""
    parts = [p.strip() for p in (patterns or "").split(",") if p.strip()]
    return "(?i)^(?:" + "|".join(f"(?:{p})" for p in parts) + ")$" if parts else None


def captured(
    schema: Column,
    table: Column,
    include_tables: str | None = None,
    exclude_tables: str | None = None,
    include_schemas: str | None = None,
    exclude_schemas: str | None = None,
) -> Column:
    """Whether a table is captured.

    Lists hold comma-separated expressions, matched in full: schemas by name, tables
    as ``schema.table``. An include list overrides its exclude list. System schemas and
    temporary tables are always out.
    """
    full = F.concat_ws(".", schema, table)
    keep = ~F.lower(schema).isin(SYSTEM_SCHEMAS) & ~full.rlike(_any(TEMP_TABLES))
    for name, include, exclude in (
        (schema, include_schemas, exclude_schemas),
        (full, include_tables, exclude_tables),
    ):
        if _any(include):
            keep = keep & name.rlike(_any(include))
        elif _any(exclude):
            keep = keep & ~name.rlike(_any(exclude))
    return keep


def captured_tables(tables: DataFrame, **lists: str) -> DataFrame:
    """The captured tables of a table list, once each and in order."""
    return (
        tables.filter(captured(F.col("schema"), F.col("table"), **lists))
        .select("schema", "table")
        .distinct()
        .orderBy("schema", "table")
    )


def select_columns(
    df: DataFrame, table: str, include: str | None = None, exclude: str | None = None
) -> DataFrame:
    """Columns whose ``schema.table.column`` passes the lists."""
    keep_in, keep_out = _any(include), _any(exclude)

    def keep(name: str) -> bool:
        full = f"{table}.{name}"
        if keep_in:
            return re.match(keep_in, full) is not None
        return keep_out is None or re.match(keep_out, full) is None

    return df.select(*[c for c in df.columns if keep(c)])


def message_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the event key made of the chosen columns."""
    return df.withColumn("_key", F.struct(*columns))


def sanitise_names(df: DataFrame) -> DataFrame:
    """Column names with letters, digits and ``_`` only, and no leading digit."""

    def clean(name: str) -> str:
        safe = re.sub("[^A-Za-z0-9_]", "_", name)
        return f"_{safe}" if safe[:1].isdigit() else safe

    return df.toDF(*[clean(c) for c in df.columns])


def skip_truncates(changes: DataFrame, mode: str = "skip") -> DataFrame:
    """Drop truncate rows, or keep them with mode ``include``."""
    if mode not in ("skip", "include"):
        raise ValueError(f"truncate mode is skip or include, not {mode}")
    return changes if mode == "include" else changes.filter(F.col("op") != "t")


def sequence_text(last_commit: Column, lsn: Column) -> Column:
    """``["<last commit>","<position>"]``, with null where there is none."""
    return F.to_json(
        F.array(last_commit.cast("string"), lsn.cast("string")), {"ignoreNullFields": "false"}
    )


def source_info(
    server: str,
    database: str,
    schema: Column,
    table: Column,
    txid: Column,
    lsn: Column,
    commit_ts: Column,
    last_commit: Column | None = None,
    xmin: Column | None = None,
    snapshot: Column | None = None,
) -> Column:
    """Where an event comes from."""
    none = F.lit(None).cast("long")
    return F.struct(
        F.lit(server).alias("name"),
        F.lit(database).alias("db"),
        F.unix_millis(commit_ts.cast("timestamp")).alias("ts_ms"),
        F.unix_micros(commit_ts.cast("timestamp")).alias("ts_usec"),
        (F.lit("false") if snapshot is None else snapshot).alias("snapshot"),
        schema.alias("schema"),
        table.alias("table"),
        txid.alias("txId"),
        lsn.alias("lsn"),
        (none if xmin is None else xmin).alias("xmin"),
        sequence_text(none if last_commit is None else last_commit, lsn).alias("sequence"),
    )


def envelope(
    op: Column, before: Column, after: Column, source: Column, ts_ms: Column | None = None
) -> Column:
    """The event: which of the two rows it shows depends on the operation."""
    shown_after = F.when(op.isin("c", "u", "r"), after)
    shown_before = F.when(op.isin("u", "d"), before)
    return F.struct(
        shown_before.alias("before"),
        shown_after.alias("after"),
        source.alias("source"),
        op.alias("op"),
        (source["ts_ms"] if ts_ms is None else ts_ms).alias("ts_ms"),
    )


def event_time(source: Column) -> Column:
    """Event time: micros where the source has them, else millis."""
    return F.coalesce(F.timestamp_micros(source["ts_usec"]), F.timestamp_millis(source["ts_ms"]))


def event_position(source: Column) -> Column:
    """Position as a map of text; xmin only where known."""
    entries = F.array(
        F.struct(F.lit("lsn").alias("k"), source["lsn"].cast("string").alias("v")),
        F.struct(F.lit("xmin").alias("k"), source["xmin"].cast("string").alias("v")),
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))


def event_transaction(source: Column) -> Column:
    return source["txId"].cast("string")
