"""Whole-table reads: snapshots, text columns cleaned by type, row counts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import values as V


def snapshot_scan(tables: dict[str, DataFrame], lsn: int | None = None) -> dict[str, DataFrame]:
    """Every row of each table as a read event of the log at position ``lsn``.

    Tables stay apart because their columns differ; the schema of each gains the
    envelope columns ``op``, ``after``, ``before`` and ``lsn``.
    """
    out = {}
    for name, df in tables.items():
        row = F.struct(*df.columns)
        out[name] = df.select(
            F.lit("r").alias("op"),
            F.lit(name).alias("table"),
            F.lit(lsn).cast("long").alias("lsn"),
            F.lit(None).cast(df.schema).alias("before"),
            row.alias("after"),
        )
    return out


def clean_columns(
    df: DataFrame,
    types: dict[str, str],
    options: dict | None = None,
    converters: dict[str, Callable[[Column], Column]] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Apply the value rule of each column that was read as text.

    ``types`` maps columns to short type names; others pass. ``converters`` maps a
    regular expression on the column name to a user's own rule, which goes first.
    """
    import re

    def one(name: str) -> Column:
        for pattern, rule in (converters or {}).items():
            if re.fullmatch(pattern, name):
                return rule(F.col(name)).alias(name)
        if name not in types:
            return F.col(name)
        value = V.from_text(types[name], F.col(name), options)
        if strict and types[name] != "bool":
            value = V.required(F.col(name), value, name)
        return value.alias(name)

    return df.select(*[one(c) for c in df.columns])


def row_counts(tables: dict[str, DataFrame], schema: str = "public") -> DataFrame:
    """One row per table, largest first. Each count reads file metadata where it can."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts).orderBy(
        F.desc("row_count"), "table_schema", "table_name"
    )


def total_rows(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("row_count").alias("total_rows"))
