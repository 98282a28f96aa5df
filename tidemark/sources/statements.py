"""Statements: user SQL read above a saved cursor, in key order, whole or in chunks."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import values as V
from tidemark.plans.order import number_rows

CHUNK_MARK = ":chunkSize"
#: the usual end of a chunked statement; parentheses keep windows and subqueries out
CHUNK_TAIL = re.compile(r"\s+order\s+by\s+[^()]*\blimit\s+(:chunkSize|\d+)\s*;?\s*$", re.IGNORECASE)
#: what a bound ``?`` takes on a first run: below every value that a key of the kind can have
LOWEST = {"number": -(1 << 63), "text": "", "time": "0001-01-01T00:00:00Z"}


@dataclass(frozen=True)
class Statement:
    """One sync job."""

    name: str
    sql: str
    index: str | None = None
    id_column: str | None = "id"
    id_type: str = "number"
    incremental: bool = True
    enabled: bool = True
    chunk_size: int = 0
    schema: str | None = None
    table: str | None = None

    @property
    def numeric(self) -> bool:
        kind = self.id_type.strip().lower()
        return not kind or kind.startswith("num")

    @property
    def keyed(self) -> bool:
        return self.incremental and bool(self.id_column)


def actual_column(df: DataFrame, name: str | None) -> str | None:
    """The column that ``name`` means, whatever its case; None if there is none."""
    if not name:
        return None
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def key_kind(df: DataFrame, column: str | None, numeric: bool) -> str:
    """How a key is compared: as time if the column holds times, else as the statement says."""
    kind = dict(df.dtypes).get(column, "") if column else ""
    if kind.startswith(("timestamp", "date")):
        return "time"
    return "number" if numeric else "text"


def key_column(column: str, kind: str, whole_type: str | None = None) -> Column:
    """The key as it is compared; a number that cannot be read stops the statement.

    ``whole_type`` is the column's type, if known: whole numbers need no check.
    """
    c = F.col(column)
    if kind == "time":
        return c.cast("timestamp")
    if kind == "text":
        return c.cast("string")
    if whole_type in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("bigint")  # plain, so that a comparison reaches the scan
    whole = c.try_cast("bigint")
    exact = whole.isNotNull() & (whole.cast("string") == F.trim(c.cast("string")))
    as_number = whole.isNotNull() & (c.try_cast("decimal(38,10)") == whole)
    fault = F.raise_error(F.concat(F.lit("key is not a whole number: "), c.cast("string")))
    return F.when(c.isNull() | exact | as_number, whole).otherwise(fault)


def key_text(column: str, kind: str, whole_type: str | None = None) -> Column:
    """The key as cursors are saved: times as ISO text in UTC."""
    key = key_column(column, kind, whole_type)
    return timestamp_cursor(key) if kind == "time" else key.cast("string")


def typed(cursor: str, kind: str) -> Column:
    """A saved cursor as the type that keys are compared by."""
    return F.lit(cursor).cast({"time": "timestamp", "text": "string", "number": "bigint"}[kind])


def cursor_value(cursor: str | None, numeric: bool) -> int | str:
    """The typed cursor: empty is 0 or one space, an unreadable number is 0."""
    if numeric:
        try:
            return int(cursor or 0)
        except ValueError:
            return 0
    return cursor or " "


def id_key(column: str, numeric: bool) -> Column:
    """The id as it is compared everywhere: numbers as numbers, text in byte order."""
    return F.col(column).try_cast("bigint") if numeric else F.col(column).cast("string")


def incremental_scan(df: DataFrame, id_column: str, cursor: int | str) -> DataFrame:
    """Rows above the cursor. A plain comparison, so it reaches the scan."""
    return df.filter(F.col(id_column) > F.lit(cursor))


def next_chunk(df: DataFrame, id_column: str, cursor: int | str, size: int) -> DataFrame:
    """The next ``size`` rows above the cursor, in key order."""
    return incremental_scan(df, id_column, cursor).orderBy(id_column).limit(size)


def assign_chunks(
    df: DataFrame, id_column: str, size: int, slices: int | None = None
) -> DataFrame:
    """The chunk in which a chunk-by-chunk read in key order would deliver each row.

    Rows with equal ids have no fixed order, so ids should be unique. Pass only the
    columns you need: all of them are sorted and written once.
    """
    numbered = number_rows(df, [F.col(id_column)], "_row", slices)
    return numbered.select(*df.columns, F.expr(f"_row div {int(size)}").alias("chunk_no"))


def run_statement(
    spark: SparkSession, spec: Statement, cursor: str | None = None, one_chunk: bool = False
) -> DataFrame:
    """The rows of a statement above its cursor.

    ``?`` takes the typed cursor; without a cursor it takes the lowest value there is, so that
    ``key > ?`` keeps every text key but the empty one, which nothing is below, and null. Without ``?``
    a first run has no lower bound and keeps those too. Keys are compared as
    the column's own type if it holds times, else as ``id_type`` says. A key that should be a
    number and is none stops the statement. A keyed statement is read to its end in one
    job, which gives the rows that reading chunk after chunk would give; its order and
    limit (the chunk mark, or a number equal to the chunk size) then mean nothing and are
    left out, so that nothing is sorted. Otherwise the chunk mark becomes the chunk size.
    """
    drain = spec.keyed and not one_chunk
    sized = not drain and spec.chunk_size > 0
    tail = CHUNK_TAIL.search(spec.sql) if drain else None
    chunked = tail and tail.group(1).lower() in (CHUNK_MARK.lower(), str(spec.chunk_size))
    sql = spec.sql[: tail.start()] if chunked else spec.sql
    sql = sql.replace(CHUNK_MARK, str(spec.chunk_size) if sized else "ALL")
    bound = "?" in sql
    kind = "number" if spec.numeric else "text"
    if bound:
        shape = spark.sql(sql, args=[None])  # only analysed, for the key's type
        kind = key_kind(shape, actual_column(shape, spec.id_column), spec.numeric)
        # a first run binds the lowest value as it is
        value = LOWEST[kind] if cursor is None else cursor if kind == "time" else cursor_value(cursor, kind == "number")
        df = spark.sql(sql, args=[value])
    else:
        df = spark.sql(sql)
    key = actual_column(df, spec.id_column)
    if spec.keyed and key and not bound:
        kind = key_kind(df, key, spec.numeric)
        if cursor:
            df = df.filter(key_column(key, kind, dict(df.dtypes)[key]) > typed(cursor, kind))
    if sized:
        df = df.orderBy(key_column(key, kind, dict(df.dtypes)[key])).limit(spec.chunk_size) if (
            spec.keyed and key
        ) else df.limit(spec.chunk_size)
    return df


def next_cursor(df: DataFrame, id_column: str, numeric: bool = True) -> DataFrame:
    """One row: the greatest id, how many rows, and whether any id was seen."""
    key = id_key(id_column, numeric)
    return df.agg(
        F.max(key).alias("next_cursor"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bool_or(key.isNotNull()), F.lit(False)).alias("id_seen"),
    )


def last_key(df: DataFrame, text_column: str, kind: str) -> DataFrame:
    """As ``next_cursor``, for keys saved as text by ``key_text``."""
    key = key_column(text_column, kind)
    last = timestamp_cursor(F.max(key)) if kind == "time" else F.max(key).cast("string")
    return df.agg(
        last.alias("next_cursor"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bool_or(key.isNotNull()), F.lit(False)).alias("id_seen"),
    )


def cursor_as_text(value: Column) -> Column:
    """Cursor text of a number, text or timestamp."""
    return F.coalesce(value.cast("string"), F.lit(""))


def timestamp_cursor(value: Column) -> Column:
    return V.iso_instant(value)
