"""Rows to documents: ids, index names, value normalising, name mapping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import values as V
from tidemark.sources.statements import actual_column


def index_name(name: Column) -> Column:
    """Lower case, ``_`` for other characters, and no leading ``_``."""
    clean = F.regexp_replace(F.lower(name), "[^a-z0-9_-]", "_")
    return F.when(clean.startswith("_"), F.concat(F.lit("idx"), clean)).otherwise(clean)


def table_index_name(schema: Column, table: Column) -> Column:
    empty = F.lit("")
    return index_name(F.concat(F.coalesce(schema, empty), F.lit("_"), F.coalesce(table, empty)))


def normalise_values(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text in UTC, dates as text."""

    def one(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return V.iso_instant(F.col(field.name)).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[one(f) for f in df.schema])


def content_hash(columns: list[str]) -> Column:
    """Hash of the non-null values, whatever the column order."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])), 256)


def documents(
    df: DataFrame,
    query: str,
    synced_at: str | Column,
    id_column: str | None = "id",
    index: str | None = None,
    schema: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """One document per row: its columns, id, index, statement and time of sync."""
    key = actual_column(df, id_column)
    rows = normalise_values(df)
    hashed = content_hash(df.columns)
    tail = hashed if key is None else F.coalesce(F.col(key).cast("string"), hashed)
    stamp = F.lit(synced_at) if isinstance(synced_at, str) else synced_at
    extra = {
        name: F.lit(value) for name, value in (("_schema", schema), ("_table", table)) if value
    }
    return rows.select(
        index_name(F.lit(index or query)).alias("_index"),
        F.concat(F.lit(query), F.lit("_"), tail).alias("_id"),
        *df.columns,
        F.lit(query).alias("_query"),
        stamp.alias("_sync_timestamp"),
        *[value.alias(name) for name, value in extra.items()],
    )


def strip_prefix(doc_id: Column, statements: list[str]) -> Column:
    """The id without the name of its statement, the longest name first."""
    names = sorted({s for s in statements if s}, key=len, reverse=True)
    cut = [
        F.when(doc_id.startswith(f"{n}_"), F.substring(doc_id, F.lit(len(n) + 2), F.length(doc_id)))
        for n in names
    ]
    return F.coalesce(*cut, doc_id)


def map_identifiers(
    df: DataFrame, table: str, names: dict[str, str] | None = None, schema: str = "PUBLIC"
) -> tuple[str, DataFrame]:
    """Target name and frame with upper-case columns.

    ``names`` maps source tables, in any case, to target tables; a table without an
    entry is upper-cased, and a table without a schema gets the default one.
    """
    known = {k.lower(): v for k, v in (names or {}).items()}
    own, _, plain = table.rpartition(".")
    target = known.get(plain.lower(), plain.upper())
    return (
        f'"{(own or schema).upper()}"."{target}"',
        df.toDF(*[c.upper() for c in df.columns]),
    )


def text_fields(df: DataFrame, id_column: str | None = None) -> list[str]:
    """Character columns other than the id: those that get full-text treatment."""
    key = actual_column(df, id_column)
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name != key
    ]


def list_indices(docs: DataFrame) -> DataFrame:
    return docs.select("_index").distinct()


def all_indices(*docs: DataFrame) -> DataFrame:
    """Documents of several indices as one table.

    Fields an index lacks are null; a field with unlike types becomes text.
    """
    types: dict[str, set[str]] = {}
    for df in docs:
        for f in df.schema:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    mixed = {name for name, kinds in types.items() if len(kinds) > 1}
    same = [
        df.withColumns({c: F.col(c).cast("string") for c in df.columns if c in mixed})
        for df in docs
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)
